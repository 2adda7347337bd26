"""Splitting oversized texts at natural boundaries.

Possible cuts are the ends of paragraphs, lines and sentences, and where these
lie far apart also those of clauses, and of words and pre-tokens on a fine grid.
Dynamic programming over the
cuts finds the pieces with the least sum of cut penalties and size imbalance
under the limit, with the overlap counted in. Texts with like numbers of cuts
are solved together, one numpy step for all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm.tokens import Counter, counter, default_path

#: Penalties of cutting at a paragraph, line, sentence, clause, word, or elsewhere; weight of the imbalance.
PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, INSIDE = 0.0, 0.5, 1.0, 2.0, 4.0, 8.0
BALANCE = 4.0
_BREAK = re.compile(r"[.!?…][\"'»”’)\]]*\s+|\n\s*")


_SPACES = np.array([*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], dtype="uint32")
_COMMAS = np.array([ord(c) for c in ",;:|"], dtype="uint32")
_IS_SPACE, _IS_COMMA = np.zeros(0x3002, bool), np.zeros(0x3002, bool)
_IS_SPACE[_SPACES], _IS_COMMA[_COMMAS] = True, True


def _codes(chars: Iterator[str]) -> np.ndarray:
    """Code points, all beyond the last white space as one."""
    return np.minimum(np.frombuffer("".join(chars).encode("utf-32-le"), dtype="<u4"), 0x3001)


class Prepared:
    """A text with what all limits share: parts, running sums of tokens and characters, and its natural cuts. `whole` is its size; `halved` tells that a pre-token was cut, so that sums of its parts' tokens are no exact sizes."""

    def __init__(self, number: int, text: str, count: Counter, most: int) -> None:
        pretokens = count.pretokens(text)
        sizes = count.counts(pretokens)
        self.number, self.text, self.whole, self.one, self.count = number, text, int(sizes.sum()), count.one, count.count
        parts, counts, self.halved = count.parts(pretokens, sizes, most)
        self.parts = parts
        n = len(parts)
        self.tokens, self.chars = np.zeros(n + 1, "int64"), np.zeros(n + 1, "int64")
        np.cumsum(counts, out=self.tokens[1:])
        np.cumsum(np.fromiter(map(len, parts), dtype="int64", count=n), out=self.chars[1:])
        at, cost = [], []
        for m in _BREAK.finditer(text):
            e, lines = m.end(), m.group().count("\n")
            at.append(e - 1 if text[e - 1] == " " and e < len(text) else e)
            cost.append(PARAGRAPH if lines > 1 else LINE if lines else SENTENCE)
        place = np.array(at, dtype="int64")
        index = np.searchsorted(self.chars, place)
        good = (index > 0) & (index < n) & (self.chars[np.minimum(index, n)] == place)
        index, first = np.unique(index[good], return_index=True)
        self.index = np.concatenate([[0], index, [n]]).astype("int64")
        self.cost = np.concatenate([[0.0], np.array(cost, dtype="float64")[good][first], [0.0]])
        self._inner: np.ndarray | None = None
        self._ends: np.ndarray | None = None
        self.last = _codes(map(itemgetter(-1), parts))
        self.blank = _IS_SPACE[self.last]  # a pre-token that ends in white space is nothing else

    def inner(self) -> np.ndarray:
        """Penalty of a cut before each part that is no natural one."""
        if self._inner is None:
            here = _IS_SPACE[_codes(map(itemgetter(0), self.parts))]
            last = np.concatenate([[0], self.last[:-1]])
            self._inner = np.where(here & _IS_COMMA[last], CLAUSE, np.where(here | _IS_SPACE[last], WORD, INSIDE))
        return self._inner

    def cuts(self, step: int) -> tuple[np.ndarray, np.ndarray]:
        """(indices, penalties): cuts before parts[i], in order, from 0 to the end.

        Where natural cuts are more than step tokens apart, of the boundaries
        between them the cheapest (of equals the last) of every step / 16 tokens
        joins in: one left out is dearer, or differs by that much imbalance.
        """
        at = self.tokens[self.index]
        wide = np.flatnonzero(np.diff(at) > step)
        if not len(wide):
            return self.index, self.cost
        more = np.concatenate([np.arange(self.index[w] + 1, self.index[w + 1]) for w in wide])
        gap = np.repeat(wide, self.index[wide + 1] - self.index[wide] - 1)
        price, stretch = self.inner()[more], self.tokens[more] * 16 // step
        order = np.lexsort((-more, price, stretch, gap))
        same = (np.diff(gap[order]) == 0) & (np.diff(stretch[order]) == 0)
        picked = order[np.concatenate([[True], ~same])] if len(order) else order
        index, cost = np.concatenate([self.index, more[picked]]), np.concatenate([self.cost, price[picked]])
        order = np.argsort(index, kind="stable")
        return index[order], cost[order]

    def ends(self, index: np.ndarray) -> np.ndarray:
        """Tokens up to each cut of a piece that ends there: white space at its end is one pre-token then."""
        if self._ends is None:
            self._ends = self.tokens.copy()
            blank = self.blank
            for b in (np.flatnonzero(blank[1:] & blank[:-1]) + 2).tolist():
                e = b
                while e > 0 and blank[e - 1]:
                    e -= 1
                self._ends[b] = self.tokens[e] + self.one("".join(self.parts[e:b]))
        return self._ends[index]


def solve(ends: list[np.ndarray], starts: list[np.ndarray], costs: list[np.ndarray], limit: int, overlap: int) -> list[list[int]]:
    """For each text the cuts of the best pieces, as positions in its lists (the last included).

    ends: tokens before each cut; starts: tokens before the place where a
    piece after that cut begins (the cut less the overlap); costs: penalties.
    """
    out: list[list[int]] = [[] for _ in ends]
    order = sorted(range(len(ends)), key=lambda i: len(ends[i]))
    for lo in range(0, len(order), 96):
        group = order[lo : lo + 96]
        n, width = len(group), len(ends[group[-1]])
        e, s = np.full((n, width), 1 << 30, dtype="int32"), np.zeros((n, width), dtype="int32")
        c, total = np.zeros((n, width)), np.zeros(n)
        for r, i in enumerate(group):
            k = len(ends[i])
            e[r, :k], s[r, :k], c[r, :k], total[r] = ends[i], starts[i], costs[i], ends[i][-1]
        count = np.maximum(1, np.ceil((total - overlap) / (limit - overlap)))
        target = (total + (count - 1) * overlap) / count
        root = BALANCE**0.5  # the imbalance is (root * size / target - root) squared
        scale = (root / target)[:, None]
        cost, back = np.full((n, width), np.inf), np.zeros((n, width), dtype="int32")
        cost[:, 0] = 0
        near = 0  # the first cut from which any text's piece still fits
        for j in range(1, width):
            while near < j - 1 and not (e[:, j] - s[:, near] <= limit).any():
                near += 1
            size = e[:, j, None] - s[:, near:j]
            worth = size * scale
            worth -= root
            np.square(worth, out=worth)
            worth += cost[:, near:j]
            worth[size > limit] = np.inf
            pick = worth.argmin(axis=1)
            back[:, j] = pick + near
            cost[:, j] = worth[np.arange(n), pick] + c[:, j]
        for r, i in enumerate(group):
            j, cuts = len(ends[i]) - 1, []
            while j > 0:
                cuts.append(j)
                j = int(back[r, j])
            out[i] = cuts[::-1]
    return out


def _solved(todo: list[Prepared], limit: int, overlap: int) -> list[list[tuple[int, int, int]]]:
    """(start, end, tokens) in characters of the pieces of each text."""
    index, costs, ends, begins = [], [], [], []
    for p in todo:
        at, cost = p.cuts(max(1, (limit - overlap) // 4))
        end = p.ends(at)
        begin = np.maximum(np.searchsorted(p.tokens, end - overlap, side="right") - 1, 0) if overlap else at.copy()
        begin[0] = 0
        index.append(at)
        costs.append(cost)
        ends.append(end)
        begins.append(begin)
    out = []
    for p, at, end, begin, cuts in zip(todo, index, ends, begins, solve(ends, [p.tokens[b] for p, b in zip(todo, begins, strict=True)], costs, limit, overlap), strict=True):
        found, last = [], 0
        for j in cuts:
            a, b = int(begin[last]), int(at[j])
            found.append((int(p.chars[a]), int(p.chars[b]), int(end[j] - p.tokens[a])))
            last = j
        out.append(found)
    return out


def pieces(n_texts: int, prepared: list[Prepared], limit: int, overlap: int) -> list[list[tuple[int, int, int]]]:
    """(start, end, tokens) in characters of the pieces of each text over the limit; tokens as the piece has them by itself.

    Texts with a pre-token cut inside are measured again piece by piece, and
    solved again with a little less room or more overlap until all fit.
    """
    if limit - overlap < 8:
        raise ValueError("the limit must exceed the overlap by eight tokens at least")
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n_texts)]
    todo = [p for p in prepared if p.whole > limit]
    for p, found in zip(todo, _solved(todo, limit, overlap), strict=True):
        less = more = 0
        while p.halved:
            found = [(a, b, p.count(p.text[a:b])) for a, b, _ in found]
            large = max(n for *_, n in found) > limit
            short = any(p.count(p.text[y[0] : x[1]]) < overlap for x, y in zip(found, found[1:], strict=False)) if overlap else False
            if not (large or short) or limit - less - overlap - more <= 8:
                break
            less, more = less + large, more + short
            (found,) = _solved([p], limit - less, overlap + more)
        out[p.number] = found
    return out


def split(documents: DataFrame, limits: list[tuple[int, int, int]], *, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(limit_id, key, piece, start_char, end_char, tokens, piece_text) of the texts over a limit, for each (limit_id, tokens, overlap).

    Consecutive pieces share the stated overlap: the later one begins at the
    last pre-token that gives at least that many common tokens. Together the
    pieces cover the whole text. Texts within the limit, empty and null ones
    give no rows; repeated rows are split alike. Sizes are those of texts and
    pieces tokenized by themselves. Only a pre-token of more tokens than an
    eighth of the room (limit less overlap, of the tightest limit) is ever cut
    inside. A limit must exceed its overlap by eight tokens, as a character may
    have four.
    """
    path = path or default_path()
    limits = sorted(limits)
    most = min((max(4, (limit - overlap) // 8) for _, limit, overlap in limits), default=4)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                b = whole.slice(lo, 2048)
                keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                prepared = []
                for i, t in enumerate(texts):
                    if limits and len(t.encode()) > min(x[1] for x in limits):  # a token has a byte at least
                        prepared.append(Prepared(i, t, count, most))
                for limit_id, limit, overlap in limits:
                    rows = [(limit_id, keys[i], k, a, z, n, texts[i][a:z]) for i, found in enumerate(pieces(len(texts), prepared, limit, overlap)) for k, (a, z, n) in enumerate(found)]
                    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], names=["limit_id", key, "piece", "start_char", "end_char", "tokens", "piece_text"])

    return documents.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(cut, f"limit_id int, {key} bigint, piece int, start_char int, end_char int, tokens int, piece_text string")
