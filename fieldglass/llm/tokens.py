"""Token counts of a public byte-level BPE tokenizer, by pre-token.

A text's tokens are the sum over its pre-tokens, so counts are kept per
distinct pre-token and a text is cut into pre-tokens only once.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np

#: The tokenizer's pre-token pattern (a fixed value), and the same in the standard library's syntax.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: How many pre-tokens' counts a worker keeps, and up to which length.
KEPT, SHORT = 2_000_000, 64


def default_path() -> str:
    """The vocabulary file: FIELDGLASS_TOKENIZER, else the installed public one."""
    named = os.environ.get("FIELDGLASS_TOKENIZER")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(1)
def _odd() -> frozenset[str]:
    """Characters the two regex engines class differently: numerals that are neither letters nor decimal digits, and separators that only one counts as space."""
    import unicodedata

    # beyond the second plane there are no numerals
    return frozenset(c for c in map(chr, range(0x20000)) if "\x1c" <= c <= "\x1f" or (c.isalnum() and unicodedata.category(c) in ("No", "Nl")))


class Counter:
    """Counts tokens; one per Python worker and vocabulary file (see counter())."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}
        self.exact = None

    def pretokens(self, text: str) -> list[str]:
        if not _odd().isdisjoint(text):
            import regex

            self.exact = self.exact or regex.compile(PATTERN)
            return self.exact.findall(text)
        return _FAST.findall(text)

    def one(self, pretoken: str) -> int:
        n = self.known.get(pretoken)
        if n is None:
            n = len(self.encoding.encode_ordinary(pretoken))
            if len(pretoken) > SHORT:
                return n
            if len(self.known) < KEPT:
                self.known[pretoken] = n
        return n

    def counts(self, pretokens: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, pretokens), dtype="int64", count=len(pretokens))
        except KeyError:
            new = {p: self.one(p) for p in set(pretokens) if p not in self.known}  # long ones are not kept
            known = self.known.get
            return np.fromiter((known(p) or new[p] for p in pretokens), dtype="int64", count=len(pretokens))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return int(self.counts(self.pretokens(text)).sum())

    def parts(self, pretokens: list[str], counts: np.ndarray, most: int) -> tuple[list[str], np.ndarray, bool]:
        """Pre-tokens with their counts, those of more than `most` tokens halved until no part has more; and whether any was."""
        if not len(counts) or counts.max() <= most:
            return pretokens, counts, False
        out: list[str] = []
        for p, n in zip(pretokens, counts.tolist(), strict=True):
            todo = [(p, n)]
            while todo:
                x, n = todo.pop()
                if n <= most or len(x) < 2:
                    out.append(x)
                else:
                    half = len(x) // 2
                    todo += [(y, self.one(y)) for y in (x[half:], x[:half])]
        return out, self.counts(out), True


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)
