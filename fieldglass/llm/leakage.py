"""Held-out texts that leak into a corpus: a prefix-filtered set join on word shingles.

A run of 12 or more words of an item with at most one word in ten altered has 6
untouched words in a row somewhere, that is two shingles of five words side by
side. Of any two neighbouring shingles of an item the rarer in the corpus is
therefore enough to look for: these are the item's prefix. Documents are
scanned once; what they share with the items' shingles is counted (rarity),
joined with the prefixes, bounded by position (both shingles on one diagonal),
and verified word by word over item-sized windows. Items, shingles and
candidates are tables; only where the items' distinct shingles are few enough
are they broadcast, to leave the others out of the scan's output.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.session import cut

SHINGLE = 5
#: Letters of other scripts that look like Latin ones; marks and invisible characters that readers don't see.
LOOKALIKES = dict(zip("аеорсухіјѕԁһӏьгкмнтвкАВЕКМНОРСТУХІЈЅαορνικτ", "aeopcyxijsdhlbrkmhtbkABEKMHOPCTYXIJSaopvikt", strict=True))
_UNSEEN = {c: None for c in [*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0xFEFF, *range(0xFE00, 0xFE10)]}
_TABLE = _UNSEEN | {ord(a): b for a, b in LOOKALIKES.items()}
_INLINE = re.compile(r"</?(?:a|abbr|b|code|em|font|i|mark|s|small|span|strong|sub|sup|u|wbr)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[/!]?[a-zA-Z][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_WRITTEN = re.compile(r"[^\W_]+(?:[-\u2010-\u2015'’][^\W_]+)*")


def visible(text: str | None) -> str:
    """A text as a reader sees it: no markup, entities, invisible characters, accents, look-alike letters or case."""
    if not text:
        return ""
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_TABLE)
    return text.lower()


def words(text: str | None) -> list[str]:
    """The words of a text as a reader sees them."""
    return _WORD.findall(visible(text))


def word_numbers(text: str | None) -> list[int]:
    """For each of an item's words() the number of the written word it is part of (throw-in is one)."""
    out: list[int] = []
    for i, w in enumerate((text or "").split()):
        out += [i] * len(words(w))
    return out


_hashes: dict[str, int] = {}


def word_ids(ws: list[str]) -> np.ndarray:
    """A 64-bit number of every word, kept for words already met."""
    if len(_hashes) > 1_000_000:
        _hashes.clear()
    try:
        return np.fromiter(map(_hashes.__getitem__, ws), dtype="int64", count=len(ws))
    except KeyError:
        for w in ws:
            if w not in _hashes:
                _hashes[w] = xxhash.xxh3_64_intdigest(w) >> 1
        return np.fromiter(map(_hashes.__getitem__, ws), dtype="int64", count=len(ws))


def shingle_keys(ids: np.ndarray) -> np.ndarray:
    """A 64-bit key of every run of five word ids."""
    n = len(ids) - SHINGLE + 1
    if n < 1:
        return np.empty(0, "int64")
    x = ids.astype("uint64")
    key = np.zeros(n, "uint64")
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            key = (key ^ (x[i : i + n] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
    return (key >> np.uint64(1)).astype("int64")


def _numbers(seen: str) -> np.ndarray:
    """For each word of a visible() text the number of the written word it is part of: words joined by a hyphen or apostrophe are one, whatever else stands between others."""
    counts = [1 if w.isalnum() else len(_WORD.findall(w)) for w in _WRITTEN.findall(seen)]
    return np.repeat(np.arange(len(counts), dtype="int32"), counts)


def _reach(doc: list[int], doc_numbers: list[int], item: list[int], numbers: list[int], most: int) -> list[int]:
    """For 0, 1, .. `most` altered words the furthest word of the item up to which its beginning matches the document's; 0 if none does.

    An alteration replaces, adds or leaves out a written word or words in it. All ways are followed, the furthest on each diagonal
    standing for the nearer ones; matching ends with a word both have.
    """
    nd, ni = len(doc), len(item)

    def along(i: int, d: int) -> int:
        n = i
        while n < ni and d < nd and item[n] == doc[d]:
            n, d = n + 1, d + 1
        return n - i

    n = along(0, 0)
    found, level = [n], {0: (n, n)}  # diagonal: (words of the item done, words in the stretch they end with)
    seen = dict.fromkeys(level, n)
    for _ in range(most):
        after: dict[int, int] = {}
        best = found[-1]
        for diagonal, (i, back) in level.items():
            d = i + diagonal
            # a stretch that ends inside a written word may also be left where that word begins
            starts = {i}
            k = i
            while k > i - back and ((k < ni and numbers[k] == numbers[k - 1]) or (k + diagonal < nd and doc_numbers[k + diagonal] == doc_numbers[k + diagonal - 1])):
                k -= 1
                starts.add(k)
            for i in starts:
                d = i + diagonal
                gi = gd = 0
                while i + gi < ni and numbers[i + gi] == numbers[i]:
                    gi += 1
                while d + gd < nd and doc_numbers[d + gd] == doc_numbers[d]:
                    gd += 1
                for x in range(gi + 1):
                    for y in range(gd + 1):
                        if x or y:
                            at = diagonal + y - x
                            if i + x > best and d + y and item[i + x - 1] == doc[d + y - 1]:
                                best = i + x
                            if after.get(at, -1) < i + x and seen.get(at, -1) < i + x:
                                after[at] = i + x
        level = {}
        for at, i in after.items():
            n = along(i, i + at)
            if n:
                best = max(best, i + n)
            if seen.get(at, -1) < i + n:
                seen[at] = i + n
            level[at] = (i + n, n)
        found.append(best)
        if not level:
            break
    return found


def most_altered(least: int, per: int) -> int:
    """How many altered words a run must be allowed to have for every longer run to be found by a part of it.

    Let a run of n words have m altered, m * per <= n, and let no two neighbouring untouched
    stretches with the alteration between them make `least` words. Adding these up, first and last
    stretch have (2 * per - least) * m words at least, and being under `least` each, m is bounded.
    """
    return max(1, 2 * (least - 1) // (2 * per - least)) if 2 * per > least else 1 << 30


def run_through(doc: list[int], doc_numbers: list[int], item: list[int], numbers: list[int], d: int, i: int, least: int = 12, per: int = 10) -> int:
    """Words of a run through document word d and item word i, which match, of `least` words or more with at most one in `per` altered; 0 if there is none.

    Altered means replaced, added or left out, counted in written words. A run begins and ends with words both have.
    """
    lo, hi, nd, ni = 0, 0, len(doc), len(item)
    while i - lo > 0 and d - lo > 0 and item[i - lo - 1] == doc[d - lo - 1]:
        lo += 1
    while i + hi + 1 < ni and d + hi + 1 < nd and item[i + hi + 1] == doc[d + hi + 1]:
        hi += 1
    if (n := numbers[i + hi] - numbers[i - lo] + 1) >= least:
        return n
    most = min((numbers[-1] + 1) // per, most_altered(least, per))
    room = len(item) + most  # written words of the document that can matter on a side
    first, last = bisect_left(doc_numbers, doc_numbers[d] - room), bisect_right(doc_numbers, doc_numbers[d] + room)
    ends = _reach(doc[d:last], doc_numbers[d:last], item[i:], numbers[i:], most)
    starts = _reach(doc[first:d][::-1], doc_numbers[first:d][::-1], item[:i][::-1], numbers[:i][::-1], most)
    best = 0
    for x, s in enumerate(starts):
        for y, t in enumerate(ends):
            n = numbers[i + t - 1] - numbers[i - s] + 1
            if n >= least and (x + y) * per <= n:
                best = max(best, n)
    return best


def leaks(documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, per: int = 10, known_keys: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, words): documents that hold `least` or more consecutive words of an item, at most one in `per` altered, with the length of a run found.

    Null and empty texts on either side leak nothing; items under `least` words
    neither. Repeated documents come out once per id and row content; items of
    equal text are each reported. Whole texts are scanned, all documents
    counted. Up to known_keys distinct shingles of items are broadcast (8 bytes
    each, and 20 for the items' words beside them) and shingles no item has dropped in the scan; beyond that all of a
    document's shingles go to the join, and items to a shuffle. Other columns are ignored.
    """
    spark = documents.sparkSession

    def read_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ws, numbers = words(text.as_py()), word_numbers(text.as_py())
                numbers = numbers if len(numbers) == len(ws) else list(range(len(ws)))
                if ws and numbers[-1] + 1 >= least:
                    ids = word_ids(ws)
                    out.append((key, ids.tobytes(), np.array(numbers, "int32").tobytes(), shingle_keys(ids).tolist()))
            kinds = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], kind) for j, kind in enumerate(kinds)], names=["item", "wanted", "numbers", "keys"])

    held = cut(items.select(F.col(item_id).cast("bigint").alias("item"), F.col(item_text)).dropna().mapInArrow(read_items, "item bigint, wanted binary, numbers binary, keys array<bigint>"))
    index = held.select("item", F.posexplode("keys").alias("pos", "key"))
    distinct = index.select("key").distinct()
    few = distinct.limit(known_keys + 1).count() <= known_keys
    shared = spark.sparkContext.broadcast(np.sort(np.array([r.key for r in distinct.collect()], "int64")) if few else None)  # bounded by known_keys

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = shared.value
        for batch in batches:
            ids_out, hit_out, at_out, doc_out, num_out = [], [], [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = visible(text.as_py())
                ids = word_ids(_WORD.findall(seen))
                found = shingle_keys(ids)
                if not len(found) or (keys is not None and not len(keys)):
                    continue
                if keys is None:
                    at = np.arange(len(found))
                else:
                    spot = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                    hit = keys[spot] == found
                    side = np.zeros(len(hit) + 2, bool)
                    side[1:-1] = hit
                    at = np.flatnonzero(hit & (side[:-2] | side[2:]))  # six untouched words are two shingles side by side
                if len(at):
                    ids_out.append(key)
                    hit_out.append(found[at])
                    at_out.append(at.astype("int32"))
                    doc_out.append(ids.tobytes())
                    num_out.append(np.packbits(np.diff(_numbers(seen), prepend=-1) > 0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids_out, pa.int64()), pa.array(hit_out, pa.list_(pa.int64())), pa.array(at_out, pa.list_(pa.int32())), pa.array(doc_out, pa.binary()), pa.array(num_out, pa.binary())], names=["doc", "hits", "at", "ids", "begins"])

    touched = cut(documents.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(doc_text)).dropna().mapInArrow(scan, "doc bigint, hits array<bigint>, at array<int>, ids binary, begins binary").withColumn("copy", F.xxhash64("doc", "ids")))
    spread = touched.select("doc", "copy", F.posexplode("hits").alias("n", "key"), "at").select("doc", "copy", "key", F.expr("element_at(at, n + 1)").alias("d"))
    rarity = spread.join(distinct, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    index = index.join(rarity, "key", "left").fillna(0, ["df"])
    after = index.select("item", (F.col("pos") - 1).alias("pos"), F.col("key").alias("key2"), F.col("df").alias("df2"))
    # of two neighbours the rarer is looked for; an item's prefix is the set of these
    pairs = index.join(after, ["item", "pos"])
    first = F.struct("df", "key") <= F.struct("df2", "key2")
    prefix = pairs.select("item", F.when(first, F.col("pos")).otherwise(F.col("pos") + 1).alias("pos"), F.when(first, F.col("key")).otherwise(F.col("key2")).alias("key")).distinct()
    candidates = spread.join(prefix, "key").groupBy("doc", "copy", "item").agg(F.collect_set(F.struct("d", "pos")).alias("anchors"))
    asked = held.select("item", "wanted", "numbers").dropDuplicates()
    # the items' words are joined before the documents': these are the larger
    found = candidates.join(F.broadcast(asked) if few else asked, "item").join(touched.select("doc", "copy", "ids", "begins"), ["doc", "copy"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, item, anchors, raw, begins, want, nums in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                ids, wanted, numbers = np.frombuffer(raw, "int64").tolist(), np.frombuffer(want, "int64").tolist(), np.frombuffer(nums, "int32").tolist()
                doc_numbers = np.cumsum(np.unpackbits(np.frombuffer(begins, "uint8"), count=len(ids))).tolist()
                tried: dict[int, int] = {}  # diagonal: where the last stretch tried ends
                for a in sorted(anchors, key=lambda x: (x["d"], x["pos"])):
                    d, i = a["d"], a["pos"]
                    if i < tried.get(d - i, 0) or ids[d : d + SHINGLE] != wanted[i : i + SHINGLE]:
                        continue
                    neighbour = (i + SHINGLE < len(wanted) and d + SHINGLE < len(ids) and ids[d + SHINGLE] == wanted[i + SHINGLE]) or (i > 0 and d > 0 and ids[d - 1] == wanted[i - 1])
                    if neighbour and (n := run_through(ids, doc_numbers, wanted, numbers, d, i, least, per)):
                        out.append((doc, item, n))
                        break
                    e = i
                    while e < len(wanted) and d - i + e < len(ids) and ids[d - i + e] == wanted[e]:
                        e += 1
                    tried[d - i] = e
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=["doc_id", "item_id", "words"])

    return found.select("doc", "item", "anchors", "ids", "begins", "wanted", "numbers").mapInArrow(verify, "doc_id bigint, item_id bigint, words bigint").distinct()
