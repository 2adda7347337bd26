"""Filling containers of fixed capacity with items of varying length.

The plan is made on the histogram of lengths, which has at most as many entries
as the capacity, whatever the number of items. Exact-complement search fills
containers to the last token: the sums of one, two and three available lengths
are an index in which the gap beside a length is looked up, and a combination
is used as often as its rarest length allows. What finds no complement goes
best-fit into the smallest gap left. Items are then told their place by their
rank among the items of their length; ranks come from counts per bucket, so a
length that a third of all items share is no hot spot.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter as Bag
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.llm.tokens import counter, default_path
from fieldglass.session import cut


def token_counts(documents: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """(key, tokens): tokens of whole texts; 0 for null and empty ones. Repeated rows stay."""
    path = path or default_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.count(t.as_py()) for t in b.column(1)], pa.int64())], names=[key, "tokens"])

    return documents.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(count, f"{key} bigint, tokens bigint")


class _Sums:
    """Index of the sums of two available lengths, kept current as lengths run out."""

    def __init__(self, have: np.ndarray) -> None:
        self.have = have
        self.there = np.flatnonzero(have > 0)
        self.pairs = np.zeros(len(have), dtype="int64")
        for a in self.there:
            self._add(int(a), 1, self.there[self.there >= a])

    def _add(self, a: int, sign: int, others: np.ndarray) -> None:
        s = others + a
        np.add.at(self.pairs, s[s < len(self.pairs)], sign)

    def gone(self, a: int) -> None:
        self._add(a, -1, self.there)
        self.there = self.there[self.there != a]

    def two(self, gap: int, used: Bag) -> tuple[int, int] | None:
        if gap < 2 or self.pairs[gap] <= 0:
            return None
        a = self.there[(self.there <= gap - 1) & (self.there * 2 >= gap)]
        for x in a[self.have[gap - a] > 0][::-1]:
            need = used + Bag((int(x), int(gap - x)))
            if all(self.have[k] >= v for k, v in need.items()):
                return int(x), int(gap - x)
        return None

    def three(self, gap: int, used: Bag) -> tuple[int, int, int] | None:
        a = self.there[(self.there <= gap - 2) & (self.there * 3 >= gap)]
        for x in a[self.pairs[gap - a] > 0][::-1]:
            if rest := self.two(int(gap - x), used + Bag((int(x),))):
                return int(x), *rest
        return None


def plan(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, dict[int, int]]]:
    """Groups of equally filled containers: (first container, how many, items of each length in one). lengths: count of items by length, 1 to capacity."""
    have = np.zeros(capacity + 1, dtype="int64")
    for k, v in lengths.items():
        have[k] = v
    sums = _Sums(have)
    groups: list[tuple[int, int, dict[int, int]]] = []
    nxt = 0

    def use(items: tuple[int, ...]) -> int:
        nonlocal nxt
        bag = Bag(items)
        times = min(int(have[k]) // v for k, v in bag.items())
        groups.append((nxt, times, dict(bag)))
        nxt += times
        for k, v in bag.items():
            have[k] -= v * times
            if have[k] == 0:
                sums.gone(k)
        return times

    for x in range(capacity, 0, -1):
        while have[x] > 0:
            gap, used = capacity - x, Bag((x,))
            if gap == 0:
                use((x,))
            elif have[gap] > (gap == x):
                use((x, gap))
            elif two := sums.two(gap, used):
                use((x, *two))
            elif three := sums.three(gap, used):
                use((x, *three))
            else:
                break
    # best fit for the rest, longest first: the smallest gap that takes it, else a new container
    open_: list[tuple[int, int]] = []  # (gap, number of the set), sorted
    sets: list[list] = []  # count, bag
    for x in range(capacity, 0, -1):
        n = int(have[x])
        while n:
            at = bisect_left(open_, (x, -1))
            if at < len(open_):
                gap, i = open_.pop(at)
                count = min(sets[i][0], n)  # the others of this set stay as they are
                sets[i][0] -= count
                if sets[i][0]:
                    insort(open_, (gap, i))
                sets.append([count, sets[i][1] + Bag((x,))])
                insort(open_, (gap - x, len(sets) - 1))
                n -= count
            else:
                per = min(capacity // x, n)
                count = n // per
                sets.append([count, Bag({x: per})])
                insort(open_, (capacity - x * per, len(sets) - 1))
                n -= count * per
    for count, bag in sets:
        if count:
            groups.append((nxt, count, dict(bag)))
            nxt += count
    return groups


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], *, key: str = "doc_id", rows_per_bucket: int = 200_000) -> DataFrame:
    """(limit_id, key, piece, tokens, container): every item's container, for each capacity (limit_id, tokens).

    sizes: key, `tokens`. An item is split only if it alone exceeds the
    capacity: into pieces of full capacity and a rest. Items of no tokens (and
    of null size) go to container 0. Repeated rows are items of their own; rows
    with a null key are packed too. No capacities or no items give no rows.
    """
    spark = sizes.sparkSession
    limits = spark.createDataFrame(capacities, "limit_id int, capacity bigint")
    base = sizes.select(F.col(key), F.coalesce("tokens", F.lit(0)).cast("bigint").alias("size"))
    n = base.count()
    buckets = max(1, -(-n * max(1, len(capacities)) // rows_per_bucket))
    many = F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("capacity"))).cast("int")
    items = base.join(F.broadcast(limits)).withColumn("piece", F.explode(F.sequence(F.lit(0), many - 1)))  # as many limits as the caller lists
    items = items.withColumn("tokens", F.least("capacity", F.col("size") - F.col("piece") * F.col("capacity"))).withColumn("bucket", F.pmod(F.xxhash64(key, "piece"), F.lit(buckets)))
    items = cut(items.select("limit_id", key, "piece", "tokens", "bucket"))
    per_bucket = items.groupBy("limit_id", "tokens", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("limit_id", "tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram: dict[int, dict[int, int]] = {}
    for r in per_bucket.filter("tokens > 0").groupBy("limit_id", "tokens").agg(F.sum("n").alias("n")).collect():  # at most the capacity's number of rows by limit
        histogram.setdefault(r.limit_id, {})[r.tokens] = r.n
    places = []
    for limit_id, capacity in capacities:
        taken: Bag = Bag()
        for first, count, bag in plan(histogram.get(limit_id, {}), capacity):
            for length, per in bag.items():
                places.append((limit_id, length, taken[length], first, per))
                taken[length] += count * per
    slots = {k: i for i, k in enumerate(sorted({(p[0], p[1]) for p in places}))}
    places.sort(key=lambda p: (slots[p[0], p[1]], p[2]))
    mark = np.array([(slots[p[0], p[1]] << 44) + p[2] for p in places] or [0], dtype="int64")
    start, first, per = (np.array([p[j] for p in places] or [0], dtype="int64") for j in (2, 3, 4))
    shared = spark.sparkContext.broadcast((slots, mark, start, first, per))  # bounded by the capacities
    within = Window.partitionBy("limit_id", "tokens", "bucket").orderBy(key, "piece")
    ranked = items.withColumn("rank", F.row_number().over(within) - 1).join(offsets.select("limit_id", "tokens", "bucket", "before"), ["limit_id", "tokens", "bucket"])

    @F.pandas_udf("bigint")
    def container(limit_id: pd.Series, tokens: pd.Series, rank: pd.Series) -> pd.Series:
        slots, mark, start, first, per = shared.value
        slot = np.array([slots.get(k, -1) for k in zip(limit_id.tolist(), tokens.tolist(), strict=True)], dtype="int64")
        at = np.clip(np.searchsorted(mark, (slot << 44) + rank.to_numpy(), side="right") - 1, 0, None)
        return pd.Series(np.where(slot < 0, 0, first[at] + (rank.to_numpy() - start[at]) // per[at]))

    return ranked.select("limit_id", key, "piece", "tokens", container("limit_id", "tokens", F.col("rank") + F.col("before")).alias("container"))
