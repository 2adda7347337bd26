"""References to records that do not exist.

Parents are reduced to one row per key, range-partitioned by key, and held as a
sorted array per range. References are cut into blocks of one range each and
probe that array by binary search, a whole Arrow batch at a time. A key that
holds a large share of the references fills several blocks of its range, each
with its own copy of the range's parents, so no task grows with a hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldglass.session import cut


def _prefix(key_hex: Column) -> Column:
    """The first 60 bits of a hex key as a number: ranges are cut on it."""
    return F.conv(F.substring(key_hex, 1, 15), 16, 10).cast("bigint")


def _range_of(prefix: Column, bounds: list[int]) -> Column:
    if not bounds:
        return F.lit(0)
    edges = np.array(bounds, dtype="int64")

    @F.pandas_udf("int")
    def locate(s):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(np.searchsorted(edges, s.to_numpy(), side="right").astype("int32"))

    return locate(prefix)


def _fixed(column: pa.ChunkedArray) -> np.ndarray:
    """A binary column of 16 bytes per value as a numpy array, without copying values one by one."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.binary())
    fixed = array.cast(pa.binary(16))
    return np.frombuffer(fixed.buffers()[1], dtype="S16")[fixed.offset : fixed.offset + len(fixed)] if len(fixed) else np.empty(0, "S16")


def failing_references(refs: DataFrame, parents: DataFrame, *, carry: list[str], rows_per_range: int = 200_000, refs_per_block: int = 500_000) -> DataFrame:
    """The references that fail, as the `carry` columns plus `reason`: missing, deleted or late.

    refs: `key_hex` (32 hex digits, or null for a text that is no key at all),
    `ref_us` (time of the reference in microseconds) and the carry columns; one
    row per reference that is to be judged, repeats included. parents: one or
    more rows per key with `key_hex`, `seen_us` (when that row appeared),
    `order_us` and `order_row` (the last row by these decides) and `gone`
    (bool). Parents with a null key are ignored. A null reference key is
    missing; a null time on either side never makes a reference late; null
    `order_us` sorts first. Either table may be empty. Other columns are ignored.
    """
    fields = [f for f in refs.schema.fields if f.name in carry]
    schema = T.StructType([next(f for f in fields if f.name == c) for c in carry] + [T.StructField("reason", T.StringType())])
    one = parents.filter("key_hex is not null").groupBy("key_hex").agg(F.max_by("gone", F.struct("order_us", "order_row")).alias("gone"), F.min("seen_us").alias("seen_us"))
    one = one.select(F.unhex("key_hex").alias("key"), _prefix(F.col("key_hex")).alias("prefix"), F.coalesce("gone", F.lit(False)).alias("gone"), "seen_us")
    keys = parents.filter("key_hex is not null").select(_prefix(F.col("key_hex")).alias("p"))
    n = keys.count()
    ranges = max(1, -(-n // rows_per_range))
    bounds: list[int] = []
    if ranges > 1:  # as many numbers as there are ranges come to the driver
        found = keys.agg(F.percentile_approx("p", [i / ranges for i in range(1, ranges)], max(10_000, 20 * ranges)).alias("b")).first().b
        bounds = sorted(set(found))
    judged = refs.filter("key_hex is not null").select(*carry, "ref_us", F.unhex("key_hex").alias("key"), _range_of(_prefix(F.col("key_hex")), bounds).alias("rng"))
    # a table of the ranges that fill several blocks: at most one row for every refs_per_block references
    split = judged.groupBy("rng").agg(F.ceil(F.count(F.lit(1)) / refs_per_block).cast("int").alias("copies")).filter("copies > 1")
    split = F.broadcast(cut(split)) if refs.count() // refs_per_block < 1_000_000 else cut(split)
    copies = F.coalesce("copies", F.lit(1))
    judged = judged.join(split, "rng", "left").withColumn("block", F.pmod(F.xxhash64(*carry), copies).cast("int")).drop("copies")
    held = one.withColumn("rng", _range_of(F.col("prefix"), bounds)).drop("prefix").join(split, "rng", "left").withColumn("block", F.explode(F.sequence(F.lit(0), copies - 1))).drop("copies")

    def probe(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known = _fixed(right.column("key"))
        order = np.argsort(known, kind="stable")
        known = known[order]
        gone = right.column("gone").to_numpy(zero_copy_only=False).astype(bool)[order] if len(known) else np.empty(0, bool)
        never = np.iinfo("int64").min
        seen = pc.fill_null(right.column("seen_us"), never).to_numpy()[order] if len(known) else np.empty(0, "int64")
        want = _fixed(left.column("key"))
        when = pc.fill_null(left.column("ref_us"), np.iinfo("int64").max).to_numpy()
        at = np.searchsorted(known, want)
        hit = np.zeros(len(want), bool)
        inside = at < len(known)
        hit[inside] = known[at[inside]] == want[inside]
        reason = np.full(len(want), "missing", dtype=object)
        spot = at[hit]
        late = seen[spot] > when[hit]
        reason[hit] = np.where(gone[spot], "deleted", np.where(late, "late", None))
        out = left.select(carry).append_column("reason", pa.array(reason, pa.string()))
        return out.filter(pc.is_valid(out.column("reason")))

    result = judged.groupBy("rng", "block").cogroup(held.groupBy("rng", "block")).applyInArrow(probe, schema)
    return result.unionByName(refs.filter("key_hex is null").select(*carry, F.lit("missing").alias("reason")))


def miss_counts(failing: DataFrame, by: list[str]) -> DataFrame:
    """Failing references counted by the given columns and reason."""
    return failing.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n_refs"))


