"""Attributes as known at event time: a bitemporal as-of join.

Events and versions are co-grouped by entity, many entities to a block. Within
a block the versions of each entity are sorted by the time they became usable;
a running maximum holds the best version so far and a binary search over
(entity, time) finds each event's position, for all events of the block at
once. Entities with very many rows are first cut into time slices; a slice gets
the best version of all earlier slices, so no block grows with a hot entity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.session import cut

_FIRST = -(2**63)


def _slices(events: DataFrame, versions: DataFrame, hot: DataFrame, hot_rows: int, small: bool) -> tuple[DataFrame, DataFrame]:
    """The hot entities' events and versions, keyed by entity, time slice and salt."""
    times = events.select("entity", "t").unionByName(versions.select("entity", F.col("usable").alias("t"))).join(hot, "entity")
    grid = times.groupBy("entity").agg(F.max("n").alias("n"), F.percentile_approx("t", [i / 1000 for i in range(1, 1000)], 10_000).alias("p"))
    # of the thousand quantiles, every k-th: about hot_rows rows to a slice (a slice of a larger entity is salted below)
    cuts = cut(grid.select("entity", F.array_distinct(F.expr(f"filter(p, (x, i) -> (i + 1) % greatest(1, cast(floor(1000 * {hot_rows} / n) as int)) = 0)")).alias("cuts")))
    cuts = F.broadcast(cuts) if small else cuts  # a thousand numbers an entity at most
    place = lambda t: F.size(F.expr(f"filter(cuts, c -> c < {t})"))
    ev = events.join(cuts, "entity").withColumn("slice", place("t")).drop("cuts")
    ve = versions.join(cuts, "entity").withColumn("slice", place("usable")).drop("cuts")
    best = ve.groupBy("entity", "slice").agg(F.max(F.struct("valid", "recorded", "neg_id")).alias("best"))
    every = cuts.select("entity", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("slice")).join(best, ["entity", "slice"], "left")
    before = Window.partitionBy("entity").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.withColumn("best", F.max("best").over(before)).filter("best is not null").select("entity", "slice", F.lit(_FIRST).alias("usable"), "best.valid", "best.recorded", "best.neg_id")
    # within a slice only the best version of each moment matters
    inside = ve.groupBy("entity", "slice", "usable").agg(F.max(F.struct("valid", "recorded", "neg_id")).alias("b")).select("entity", "slice", "usable", "b.valid", "b.recorded", "b.neg_id")
    salts = ev.groupBy("entity", "slice").agg(F.ceil(F.count(F.lit(1)) / hot_rows).cast("int").alias("salts"))
    ev = ev.join(salts, ["entity", "slice"]).withColumn("salt", F.pmod(F.xxhash64("event_id", "t"), F.col("salts")))
    ve = carried.unionByName(inside).join(salts, ["entity", "slice"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    name = F.concat_ws("\u0000", "entity", F.col("slice").cast("string"), F.col("salt").cast("string"))
    return ev.select(name.alias("entity"), "event_id", "t"), ve.select(name.alias("entity"), "usable", "valid", "recorded", "neg_id")


def as_of(events: DataFrame, versions: DataFrame, *, block_rows: int = 200_000, hot_rows: int = 200_000, most_broadcast: int = 2_000) -> DataFrame:
    """(event_id, version_id) for every event that has a usable version.

    events: `entity` (string), `event_id` (bigint), `t` (microseconds).
    versions: `entity`, `version_id` (bigint), `valid` and `recorded`
    (microseconds). A version is usable from the later of both on. Of those
    usable at t the latest `valid` wins, then the latest `recorded`, then the
    smallest `version_id`. Rows with a null in any of these columns match
    nothing; repeated events come out once per row; either table may be empty;
    other columns are ignored.
    """
    ev = events.select(F.col("entity").cast("string").alias("entity"), F.col("event_id").cast("bigint").alias("event_id"), F.col("t").cast("bigint").alias("t")).dropna()
    ve = versions.select(F.col("entity").cast("string").alias("entity"), F.greatest("valid", "recorded").cast("bigint").alias("usable"), F.col("valid").cast("bigint").alias("valid"), F.col("recorded").cast("bigint").alias("recorded"), (-F.col("version_id").cast("bigint")).alias("neg_id")).dropna()
    counts = ev.select("entity").unionByName(ve.select("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > hot_rows).alias("hot")).first()
    if total.hot:
        hot = cut(counts.filter(F.col("n") > hot_rows))  # at most rows / hot_rows entities
        hot = F.broadcast(hot) if total.hot <= most_broadcast else hot
        hot_ev, hot_ve = _slices(ev, ve, hot, hot_rows, total.hot <= most_broadcast)
        ev = ev.join(hot, "entity", "left_anti").unionByName(hot_ev)
        ve = ve.join(hot, "entity", "left_anti").unionByName(hot_ve)
    blocks = max(1, -(-total.n // block_rows))
    block = F.pmod(F.xxhash64("entity"), F.lit(blocks)).alias("block")

    def search(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"event_id": pa.array([], pa.int64()), "version_id": pa.array([], pa.int64())})
        number = lambda t, c: t.column(c).to_numpy()
        names = pa.chunked_array(left.column("entity").chunks + right.column("entity").chunks).combine_chunks()
        names = names if isinstance(names, pa.Array) else pa.concat_arrays(names.chunks)
        code = pc.dictionary_encode(names).indices.to_numpy().astype("int64")
        who_e, who_v = code[: left.num_rows], code[left.num_rows :]
        valid, recorded, neg = number(right, "valid"), number(right, "recorded"), number(right, "neg_id")
        preference = np.empty(len(neg), "int64")
        ordered = np.lexsort((neg, recorded, valid))
        preference[ordered] = np.arange(len(neg))
        moments, rank = np.unique(number(right, "usable"), return_inverse=True)
        width = len(moments) + 1
        place = who_v * width + rank + 1
        order = np.argsort(place, kind="stable")
        place = place[order]
        best = np.maximum.accumulate(who_v[order] * len(neg) + preference[order])
        want = who_e * width + np.searchsorted(moments, number(left, "t"), side="right")
        at = np.searchsorted(place, want, side="right") - 1
        hit = at >= 0
        hit[hit] = best[at[hit]] // len(neg) == who_e[hit]
        chosen = -neg[ordered[best[at[hit]] % len(neg)]]
        return pa.table({"event_id": pa.array(number(left, "event_id")[hit]), "version_id": pa.array(chosen)})

    return ev.withColumn("block", block).groupBy("block").cogroup(ve.withColumn("block", block).groupBy("block")).applyInArrow(search, "event_id bigint, version_id bigint")
