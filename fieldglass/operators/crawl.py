"""Bounded crawl over stored pages: one DataFrame step per level, visited URLs removed by anti-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.session import cut


def crawl(links: DataFrame, seeds: DataFrame, *, max_depth: int, max_pages: int | None = None, per_family: int | None = None) -> DataFrame:
    """(url, depth, found_from) of the pages reached from the seeds.

    links: `url`, `target`, both in normal form, and optionally `family` of the
    target; seeds: `url`. A URL is visited once, at its least depth; of several
    pages that lead to it the first by name counts. The caps are part of the
    walk: once max_pages pages are visited in all, or per_family of a family, in order of
    depth and URL, further ones are neither visited nor followed, and so
    neither are pages only they lead to. Seeds have the family their links
    say, if any. Links to nowhere end there; null URLs are ignored.
    """
    family = F.col("family") if "family" in links.columns else F.lit("")
    edges = links.select(F.col("url").alias("from"), F.col("target").alias("url"), family.alias("family")).dropna(subset=["from", "url"])
    kinds = edges.groupBy("url").agg(F.min("family").alias("family"))
    columns = ["url", "depth", "found_from", "family"]

    def within(found: DataFrame, before: DataFrame | None) -> DataFrame:
        """Those of a level that fit under the caps."""
        found = found.join(kinds, "url", "left").select(*columns)
        if per_family is not None:
            had = before.groupBy("family").agg(F.count(F.lit(1)).alias("_had")) if before is not None else None
            found = _ranked(found, ["family"], "url", "_n", per_family)
            if had is not None:
                found = found.join(F.broadcast(had), "family", "left")  # as many rows as families
            taken = F.col("_n") + (F.coalesce("_had", F.lit(0)) if had is not None else F.lit(0))
            found = found.filter(F.col("family").isNull() | (taken <= per_family)).select(*columns)
        if max_pages is not None:
            found = found.orderBy("url").limit(max(0, max_pages - (before.count() if before is not None else 0)))
        return cut(found)

    seen = within(seeds.select("url").dropna().distinct().withColumn("depth", F.lit(0)).withColumn("found_from", F.lit(None).cast("string")), None)
    front = seen
    for depth in range(1, max_depth + 1):
        step = front.select(F.col("url").alias("from")).join(edges, "from").groupBy("url").agg(F.min("from").alias("found_from"))
        front = within(step.join(seen.select("url"), "url", "left_anti").select("url", F.lit(depth).alias("depth"), "found_from"), seen)
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen.drop("family")


def _ranked(df: DataFrame, keys: list[str], order: str, rank: str, k: int) -> DataFrame:
    """The first k rows of each key, numbered; a null key's rows have no number and all stay."""
    from fieldglass.operators.dedup import top_k

    known = df.filter(F.col(keys[0]).isNotNull())
    return top_k(known, keys, [F.asc(order)], k, rank).unionByName(df.filter(F.col(keys[0]).isNull()).withColumn(rank, F.lit(None).cast("int")))
