"""Joins on pairs of names: blocked by the beginnings of normalised words, scored a batch at a time, settled by policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.similarity import compare_pairs, name_similarity, normalized_name


def with_forms(df: DataFrame, home: str = "home_team", away: str = "away_team") -> DataFrame:
    """Adds `_h` and `_a`, the normal forms of the two names."""
    return df.withColumns({"_h": normalized_name(home), "_a": normalized_name(away)})


def scored_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, within: list[str], *, swap: bool = False, both_least: float | None = None, size: int = 4, slice_rows: int = 1_000) -> DataFrame:
    """(left_id, right_id, accepted, score, swapped) of rows that agree in the `within` columns and whose home names, and whose away names, have words beginning with the same `size` letters.

    Both tables have `home_team` and `away_team`. With swap, right rows also come with their sides
    exchanged. With both_least, what is accepted is a similarity of at least that on both sides, without guards. Equal pairs of names are compared once, however many rows have
    them. A block with more than slice_rows names is cut into slices, each
    with a copy of the other side. Null names and null `within` values meet nothing.
    """
    cols = [*within, "home_team", "away_team"]

    def named(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*within, F.col("home_team").alias(f"h_{tag}"), F.col("away_team").alias(f"a_{tag}")).dropna().distinct()

    turned = right.select(right_id, *within, F.col("away_team").alias("home_team"), F.col("home_team").alias("away_team"), F.lit(True).alias("swapped")) if swap else None
    right = right.select(right_id, *cols, F.lit(False).alias("swapped"))
    right = right.unionByName(turned) if turned is not None else right

    def blocks(df: DataFrame, tag: str) -> DataFrame:
        starts = lambda c: F.transform(F.array_distinct(F.split(normalized_name(c), " ")), lambda w: F.substring(w, 1, size))
        one = df.withColumn("_hk", F.explode(F.array_distinct(starts(f"h_{tag}")))).withColumn("_ak", F.explode(F.array_distinct(starts(f"a_{tag}"))))
        return one.filter("_hk <> '' and _ak <> ''").withColumn("_key", F.xxhash64(*within, "_hk", "_ak")).drop("_hk", "_ak")

    a, b = blocks(named(left, "l"), "l"), blocks(named(right, "r"), "r")
    hot = a.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("_n")).filter("_n > 1")
    a = a.join(hot, "_key", "left").withColumn("_s", F.pmod(F.xxhash64("h_l", "a_l"), F.coalesce("_n", F.lit(1)))).drop("_n")
    b = b.join(hot, "_key", "left").withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_n", *within)
    pairs = a.join(b.withColumn("_s", F.col("_s").cast("bigint")), ["_key", "_s"]).select(*within, "h_l", "a_l", "h_r", "a_r").distinct()
    if both_least is None:
        verdict = compare_pairs("h_l", "a_l", "h_r", "a_r")
    else:
        h, a = name_similarity("h_l", "h_r"), name_similarity("a_l", "a_r")
        verdict = F.struct(((h >= both_least) & (a >= both_least)).alias("accepted"), ((h + a) / 2).alias("score"))
    pairs = pairs.withColumn("_c", verdict).select(*within, "h_l", "a_l", "h_r", "a_r", F.col("_c.accepted").alias("accepted"), F.col("_c.score").alias("score"))
    out = pairs.join(left.select(left_id, *within, F.col("home_team").alias("h_l"), F.col("away_team").alias("a_l")), [*within, "h_l", "a_l"])
    return out.join(right.withColumnsRenamed({"home_team": "h_r", "away_team": "a_r"}), [*within, "h_r", "a_r"]).select(left_id, right_id, "accepted", "score", "swapped")


def reconcile(left: DataFrame, right: DataFrame, left_id: str, right_id: str, within: list[str], order: str) -> DataFrame:
    """(left_id, right_id, how): exact normal forms first (the last right row by order), else the best accepted pair (the first by order among equals, no margin), else unmatched_result.

    Right rows without both names are left out; a left row without both is unmatched.
    """
    r = with_forms(right.filter("coalesce(home_team, '') <> '' and coalesce(away_team, '') <> ''"))
    exact = r.groupBy(*within, "_h", "_a").agg(F.max_by(right_id, order).alias("_exact"))
    named = with_forms(left)
    first = named.join(exact, [*within, "_h", "_a"], "left").select(left_id, *within, "home_team", "away_team", "_exact")
    found = scored_pairs(first.filter("_exact is null"), r, left_id, right_id, within).filter("accepted")
    best = found.join(r.select(right_id, F.col(order).alias("_o")), right_id).groupBy(left_id).agg(F.max_by(right_id, F.struct("score", (-F.col("_o")).alias("_o"))).alias("_fuzzy"))
    out = first.join(best, left_id, "left")
    return out.select(left_id, F.coalesce("_exact", "_fuzzy").alias(right_id), F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_fuzzy").isNotNull(), "fuzzy").otherwise("unmatched_result").alias("how"))


def match_with_margin(left: DataFrame, right: DataFrame, left_id: str, right_id: str, within: list[str], *, swap: bool = False, least: float = 0.82, margin: float = 0.05) -> DataFrame:
    """(left_id, right_id, score, swapped, status): the best right row per left row.

    status: matched, ambiguous (another right row within the margin), or
    below. With swap a right row counts with its sides exchanged where it is
    not accepted as it is; its better score counts. Left rows without any
    candidate have status none.
    """
    s = scored_pairs(left, right, left_id, right_id, within, swap=swap)
    rank = F.struct(F.col("accepted") & ~F.col("swapped"), F.col("accepted"), "score")
    per = s.groupBy(left_id, right_id).agg(F.max_by(F.struct("score", "swapped"), rank).alias("x")).select(left_id, right_id, "x.*")
    w = Window.partitionBy(left_id).orderBy(F.desc("score"), F.asc(right_id))
    best = per.withColumn("_n", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead("score").over(w), F.lit(-1.0))).filter("_n = 1")
    status = F.when(F.col("score") < least, "below").when(F.round(F.col("score") - F.col("_next"), 9) < margin, "ambiguous").otherwise("matched")
    return left.select(left_id).join(best.select(left_id, right_id, "score", "swapped", status.alias("status")), left_id, "left").fillna("none", ["status"])


def outer_with_margin(left: DataFrame, right: DataFrame, left_id: str, right_id: str, within: list[str], *, margin: float = 0.05) -> DataFrame:
    """(left_id, right_id, join_status): exact normal forms, then the best fuzzy pair; `ambiguous_quarantine` where two are within the margin, `left_only` and `right_only` for the rest."""
    l, r = with_forms(left), with_forms(right)  # noqa: E741
    exact = l.join(r.select(right_id, *within, "_h", "_a"), [*within, "_h", "_a"]).filter("_h <> '' and _a <> ''").select(left_id, right_id)
    rest = l.join(exact.select(left_id), left_id, "left_anti")
    fuzzy = match_with_margin(rest, r, left_id, right_id, within, margin=margin)
    hit = F.col("status") == "matched"
    own = fuzzy.select(left_id, F.when(hit, F.col(right_id)).alias(right_id), F.when(hit, "fuzzy").when(F.col("status") == "ambiguous", "ambiguous_quarantine").otherwise("left_only").alias("join_status"))
    both = exact.select(left_id, right_id, F.lit("exact").alias("join_status")).unionByName(own)
    alone = right.join(both.filter(F.col(right_id).isNotNull()).select(right_id).distinct(), right_id, "left_anti")
    return both.unionByName(alone.select(F.lit(None).cast(left.schema[left_id].dataType).alias(left_id), right_id, F.lit("right_only").alias("join_status")))
