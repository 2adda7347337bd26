"""Best representative of each duplicate group, field by field.

Fields are unpivoted to long rows. Every row votes for its normalised value
with the trust in its source times a decay with age; votes are summed per
value, the value with most votes wins, and the winners are pivoted back. All
steps are aggregations with map-side combining, so a group may hold any share
of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log_vote(trust_bits: Column, at_us: Column, half_life_us: float, scale: int = 20) -> Column:
    """log2 of trust times 2^(-age / half life) but for the group's own constant, in units of 2^-scale, as bigint; a null time counts as earliest."""
    return F.coalesce((trust_bits * (1 << scale)).cast("bigint") + F.floor(at_us / (half_life_us / (1 << scale))).cast("bigint"), F.lit(-(2**62)))


def survivors(df: DataFrame, keys: list[str], fields: dict[str, Column], *, trust: Column, at_us: Column, bits: Column, row: str, scale: int = 20, least_rows: int = 1) -> DataFrame:
    """One row per key: for each field `<field>_row`, the row that supplies the winning value, and `<field>`, that value.

    fields: normalised value by name, null where the row has none that is
    valid. bits: log2 of a row's vote in units of 2^-scale (see log_vote); only
    differences within a group matter, so votes of any range are summed without
    loss, relative to the group's greatest. Rows of one value with equal trust
    and time are copies of one delivery and vote once. Votes equal to four
    digits are a tie, which goes to the value with the most trusted, then
    latest, then lowest row; the same order tells which row supplies a value.
    Fields without a valid value are null. Rows with a null key are left out; a
    null trust counts as 0, a null time as earliest; groups under least_rows
    rows are dropped; repeated rows count as rows. Names beginning with `_v_`
    are used inside.
    """
    long = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.cast("string").alias("value")) for n, v in fields.items()]))
    base = df.select(*keys, trust.cast("double").alias("_v_t"), at_us.cast("bigint").alias("_v_us"), bits.cast("bigint").alias("_v_bits"), F.col(row).cast("bigint").alias("_v_row"), long.alias("_v_x")).dropna(subset=keys)
    least = F.lit(-(2**62))
    base = base.select(*keys, F.coalesce("_v_t", F.lit(0.0)).alias("_v_t"), F.coalesce("_v_us", least).alias("_v_us"), F.coalesce("_v_bits", least).alias("_v_bits"), "_v_row", "_v_x.*")
    sent = base.groupBy(*keys, "field", "value", "_v_t", "_v_us", "_v_bits").agg(F.min("_v_row").alias("_v_row"), F.count(F.lit(1)).alias("_v_n"))
    top = sent.filter("value is not null").groupBy(*keys, "field").agg(F.max("_v_bits").alias("_v_top"))
    sent = sent.join(top, [*keys, "field"], "left")
    vote = F.round(F.sum(F.when(F.col("value").isNotNull(), F.pow(F.lit(2.0), (F.col("_v_bits") - F.col("_v_top")) / float(1 << scale)))), 4)
    best = F.max(F.when(F.col("value").isNotNull(), F.struct("_v_t", "_v_us", (-F.col("_v_row")).alias("_v_neg"))))
    per_value = sent.groupBy(*keys, "field", "value").agg(vote.alias("_v_votes"), best.alias("_v_best"), F.sum("_v_n").alias("_v_n"))
    winner = [F.max_by(F.struct("value", (-F.col("_v_best._v_neg")).alias("row")), F.when((F.col("field") == n) & F.col("_v_best").isNotNull(), F.struct("_v_votes", "_v_best"))).alias(f"_v_{n}") for n in fields]
    any_field = next(iter(fields))
    out = per_value.groupBy(*keys).agg(F.sum(F.when(F.col("field") == any_field, F.col("_v_n"))).alias("_v_rows"), *winner)
    return out.filter(F.col("_v_rows") >= least_rows).select(*keys, F.col("_v_rows").alias("n_rows"), *[c for n in fields for c in (F.col(f"_v_{n}.value").alias(n), F.col(f"_v_{n}.row").alias(f"{n}_row"))])
