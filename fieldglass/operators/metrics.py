"""Conditional aggregation: outcome metrics, grouping sets, buckets and histograms. One pass and one shuffle of partial sums each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outcome_aggregates(won: str, probability: str, error: str) -> list[Column]:
    """n, wins, losses, unresolved, hit rate, mean probability, calibration error and mean error of graded rows; `won` is null while unresolved. The mean probability divides the sum over all rows by the settled ones."""
    settled = F.count(won)
    hit = F.try_divide(F.count_if(F.col(won)), settled)
    mean = F.try_divide(F.sum(probability), settled)
    return [
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(won)).alias("wins"), F.count_if(~F.col(won)).alias("losses"), F.count_if(F.col(won).isNull()).alias("unresolved"),
        hit.alias("hit_rate"), mean.alias("avg_probability"), (hit - mean).alias("calibration_error"), F.try_divide(F.sum(error), F.count(error)).alias("mean_error"),
    ]


def by_grouping_sets(df: DataFrame, sets: list[list[str]], aggregates: list[Column]) -> DataFrame:
    """The aggregates for several groupings in one pass; `grouping` tells which (bits of the columns left out)."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(F.grouping_id().alias("grouping"), *aggregates)


def bucket(value: Column, edges: list[float], labels: list[str] | None = None) -> Column:
    """The half-open bucket [edge, next edge) of a value; null outside the edges."""
    out = None
    for i in range(len(edges) - 1):
        inside = (value >= edges[i]) & (value < edges[i + 1])
        label = F.lit(labels[i] if labels else f"[{edges[i]:g},{edges[i + 1]:g})")
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def calibration(df: DataFrame, predicted: str, hit: str, edges: list[float]) -> DataFrame:
    """Per non-empty bucket: n, mean prediction, hit rate and their gap."""
    b = df.withColumn("bucket", bucket(F.col(predicted), edges)).filter("bucket is not null and %s is not null" % hit)
    out = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.avg(predicted).alias("mean_predicted"), (F.count_if(F.col(hit)) / F.count(F.lit(1))).alias("hit_rate"))
    return out.withColumn("gap", F.col("hit_rate") - F.col("mean_predicted"))


def histogram(df: DataFrame, column: str, steps_per_unit: int) -> DataFrame:
    """Counts by equal-width bucket, named by its lower edge; null values are left out."""
    return df.filter(F.col(column).isNotNull()).groupBy((F.floor(F.col(column) * steps_per_unit) / steps_per_unit).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def conditional_counts(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Per key how many rows meet each condition; a null condition is not met."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def consensus(df: DataFrame, votes: list[Column], out: str = "agreeing") -> DataFrame:
    """Rows counted by how many of the conditions hold."""
    n = sum((F.coalesce(v.cast("int"), F.lit(0)) for v in votes), F.lit(0))
    return df.groupBy(n.alias(out)).agg(F.count(F.lit(1)).alias("n"))


def score_summary(df: DataFrame, score: str, below: float) -> DataFrame:
    """Least and mean score, rows, and rows under a threshold."""
    return df.agg(F.count(score).alias("n"), F.min(score).alias("least"), F.avg(score).alias("mean"), F.count_if(F.col(score) < below).alias("n_below"))


#: Classes of a probability.
PROBABILITY_EDGES, PROBABILITY_LABELS = [float("-inf"), 0.5, 0.6, 0.7, 0.8, 0.9, float("inf")], ["<50%", "50-60%", "60-70%", "70-80%", "80-90%", "90%+"]


def probability_class(p: Column) -> Column:
    return bucket(p, PROBABILITY_EDGES, PROBABILITY_LABELS)


def failure_histogram(df: DataFrame, error: str) -> DataFrame:
    """Failed rows counted by error text, memory addresses made equal; rows without an error are no failures."""
    from fieldglass.functions.text import scrub_addresses

    return df.filter(F.col(error).isNotNull()).groupBy(scrub_addresses(F.col(error)).alias("error")).agg(F.count(F.lit(1)).alias("n"))


def hit_rate(won: str) -> Column:
    """Share of settled rows that are won, 0 if none is settled."""
    return F.count_if(F.col(won)) / F.greatest(F.lit(1), F.count(won))


def trusted(groups: DataFrame, least: int = 10, gap: float = 0.10, rate: float = 0.5) -> DataFrame:
    """Groups of enough rows (`n`), a small `gap` and a `hit_rate` above chance: a HAVING on calibration's output."""
    return groups.filter((F.col("n") >= least) & (F.abs("gap") < gap) & (F.col("hit_rate") > rate))


def finished_with_outcome(df: DataFrame, status: str, outcome: str) -> DataFrame:
    return df.filter((F.col(status) == "finished") & F.col(outcome).isNotNull())


def outcome_of(home: Column, away: Column) -> Column:
    """1, X or 2 of a score; null unless both sides have one."""
    return F.when(home > away, "1").when(home < away, "2").when(home == away, "X")


def flattened(df: DataFrame, fields: dict[str, Column], prefix: str) -> DataFrame:
    """One flat row per record: each named expression as a column with the prefix."""
    return df.select(*[c.alias(f"{prefix}_{n}") for n, c in fields.items()])


def score_columns(home: Column, away: Column) -> dict[str, Column]:
    """What follows from a score: outcome, total, whether both scored, over or under 2.5; null without a score."""
    both = home.isNotNull() & away.isNotNull()
    return {"outcome_1x2": outcome_of(home, away), "total_goals": home + away, "btts_outcome": F.when(both, F.when((home != 0) & (away != 0), "yes").otherwise("no")), "o25_outcome": F.when(both, F.when(home + away > 2, "over").otherwise("under"))}


def paired_columns(f: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """For each pair of home and away numbers their difference, sum, mean and favourite; null unless both are there."""
    out = {}
    for n, (h, a) in f.items():
        out |= {f"{n}_diff": h - a, f"{n}_sum": h + a, f"{n}_avg": (h + a) / 2, f"{n}_fav": outcome_of(h, a)}
    return out
