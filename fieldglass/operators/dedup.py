"""Order-dependent reductions. Order is always explicit columns; ties are broken by listing more of them.

first/last/prefer/coalesce use max_by and min_by on structs, so groups are
combined before the shuffle and a hot key costs no more than any other.
Empty input gives empty output; null keys form one group; extra columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.session import cut


def _row_of(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by the order columns, nulls first."""
    return df.groupBy(*keys).agg(F.min_by(_row_of(df), F.struct(*order)).alias("_r")).select("_r.*")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns."""
    return df.groupBy(*keys).agg(F.max_by(_row_of(df), F.struct(*order)).alias("_r")).select("_r.*")


def prefer(df: DataFrame, keys: list[str], wanted: Column, order: list[str]) -> DataFrame:
    """The first row for which `wanted` holds, else the first row; a null condition counts as false."""
    rank = F.when(F.coalesce(wanted, F.lit(False)), 0).otherwise(1)
    return df.groupBy(*keys).agg(F.min_by(_row_of(df), F.struct(rank.alias("_p"), *order)).alias("_r")).select("_r.*")


def completeness(columns: list[str]) -> Column:
    """How many of the columns are not null."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns], F.lit(0))


def coalesce_merge(df: DataFrame, keys: list[str], columns: list[str], order: list[str], by_completeness: bool = False) -> DataFrame:
    """Per key and column the first value that is not null, in row order or from the most complete row on."""
    rank = F.struct(*([(-completeness(columns)).alias("_c")] if by_completeness else []), *order)
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def refine(df: DataFrame, keys: list[str], columns: list[str], sentinels: list[str], order: list[str], collect: dict[str, str] | None = None) -> DataFrame:
    """Per key and column the first value that is neither null nor a sentinel, else the first value; `collect` maps new columns to sorted sets of a column's values."""
    real = lambda c: F.col(c).isNotNull() & ~F.col(c).isin(*sentinels)
    picks = [F.coalesce(F.min_by(c, F.when(real(c), F.struct(*order))), F.min_by(c, F.struct(*order))).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*picks, *[F.array_sort(F.collect_set(c)).alias(n) for n, c in (collect or {}).items()])


def mark_duplicates(df: DataFrame, key: str, order: list[str], column: str, label: str) -> DataFrame:
    """Rows after the first with an equal non-null key get `label` in `column`; rows equal in all order columns are not told apart.

    The first of each key is an aggregate combined before the shuffle, and the
    join back splits skewed keys; null keys, which mark nothing, stay out of both.
    """
    first = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])).alias("_first"))
    known = df.filter(F.col(key).isNotNull()).join(first, F.col(key) == F.col("_k"))
    later = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]) > F.col("_first")
    return known.withColumn(column, F.when(later, F.lit(label)).otherwise(F.col(column))).select(*df.columns).unionByName(df.filter(F.col(key).isNull()))


def representative(df: DataFrame, keys: list[str], score: Column, order: list[str]) -> DataFrame:
    """The row of the greatest score; the first by order among equals; null scores last."""
    return df.groupBy(*keys).agg(F.min_by(_row_of(df), F.struct(F.coalesce(-score.cast("double"), F.lit(float("inf"))).alias("_s"), *order)).alias("_r")).select("_r.*")


def best_by_preference(df: DataFrame, keys: list[str], column: str, preference: list[str], order: list[str]) -> DataFrame:
    """The row whose column value stands first in the list; values outside it come after, in order."""
    at = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(column))
    rank = F.when(F.coalesce(at, F.lit(0)) > 0, at).otherwise(len(preference) + 1)
    return df.groupBy(*keys).agg(F.min_by(_row_of(df), F.struct(rank.alias("_p"), *order)).alias("_r")).select("_r.*")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The k first rows of each key, numbered (a top-k report). Two stages: the best k of each of 64 slices of a key, then the best of these, so a key may hold any share of the rows."""
    first = Window.partitionBy(*keys, "_slice").orderBy(*order)
    some = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(64))).withColumn(rank, F.row_number().over(first)).filter(F.col(rank) <= k).drop("_slice")
    return some.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def _sliced(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows cut into ranges of (keys, order), the range in `_p`: a key with very many rows fills several of them."""
    return cut(df.repartitionByRange(*keys, *order).withColumn("_p", F.spark_partition_id()))


def fill_forward(df: DataFrame, keys: list[str], order: list[str], column: str, out: str) -> DataFrame:
    """The last non-null value up to each row. Null keys form one group.

    Rows are filled within ranges of (keys, order); what a range inherits from
    those before it comes from a table of one row per range and key.
    """
    rows = _sliced(df, keys, order)
    w = Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("v")))
    ends = rows.groupBy(*keys, "_p").agg(F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_had", F.last("_end", ignorenulls=True).over(before)).filter("_had is not null").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_p").alias("_q"), "_had")
    same = (F.col("_p") == F.col("_q")) & reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    filled = rows.withColumn("_own", F.last(column, ignorenulls=True).over(w)).join(carried, same, "left")
    return filled.select(*df.columns, F.coalesce("_own", F.col("_had.v")).alias(out))


def pair_rows(df: DataFrame, keys: list[str], order: list[str], opens: Column, closes: Column, columns: list[str], prefix: str = "next_") -> DataFrame:
    """Rows where `opens` holds, joined with the row right after them if `closes` holds there, else nulls.

    The row after the last of a range of (keys, order) is the first of the
    key's next range, from a table of one row per range and key.
    """
    rows = _sliced(df.withColumn("_next", F.struct(F.coalesce(closes, F.lit(False)).alias("closes"), *columns)), keys, order)
    w = Window.partitionBy("_p", *keys).orderBy(*order)
    firsts = rows.groupBy(*keys, "_p").agg(F.min_by("_next", F.struct(*order)).alias("_first"))
    follow = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_p"))).filter("_after is not null").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_p").alias("_q"), "_after")
    same = (F.col("_p") == F.col("_q")) & reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    paired = rows.withColumn("_own", F.lead("_next").over(w)).filter(opens).join(follow, same, "left").withColumn("_n", F.coalesce("_own", "_after"))
    return paired.select(*df.columns, *[F.when(F.col("_n.closes"), F.col(f"_n.{c}")).alias(f"{prefix}{c}") for c in columns])
