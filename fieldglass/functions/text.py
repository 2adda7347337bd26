"""Text, number and collection expressions; all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """Lower case with runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def slug(c: Column) -> Column:
    """Lower-case letters and digits joined by single underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def split_once(c: Column, mark: str) -> tuple[Column, Column]:
    """What stands before and after the first mark; null if it is absent."""
    at = F.locate(mark, c) if isinstance(c, str) else F.instr(c, mark)
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)), F.when(at > 0, F.substring(c, at + len(mark), F.length(c)))


def before_mark(c: Column, mark: str, default: str) -> Column:
    return F.when(F.instr(c, mark) > 0, F.substring_index(c, mark, 1)).otherwise(default)


def percent(c: Column) -> Column:
    """'72%' or '72' as 0.72; null if it is no number."""
    return F.replace(c, F.lit("%"), F.lit("")).try_cast("double") / 100


def number(c: Column) -> Column:
    """A text as double; null for what is none and for NaN."""
    x = c.try_cast("double")
    return F.when(~F.isnan(x), x)


def leading_int(c: Column) -> Column:
    """The digits a text begins with ('8th' is 8)."""
    return F.regexp_extract(c, r"^(\d+)", 1).try_cast("int")


def least_of_both(a: Column, b: Column) -> Column:
    """The lesser, null unless both are there."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def last_of(c: Column, n: int) -> Column:
    """The last n elements of an array (all if it is shorter)."""
    return F.slice(c, F.greatest(F.lit(1), F.size(c) - n + 1), F.lit(n))


def argmax(values: dict[str, Column]) -> Column:
    """The name of the greatest non-null value, the earlier of equals; null if there is none."""
    best = F.array_max(F.array(*[F.when(v.isNotNull(), F.struct(v.cast("double").alias("v"), F.lit(-i).alias("o"), F.lit(n).alias("n"))) for i, (n, v) in enumerate(values.items())]))
    return best["n"]


def canonical_hash(columns: list[str]) -> Column:
    """sha256 of a row as JSON with its columns in name order; absent values are left out."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def allowed_keys(m: Column, keys: list[str]) -> Column:
    """A map without the keys that are not listed, whatever their case."""
    return F.map_filter(m, lambda k, _: F.lower(k).isin(*[x.lower() for x in keys]))


def scrub_addresses(c: Column) -> Column:
    """Memory addresses in error texts made equal."""
    return F.regexp_replace(c, r"0x[0-9a-fA-F]+", "0x..")


def find_all(c: Column, pattern: str, group: int = 0) -> Column:
    """All that a pattern matches in a text, as an array."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def at_clock(day: Column, clock: Column) -> Column:
    """The day of a timestamp at a time written hh:mm; null if it is none."""
    h, m = F.regexp_extract(clock, r"^(\d{1,2}):(\d{2})$", 1).try_cast("int"), F.regexp_extract(clock, r"^(\d{1,2}):(\d{2})$", 2).try_cast("int")
    return F.when(h.between(0, 23) & m.between(0, 59), F.date_trunc("DAY", day) + F.make_dt_interval(F.lit(0), h, m))


def plus_minutes(at: Column, minutes: int) -> Column:
    return at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def half_even(c: Column, digits: int) -> Column:
    """Rounded to the nearest decimal of the number as it is stored in binary, exact ties to the even digit; by integer arithmetic on its mantissa. Up to six digits; what is no finite number stays."""
    x = F.abs(c)
    k = F.greatest(F.lit(0), F.lit(54) - F.floor(F.log2(x))).cast("int")  # x * 2^k is whole
    whole = lambda bits: F.call_function("shiftleft", F.lit(1).cast("bigint"), bits).cast("decimal(19,0)")
    low = F.least(k, F.lit(62))
    unit = whole(low) * whole(F.least(k - low, F.lit(62)))
    n = (x * F.pow(F.lit(2.0), k)).cast("bigint").cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(7,0)")
    q, r = F.call_function("div", n, unit), n % unit
    up = (r > unit - r) | ((r == unit - r) & (q % 2 == 1))
    rounded = F.when(k > 120, 0.0).otherwise((q + up.cast("bigint")) / 10.0**digits)
    return F.when((x > 0) & (x < 2.0**42), F.signum(c) * rounded).otherwise(c)


def first_key(m: Column, default: str | None = None) -> Column:
    """The first key of a map in its stored order; the default for null and empty maps."""
    return F.coalesce(F.get(F.map_keys(m), F.lit(0)), F.lit(default))


def with_default(c: Column, path: str, default: object) -> Column:
    """A field inside nested structs, the default where it or what holds it is null."""
    out = c
    for name in path.split("."):
        out = out[name]
    return F.coalesce(out, F.lit(default))


def byte_length(c: Column) -> Column:
    """Bytes of a text in UTF-8, 0 for null."""
    return F.coalesce(F.octet_length(c), F.lit(0))


#: Fields that differ from run to run and are left out of a record's hash.
VOLATILE = "run_id run_started_at run_finished_at generated_at created_at updated_at fetched_at git_commit frozen_at timestamp".split()


def record_json(df_columns: list[str]) -> Column:
    """A row as compact JSON, columns in name order, volatile ones left out, nulls written."""
    return F.to_json(F.struct(*sorted(c for c in df_columns if c not in VOLATILE)), {"ignoreNullFields": "false"})


def list_hash(df, by: str):  # noqa: ANN001, ANN201
    """One row (`list_hash`): sha256 over the sha256 of a table's records in order of an id, a tree of 4096 hashed slices so that no task holds the list. Equal tables have equal hashes whatever the order of rows."""
    each = df.select(F.col(by).cast("string").alias("_id"), F.sha2(record_json(df.columns), 256).alias("_h")).withColumn("_s", F.pmod(F.xxhash64("_id"), F.lit(4096)))
    leaf = each.groupBy("_s").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_id", "_h"))), lambda x: x["_h"]), ","), 256).alias("_h"))
    return leaf.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_h"))), lambda x: x["_h"]), ","), 256).alias("list_hash"))
