"""Sinks: overwrite, append, one-shot, upsert, content-addressed, quarantine, CSV and manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators.dedup import last_wins


def overwrite_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_lines(df: DataFrame, path: str) -> None:
    """Adds rows; earlier ones are never rewritten, duplicates are allowed."""
    df.write.mode("append").json(path)


def freeze(df: DataFrame, path: str, stamp: str = "frozen_at") -> None:
    """Writes once: every row gets the same time, and an existing target raises."""
    df.withColumn(stamp, F.current_timestamp()).write.mode("errorifexists").parquet(path)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Whole rows replaced by key: the last new row wins, untouched old rows stay. Columns only one side has are null in the other's rows."""
    last = last_wins(new, keys, order)
    return old.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: list[str]) -> str:
    """Upserts into a folder of generations and returns the new one; readers of the old generation are not disturbed."""
    from fieldglass.sources.readers import _paths

    done = _paths(spark, f"{path}/gen=*/_SUCCESS")
    old = spark.read.parquet(done[-1].removesuffix("/_SUCCESS")) if done else spark.createDataFrame([], new.schema)
    target = f"{path}/gen={len(done):08d}-{uuid.uuid4().hex[:8]}"
    upserted(old, new, keys, order).write.mode("errorifexists").parquet(target)
    return target


def new_contents(stored: DataFrame, incoming: DataFrame, content: str = "content") -> DataFrame:
    """Incoming rows whose content is not stored yet, each content once, with its sha256 as `content_hash`."""
    hashed = incoming.withColumn("content_hash", F.sha2(F.col(content).cast("binary"), 256))
    return hashed.join(stored.select("content_hash"), "content_hash", "left_anti").dropDuplicates(["content_hash"])


def validated(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Adds `reason`: the first rule (name, condition that must hold) that fails or is null; null where all hold."""
    out = None
    for name, holds in rules:
        bad = ~F.coalesce(holds, F.lit(False))
        out = F.when(bad, name) if out is None else out.when(bad, name)
    return df.withColumn("reason", out if out is not None else F.lit(None).cast("string"))


def quarantine(df: DataFrame, good: str, bad: str) -> None:
    """Appends rows without a reason to `good` and the others, with theirs, to `bad`."""
    df.filter("reason is null").drop("reason").write.mode("append").parquet(good)
    df.filter("reason is not null").withColumn("quarantined_at", F.current_timestamp()).write.mode("append").parquet(bad)


def csv_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    """A fixed list of columns as texts: others are left out, absent ones are empty."""
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns])


def export_csv(df: DataFrame, columns: list[str], path: str) -> None:
    csv_projection(df, columns).write.mode("overwrite").option("header", True).csv(path)


def manifest(df: DataFrame, counts: dict[str, Column], volatile: list[str] | None = None, **facts: str) -> DataFrame:
    """One row: conditional counts of a table and given facts, without those named volatile."""
    row = df.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return row.withColumns({k: F.lit(v) for k, v in facts.items() if k not in (volatile or [])}) if facts else row


def freeze_with_summary(df: DataFrame, path: str, counts: dict[str, Column], stamp: str = "frozen_at") -> DataFrame:
    """freeze(), then one row of conditional counts of what was written, with its one time."""
    freeze(df, path, stamp)
    done = df.sparkSession.read.parquet(path)
    return done.agg(F.max(stamp).alias(stamp), *[F.count_if(c).alias(n) for n, c in counts.items()])


def page_status(response_status: Column, content: Column) -> Column:
    """`error` for a failed or empty response, else `unparsed`."""
    return F.when((response_status >= 400) | (F.coalesce(F.octet_length(content), F.lit(0)) == 0), "error").otherwise("unparsed")


def create_tables(spark: SparkSession, tables: dict[str, str], database: str = "default") -> None:
    """CREATE TABLE IF NOT EXISTS for each name and its columns; existing tables and their rows stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, columns in tables.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def markdown_summary(df: DataFrame, title: str, by: str, facts: dict[str, object] | None = None) -> str:
    """A Markdown text: title, given facts, and a table of counts in key order. As many lines as keys come to the driver."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(by).collect()
    return "\n".join([f"# {title}", "", *[f"{k}: {v}" for k, v in (facts or {}).items()], *([""] if facts else []), f"| {by} | count |", "|-|-|", *[f"| {r[0]} | {r.n} |" for r in counts]])
