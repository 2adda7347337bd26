"""Typed readers. Schemas are always given, never inferred; bad records go to `_corrupt` or are dropped, never guessed."""

from __future__ import annotations

import re
import tomllib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def register(name: str) -> Callable:
    """Registers a source under a name."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        REGISTRY[name] = f
        return f

    return add


def source(name: str) -> Callable[..., DataFrame]:
    """The source of that name; an unknown one raises ValueError."""
    if name not in REGISTRY:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def _paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, on whatever file system it names, sorted."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(s.getPath()) for s in found or [])


@register("json_array")
def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array each; a missing or broken file raises."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


@register("jsonl")
def json_lines(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """One JSON object a line. Blank lines are skipped, a missing path is an empty table; broken lines are dropped or, on request, kept in `_corrupt`."""
    if not _paths(spark, path):
        return spark.createDataFrame([], schema + (", _corrupt string" if keep_corrupt else ""))
    reader = spark.read.option("mode", "PERMISSIVE" if keep_corrupt else "DROPMALFORMED").option("columnNameOfCorruptRecord", "_corrupt")
    return reader.schema(schema + (", _corrupt string" if keep_corrupt else "")).json(path)


@register("files")
def files(spark: SparkSession, root: str, extension: str | None = None) -> DataFrame:
    """All files under a folder as (path, modificationTime, length, content, name, extension)."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    df = df.withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("extension", F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)))
    return df if extension is None else df.filter(F.col("extension") == extension.lower())


def run_root(root: str, run_id: str) -> str:
    """The folder of one run; ids that could leave the root raise ValueError."""
    if not run_id or run_id in (".", "..") or re.search(r"[/\\]", run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    return f"{root.rstrip('/')}/{run_id}"


def latest(spark: SparkSession, pattern: str) -> str:
    """The last path of a glob in name order; none raises FileNotFoundError."""
    found = _paths(spark, pattern)
    if not found:
        raise FileNotFoundError(pattern)
    return found[-1]


@register("config")
def settings(path: str, defaults: dict) -> dict:
    """A TOML file over defaults, section by section."""
    given = tomllib.loads(Path(path).read_text()) if Path(path).exists() else {}
    return {k: (v | given.get(k, {})) if isinstance(v, dict) else given.get(k, v) for k, v in defaults.items()} | {k: v for k, v in given.items() if k not in defaults}


def probed_run(spark: SparkSession, roots: list[str], run_id: str) -> str:
    """The run's folder under the first root that has it; none raises FileNotFoundError."""
    for root in roots:
        where = run_root(root, run_id)
        if _paths(spark, where):
            return where
    raise FileNotFoundError(f"run {run_id} under none of {roots}")


def frozen_report(spark: SparkSession, folder: str, day: str, schema: str) -> DataFrame:
    """The report of a day; an absent one raises FileNotFoundError."""
    path = f"{folder.rstrip('/')}/report_{day}.json"
    if not _paths(spark, path):
        raise FileNotFoundError(path)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


RESULT_PAGES = "result_pages array<struct<match_id:string,home_team:string,away_team:string,competition:string,summary:struct<final_score:struct<home:int,away:int>,total_goals:int,btts:boolean>>>"


@register("result_reports")
def result_reports(spark: SparkSession, pattern: str) -> DataFrame:
    """One row per result page of all reports of a glob that has both scores; broken reports are skipped, no reports give no rows."""
    if not _paths(spark, pattern):
        return spark.createDataFrame([], "match_id string, home_team string, away_team string, competition string, home_score int, away_score int, total_goals int, btts boolean, source_report string")
    docs = spark.read.schema(RESULT_PAGES).option("multiLine", True).option("mode", "PERMISSIVE").json(pattern).withColumn("source_report", F.element_at(F.split(F.input_file_name(), "/"), -1))
    p = docs.select(F.explode("result_pages").alias("p"), "source_report").select("p.*", "source_report")
    out = p.select("match_id", "home_team", "away_team", "competition", F.col("summary.final_score.home").alias("home_score"), F.col("summary.final_score.away").alias("away_score"), F.col("summary.total_goals").alias("total_goals"), F.col("summary.btts").alias("btts"), "source_report")
    return out.dropna(subset=["home_score", "away_score"])


def finished_fallback(matches: DataFrame) -> DataFrame:
    """Finished matches as results without scores, for want of reports."""
    return matches.filter(F.col("status").isin("finished", "full_time")).select("match_id", "home_team", "away_team", "competition")


def first_pages(links: DataFrame, kinds: list[str], order: str) -> DataFrame:
    """(path, page_type, and the other columns) of collected pages: the path columns `<kind>_snapshot_path` unpivoted, each path once, its first row by order and kind."""
    from fieldglass.operators.dedup import first_wins

    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_k"), F.lit(k).alias("page_type"), F.col(f"{k}_snapshot_path").alias("path")) for i, k in enumerate(kinds)])).alias("_p")
    rows = links.select("*", each).select(*[c for c in links.columns if not c.endswith("_snapshot_path")], "_p.*").filter(F.coalesce("path", F.lit("")) != "")
    return first_wins(rows, ["path"], [order, "_k"]).drop("_k")
