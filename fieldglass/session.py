"""Session helpers: table access and lineage cuts that work on a cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` of a data folder (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own (tests); on a cluster that would be one per machine, so it raises RuntimeError."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("name a shared folder in spark.checkpoint.dir")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="fieldglass-checkpoints-"))


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the checkpoint folder and read back: no recomputation, and it survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session as tests and bench use it."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
