"""Streams: append-only file feeds, first sightings, windowed counts and the last state per key. All state is bounded by a watermark."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_folder(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(kind).load(path)


def first_sightings(stream: DataFrame, keys: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """Each key once, its repeats within the delay dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], window: str, delay: str) -> DataFrame:
    """Rows and sum of `value` by tumbling window and key; rows later than the delay are left out."""
    out = stream.withWatermark(time, delay).groupBy(F.window(time, window), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "total")


def append_to(stream: DataFrame, path: str, progress: str | None = None) -> StreamingQuery:
    """Writes what has arrived to parquet, exactly once, and stops; a later call, in any session, goes on from there.

    progress: the folder that holds how far the stream has come, by default
    `_progress` inside the target. It belongs to this target and must outlive sessions.
    """
    where = progress or f"{path.rstrip('/')}/_progress"
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", where).outputMode("append").trigger(availableNow=True).start()


def state_changes(observations: DataFrame, key: str, time: str, status: str, due: str, *, overdue: str = "overdue", delay: str = "1 day") -> DataFrame:
    """(key, time, status) whenever a record's status differs from the one before, and once as `overdue` when its due time passes in event time without a new observation.

    A null due time keeps the last one known. Observations of one batch are
    taken in order of time, then status. Rows without a key or time are left
    out. State is one row per key; it goes when the record is overdue.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    columns = [key, time, status]

    def follow(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, known = state.get
            state.remove()
            yield pd.DataFrame([(k[0], pd.Timestamp(known, unit="us"), overdue)], columns=columns)
            return
        before, known = state.get if state.exists else (None, None)
        out = []
        for r in pd.concat(list(batches)).sort_values([time, status], kind="stable").to_dict("records"):
            known = known if pd.isna(r[due]) else int(pd.Timestamp(r[due]).value // 1000)
            said = None if pd.isna(r[status]) else r[status]
            if not state.exists or said != before:
                out.append((k[0], r[time], said))
            before = said
            state.update((before, known))
        if known is not None and known // 1000 > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(known // 1000)
        yield pd.DataFrame(out, columns=columns)

    kept = observations.select(key, time, status, due).dropna(subset=[key, time]).withWatermark(time, delay)
    kind = observations.schema[key].dataType.simpleString()
    return kept.groupBy(key).applyInPandasWithState(follow, f"{key} {kind}, {time} timestamp, {status} string", f"{status} string, due bigint", "append", GroupStateTimeout.EventTimeTimeout)
