"""Streams of timed rows: pick-up of files, repeats, late data, daily and sliding totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    files: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New Parquet files in `folder` (those named like `files`), oldest first.

    `max_files` bounds one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def timed(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a timestamp with a watermark."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def drop_repeats(
    events: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 day", salts: int = 8
) -> DataFrame:
    """Repeats across batches, as long as they arrive within `delay`; state is bounded by the watermark.

    Copies of one row may be a large share of a stream. They are first reduced within `salts` random parts
    and then to one, so that no task has to read them all; with salts=1 the first step is left out.
    """
    rows = timed(events, ts, delay)
    if salts > 1:
        rows = (
            rows.withColumn("_salt", F.floor(F.rand(seed=0) * salts))
            .dropDuplicatesWithinWatermark([*keys, "_salt"])
            .drop("_salt")
        )
    return rows.dropDuplicatesWithinWatermark(keys)


def window_totals(
    events: DataFrame,
    keys: list[str],
    value: str = "value",
    ts: str = "ts",
    length: str = "1 day",
    slide: str | None = None,
    delay: str = "1 day",
) -> DataFrame:
    """Count and sum per window; a window is written once the watermark has passed its end."""
    return (
        timed(events, ts, delay)
        .groupBy(F.window(ts, length, slide), *keys)
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "n",
            "total",
        )
    )


def daily_totals(events: DataFrame, keys: list[str], **options: str) -> DataFrame:
    return window_totals(events, keys, length="1 day", **options)


def sliding_totals(events: DataFrame, keys: list[str], days: int = 7, **options: str) -> DataFrame:
    return window_totals(events, keys, length=f"{days} days", slide="1 day", **options)


def idle_sessions(
    events: DataFrame, keys: list[str], gap: str, ts: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """Executions on a stream: sessions that close after `gap` without a row."""
    return (
        timed(events, ts, delay)
        .groupBy(F.session_window(ts, gap), *keys)
        .agg(F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.count("*").alias("n_runs"))
        .select(*keys, "started_at", "ended_at", "n_runs")
    )
