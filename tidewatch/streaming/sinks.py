"""Run a stream over everything that is available and read back what it wrote."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.session import shared_dir


def drained(query: StreamingQuery) -> int:
    """Wait until the source is drained; how many rows came too late for the watermark, which is logged too."""
    query.awaitTermination()
    late = sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
    if late:
        logging.getLogger(__name__).warning("%s: %d rows came after the watermark and were dropped", query.name, late)
    return late


def run_available(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Append the output of `stream` to Parquet in the shared folder until its source is drained.

    Progress is kept next to the output, so a restarted query goes on where it stopped.
    """
    base = shared_dir(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{base}/progress")
        .option("path", f"{base}/rows")
        .trigger(availableNow=True)
        .start()
    )
    drained(query)
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def run_latest(spark: SparkSession, stream: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The newest version of every key that `stream` gives in update mode, open windows and batches included.

    Each micro-batch writes its changes to a folder of its own, which a repeated attempt replaces.
    """
    base = shared_dir(spark, name)
    query = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", f"{base}/progress")
        .foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{base}/rows/version={n}"))
        .trigger(availableNow=True)
        .start()
    )
    drained(query)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
    versions = spark.read.schema(f"{fields}, version bigint").parquet(f"{base}/rows")
    rest = [c for c in stream.columns if c not in keys]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in stream.columns])
