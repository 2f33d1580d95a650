"""Columnar sources and sinks: sales, batch extracts, run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import shared_dir


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` below the shared folder and read it back: steps that follow all see the same rows."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def series_code(prefix: str, number: Column) -> Column:
    """P001, S010, S1234 and so on."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))


def name_series(panel: DataFrame) -> DataFrame:
    """Codes in place of numeric keys. Applied to the panel, so source rows are summed by number."""
    kinds = dict(panel.dtypes)
    for column, prefix in (("store_id", "S"), ("product_id", "P")):
        if kinds[column] != "string":
            panel = panel.withColumn(column, series_code(prefix, F.col(column)))
    return panel


def sales_from_lineitem(
    lineitem: DataFrame, stores: int = 10, products: int = 5, keep: Sequence[str] = ()
) -> DataFrame:
    """Order lines as sales of `products` x `stores` numbered series; other columns are not read.

    `keep` names columns to carry along, such as the row key that `MonitorConfig.dedup` needs.
    """
    return lineitem.select(
        *keep,
        (F.col("l_suppkey") % stores + 1).alias("store_id"),
        (F.col("l_partkey") % products + 1).alias("product_id"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").alias("y"),
    )


def write_runs(records: DataFrame, path: str) -> None:
    """Write records by execution and batch, or by batch where there is no execution number.

    With dynamic overwrite a repeated write replaces only the pairs of execution and batch that it holds, so
    a rerun under another number stands beside the first one. The records are small against the sales, so
    one task per pair writes one file each; AQE splits a pair that is large.
    """
    parts = [c for c in ("execution_number", "batch_number") if c in records.columns]
    (
        records.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


write_panel = write_runs


def read_batch(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The extract of one batch; only its partition is listed and read."""
    return spark.read.parquet(path).filter(F.col("batch_number") == n)
