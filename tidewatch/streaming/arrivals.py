"""The monitoring job per arriving batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.forecast import fit_predict
from tidewatch.operators.panel import assign_batch, batch_number, daily_panel, dedup_rows
from tidewatch.operators.rollup import batch_rollup
from tidewatch.plans.monitor import MonitorConfig, model_run
from tidewatch.schema import SERIES
from tidewatch.session import shared_dir
from tidewatch.sources.tables import name_series, write_runs

HISTORY = (
    "store_id string, product_id string, day date, y double, batch_number int, arrival bigint"
)

#: An arrival without repeats is found in so many passes at most; fewer than so many rows need one.
PASSES, PASS_ROWS = 8, 1 << 22

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Outputs:
    """Folders of the tables a replay keeps."""

    history: str
    keys: str
    tail: str
    model_runs: str
    global_runs: str

    @classmethod
    def below(cls, base: str) -> Outputs:
        return cls(f"{base}/history", f"{base}/keys", f"{base}/tail", f"{base}/model_run", f"{base}/global_run")


def _tail_rows(panel: DataFrame, newest: int, config: MonitorConfig) -> DataFrame:
    """The rows that batches from `newest` on can still need.

    Those are the reference batches of the drift test and the longest window before `newest`: bounded per
    series, however long the history is.
    """
    by_day = Window.partitionBy(*SERIES).orderBy(F.col("day").desc())
    older = panel.filter(F.col("batch_number") < newest)
    kept = older.withColumn("_rn", F.row_number().over(by_day)).filter(
        (F.col("_rn") <= config.long_rows)
        | (F.col("batch_number") >= newest - config.drift.reference_batches)
    )
    return panel.filter(F.col("batch_number") >= newest).unionByName(kept.drop("_rn"))


def _previous_tail(spark: SparkSession, out: Outputs, arrival: int) -> DataFrame | None:
    """What the arrival before left behind; None if there is nothing of exactly that arrival."""
    try:
        tail = spark.read.schema(HISTORY).parquet(f"{out.tail}/{(arrival - 1) % 2}")
    except AnalysisException:
        return None
    written_by = tail.select("arrival").first()
    return tail.drop("arrival") if written_by and written_by[0] == arrival - 1 else None


def _shares(sizes: dict[int, int]) -> list[list[int]]:
    """Batches in order, in up to `PASSES` groups with about as many rows each; one empty group if there are none."""
    total, before, groups = sum(sizes.values()), 0, {}
    passes = min(PASSES, 1 + total // PASS_ROWS)
    for batch, rows in sorted(sizes.items()):
        groups.setdefault(before * passes // total, []).append(batch)
        before += rows
    return list(groups.values()) or [[]]


@contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """What a query in here shuffles is deleted when the query ends, not when the driver comes to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _unseen(sales: DataFrame, arrival: int, out: Outputs, config: MonitorConfig) -> DataFrame:
    """The rows of an arrival without repeats of each other or of rows that came before.

    First copies are kept by arrival and batch, with the columns that tell rows apart and those of a sale, and read back
    from there. A repeat has the day of its first copy, so only the rows of the batches that the arrival touches are
    compared, some batches at a time: the rows of one pass are in a shuffle, those of the others aren't. Where the day is
    no part of the key, repeats inside the arrival may differ in it, so all batches are one pass.
    """
    spark = sales.sparkSession
    keys = config.dedup or sales.columns
    rest = [c for c in sales.columns if c not in keys]
    kept = [*keys, *[c for c in (*SERIES, "day", "y") if c in rest]]
    day = F.coalesce(F.col("day"), F.lit("1970-01-01").cast("date"))
    own = batch_number(day, F.lit(config.origin).cast("date"), config.batch_days)
    rows = (sales if "day" in keys else dedup_rows(sales, keys)).withColumn("_batch", own)
    touched = dict(sales.groupBy(own).count().collect())
    try:
        before = spark.read.parquet(out.keys)
    except AnalysisException:
        before = None
    if before is not None:
        mine = (F.col("_arrival").cast("bigint") < arrival) & F.col("_batch").cast("int").isin([*touched])
        before = before.filter(mine).select(*keys, F.col("_batch").cast("int"))
        for batch, n in before.groupBy("_batch").count().collect():
            touched[batch] += n
    folder = f"{out.keys}/_arrival={arrival}"
    for share in _shares(touched) if "day" in keys else [[*touched]]:
        here = F.col("_batch").isin(share)
        came = rows.filter(here).select(*keys, "_batch", *[F.struct(*rest).alias("_rest")] * bool(rest), F.lit(False).alias("_known"))
        if before is not None:
            came = came.unionByName(before.filter(here).withColumn("_known", F.lit(True)), allowMissingColumns=True)
        least = [F.min("_rest").alias("_rest")] if rest else []
        first = came.groupBy(*keys, "_batch").agg(F.max("_known").alias("_known"), *least).filter(~F.col("_known"))
        new = first.select(*[F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in kept], "_batch")
        new = new.sortWithinPartitions("_batch", *keys)  # like keys side by side take less room in a file
        with _released(spark):
            (
                new.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy("_batch")
                .parquet(folder)
            )
    return spark.read.schema(sales.select(*kept).schema).parquet(folder)


def process_arrival(
    sales: DataFrame,
    arrival: int,
    out: Outputs,
    config: MonitorConfig,
    forecaster: Callable[[DataFrame], DataFrame] = fit_predict,
) -> None:
    """Add the sales of one micro-batch to the history and renew the batches it touches.

    Safe to repeat: the daily sums go to a partition of their own per arrival, the records replace those
    of the same execution and batch, and the tail alternates between two folders, so the one that is read is never the one
    that is written. `config.dedup` removes repeats inside an arrival and of earlier arrivals. In order, an arrival reads the tail only. A row that comes late renews its batch and
    all later ones from the full history.
    """
    spark = sales.sparkSession
    origin = F.lit(config.origin).cast("date")
    if config.dedup is not None:
        sales = _unseen(sales, arrival, out, config)
    daily = assign_batch(name_series(daily_panel(sales)), config.batch_days, origin)
    own = f"{out.history}/arrival={arrival}"
    daily.hint("rebalance", "batch_number").write.mode("overwrite").partitionBy("batch_number").parquet(own)
    # In order, the folder of the arrival is all that is listed; the whole history is opened for late rows only.
    arrived = spark.read.schema(HISTORY).option("basePath", out.history).parquet(own)
    oldest = arrived.agg(F.min("batch_number")).first()[0]
    tail = _previous_tail(spark, out, arrival)
    reached = tail.agg(F.max("batch_number")).first()[0] if tail is not None else None
    if reached is not None and (oldest is None or oldest >= reached):
        rows = tail.unionByName(arrived.drop("arrival"))
    else:
        history = spark.read.schema(HISTORY).parquet(out.history)
        rows = history.filter(F.col("arrival") <= arrival).drop("arrival")
    panel = rows.groupBy(*SERIES, "day", "batch_number").agg(F.sum("y").alias("y"))
    newest = rows.agg(F.max("batch_number")).first()[0]
    if newest is None:
        return
    (
        _tail_rows(panel, newest, config)
        .withColumn("arrival", F.lit(arrival).cast("bigint"))
        .write.mode("overwrite")
        .parquet(f"{out.tail}/{arrival % 2}")
    )
    if oldest is None:
        return
    renewed = model_run(panel, config, forecaster).filter(F.col("batch_number") >= oldest)
    write_runs(renewed, out.model_runs)
    stored = spark.read.schema(renewed.schema).parquet(out.model_runs).filter(F.col("batch_number") >= oldest)
    write_runs(batch_rollup(stored), out.global_runs)


def monitor_stream(
    sales: DataFrame,
    base: str,
    config: MonitorConfig,
    forecaster: Callable[[DataFrame], DataFrame] = fit_predict,
):
    """Start the job on a stream of sales; it ends when the source is drained.

    `config.origin` has to be given: a stream has no first day to look up.
    """
    if config.origin is None:
        raise ValueError("a stream needs config.origin")
    out = Outputs.below(base)
    return (
        sales.writeStream.foreachBatch(
            lambda df, arrival: process_arrival(df, arrival, out, config, forecaster)
        )
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )


def replay(
    spark: SparkSession, sales: DataFrame, config: MonitorConfig, name: str = "replay"
) -> Outputs:
    """Drain a stream of sales into new tables in the shared folder."""
    base = shared_dir(spark, name)
    monitor_stream(sales, base, config).awaitTermination()
    return Outputs.below(base)
