"""The daily panel: one row per series and day, and what can be said about its coverage.

A series holds at most one row per calendar day once `daily_panel` has run, so every window that is
partitioned by the series is bounded by the calendar, however many source rows a hot series has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import batch_number
from tidewatch.schema import RUN_KEY, SERIES


def dedup_rows(sales: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Remove repeated source rows.

    Without `keys` two rows repeat each other when all columns agree. With `keys` the row with the
    smallest remaining columns is kept, so the outcome does not depend on the order of the input.
    Both are aggregations: copies collapse before the shuffle.
    """
    if keys is None:
        return sales.distinct()
    rest = [c for c in sales.columns if c not in keys]
    if not rest:
        return sales.select(*keys).distinct()
    return (
        sales.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("_kept"))
        .select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in sales.columns])
    )


def daily_panel(sales: DataFrame) -> DataFrame:
    """Sum of y per series and day. Map-side partial sums keep a hot series out of the shuffle."""
    return sales.groupBy(*SERIES, "day").agg(F.sum("y").alias("y"))


def first_day(sales: DataFrame) -> Column:
    """The earliest day as a scalar subquery: one column is scanned, nothing is shuffled."""
    return sales.agg(F.min("day")).scalar()


def assign_batch(panel: DataFrame, days: int, origin: Column) -> DataFrame:
    return panel.withColumn("batch_number", batch_number(F.col("day"), origin, days))


def history_asof(panel: DataFrame, last_batch: Column | None = None) -> DataFrame:
    """The rows visible to each batch: batch n sees all days of the batches up to n.

    The row's own batch becomes `source_batch`. Each row is repeated once per later batch by a
    sequence, so no join is needed; `history_profile` gives the totals without the repetition.
    """
    if last_batch is None:
        last_batch = panel.agg(F.max("batch_number")).scalar()
    return panel.withColumnRenamed("batch_number", "source_batch").withColumn(
        "batch_number", F.explode(F.sequence("source_batch", last_batch))
    )


def history_profile(panel: DataFrame) -> DataFrame:
    """Rows, days and demand visible to each batch that a series has rows in, as running totals."""
    running = Window.partitionBy(*SERIES).orderBy("batch_number")
    return (
        panel.groupBy(*RUN_KEY)
        .agg(
            F.count("*").alias("n"),
            F.min("day").alias("lo"),
            F.max("day").alias("hi"),
            F.sum("y").alias("s"),
        )
        .select(
            *RUN_KEY,
            F.sum("n").over(running).alias("visible_rows"),
            F.min("lo").over(running).alias("first_day"),
            F.max("hi").over(running).alias("last_day"),
            F.sum("s").over(running).alias("visible_y"),
        )
    )


def last_rows(panel: DataFrame, rows: int) -> DataFrame:
    """The newest `rows` rows of each series: rows, not days. The limit is applied before the shuffle too."""
    newest = Window.partitionBy(*SERIES).orderBy(F.col("day").desc())
    return panel.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= rows).drop("_rn")


def window_profile(df: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """data_points, training_period_days and the gap test of each group of panel rows."""
    profile = df.groupBy(*keys).agg(
        F.count("*").alias("data_points"),
        F.datediff(F.max("day"), F.min("day")).alias("training_period_days"),
    )
    return profile.withColumn("has_gap", F.col("data_points") < F.col("training_period_days") + 1)


def gap_list(panel: DataFrame) -> DataFrame:
    """Each run of absent days between two rows of a series."""
    by_day = Window.partitionBy(*SERIES).orderBy("day")
    return (
        panel.select(*SERIES, "day", F.lag("day").over(by_day).alias("_before"))
        .filter(F.datediff("day", "_before") > 1)
        .select(
            *SERIES,
            F.date_add("_before", 1).alias("gap_start"),
            F.date_sub("day", 1).alias("gap_end"),
            (F.datediff("day", "_before") - 1).alias("gap_days"),
        )
    )


def missing_series(panel: DataFrame, expected: DataFrame | None = None, grid: bool = False) -> DataFrame:
    """(series, batch) pairs without a row, from batch 1 to the last batch of the panel.

    Expected are the series seen in any batch, those listed in `expected`, and with `grid` every product in every store.
    The products are one array, which every store unfolds: the bound is that of a product dimension. The batches present
    are gathered per series (at most one number per batch) and subtracted from the full sequence.
    """
    last_batch = panel.agg(F.max("batch_number")).scalar()
    rows = panel.select(*RUN_KEY)
    if grid:
        products = panel.agg(F.collect_set("product_id")).scalar()
        every = panel.select("store_id").distinct().select("store_id", F.explode(products).alias("product_id"))
        expected = every if expected is None else every.unionByName(expected.select(*SERIES))
    if expected is not None:
        rows = rows.unionByName(
            expected.select(*SERIES).withColumn("batch_number", F.lit(None).cast("int"))
        )
    present = rows.groupBy(*SERIES).agg(F.collect_set("batch_number").alias("present"))
    everything = F.sequence(F.lit(1), last_batch)
    return present.select(
        *SERIES, F.explode(F.array_except(everything, F.col("present"))).alias("batch_number")
    )


def dense_calendar(panel: DataFrame, fill: float = 0.0) -> DataFrame:
    """One row for every day between the first and last day of a series, absent days filled.

    Each row is stretched up to the day before its successor, so the calendar is never joined.
    """
    by_day = Window.partitionBy(*SERIES).orderBy("day")
    until = F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), F.col("day"))
    return (
        panel.select(*SERIES, F.col("day").alias("_own"), "y", until.alias("_until"))
        .select(*SERIES, "_own", "y", F.explode(F.sequence("_own", "_until")).alias("day"))
        .select(
            *SERIES,
            "day",
            F.when(F.col("day") == F.col("_own"), F.col("y")).otherwise(F.lit(fill)).alias("y"),
            (F.col("day") != F.col("_own")).alias("filled"),
        )
    )
