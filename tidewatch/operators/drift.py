"""Drift flags and the training window that follows from them.

The test itself is a parameter: the default compares the mean of a batch with the mean of the
batches before it. The flag depends on the data only, never on a fitted score, and each batch is
judged anew, so a series goes back to the long window once its level has settled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.schema import LONG_WINDOW, RUN_KEY, SERIES, SHORT_WINDOW


@dataclass(frozen=True)
class Moments:
    """Count, mean and sample variance of the rows on one side of a comparison."""

    n: Column
    mean: Column
    var: Column


Detector = Callable[[Moments, Moments], Column]


def mean_shift(recent: Moments, reference: Moments) -> Column:
    """z of the difference of two means with unequal variances (Welch)."""
    error = F.sqrt(recent.var / recent.n + reference.var / reference.n)
    return (recent.mean - reference.mean) / F.nullif(error, F.lit(0.0))


@dataclass(frozen=True)
class DriftRule:
    """`threshold` on the absolute score; the reference is the `reference_batches` before the batch."""

    threshold: float = 2.0
    reference_batches: int = 3
    detector: Detector = mean_shift


def judged(recent: Moments, reference: Moments, rule: DriftRule) -> tuple[Column, Column]:
    """Score and flag of a comparison. Two constant levels have no spread to measure a score in: any step
    between them is drift."""
    enough = (recent.n >= 2) & (reference.n >= 2)
    score = F.when(enough, rule.detector(recent, reference))
    step = (recent.var == 0) & (reference.var == 0) & (recent.mean != reference.mean)
    return score, F.coalesce(F.abs(score) > rule.threshold, enough & step, F.lit(False))


def with_drift(panel: DataFrame, rule: DriftRule = DriftRule()) -> DataFrame:
    """Add drift_score and has_concept_drift of the row's own batch to every panel row.

    The frames range over batch numbers, so they move once per batch and not once per row, and they
    share the partitioning and the order of the other windows over a series.
    """
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    recent = order.rangeBetween(0, 0)
    reference = order.rangeBetween(-rule.reference_batches, -1)

    def moments(frame) -> list[Column]:
        return [F.count("y").over(frame), F.avg("y").over(frame), F.var_samp("y").over(frame)]

    names = ["_n1", "_m1", "_v1", "_n0", "_m0", "_v0"]
    measured = panel.select(
        "*", *[c.alias(n) for c, n in zip(moments(recent) + moments(reference), names)]
    )
    column = [F.col(n) for n in names]
    score, flag = judged(Moments(*column[:3]), Moments(*column[3:]), rule)
    return measured.withColumns({"drift_score": score, "has_concept_drift": flag}).drop(*names)


def drift_flags(panel: DataFrame, rule: DriftRule = DriftRule()) -> DataFrame:
    """One row per series and batch with its score and flag."""
    by_day = Window.partitionBy(*SERIES).orderBy("batch_number", "day")
    closing = F.lead("batch_number").over(by_day)
    return (
        with_drift(panel.withColumn("_next", closing), rule)
        .filter(F.col("_next").isNull() | (F.col("_next") != F.col("batch_number")))
        .select(*RUN_KEY, "drift_score", "has_concept_drift")
    )


def training_windows(
    panel: DataFrame,
    rule: DriftRule = DriftRule(),
    long_rows: int = LONG_WINDOW,
    short_rows: int = SHORT_WINDOW,
) -> DataFrame:
    """The rows each (series, batch) is trained on: the newest `long_rows` rows visible to the batch,
    or the newest `short_rows` if the batch is in drift.

    Output: series, batch_number (of the window), day, weekday (0 = Monday), y, rank_from_end
    (0 = newest), data_points, training_period_days, has_concept_drift. A series has a window in every batch it has
    rows in.

    The batches a row serves are a range of numbers that ends at the batch of the row `long_rows - 1`
    places further on, so a lead and a sequence replace the non-equi join of rows with batches. The
    whole operator needs one shuffle, on the series. The one sort of the repeated rows serves the windows
    per batch here and those per weekday of the fit.
    """
    if short_rows > long_rows:
        raise ValueError("the short window cannot be longer than the long one")
    by_day = Window.partitionBy(*SERIES).orderBy("batch_number", "day")
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def served_until(rows: int) -> Column:
        """The newest batch that is complete `rows - 1` places further on, or the last of the series."""
        there = F.lead("batch_number", rows - 1).over(by_day)
        after = F.lead("batch_number", rows).over(by_day)
        complete = F.when(after == there, there - 1).otherwise(there)
        return F.coalesce(complete, F.max("batch_number").over(whole))

    placed = panel.select(
        *SERIES,
        "day",
        "y",
        "batch_number",
        F.row_number().over(by_day).alias("_rn"),
        served_until(long_rows).alias("_long_until"),
        served_until(short_rows).alias("_short_until"),
    )
    served = with_drift(placed, rule).select(
        *SERIES,
        "day",
        "y",
        "_rn",
        "_short_until",
        F.col("batch_number").alias("_own"),
        F.col("has_concept_drift").alias("_flag"),
        F.explode(
            F.when(
                F.col("_long_until") >= F.col("batch_number"),
                F.sequence("batch_number", "_long_until"),
            )
        ).alias("batch_number"),
        F.weekday("day").alias("weekday"),
    ).sortWithinPartitions(*RUN_KEY, "weekday")
    window = Window.partitionBy(*RUN_KEY)
    flagged = served.withColumn(
        "has_concept_drift",
        F.max(F.when(F.col("_own") == F.col("batch_number"), F.col("_flag"))).over(window),
    ).filter(
        F.col("has_concept_drift").isNotNull()
        & (~F.col("has_concept_drift") | (F.col("_short_until") >= F.col("batch_number")))
    )
    return flagged.select(
        *RUN_KEY,
        "day",
        "weekday",
        "y",
        (F.max("_rn").over(window) - F.col("_rn")).alias("rank_from_end"),
        F.count("*").over(window).alias("data_points"),
        F.datediff(F.max("day").over(window), F.min("day").over(window)).alias("training_period_days"),
        "has_concept_drift",
    )


def window_sizes(windows: DataFrame) -> DataFrame:
    """One row per (series, batch): the bookkeeping of its training window."""
    return windows.filter(F.col("rank_from_end") == 0).select(
        *RUN_KEY, "data_points", "training_period_days", "has_concept_drift"
    )


def drift_episodes(flags: DataFrame) -> DataFrame:
    """Runs of consecutive flagged batches of a series (gaps and islands)."""
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    return (
        flags.filter("has_concept_drift")
        .select(
            *RUN_KEY,
            (F.col("batch_number") - F.row_number().over(order)).alias("_island"),
        )
        .groupBy(*SERIES, "_island")
        .agg(
            F.min("batch_number").alias("first_batch"),
            F.max("batch_number").alias("last_batch"),
            F.count("*").alias("n_batches"),
        )
        .drop("_island")
    )
