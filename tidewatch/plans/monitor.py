"""The monitoring job: sales in, one record per model and one per batch out, in one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.drift import DriftRule, training_windows
from tidewatch.operators.forecast import fit_predict, split
from tidewatch.operators.panel import assign_batch, daily_panel, dedup_rows, first_day
from tidewatch.operators.rollup import batch_rollup
from tidewatch.operators.scoring import model_records
from tidewatch.sources.tables import name_series
from tidewatch.schema import LONG_WINDOW, SHORT_WINDOW


@dataclass(frozen=True)
class MonitorConfig:
    """Everything that is a choice. `origin` (a date) saves the scan that finds the first day.

    `dedup`: None leaves repeated source rows in, a list of columns removes rows equal in those, and []
    removes rows equal in all columns. Two true sales may agree in series, day and y, so the sales have to
    carry a row key for that.
    """

    batch_days: int = 90
    origin: str | None = None
    dedup: list[str] | None = None
    drift: DriftRule = field(default_factory=DriftRule)
    long_rows: int = LONG_WINDOW
    short_rows: int = SHORT_WINDOW
    holdout_percent: int = 20
    execution: int | None = None


def batched_panel(sales: DataFrame, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    origin: Column = F.lit(config.origin).cast("date") if config.origin else first_day(sales)
    if config.dedup is not None:
        sales = dedup_rows(sales, config.dedup or None)
    return assign_batch(name_series(daily_panel(sales)), config.batch_days, origin)


def marked_windows(panel: DataFrame, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    windows = training_windows(panel, config.drift, config.long_rows, config.short_rows)
    return split(windows, config.holdout_percent)


def model_run(
    panel: DataFrame,
    config: MonitorConfig = MonitorConfig(),
    forecaster: Callable[[DataFrame], DataFrame] = fit_predict,
) -> DataFrame:
    """Drift, windows, fit, prediction and scores of every batch of a batched panel."""
    return model_records(forecaster(marked_windows(panel, config)), config.execution)


def monitor(sales: DataFrame, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    """The roll-up of every batch, straight from the sales."""
    return batch_rollup(model_run(batched_panel(sales, config), config))
