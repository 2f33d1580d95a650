"""Additive forecasts: trend plus weekday offsets in built-in functions, and a richer grouped fit.

The grouped fit follows Taylor and Letham, "Forecasting at Scale" (2018): a piecewise linear trend
with changepoints and Fourier seasonality. It is solved by ridge least squares.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import day_number, fourier_terms
from tidewatch.schema import BOOKKEEPING, RUN_KEY


def split(windows: DataFrame, holdout_percent: int = 20) -> DataFrame:
    """Mark the newest rows of each window as scored, the rest as trained on.

    The share is taken of data_points, rounded down, and at least one row, so a rerun scores the same
    rows. With 0 every row is both trained on and scored.
    """
    if holdout_percent == 0:
        return windows.withColumn("is_train", F.lit(True)).withColumn("is_scored", F.lit(True))
    held = F.greatest(F.lit(1), F.floor(F.col("data_points") * holdout_percent / 100))
    scored = F.col("rank_from_end") < held
    return windows.withColumn("is_train", ~scored).withColumn("is_scored", scored)


def _trend(y: Column, t: Column) -> list[Column]:
    slope = F.coalesce(F.regr_slope(y, t), F.lit(0.0))
    return [slope.alias("slope"), F.avg(y).alias("mean_y"), F.avg(t).alias("mean_t")]


def fit_trend(marked: DataFrame, keys: list[str] = RUN_KEY) -> DataFrame:
    """Least squares line over the training rows, t in days since 1970-01-01.

    intercept = mean_y - slope * mean_t; a window with a single training day has slope 0.
    """
    return (
        marked.filter("is_train")
        .groupBy(*keys)
        .agg(*_trend(F.col("y"), day_number(F.col("day")).cast("double")), F.count("*").alias("n_train"))
        .withColumn("intercept", F.col("mean_y") - F.col("slope") * F.col("mean_t"))
    )


def fit_weekly(marked: DataFrame, keys: list[str] = RUN_KEY) -> DataFrame:
    """Trend and the mean residual of every weekday (0 = Monday) in one aggregation.

    The mean residual of a weekday follows from its mean y and mean t, so the rows are read once and
    no second pass over residuals is needed. A weekday without training rows has offset 0.
    """
    t = day_number(F.col("day")).cast("double")
    weekday = F.weekday("day")
    per_day = []
    for d in range(7):
        on = weekday == d
        per_day += [
            F.avg(F.when(on, F.col("y"))).alias(f"_y{d}"),
            F.avg(F.when(on, t)).alias(f"_t{d}"),
        ]
    fitted = (
        marked.filter("is_train")
        .groupBy(*keys)
        .agg(*_trend(F.col("y"), t), F.count("*").alias("n_train"), *per_day)
    )
    line = lambda at: F.col("mean_y") + F.col("slope") * (at - F.col("mean_t"))
    return fitted.select(
        *keys,
        "slope",
        "mean_y",
        "mean_t",
        "n_train",
        (F.col("mean_y") - F.col("slope") * F.col("mean_t")).alias("intercept"),
        *[
            F.coalesce(F.col(f"_y{d}") - line(F.col(f"_t{d}")), F.lit(0.0)).alias(f"weekday_{d}")
            for d in range(7)
        ],
    )


def predict(model: DataFrame, days: DataFrame, keys: list[str] = RUN_KEY) -> DataFrame:
    """yhat of every row of `days` that has a model: a join of coefficients to days.

    The coefficients are one row per key. They are not hinted: AQE broadcasts them while they are small
    and splits a hot key of `days` otherwise.
    """
    columns = days.columns
    offset = F.element_at(
        F.array(*[F.col(f"weekday_{d}") for d in range(7)]), F.weekday("day") + 1
    )
    yhat = (
        F.col("mean_y")
        + F.col("slope") * (day_number(F.col("day")).cast("double") - F.col("mean_t"))
        + offset
    )
    return days.join(model, keys).select(*columns, yhat.alias("yhat"))


def fit_predict(marked: DataFrame) -> DataFrame:
    """`fit_weekly` and `predict` without the join: yhat as window expressions over each window.

    Used by the monitoring plan, where all rows of a window already lie in one partition: the windows
    share one sort and add no shuffle. The result equals the join form.
    """
    whole = Window.partitionBy(*RUN_KEY)
    same_weekday = Window.partitionBy(*RUN_KEY, "weekday")
    with_t = (
        marked.withColumn("_t", day_number(F.col("day")).cast("double"))
        .withColumn("_train_y", F.when(F.col("is_train"), F.col("y")))
        .withColumn("_train_t", F.when(F.col("is_train"), F.col("_t")))
    )
    fitted = with_t.select(
        *with_t.columns,
        F.avg("_train_y").over(same_weekday).alias("_day_y"),
        F.avg("_train_t").over(same_weekday).alias("_day_t"),
        F.coalesce(F.regr_slope("_train_y", "_train_t").over(whole), F.lit(0.0)).alias("_slope"),
        F.avg("_train_y").over(whole).alias("_mean_y"),
        F.avg("_train_t").over(whole).alias("_mean_t"),
    )
    line = lambda at: F.col("_mean_y") + F.col("_slope") * (at - F.col("_mean_t"))
    offset = F.coalesce(F.col("_day_y") - line(F.col("_day_t")), F.lit(0.0))
    return fitted.select(*marked.columns, (line(F.col("_t")) + offset).alias("yhat"))


def fourier(df: DataFrame, period: float, order: int, prefix: str = "season") -> DataFrame:
    """Add the Fourier terms of `period` days as columns."""
    t = day_number(F.col("day")).cast("double")
    return df.select("*", *fourier_terms(t, period, order, prefix))


@dataclass(frozen=True)
class AdditiveSpec:
    """Shape of the grouped fit. Changepoints are spread over the first 80 % of the training span.

    A series has one changepoint for each `rows_per_changepoint` training rows, `changepoints` at most. A season is
    fitted only where the training span holds `season_periods` of its periods. The scales, public defaults of
    this kind of model, are those of normal priors on the coefficients of y / max(abs(y)): the ridge of a coefficient is the variance of the
    noise over the square of its scale, so a clean series bends freely and a noisy one hardly.
    """

    changepoints: int = 8
    rows_per_changepoint: int = 10
    season_periods: float = 2.0
    yearly_order: int = 3
    weekly_order: int = 3
    trend_scale: float = 5.0
    changepoint_scale: float = 0.05
    season_scale: float = 10.0
    holiday_scale: float = 10.0


MODEL_SCHEMA = (
    "store_id string, product_id string, batch_number int, n_train bigint, t_start double,"
    " t_span double, y_scale double, knots array<double>, beta array<double>"
)


@dataclass(frozen=True)
class _Fitted:
    """Models of all batches of a series; arrays have one row per batch."""

    numbers: np.ndarray
    n_train: np.ndarray
    start: np.ndarray
    span: np.ndarray
    scale: np.ndarray
    knots: np.ndarray
    beta: np.ndarray
    yhat: np.ndarray


def fit_batches(
    batch: np.ndarray, t: np.ndarray, y: np.ndarray, train: np.ndarray, spec: AdditiveSpec, events: np.ndarray | None = None
) -> _Fitted:
    """Fit every batch on its training rows and predict all rows.

    Rows are sorted by batch and t, and every batch has a training row. `events` has a column of 0 and 1 for each holiday
    regressor, whose coefficients come last. The normal equations of all batches are solved in one call.
    """
    numbers, of = np.unique(batch, return_inverse=True)
    t_train, of_train = t[train], of[train]
    lo = np.searchsorted(of_train, np.arange(len(numbers)))
    n = np.bincount(of_train, minlength=len(numbers))
    start = t_train[lo]
    span = np.maximum(t_train[lo + n - 1] - start, 1.0)

    # Unused knots sit at the end of the training span, where their hinge is zero.
    used = np.minimum(spec.changepoints, n // spec.rows_per_changepoint)[:, None]
    place = np.arange(1, spec.changepoints + 1)
    knots = np.where(place <= used, 0.8 * place / (used + 1), 1.0)

    u = (t - start[of]) / span[of]
    columns = [np.ones_like(u)[:, None], u[:, None], np.maximum(u[:, None] - knots[of], 0.0)]
    for period, order in ((365.25, spec.yearly_order), (7.0, spec.weekly_order)):
        angle = 2.0 * np.pi * t[:, None] * np.arange(1, order + 1) / period
        waves = np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(t), 2 * order)
        columns.append(waves * (span >= spec.season_periods * period)[of][:, None])
    if events is not None:
        columns.append(events)
    x = np.hstack(columns)

    x_train = x[train]
    scale = np.maximum.reduceat(np.abs(y[train]), lo)
    scale[scale == 0] = 1.0
    target = y[train] / scale[of_train]
    parts = [slice(a, a + k) for a, k in zip(lo, n)]
    gram = np.stack([x_train[part].T @ x_train[part] for part in parts])
    moment = np.stack([target[part] @ x_train[part] for part in parts])[:, :, None]

    # First with almost no penalty, to measure the noise; then with the priors. Columns of an unused knot or
    # an unseen season are all zero and get the coefficient 0.
    unit = np.eye(x.shape[1])
    free = np.linalg.solve(gram + 1e-8 * unit, moment)[:, :, 0]
    squares = (target - (x_train * free[of_train]).sum(axis=1)) ** 2
    spare = n - np.count_nonzero(np.diagonal(gram, axis1=1, axis2=2), axis=1)
    noise = np.where(spare > 0, np.add.reduceat(squares, lo) / np.maximum(spare, 1), 1.0)
    width = np.full(x.shape[1], spec.season_scale)
    width[:2] = spec.trend_scale
    width[2 : 2 + spec.changepoints] = spec.changepoint_scale
    if events is not None:
        width[-events.shape[1] :] = spec.holiday_scale
    penalty = np.maximum(noise[:, None] / width**2, 1e-8)
    beta = np.linalg.solve(gram + penalty[:, :, None] * unit, moment)[:, :, 0]
    yhat = (x * beta[of]).sum(axis=1) * scale[of]
    return _Fitted(numbers, n, start, span, scale, knots, beta, yhat)


def _arrays(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as numpy arrays, with the rows sorted by batch and t."""
    got = [table.column(name).to_numpy() for name in ("batch_number", "t", *names)]
    order = np.lexsort((got[1], got[0]))
    return [order, *[column[order] for column in got]]


def fit_series(marked: DataFrame, spec: AdditiveSpec = AdditiveSpec()) -> DataFrame:
    """One model per (series, batch), all in one grouped job; see MODEL_SCHEMA.

    Grouped by the series, so one Python call fits all batches of it and the partitioning of
    `training_windows` is reused. A group is bounded by days times the batches a day serves.
    """

    def fit_all(table: pa.Table) -> pa.Table:
        _, batch, t, y = _arrays(table, "y")
        got = fit_batches(batch, t.astype(float), y, np.ones(len(t), dtype=bool), spec)
        many = len(got.numbers)
        return pa.table(
            {
                "store_id": pa.repeat(table.column("store_id")[0], many),
                "product_id": pa.repeat(table.column("product_id")[0], many),
                "batch_number": pa.array(got.numbers, pa.int32()),
                "n_train": pa.array(got.n_train, pa.int64()),
                "t_start": got.start,
                "t_span": got.span,
                "y_scale": got.scale,
                "knots": pa.array(list(got.knots), pa.list_(pa.float64())),
                "beta": pa.array(list(got.beta), pa.list_(pa.float64())),
            }
        )

    train = marked.filter("is_train and y is not null").select(
        *RUN_KEY, day_number(F.col("day")).alias("t"), "y"
    )
    return train.groupBy("store_id", "product_id").applyInArrow(fit_all, MODEL_SCHEMA)


SCORED = [*RUN_KEY, "day", "y", "is_scored", *BOOKKEEPING]
SCORED_SCHEMA = (
    "store_id string, product_id string, batch_number int, day date, y double, is_scored boolean,"
    " data_points bigint, training_period_days int, has_concept_drift boolean, yhat double"
)


def fit_predict_additive(marked: DataFrame, spec: AdditiveSpec = AdditiveSpec()) -> DataFrame:
    """`fit_series` and `predict_additive` on the scored rows in one pass; used by the monitoring plan.

    The windows are computed once and only the scored rows come back from Python; no join is needed. A
    window without a training row has no prediction.
    """

    def fit_and_predict(table: pa.Table) -> pa.Table:
        order, batch, t, y, train, scored = _arrays(table, "y", "is_train", "is_scored")
        yhat = np.full(len(t), np.nan)
        fitted = np.isin(batch, batch[train])
        if fitted.any():
            got = fit_batches(batch[fitted], t[fitted].astype(float), y[fitted], train[fitted], spec)
            yhat[fitted] = got.yhat
        rows = table.select(SCORED).take(order[scored])
        return rows.append_column("yhat", pa.array(yhat[scored], from_pandas=True))

    rows = marked.filter("y is not null").select(
        *SCORED, "is_train", day_number(F.col("day")).alias("t")
    )
    return rows.groupBy("store_id", "product_id").applyInArrow(fit_and_predict, SCORED_SCHEMA)


def predict_additive(
    model: DataFrame, days: DataFrame, spec: AdditiveSpec = AdditiveSpec(), keys: list[str] = RUN_KEY, extra: list[str] | None = None
) -> DataFrame:
    """yhat of the grouped fit, evaluated in the JVM from the stored coefficients; `extra` columns of the model stay."""
    columns = days.columns
    t = day_number(F.col("day")).cast("double")
    u = (t - F.col("t_start")) / F.col("t_span")
    seasonal = []
    for period, order in ((365.25, spec.yearly_order), (7.0, spec.weekly_order)):
        for k in range(1, order + 1):
            angle = t * (2.0 * math.pi * k / period)
            seasonal += [F.sin(angle), F.cos(angle)]
    terms = F.concat(
        F.array(F.lit(1.0), u),
        F.transform("knots", lambda k: F.greatest(u - k, F.lit(0.0))),
        F.array(*seasonal) if seasonal else F.expr("cast(array() as array<double>)"),
    )
    dot = F.aggregate(
        F.zip_with(terms, F.col("beta"), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
    )
    return days.join(model, keys).select(*columns, *(extra or []), (dot * F.col("y_scale")).alias("yhat"))
