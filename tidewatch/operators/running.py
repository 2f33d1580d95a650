"""Windows as differences of running sums.

A training window is a stretch of the rows of a series in order of day. Sums over it are the difference of two running
sums, so a window needs two rows of the panel and not each of its rows, and a row that serves five batches is not
repeated five times. Everything here is one row per (series, day) and two per (series, batch).

Running sums are taken of days since the first day of the series, whole numbers that doubles hold exactly. Rows without
y are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import day_number
from tidewatch.operators.drift import DriftRule, with_drift
from tidewatch.operators.forecast import MODEL_SCHEMA, AdditiveSpec, fit_batches
from tidewatch.schema import LONG_WINDOW, RUN_KEY, SERIES, SHORT_WINDOW

WEEKDAYS = range(7)
#: Running sums, and those of each weekday.
SUMS = ["n", "y", "t", "ty", "tt", "yy"]
BY_WEEKDAY = [f"{s}{d}" for d in WEEKDAYS for s in ("n", "y", "t")]

BOUNDS = [*RUN_KEY, "train_from", "train_to", "scored_to", "data_points", "has_concept_drift"]


def _by_day() -> Window:
    return Window.partitionBy(*SERIES).orderBy("day")


def numbered(panel: DataFrame) -> DataFrame:
    """Rows with y and their place in the series, from 1."""
    return panel.filter(F.col("y").isNotNull()).withColumn("place", F.row_number().over(_by_day()))


def window_bounds(
    panel: DataFrame,
    rule: DriftRule = DriftRule(),
    long_rows: int = LONG_WINDOW,
    short_rows: int = SHORT_WINDOW,
    holdout_percent: int = 20,
) -> DataFrame:
    """One row per series and batch it has rows in; places (train_from, train_to] are trained on, (train_to, scored_to] scored.

    The same windows as those of `training_windows` and `split`, without their rows. With holdout 0 all rows are trained
    on and scored, and (train_from, scored_to] is scored.
    """
    if short_rows > long_rows:
        raise ValueError("the short window cannot be longer than the long one")
    ends = numbered(panel).withColumn("_next", F.lead("batch_number").over(_by_day()))
    last = with_drift(ends, rule).filter(F.col("_next").isNull() | (F.col("_next") != F.col("batch_number")))
    size = F.least(F.col("place"), F.when(F.col("has_concept_drift"), short_rows).otherwise(long_rows))
    held = F.greatest(F.lit(1), F.floor(F.col("data_points") * holdout_percent / 100)) if holdout_percent else F.lit(0)
    return last.withColumn("data_points", size.cast("bigint")).select(
        *RUN_KEY,
        (F.col("place") - F.col("data_points")).alias("train_from"),
        (F.col("place") - held).alias("train_to"),
        F.col("place").cast("bigint").alias("scored_to"),
        "data_points",
        "has_concept_drift",
    )


def running_sums(panel: DataFrame) -> DataFrame:
    """(series, place, first_day, sums): what all rows up to each place add up to, one row per series and day."""
    whole = Window.partitionBy(*SERIES)
    rows = numbered(panel).select(
        *SERIES, "day", F.col("y").cast("double").alias("_y"), F.weekday("day").alias("_d"), "place", F.min("day").over(whole).alias("first_day")
    )
    t, y = F.datediff("day", "first_day").cast("double"), F.col("_y")
    parts = dict(zip(SUMS, (F.lit(1.0), y, t, t * y, t * t, y * y)))
    for d in WEEKDAYS:
        on = F.col("_d") == d
        parts |= {f"{s}{d}": F.when(on, v).otherwise(0.0) for s, v in (("n", F.lit(1.0)), ("y", y), ("t", t))}
    upto = _by_day().rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(*SERIES, "place", "first_day", *[F.sum(v).over(upto).alias(k) for k, v in parts.items()])


def moments(running: DataFrame, bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Sums over the places (start, end] of every window: running sums at `end` less those at `start`.

    Windows without a row are absent. One join on (series, place) of two rows per window.
    """
    asked = bounds.select(
        *RUN_KEY,
        F.explode(
            F.array(
                F.struct(F.col(end).cast("int").alias("place"), F.lit(1.0).alias("sign")),
                F.struct(F.col(start).cast("int").alias("place"), F.lit(-1.0).alias("sign")),
            )
        ).alias("_at"),
    ).select(*RUN_KEY, "_at.place", "_at.sign")
    signed = asked.join(running, [*SERIES, "place"])
    totals = [F.sum(F.col(c) * F.col("sign")).alias(c) for c in [*SUMS, *BY_WEEKDAY]]
    return signed.groupBy(*RUN_KEY).agg(F.max("first_day").alias("first_day"), *totals).filter(F.col("n") > 0)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def fit_weekly_running(panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """The result of `forecast.fit_weekly` from running sums: trend, then the mean residual of every weekday."""
    m = moments(running_sums(panel), bounds, "train_from", "train_to")
    n, y, t = F.col("n"), F.col("y"), F.col("t")
    slope = _ratio(n * F.col("ty") - t * y, n * F.col("tt") - t * t)
    line = m.select("*", slope.alias("slope"), (y / n).alias("mean_y"), (t / n).alias("_mean_t"))
    at = lambda d: F.col(f"t{d}") / F.col(f"n{d}") - F.col("_mean_t")
    offset = lambda d: F.when(
        F.col(f"n{d}") > 0, F.col(f"y{d}") / F.col(f"n{d}") - F.col("mean_y") - F.col("slope") * at(d)
    ).otherwise(0.0)
    mean_t = F.col("_mean_t") + day_number(F.col("first_day"))
    return line.select(
        *RUN_KEY,
        "slope",
        "mean_y",
        mean_t.alias("mean_t"),
        F.col("n").cast("bigint").alias("n_train"),
        (F.col("mean_y") - F.col("slope") * mean_t).alias("intercept"),
        *[offset(d).alias(f"weekday_{d}") for d in WEEKDAYS],
    )


def fit_additive_weekly(panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """Trend and weekday levels fitted together by least squares, and the rmse on the scored rows, all from running sums.

    The slope is that of the deviations from the weekday means, the level of a weekday follows from it. `level_d` is the
    level on weekday d at the middle of the training days; a weekday without training rows has the mean of all. The
    squared error of the scored rows is expanded into their sums, so no row is predicted.
    """
    running = running_sums(panel)
    m = moments(running, bounds, "train_from", "train_to")
    total = lambda f: sum((f(d) for d in WEEKDAYS), F.lit(0.0))
    own = lambda s, d: _ratio(F.col(f"{s}{d}"), F.col(f"n{d}"))
    ty = F.col("ty") - total(lambda d: F.col(f"t{d}") * own("y", d))
    tt = F.col("tt") - total(lambda d: F.col(f"t{d}") * own("t", d))
    # One row for each weekday leaves no spread in t; what is left then is rounding.
    slope = F.when(tt > 1e-9 * F.greatest(F.col("tt"), F.lit(1.0)), ty / tt).otherwise(0.0)
    fitted = m.select("*", slope.alias("slope"), (F.col("t") / F.col("n")).alias("_mid"))
    level = lambda d: F.when(
        F.col(f"n{d}") > 0, own("y", d) - F.col("slope") * (own("t", d) - F.col("_mid"))
    ).otherwise(F.col("y") / F.col("n"))
    model = fitted.select(*RUN_KEY, F.col("n").cast("bigint").alias("n_train"), "slope", "_mid", *[level(d).alias(f"level_{d}") for d in WEEKDAYS])

    scored = moments(running, bounds.withColumn("_from", _scored_from()), "_from", "scored_to").drop("first_day")
    a = lambda d: F.col(f"level_{d}") - F.col("slope") * F.col("_mid")
    s = F.col("slope")
    squares = (
        F.col("yy") + s * s * F.col("tt") - 2 * s * F.col("ty")
        + total(lambda d: F.col(f"n{d}") * a(d) * a(d) - 2 * a(d) * F.col(f"y{d}") + 2 * s * a(d) * F.col(f"t{d}"))
    )
    return model.join(scored, RUN_KEY).select(
        *RUN_KEY, "n_train", "slope", *[f"level_{d}" for d in WEEKDAYS], F.sqrt(F.greatest(squares, F.lit(0.0)) / F.col("n")).alias("rmse")
    )


def _scored_from() -> Column:
    """Where the scored rows begin; with nothing held out they are the training rows."""
    return F.when(F.col("train_to") == F.col("scored_to"), F.col("train_from")).otherwise(F.col("train_to"))


def scored_rows(panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """(series, batch, day, y) of the scored rows, by a join on (series, place)."""
    places = F.explode(F.sequence((_scored_from() + 1).cast("int"), F.col("scored_to").cast("int"))).alias("place")
    asked = bounds.select(*RUN_KEY, places)
    rows = numbered(panel).select(*SERIES, "place", "day", "y")
    return asked.join(rows, [*SERIES, "place"]).select(*RUN_KEY, "day", "y")


def fit_series_by_days(panel: DataFrame, bounds: DataFrame, spec: AdditiveSpec = AdditiveSpec()) -> DataFrame:
    """The models of `forecast.fit_series`, with each day of a series sent to Python once and not once per batch.

    A series comes with its days and the bounds of its windows, which are cut out of the days there; a group is bounded
    by the number of days however many batches it serves.
    """

    def fit(days: pa.Table, windows: pa.Table) -> pa.Table:
        schema = pa.schema([
            ("store_id", pa.string()), ("product_id", pa.string()), ("batch_number", pa.int32()), ("n_train", pa.int64()), ("t_start", pa.float64()),
            ("t_span", pa.float64()), ("y_scale", pa.float64()), ("knots", pa.list_(pa.float64())), ("beta", pa.list_(pa.float64())),
        ])
        windows = windows.filter(pc.less(windows["train_from"], windows["train_to"])).sort_by("batch_number")
        if not windows.num_rows or not days.num_rows:
            return schema.empty_table()
        days = days.sort_by("place")
        t, y = days["t"].to_numpy().astype(float), days["y"].to_numpy()
        numbers, lo, hi = (windows[c].to_numpy() for c in ("batch_number", "train_from", "train_to"))
        places = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
        batch = np.repeat(numbers, hi - lo)
        got = fit_batches(batch, t[places], y[places], np.ones(len(places), bool), spec)
        many = len(got.numbers)
        columns = [
            pa.repeat(days["store_id"][0], many), pa.repeat(days["product_id"][0], many), pa.array(got.numbers, pa.int32()), pa.array(got.n_train, pa.int64()),
            pa.array(got.start), pa.array(got.span), pa.array(got.scale), pa.array(list(got.knots), pa.list_(pa.float64())), pa.array(list(got.beta), pa.list_(pa.float64())),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    days = numbered(panel).select(*SERIES, "place", day_number(F.col("day")).alias("t"), F.col("y").cast("double").alias("y"))
    # Names of their own: the days and the windows may come from one table.
    windows = bounds.select(*[F.col(k).alias(f"_{k}") for k in SERIES], "batch_number", "train_from", "train_to")
    return days.groupBy(*SERIES).cogroup(windows.groupBy(*[f"_{k}" for k in SERIES])).applyInArrow(fit, MODEL_SCHEMA)


def history_totals(panel: DataFrame, last_batch: Column | None = None) -> DataFrame:
    """Rows, days and demand of a series that every batch up to the last can see, as running totals.

    The totals of `panel.history_asof` without repeating a row of the panel: a series has one row per batch from its first.
    A batch in which it has no rows sees what the one before it saw.
    """
    if last_batch is None:
        last_batch = panel.agg(F.max("batch_number")).scalar()
    per_batch = panel.groupBy(*RUN_KEY).agg(
        F.count("*").alias("_n"), F.min("day").alias("_lo"), F.max("day").alias("_hi"), F.sum("y").alias("_s")
    )
    order = Window.partitionBy(*SERIES).orderBy("batch_number")
    seen = per_batch.select(
        *SERIES,
        "batch_number",
        (F.lead("batch_number").over(order) - 1).alias("_until"),
        F.sum("_n").over(order).alias("visible_rows"),
        F.min("_lo").over(order).alias("first_day"),
        F.max("_hi").over(order).alias("last_day"),
        F.sum("_s").over(order).alias("visible_y"),
    ).withColumn("_until", F.coalesce("_until", last_batch))
    return seen.select(
        *SERIES,
        F.explode(F.sequence("batch_number", "_until")).alias("batch_number"),
        "visible_rows",
        "first_day",
        "last_day",
        "visible_y",
    )
