"""Holidays in the additive model: regressors for days around named events.

A calendar has one row per holiday and day it falls on: (holiday, day, before, after). Each holiday stands for one
regressor per day from `before` days ahead of it to `after` days past it, so the effect of the eve is its own. A row of
the panel carries the numbers of the few regressors that hold on its day as an array (`regressors`), and only the grouped
fit turns them into columns. What repeats every year shares its coefficients over the years, as in the cited model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.calendar import day_number
from tidewatch.operators.forecast import MODEL_SCHEMA, AdditiveSpec, fit_batches, predict_additive
from tidewatch.operators.running import numbered
from tidewatch.schema import RUN_KEY, SERIES

#: Regressors are columns of every model, so a calendar has to stay a list of holidays.
MOST = 1000

HOLIDAY_MODEL = f"{MODEL_SCHEMA}, holiday_days array<bigint>"


def expanded(calendar: DataFrame) -> DataFrame:
    """(day, holiday, offset): every day on which a regressor holds, once; offset -1 is the day before. Nulls are left out."""
    around = F.explode(F.sequence(-F.coalesce("before", F.lit(0)), F.coalesce("after", F.lit(0)))).alias("offset")
    known = calendar.filter(F.col("day").isNotNull() & F.col("holiday").isNotNull())
    return (
        known.select("holiday", F.col("day").alias("_on"), around)
        .select(F.date_add("_on", F.col("offset")).alias("day"), "holiday", "offset")
        .distinct()
    )


def regressors(calendar: DataFrame) -> list[tuple[str, int]]:
    """The regressors of a calendar in the order of their coefficients: (holiday, offset)."""
    found = expanded(calendar).select("holiday", "offset").distinct().limit(MOST + 1).collect()
    if len(found) > MOST:
        raise ValueError(f"a calendar stands for at most {MOST} regressors")
    return sorted((r.holiday, r.offset) for r in found)


def with_holidays(days: DataFrame, calendar: DataFrame, names: list[tuple[str, int]]) -> DataFrame:
    """Add `holidays`, the numbers of the regressors that hold on the day of each row; an empty array on most.

    The calendar has one row per day after grouping and is joined on the day; AQE broadcasts it by its size.
    """
    number = F.create_map(*[x for i, (h, o) in enumerate(names) for x in (F.lit(f"{o}/{h}"), F.lit(i))]) if names else None
    own = F.try_element_at(number, F.concat_ws("/", F.col("offset").cast("string"), "holiday")) if names else F.lit(None).cast("int")
    per_day = expanded(calendar).groupBy(F.col("day").alias("_day")).agg(F.array_sort(F.collect_set(own)).alias("holidays"))
    joined = days.join(per_day, F.col("day") == F.col("_day"), "left").drop("_day")
    return joined.withColumn("holidays", F.coalesce("holidays", F.expr("cast(array() as array<int>)")))


def fit_with_holidays(
    panel: DataFrame, bounds: DataFrame, calendar: DataFrame, spec: AdditiveSpec = AdditiveSpec()
) -> tuple[DataFrame, list[tuple[str, int]]]:
    """Models of every window with holiday coefficients at the end of `beta`, and the regressors they belong to.

    `holiday_days` counts the training days of each regressor; one that was never seen has the coefficient 0.
    """
    names = regressors(calendar)

    def fit(days: pa.Table, windows: pa.Table) -> pa.Table:
        schema = pa.schema([
            ("store_id", pa.string()), ("product_id", pa.string()), ("batch_number", pa.int32()), ("n_train", pa.int64()), ("t_start", pa.float64()),
            ("t_span", pa.float64()), ("y_scale", pa.float64()), ("knots", pa.list_(pa.float64())), ("beta", pa.list_(pa.float64())),
            ("holiday_days", pa.list_(pa.int64())),
        ])
        windows = windows.filter(pc.less(windows["train_from"], windows["train_to"])).sort_by("batch_number")
        if not windows.num_rows or not days.num_rows:
            return schema.empty_table()
        days = days.sort_by("place")
        t, y = days["t"].to_numpy().astype(float), days["y"].to_numpy()
        on = np.zeros((len(t), len(names)))
        held = days["holidays"].combine_chunks()
        on[pc.list_parent_indices(held).to_numpy(), pc.list_flatten(held).to_numpy()] = 1.0
        numbers, lo, hi = (windows[c].to_numpy() for c in ("batch_number", "train_from", "train_to"))
        places = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
        batch = np.repeat(numbers, hi - lo)
        got = fit_batches(batch, t[places], y[places], np.ones(len(places), bool), spec, on[places] if names else None)
        upto = np.vstack([np.zeros(len(names)), on.cumsum(0)])
        many = len(got.numbers)
        columns = [
            pa.repeat(days["store_id"][0], many), pa.repeat(days["product_id"][0], many), pa.array(got.numbers, pa.int32()), pa.array(got.n_train, pa.int64()),
            pa.array(got.start), pa.array(got.span), pa.array(got.scale), pa.array(list(got.knots), pa.list_(pa.float64())), pa.array(list(got.beta), pa.list_(pa.float64())),
            pa.array(list((upto[hi] - upto[lo]).astype(np.int64)), pa.list_(pa.int64())),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    rows = with_holidays(numbered(panel), calendar, names).select(
        *SERIES, "place", day_number(F.col("day")).alias("t"), F.col("y").cast("double").alias("y"), "holidays"
    )
    # Names of their own: the days and the windows may come from one table.
    windows = bounds.select(*[F.col(k).alias(f"_{k}") for k in SERIES], "batch_number", "train_from", "train_to")
    return rows.groupBy(*SERIES).cogroup(windows.groupBy(*[f"_{k}" for k in SERIES])).applyInArrow(fit, HOLIDAY_MODEL), names


def _coefficient(place: Column, names: list[tuple[str, int]]) -> Column:
    """Entry of `beta` of the regressor with a number."""
    return F.element_at("beta", (F.size("beta") - len(names) + place + 1).cast("int"))


def holiday_effects(model: DataFrame, names: list[tuple[str, int]], least_days: int = 1) -> DataFrame:
    """(series, batch, holiday, offset, days, effect): what each regressor adds to y, where it was seen in training."""
    listed = F.array(*[F.struct(F.lit(h).alias("holiday"), F.lit(o).alias("offset"), F.lit(i).alias("i")) for i, (h, o) in enumerate(names)])
    if not names:
        listed = F.expr("cast(array() as array<struct<holiday: string, offset: int, i: int>>)")
    each = model.select("*", F.explode(listed).alias("_r"))
    days = F.element_at("holiday_days", F.col("_r.i") + 1)
    effect = _coefficient(F.col("_r.i"), names) * F.col("y_scale")
    return each.filter(days >= least_days).select(*RUN_KEY, "_r.holiday", "_r.offset", days.alias("days"), effect.alias("effect"))


def predict_with_holidays(
    model: DataFrame, days: DataFrame, calendar: DataFrame, names: list[tuple[str, int]], spec: AdditiveSpec = AdditiveSpec()
) -> DataFrame:
    """yhat of every row of `days`: trend and seasons as in `predict_additive`, and the effects of the holidays of the day."""
    columns = days.columns
    marked = with_holidays(days, calendar, names)
    bare = model.withColumn("_all", F.col("beta")).withColumn("beta", F.slice("beta", 1, F.size("beta") - len(names)))
    plain = predict_additive(bare, marked, spec, extra=["_all", "y_scale"])
    effects = F.aggregate(
        "holidays", F.lit(0.0), lambda total, i: total + F.element_at("_all", (F.size("_all") - len(names) + i + 1).cast("int"))
    )
    return plain.select(*columns, (F.col("yhat") + effects * F.col("y_scale")).alias("yhat"))
