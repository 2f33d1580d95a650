import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift, forecast, holidays, running
from tidewatch.schema import RUN_KEY

START = datetime.date(2022, 1, 1)
CALENDAR = "holiday string, day date, before int, after int"
CALM = drift.DriftRule(threshold=1e9)
FREE = forecast.AdditiveSpec(changepoints=0, yearly_order=0, trend_scale=1e6, season_scale=1e6, holiday_scale=1e6)


@pytest.fixture(scope="module")
def calendar(spark):
    """A fair on two days of a year with its eve, and a feast; a row without a day, and one that comes twice."""
    rows = [("fair", START + datetime.timedelta(days=d), 1, 0) for d in (40, 140, 240, 340)]
    rows += [("feast", START + datetime.timedelta(days=d), None, None) for d in (75, 275)]
    return spark.createDataFrame([*rows, rows[0], ("none", None, 1, 1)], CALENDAR)


@pytest.fixture(scope="module")
def panel(spark):
    effect = {40: 30, 140: 30, 240: 30, 340: 30, 39: -12, 139: -12, 239: -12, 339: -12, 75: 7, 275: 7}
    rows = [
        ("S1", "P1", START + datetime.timedelta(days=i), 100 + 0.1 * i + 4.0 * (i % 7) + effect.get(i, 0), i // 180 + 1)
        for i in range(360)
    ]
    return spark.createDataFrame(rows, "store_id string, product_id string, day date, y double, batch_number int").cache()


def test_calendar_is_unfolded_once_per_day(calendar):
    got = holidays.expanded(calendar).collect()
    assert len(got) == len({(r.day, r.holiday, r.offset) for r in got}) == 4 * 2 + 2
    assert holidays.regressors(calendar) == [("fair", -1), ("fair", 0), ("feast", 0)]


def test_planted_effects_are_found(panel, calendar):
    bounds = running.window_bounds(panel, CALM, holdout_percent=0)
    model, names = holidays.fit_with_holidays(panel, bounds, calendar, FREE)
    got = {(r.batch_number, r.holiday, r.offset): (r.days, r.effect) for r in holidays.holiday_effects(model, names).collect()}
    assert got.keys() == {(b, h, o) for b in (1, 2) for h, o in names}
    for (batch, holiday, offset), (days, effect) in got.items():
        assert effect == pytest.approx({("fair", -1): -12, ("fair", 0): 30, ("feast", 0): 7}[holiday, offset], abs=1e-3)
        assert days == (1 if holiday == "feast" else 2) * batch
    assert {r.holiday for r in holidays.holiday_effects(model, names, least_days=3).collect()} == {"fair"}


def test_predictions_hold_the_effects(panel, calendar):
    bounds = running.window_bounds(panel, CALM, holdout_percent=0)
    model, names = holidays.fit_with_holidays(panel, bounds, calendar, FREE)
    days = panel.filter("batch_number = 2")
    got = holidays.predict_with_holidays(model, days, calendar, names, FREE).collect()
    assert len(got) == 180 and max(abs(r.y - r.yhat) for r in got) < 0.02
    plain = forecast.predict_additive(running.fit_series_by_days(panel, bounds, FREE), days, FREE).collect()
    assert max(abs(r.y - r.yhat) for r in plain) > 10


def test_without_holidays_it_is_the_plain_fit(spark, panel):
    bounds = running.window_bounds(panel)
    empty = spark.createDataFrame([], CALENDAR)
    model, names = holidays.fit_with_holidays(panel, bounds, empty)
    assert names == [] and holidays.holiday_effects(model, names).count() == 0
    beta = lambda df: np.array([r.beta for r in df.orderBy(*RUN_KEY).collect()])
    assert np.allclose(beta(model), beta(running.fit_series_by_days(panel, bounds)))
    days = panel.select(*RUN_KEY, "day", "y")
    assert holidays.predict_with_holidays(model, days, empty, names).filter("yhat is null").count() == 0


def test_a_calendar_is_no_table_of_rows(spark):
    many = spark.range(holidays.MOST + 1).select(
        F.col("id").cast("string").alias("holiday"), F.lit(START).alias("day"), F.lit(0).alias("before"), F.lit(0).alias("after")
    )
    with pytest.raises(ValueError, match="at most"):
        holidays.regressors(many)
