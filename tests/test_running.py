import datetime
import random

import numpy as np
import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import drift, forecast, panel, running
from tidewatch.schema import RUN_KEY


@pytest.fixture(scope="module")
def rows(spark):
    """Four series with gaps; one has a single row, one a jump, so long and short windows occur. A null y among them."""
    rng = random.Random(5)
    start = datetime.date(2023, 1, 1)
    data = []
    for k, (days, level) in enumerate(((700, 0), (500, 40), (40, 0), (1, 0))):
        for i in range(days):
            if rng.random() < 0.8 or days == 1:
                y = 50 + 0.05 * i + 5 * (i % 7) + (level if i > 250 else 0) + rng.gauss(0, 3)
                data.append((f"S{k}", "P1", start + datetime.timedelta(days=i), float(y), i // 60 + 1))
    data.append(("S0", "P1", start + datetime.timedelta(days=701), None, 12))
    df = spark.createDataFrame(data, "store_id string, product_id string, day date, y double, batch_number int")
    return df.cache()


def marked(rows, holdout=20, long=100, short=60):
    known = rows.filter("y is not null")
    return forecast.split(drift.training_windows(known, long_rows=long, short_rows=short), holdout)


def close(got, want, columns, tolerance=1e-6):
    a = {tuple(r[k] for k in RUN_KEY): r for r in got.collect()}
    b = {tuple(r[k] for k in RUN_KEY): r for r in want.collect()}
    assert a.keys() == b.keys() and a
    for key in a:
        for c in columns:
            assert a[key][c] == pytest.approx(b[key][c], rel=tolerance, abs=tolerance), (key, c)


@pytest.mark.parametrize("holdout", [0, 20])
def test_bounds_are_those_of_the_windows(rows, holdout):
    bounds = running.window_bounds(rows, long_rows=100, short_rows=60, holdout_percent=holdout)
    want = marked(rows, holdout).groupBy(*RUN_KEY, "has_concept_drift").agg(
        F.max("data_points").alias("data_points"), F.count_if("is_train").alias("n_train"), F.count_if("is_scored").alias("n_scored")
    )
    got = bounds.select(
        "*", (F.col("train_to") - F.col("train_from")).alias("n_train"), (F.col("scored_to") - running._scored_from()).alias("n_scored")
    )
    close(got, want, ["data_points", "n_train", "n_scored", "has_concept_drift"])
    assert {r.has_concept_drift for r in want.collect()} == {True, False}


def test_weekly_fit_equals_the_one_over_rows(rows):
    bounds = running.window_bounds(rows, long_rows=100, short_rows=60)
    columns = ["slope", "mean_y", "mean_t", "n_train", "intercept", *[f"weekday_{d}" for d in range(7)]]
    close(running.fit_weekly_running(rows, bounds), forecast.fit_weekly(marked(rows)), columns)


@pytest.mark.parametrize("holdout", [0, 20])
def test_joint_fit_equals_least_squares(rows, holdout):
    bounds = running.window_bounds(rows, long_rows=100, short_rows=60, holdout_percent=holdout)
    got = {tuple(r[k] for k in RUN_KEY): r for r in running.fit_additive_weekly(rows, bounds).collect()}
    windows = {}
    for r in marked(rows, holdout).collect():
        windows.setdefault(tuple(r[k] for k in RUN_KEY), []).append(r)
    checked = 0
    for key, window in windows.items():
        train = [r for r in window if r.is_train]
        if len(train) < 30:
            continue
        design = lambda rs: np.array([[r.day.toordinal(), *[float(r.weekday == d) for d in range(7)]] for r in rs])
        mid = np.mean([r.day.toordinal() for r in train])
        x = design(train) - np.array([mid] + [0] * 7)
        beta = np.linalg.lstsq(x, np.array([r.y for r in train]), rcond=None)[0]
        assert got[key].slope == pytest.approx(beta[0], abs=1e-6)
        assert [got[key][f"level_{d}"] for d in range(7)] == pytest.approx(beta[1:].tolist(), abs=1e-5)
        scored = [r for r in window if r.is_scored]
        error = np.array([r.y for r in scored]) - (design(scored) - np.array([mid] + [0] * 7)) @ beta
        assert got[key].rmse == pytest.approx(float(np.sqrt((error**2).mean())), rel=1e-6)
        checked += 1
    assert checked > 10


def test_a_single_row_has_no_window_to_train_on(rows):
    bounds = running.window_bounds(rows, long_rows=100, short_rows=60)
    assert running.fit_additive_weekly(rows, bounds).filter("store_id = 'S3'").count() == 0
    all_rows = running.window_bounds(rows, holdout_percent=0)
    one = running.fit_additive_weekly(rows, all_rows).filter("store_id = 'S3'").first()
    assert (one.slope, one.rmse) == (0.0, 0.0) and len({one[f"level_{d}"] for d in range(7)}) == 1


def test_scored_rows_and_models_by_days(rows):
    bounds = running.window_bounds(rows, long_rows=100, short_rows=60)
    day = lambda df: sorted(tuple(r) for r in df.select(*RUN_KEY, "day", "y").collect())
    assert day(running.scored_rows(rows, bounds)) == day(marked(rows).filter("is_scored"))
    own, plain = running.fit_series_by_days(rows, bounds), forecast.fit_series(marked(rows))
    unpacked = lambda df: df.select("*", *[F.element_at("beta", i + 1).alias(f"b{i}") for i in range(6)])
    close(unpacked(own), unpacked(plain), ["n_train", "t_start", "t_span", "y_scale", *[f"b{i}" for i in range(6)]])


def test_python_gets_every_day_once(rows):
    plan = plan_of(running.fit_series_by_days(rows, running.window_bounds(rows)))
    assert "FlatMapCoGroupsInArrow" in plan and "Generate" not in plan


def test_history_totals_equal_the_repeated_rows(rows):
    known = rows.filter("y is not null and not (store_id = 'S1' and batch_number = 3)")
    want = panel.history_asof(known).groupBy(*RUN_KEY).agg(
        F.count("*").alias("visible_rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("y").alias("visible_y")
    )
    fields = ["store_id", "batch_number", "visible_rows", "first_day", "last_day"]
    key = lambda df: sorted(tuple(r) for r in df.select(*fields, F.round("visible_y", 6)).collect())
    assert key(running.history_totals(known)) == key(want)


def test_short_windows_cannot_be_the_longer_ones(rows):
    with pytest.raises(ValueError):
        running.window_bounds(rows, long_rows=10, short_rows=20)
