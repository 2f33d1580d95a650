import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import forecast as C
from tidewatch.operators import panel as P
from tidewatch.operators import scoring as S
from tidewatch.plans.monitor import MonitorConfig, marked_windows, model_run, monitor

OFFSETS = [0.0, 3.0, -2.0, 1.0, 4.0, -5.0, -1.0]


def batched(panel, days=90):
    return P.assign_batch(panel, days, F.lit("2024-01-01").cast("date"))


def exact(n):
    return [50 + 0.25 * i + OFFSETS[i % 7] for i in range(n)]


def test_exact_model_is_recovered(make_panel):
    # 70 training rows of an 88-row window are ten whole weeks: slope and offsets come apart exactly.
    panel = batched(make_panel(exact(88)))
    marked = marked_windows(panel, MonitorConfig(holdout_percent=21))
    model = C.fit_weekly(marked).first()
    assert model.n_train == 70
    assert model.slope == pytest.approx(0.25, abs=0.02)
    offsets = np.array([model[f"weekday_{d}"] for d in range(7)])
    assert np.allclose(offsets - offsets.mean(), np.array(OFFSETS), atol=0.2)
    run = S.model_records(C.fit_predict(marked)).first()
    assert run.r2 > 0.99 and run.rmse < 0.7


def test_windows_form_equals_join_form(make_panel):
    rng = np.random.default_rng(1)
    panel = batched(make_panel(list(rng.integers(1, 90, 400))))
    marked = marked_windows(panel)
    joined = C.predict(C.fit_weekly(marked), marked.select("store_id", "product_id", "batch_number", "day", "y"))
    windowed = C.fit_predict(marked).withColumnRenamed("yhat", "other")
    both = joined.join(windowed, ["store_id", "product_id", "batch_number", "day"])
    assert both.count() == marked.count()
    assert both.filter(F.abs(F.col("yhat") - F.col("other")) > 1e-9).count() == 0


def test_additive_fit_recovers_trend_changes_and_seasons(make_panel):
    t = np.arange(365)
    y = 200 + 0.3 * t + 0.5 * np.maximum(t - 120, 0) + 8 * np.sin(2 * np.pi * t / 7)
    panel = batched(make_panel(list(y)), 365)
    run = model_run(panel, MonitorConfig(batch_days=365), C.fit_predict_additive).first()
    assert run.r2 > 0.95
    plain = model_run(panel, MonitorConfig(batch_days=365)).first()
    assert run.rmse < plain.rmse


def test_one_pass_fit_equals_stored_coefficients(make_panel):
    rng = np.random.default_rng(11)
    marked = marked_windows(batched(make_panel(list(rng.integers(1, 90, 200)))))
    key = ["store_id", "product_id", "batch_number", "day"]
    stored = C.predict_additive(C.fit_series(marked), marked.filter("is_scored").select(*key, "y"))
    one = C.fit_predict_additive(marked).select(*key, F.col("yhat").alias("other"))
    both = stored.join(one, key)
    assert both.count() == marked.filter("is_scored").count() == one.count()
    assert both.filter(F.abs(F.col("yhat") - F.col("other")) > 1e-6).count() == 0


def test_additive_fit_of_a_short_series(make_panel):
    run = model_run(batched(make_panel([3.0, 4.0])), MonitorConfig(), C.fit_predict_additive).first()
    assert run.data_points == 2 and run.rmse is not None


def test_scored_rows_are_the_newest_and_repeatable(make_panel):
    marked = marked_windows(batched(make_panel(range(100)), 100))
    scored = sorted(r.y for r in marked.filter("is_scored").collect())
    assert scored == [float(v) for v in range(80, 100)]
    assert marked.filter("is_scored and is_train").count() == 0
    every = C.split(marked.drop("is_train", "is_scored"), 0)
    assert every.filter("is_scored and is_train").count() == 100


def test_scores_against_numpy(make_panel):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 30, 90).astype(float)
    predicted = C.fit_predict(marked_windows(batched(make_panel(list(y)))))
    part = predicted.filter("is_scored").toPandas()
    e = (part.y - part.yhat).to_numpy()
    got = S.score(predicted).first()
    keep = part.y.to_numpy() != 0
    assert got.rmse == pytest.approx(np.sqrt((e**2).mean()))
    assert got.mae == pytest.approx(np.abs(e).mean())
    assert got.mape == pytest.approx(100 * (np.abs(e)[keep] / part.y[keep]).mean())
    assert got.r2 == pytest.approx(1 - (e**2).sum() / ((part.y - part.y.mean()) ** 2).sum())
    assert got.erreur_moyenne == pytest.approx(e.mean())
    assert got.erreur_std == pytest.approx(e.std())


def test_zeros_constants_and_short_series(make_panel):
    constant = model_run(batched(make_panel([4.0] * 30))).first()
    assert constant.r2 is None and constant.rmse == pytest.approx(0, abs=1e-9)
    zeros = model_run(batched(make_panel([0.0] * 30))).first()
    assert zeros.mape is None and zeros.rmse == 0
    assert model_run(batched(make_panel([4.0]))).count() == 0


def test_audit_and_implied_variance(spark, make_panel):
    rng = np.random.default_rng(5)
    panel = batched(make_panel(list(rng.integers(1, 60, 200))))
    doubled = panel.withColumn("y", F.col("y") * 2)
    one, two = model_run(panel), model_run(doubled)
    assert S.audit_scores(one).count() == 0
    broken = one.withColumn("mae", F.col("rmse") + 1)
    assert {r.violation for r in S.audit_scores(broken).collect()} == {"rmse_below_mae"}
    ratio = S.compare_implied_variance(one.unionByName(two)).collect()
    assert all(r.ratio == pytest.approx(4.0) and not r.same_target for r in ratio)
    same = S.compare_implied_variance(one.unionByName(one)).collect()
    assert all(r.same_target for r in same)


def test_monitor_counts_models_and_flags(spark, make_panel):
    rng = np.random.default_rng(7)
    a = make_panel(list(100 + rng.normal(0, 1, 180)))
    b = make_panel(list(100 + rng.normal(0, 1, 90)) + list(150 + rng.normal(0, 1, 90)), store="S002")
    c = make_panel(list(100 + rng.normal(0, 1, 90)), store="S003")
    sales = a.unionByName(b).unionByName(c)
    config = MonitorConfig(origin="2024-01-01")
    from tidewatch.operators.drift import DriftRule
    from dataclasses import replace

    got = monitor(sales, replace(config, drift=DriftRule(threshold=6.0))).orderBy("batch_number").collect()
    assert [(r.nombre_modeles, r.modeles_avec_derive) for r in got] == [(3, 0), (2, 1)]


def test_hot_series_does_not_change_the_result(spark, make_panel):
    """A third of all source rows in one series and day: the sums are made before the shuffle."""
    panel = make_panel([10.0] * 60)
    one = panel.limit(1)
    hot = one.crossJoin(spark.range(5000)).select(*panel.columns)
    day = one.first().day
    summed = P.daily_panel(panel.unionByName(hot))
    assert summed.filter(F.col("day") == F.lit(day)).first().y == 10.0 * 5001
    assert summed.count() == 60
