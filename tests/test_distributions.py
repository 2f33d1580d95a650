import random

import numpy as np
import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import distributions, drift, loads, rollup

PANEL = "store_id string, product_id string, day date, y double, batch_number int"


@pytest.fixture(scope="module")
def panel(spark):
    """S1 is quiet, S2 spreads from batch 5 on around the same mean, S3 has a single row in batch 5."""
    rng = np.random.default_rng(3)
    rows = []
    for batch in range(1, 7):
        for store, spread in (("S1", 2.0), ("S2", 20.0 if batch >= 5 else 2.0), ("S3", 2.0)):
            half = rng.normal(0, spread, 40 if (store, batch) != ("S3", 5) else 0)
            values = np.concatenate([100 + half, 100 - half]) if len(half) else np.array([100.0])
            rows += [(store, "P1", None, float(v), batch) for v in values]
    return spark.createDataFrame([*rows, ("S1", "P1", None, None, 2)], PANEL).cache()


def test_a_change_of_spread_is_seen_where_means_are_equal(panel):
    flags = distributions.distribution_drift(distributions.batch_histograms(panel, 0.0, 200.0, 100))
    got = {(r.store_id, r.batch_number): r for r in flags.collect()}
    assert {k for k, r in got.items() if r.has_concept_drift} >= {("S2", 5)}
    assert not any(r.has_concept_drift for (s, _), r in got.items() if s != "S2")
    assert got["S1", 1].distance is None and got["S3", 5].distance is None
    days = panel.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("batch_number")))
    means = {(r.store_id, r.batch_number): r.has_concept_drift for r in drift.drift_flags(days).collect()}
    assert not means["S2", 5]


def test_distance_equals_the_plain_one(panel):
    flags = distributions.distribution_drift(distributions.batch_histograms(panel, 90.0, 110.0, 64), reference_batches=2)
    got = {(r.store_id, r.batch_number): r.distance for r in flags.collect()}
    values = {}
    for r in panel.filter("y is not null").collect():
        values.setdefault((r.store_id, r.batch_number), []).append(r.y)
    edges = np.linspace(90, 110, 65)[:-1]
    place = lambda ys: np.searchsorted(edges, np.array(ys), side="right") - (np.array(ys) >= 110) * 0
    for (store, batch), own in values.items():
        before = [y for b in (batch - 2, batch - 1) for y in values.get((store, b), [])]
        if len(own) < 2 or len(before) < 2:
            continue
        a = np.where(np.array(own) >= 110, 65, place(own))
        b = np.where(np.array(before) >= 110, 65, place(before))
        want = max(abs((a <= k).mean() - (b <= k).mean()) for k in range(66))
        assert got[store, batch] == pytest.approx(want, abs=1e-12)


def test_one_shuffle_of_histograms(panel):
    plan = plan_of(distributions.distribution_drift(distributions.batch_histograms(panel, 0.0, 200.0, 10)))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_sketches_of_parts_merge_to_the_whole(spark):
    rng = np.random.default_rng(8)
    values = rng.lognormal(size=20_000)
    rows = [(i % 3, i % 50, float(v)) for i, v in enumerate(values)] + [(0, 1, None), (0, 2, float("nan")), (9, 1, None)]
    df = spark.createDataFrame(rows, "k int, part int, v double")
    stored = distributions.sketches(df, ["k", "part"], ["v"])
    got = distributions.sketched_quantiles(stored.filter("k < 9"), ["k"], "v", [0.05, 0.5, 0.95]).collect()
    assert len(got) == 9
    for r in got:
        own = values[r.k :: 3]
        assert abs((own <= r.quantile).mean() - r.probability) < 0.01


# --- loads ---------------------------------------------------------------------------------------


def test_the_repeated_load_is_named(spark):
    first = [("a", 1), ("b", 2), ("b", 2)]
    table = {1: first, 2: [("a", 1), ("b", 2)], 3: first[::-1], 4: [("a", 1), ("a", 1), ("b", 2)], 5: [(None, None)], 6: [(None, None)]}
    rows = [(n, k, x, v) for n, load in table.items() for k in ("u", None) for x, v in load]
    rows += [(7, "w", "a", 1)]
    df = spark.createDataFrame(rows, "load int, k string, x string, v int")
    got = {(r.k, r.load, r.repeats, r.n_rows) for r in loads.repeated_loads(df, "load", ["k"], ["x", "v"]).collect()}
    assert got == {(k, *r) for k in ("u", None) for r in ((3, 1, 3), (6, 5, 1))}
    assert loads.repeated_loads(df.filter("load > 9"), "load", ["k"], ["x", "v"]).count() == 0


# --- revised roll-ups ----------------------------------------------------------------------------

RUNS = "run_id string, batch_number int, execution_number int, logged_at timestamp, rmse double, mae double, r2 double, has_concept_drift boolean"


def records(spark, rng, batches, models):
    lost = lambda v: None if rng.random() < 0.3 else v
    rows = [
        (f"r{b}-{k}-{rng.random()}", b, 1, None, lost(1e6 + rng.random()), lost(rng.gauss(0, 5)), lost(rng.random()), rng.random() < 0.4)
        for b in batches for k in range(models)
    ]
    return spark.createDataFrame(rows, RUNS).cache()


def agree(got, want):
    a = {r.batch_number: r for r in got.collect()}
    b = {r.batch_number: r for r in want.collect()}
    assert a.keys() == b.keys()
    for n in a:
        for c in got.columns:
            assert a[n][c] == pytest.approx(b[n][c], rel=1e-9, abs=1e-6), (n, c)


def test_moments_after_reruns_equal_a_roll_up_from_the_start(spark):
    rng = random.Random(6)
    now = records(spark, rng, [1, 2, 3], 12)
    moments = rollup.batch_moments(now)
    for batches in ([1], [2, 4], [1, 3]):
        out = now.filter(F.col("batch_number").isin(batches) & (F.crc32("run_id") % 2 == 0))
        new = records(spark, rng, batches, 5)
        moments = rollup.revise(moments, out, new).cache()
        now = now.join(out.select("run_id"), "run_id", "left_anti").select(*now.columns).unionByName(new).cache()
        plain = rollup.batch_rollup(now).drop("run_id", "execution_number", "logged_at")
        agree(rollup.measures_of(moments), plain)


def test_a_batch_that_loses_all_records_is_gone(spark):
    now = records(spark, random.Random(1), [1, 2], 3)
    nothing = now.limit(0)
    left = rollup.revise(rollup.batch_moments(now), now.filter("batch_number = 1"), nothing)
    agree(rollup.measures_of(left), rollup.batch_rollup(now.filter("batch_number = 2")).drop("run_id", "execution_number", "logged_at"))
    agree(rollup.measures_of(rollup.revise(rollup.batch_moments(nothing), nothing, now)), rollup.batch_rollup(now).drop("run_id", "execution_number", "logged_at"))
