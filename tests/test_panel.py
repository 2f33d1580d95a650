import datetime

import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import panel as P

START = datetime.date(2024, 1, 1)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_daily_panel_sums_and_ignores_row_order(spark):
    data = [("S001", "P001", START, 2.0), ("S001", "P001", START, 3.0), ("S002", "P001", START, 4.0)]
    schema = "store_id string, product_id string, day date, y double"
    one = rows(P.daily_panel(spark.createDataFrame(data, schema)), "store_id")
    two = rows(P.daily_panel(spark.createDataFrame(data[::-1], schema)), "store_id")
    assert one == two == [("S001", "P001", START, 5.0), ("S002", "P001", START, 4.0)]


def test_dedup_removes_doubling_of_variance(make_panel):
    clean = make_panel([1, 5, 2, 8, 3])
    doubled = clean.unionByName(clean)
    var = lambda df: P.daily_panel(df).agg(F.var_pop("y")).first()[0]
    assert var(doubled) == pytest.approx(4 * var(clean))
    assert var(P.dedup_rows(doubled)) == pytest.approx(var(clean))


def test_dedup_by_key_does_not_depend_on_order(spark):
    data = [(1, "b", 2.0), (1, "a", 3.0), (2, "c", 1.0), (1, "a", 2.5)]
    schema = "k int, s string, v double"
    for part in (data, data[::-1]):
        df = P.dedup_rows(spark.createDataFrame(part, schema), ["k"])
        assert df.columns == ["k", "s", "v"]
        assert rows(df, "k") == [(1, "a", 2.5), (2, "c", 1.0)]


def test_copies_collapse_before_the_shuffle(make_panel):
    plan = plan_of(P.dedup_rows(make_panel([1, 2])))
    assert plan.count("HashAggregate") == 2


def test_batches_history_and_profile(make_panel):
    panel = P.assign_batch(make_panel(range(25)), 10, F.lit("2024-01-01").cast("date"))
    assert rows(panel.groupBy("batch_number").count(), "batch_number") == [(1, 10), (2, 10), (3, 5)]
    seen = P.history_asof(panel).groupBy("batch_number").agg(F.count("*"), F.sum("y"))
    profile = P.history_profile(panel).select("batch_number", "visible_rows", "visible_y")
    assert rows(seen, "batch_number") == rows(profile, "batch_number")
    assert [r[1] for r in rows(profile, "batch_number")] == [10, 20, 25]


def test_missing_batch_leaves_a_gap(make_panel):
    """72 of 245 days are absent: 173 rows over a span of 244 days."""
    ys = [1.0] * 78 + [None] * 72 + [1.0] * 95
    panel = make_panel(ys)
    profile = P.window_profile(panel).first()
    assert (profile.data_points, profile.training_period_days, profile.has_gap) == (173, 244, True)
    gap = P.gap_list(panel).collect()
    assert [(g.gap_start, g.gap_days) for g in gap] == [(START + datetime.timedelta(78), 72)]
    assert not P.window_profile(make_panel([1] * 78)).first().has_gap


def test_last_rows_counts_rows_not_days(make_panel):
    ys = [1.0, None] * 300
    profile = P.window_profile(P.last_rows(make_panel(ys), 180)).first()
    assert (profile.data_points, profile.training_period_days) == (180, 358)


def test_last_rows_is_limited_before_the_shuffle(make_panel):
    plan = plan_of(P.last_rows(make_panel([1, 2, 3]), 2))
    assert plan.count("WindowGroupLimit") == 2


def test_missing_series_with_and_without_expected(make_panel, spark):
    a = P.assign_batch(make_panel([1] * 30), 10, F.lit("2024-01-01").cast("date"))
    b = P.assign_batch(make_panel([1] * 10 + [None] * 10 + [1] * 5, store="S002"), 10, F.lit("2024-01-01").cast("date"))
    both = a.unionByName(b)
    assert rows(P.missing_series(both), "store_id") == [("S002", "P001", 2)]
    expected = spark.createDataFrame([("S003", "P001"), ("S001", "P001")], "store_id string, product_id string")
    got = rows(P.missing_series(both, expected), "store_id", "batch_number")
    assert got == [("S002", "P001", 2), ("S003", "P001", 1), ("S003", "P001", 2), ("S003", "P001", 3)]


def test_dense_calendar_fills_and_keeps(make_panel):
    dense = P.dense_calendar(make_panel([3, None, None, 4, None, 5]))
    assert [r.y for r in dense.orderBy("day").collect()] == [3, 0, 0, 4, 0, 5]
    assert dense.filter("filled").count() == 3
    assert "Join" not in plan_of(dense)


def test_job_removes_repeats_by_row_key(spark):
    """Two true sales of equal size on one day stay, the second load of each does not."""
    from tidewatch.plans.monitor import MonitorConfig, batched_panel

    data = [(1, "S001", "P001", START, 4.0), (2, "S001", "P001", START, 4.0), (3, "S001", "P001", START, 1.0)]
    sales = spark.createDataFrame(data, "line int, store_id string, product_id string, day date, y double")
    twice = sales.unionByName(sales)
    total = lambda dedup: batched_panel(twice, MonitorConfig(dedup=dedup)).first().y
    assert total(None) == 18.0
    assert total([]) == 9.0
    assert total(["line"]) == 9.0


def test_numbered_series_get_codes_of_any_length(spark):
    from tidewatch.sources.tables import name_series

    df = spark.createDataFrame([(1, 12345), (10, None)], "store_id bigint, product_id bigint")
    got = [tuple(r) for r in name_series(df).collect()]
    assert got == [("S001", "P12345"), ("S010", None)]
