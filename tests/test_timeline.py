import datetime
import random

import numpy as np
import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import history as H
from tidewatch.operators import timeline as T

EPOCH = datetime.datetime(2025, 6, 1)


def stamped(spark, seconds, keys=None, extra=""):
    rows = [(i, keys[i] if keys else 0, None if s is None else EPOCH + datetime.timedelta(seconds=s)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "id int, k int, ts timestamp")


@pytest.fixture(params=["1", "4", "13"])
def ranges(request, spark):
    """The number of ranges that an order is cut into."""
    settings = {"spark.sql.shuffle.partitions": request.param, "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield int(request.param)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_next_mark_equals_brute_force(spark, ranges):
    rng = random.Random(ranges)
    # Half of the points share one instant.
    seconds = [500 if rng.random() < 0.5 else rng.randrange(0, 4000) for _ in range(200)] + [None]
    keys = [rng.randrange(2) for _ in seconds]
    marks = [(rng.randrange(100, 3800), rng.randrange(2), 1000 + i) for i in range(12)] + [(500, 0, 1), (500, 0, 2)]
    points = stamped(spark, seconds, keys)
    table = spark.createDataFrame(
        [(EPOCH + datetime.timedelta(seconds=s), k, i) for s, k, i in marks], "ts timestamp, k int, mark int"
    )
    got = {r.id: r.mark for r in T.next_mark(points, table, "ts", "mark", ["k"]).collect()}
    for i, s in enumerate(seconds):
        later = [] if s is None else sorted((m, n) for m, k, n in marks if k == keys[i] and m >= s)
        assert got[i] == (later[0][1] if later else None)
    assert len(got) == len(seconds)
    anyone = {r.id: r.mark for r in T.next_mark(points, table.drop("k"), "ts", "mark", []).collect()}
    for i, s in enumerate(seconds):
        later = [] if s is None else sorted((m, n) for m, _, n in marks if m >= s)
        assert anyone[i] == (later[0][1] if later else None)


def test_idle_groups_equal_brute_force(spark, ranges):
    rng = random.Random(4)
    seconds = [rng.randrange(0, 20_000) for _ in range(150)] + [7] * 200
    df = stamped(spark, seconds)
    for gap in (1, 60, 300):
        expected, last = [], None
        for s in sorted(seconds):
            if last is None or s - last > gap:
                expected.append([s, s, 0])
            expected[-1][1] = last = s
            expected[-1][2] += 1
        rel = lambda t: int((t - EPOCH).total_seconds())
        got = T.idle_groups(df, "ts", gap).orderBy("execution").collect()
        assert [[rel(r.started_at), rel(r.ended_at), r.n_runs] for r in got] == expected
        numbered = T.assign_idle_groups(df, "ts", gap).groupBy("execution").count().orderBy("execution")
        assert [r["count"] for r in numbered.collect()] == [e[2] for e in expected]


def test_seconds_between(spark, ranges):
    df = stamped(spark, [0, 10, 10, 10, 4000, 90_000, None])
    got = T.seconds_between(df, "ts").orderBy("ts").collect()
    assert [(r.n_runs, r.seconds) for r in got] == [(1, None), (3, 10.0), (1, 3990.0), (1, 86_000.0)]


def hourful(spark):
    """2,000 times, nine tenths of them within one hour of a year."""
    rng = random.Random(9)
    seconds = [rng.randrange(5 * 10**6, 5 * 10**6 + 3600) if rng.random() < 0.9 else rng.randrange(3 * 10**7) for _ in range(2000)]
    return seconds, stamped(spark, seconds)


def test_an_hour_with_most_of_the_rows_is_cut_into_many_ranges(spark, ranges):
    seconds, df = hourful(spark)
    times = sorted(set(seconds))
    cut = T.in_ranges(df.select("ts").distinct(), [], "ts").groupBy("_range").count().collect()
    assert len(cut) == ranges and max(r["count"] for r in cut) <= 2.5 * len(times) / ranges
    got = [r.seconds for r in T.seconds_between(df, "ts").orderBy("ts").collect()]
    assert got == [None, *[float(b - a) for a, b in zip(times, times[1:])]]
    groups = T.idle_groups(df, "ts", 2).count()
    assert groups == 1 + sum(b - a > 2 for a, b in zip(times, times[1:]))


def test_no_order_of_rows_lies_in_one_task(spark):
    """Every window over rows is within a range; only tables of one row per range are put in order as a whole."""
    _, df = hourful(spark)
    marks = df.filter("id % 50 = 0").select("ts", F.col("id").alias("mark"))
    for out in (T.next_mark(df, marks, "ts", "mark"), T.idle_groups(df, "ts", 60), T.seconds_between(df, "ts")):
        feeds = [part.split("\n")[1] for part in plan_of(out).split("Exchange SinglePartition")[1:]]
        assert feeds and all("Aggregate(key" in line and "=[_range#" in line for line in feeds)


def test_null_keys_are_a_key_of_their_own(spark):
    rows = [(1, None, EPOCH), (2, None, EPOCH + datetime.timedelta(seconds=5)), (3, 1, EPOCH)]
    df = spark.createDataFrame(rows, "id int, k int, ts timestamp")
    assert sorted((r.k or 0, r.seconds or 0) for r in T.seconds_between(df, "ts", ["k"]).collect()) == [(0, 0), (0, 5.0), (1, 0)]
    assert {r.id: r.execution for r in T.assign_idle_groups(df, "ts", 2, ["k"]).collect()} == {1: 1, 2: 2, 3: 1}


def runs(spark, rows):
    schema = "store_id string, product_id string, batch_number int, rmse double, has_concept_drift boolean"
    return spark.createDataFrame(rows, schema).withColumn(
        "run_id", F.md5(F.concat_ws("|", "store_id", "product_id", F.col("batch_number")))
    )


def test_chains_changes_and_ranks(spark):
    left = runs(spark, [("S1", "P1", 1, 2.0, False), ("S1", "P1", 2, 3.0, True), ("S2", "P1", 1, None, None)])
    right = runs(spark, [("S1", "P1", 1, 2.5, False), ("S1", "P1", 2, 3.0, False), ("S3", "P1", 1, 1.0, None)])
    got = {(r.store_id, r.batch_number): r for r in H.compare_chains(left, right, ["rmse"]).collect()}
    assert got["S1", 1].rmse_delta == 0.5 and got["S1", 1].same_flag
    assert not got["S1", 2].same_flag
    assert got["S2", 1].rmse_delta is None and not got["S2", 1].in_right
    assert got["S3", 1].in_right and not got["S3", 1].in_left
    change = {r.batch_number: r.change for r in H.score_change(left.filter("store_id = 'S1'")).collect()}
    assert change == {1: None, 2: 1.0}
    worst = H.worst_series(left, 1).orderBy("batch_number").collect()
    assert [(r.batch_number, r.rmse, r["rank"]) for r in worst] == [(1, 2.0, 1), (2, 3.0, 1)]
    assert plan_of(H.worst_series(left, 1)).count("WindowGroupLimit") == 2
    share = H.coverage(left, ["rmse"]).first()
    assert (share.n_runs, round(share.rmse_missing, 6)) == (3, 0.333333)


def test_flag_changes_and_transitions(spark):
    df = runs(
        spark,
        [
            ("S1", "P1", 1, 1.0, True), ("S1", "P1", 2, 1.0, True),
            ("S2", "P1", 1, 1.0, True), ("S2", "P1", 2, 1.0, False),
            ("S3", "P1", 1, 1.0, False), ("S3", "P1", 2, 1.0, True),
            ("S4", "P1", 1, 1.0, False), ("S4", "P1", 2, 1.0, False),
        ],
    )
    got = {(r.store_id, r.change) for r in H.flag_changes(df, 1, 2).collect()}
    assert got == {("S1", "both"), ("S2", "only_before"), ("S3", "only_after")}
    counts = {r.change: r.n_series for r in H.flag_transitions(df).collect()}
    assert counts == {"both": 1, "only_before": 1, "only_after": 1, "neither": 1}


def test_period_label(spark):
    df = stamped(spark, [0, 86_400 * 2])
    label = H.period_label(F.col("ts"), [("a", "2025-06-01"), ("b", "2025-06-02")])
    assert [r.p for r in df.orderBy("id").select(label.alias("p")).collect()] == ["a", "b"]
