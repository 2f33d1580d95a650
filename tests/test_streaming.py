"""Every stream against the batch operator on the same rows, in several micro-batches."""

import dataclasses
import datetime
import pathlib
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidewatch.operators.drift import DriftRule, drift_flags
from tidewatch.operators.rollup import batch_rollup
from tidewatch.plans import queries
from tidewatch.plans.monitor import MonitorConfig, batched_panel, model_run
from tidewatch.operators.timeline import idle_groups
from tidewatch.streaming import arrivals, drift_state, events, sessions, sinks

START = datetime.date(2024, 1, 1)
CONFIG = MonitorConfig(batch_days=30, origin="2024-01-01", long_rows=60, short_rows=25)
SALES = "store_id string, product_id string, day date, y double"


def write_files(spark, folder, parts, schema):
    """One file per part, in order of arrival."""
    import os
    import time

    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/f{i:03d}")
        for name in os.listdir(f"{folder}/f{i:03d}"):
            os.utime(f"{folder}/f{i:03d}/{name}", (1_700_000_000 + i * 10,) * 2)
    time.sleep(0.1)


def sales_rows(days, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in ("S001", "S002"):
        for d in days:
            for _ in range(2):
                level = 20 if s == "S002" and d >= 70 else 5
                rows.append((s, "P001", START + datetime.timedelta(days=int(d)), float(rng.integers(0, level) + level)))
    return rows


def tables(spark, out):
    runs = spark.read.parquet(out.model_runs)
    return sorted(map(str, runs.select(sorted(runs.columns)).collect()))


def expected(spark, parts):
    sales = spark.createDataFrame([r for p in parts for r in p], SALES)
    runs = model_run(batched_panel(sales, CONFIG), CONFIG)
    return sorted(map(str, runs.select(sorted(runs.columns)).collect())), batch_rollup(runs)


@pytest.mark.parametrize(
    "cuts",
    [
        [range(0, 30), range(30, 60), range(60, 90), range(90, 120)],  # whole batches in order
        [range(0, 45), range(45, 100), range(100, 120)],  # batches split over arrivals
        [range(60, 120), range(0, 60)],  # old days come last
        [range(0, 50), range(50, 110), range(20, 30), range(110, 125)],  # late days in between
    ],
)
def test_monitor_stream_equals_batch(spark, tmp_path, cuts):
    parts = [sales_rows(days, i) for i, days in enumerate(cuts)]
    write_files(spark, str(tmp_path / "in"), parts, SALES)
    stream = events.file_stream(
        spark, str(tmp_path / "in/*"), spark.createDataFrame([], SALES).schema, max_files=1
    )
    base = str(tmp_path / "out")
    arrivals.monitor_stream(stream, base, CONFIG).awaitTermination()
    want, rollup = expected(spark, parts)
    out = arrivals.Outputs.below(base)
    assert tables(spark, out) == want
    totals = spark.read.parquet(out.global_runs)
    pick = lambda df: sorted((r.batch_number, r.nombre_modeles, round(r.rmse_global, 9)) for r in df.collect())
    assert pick(totals) == pick(rollup)


def test_lines_sent_twice_are_written_by_as_many_tasks_as_read_them(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    form = "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_partkey bigint, l_shipdate timestamp, l_quantity double, l_extendedprice double"
    day = lambda i: datetime.datetime(1997, 10, 1) + datetime.timedelta(days=i // 4)
    rows = [(i // 3, i % 3, 1, 1, day(i), float(rng.integers(1, 50)), float(i)) for i in range(800)]
    for part in range(5):
        spark.createDataFrame(rows[part::5], form).coalesce(1).write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(queries, "shared_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = queries.stream_monitor_dedup(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list(tmp_path.glob("lines/part-*.parquet"))) >= 3 * 5
    assert len(list(tmp_path.glob("replay/history/arrival=*"))) == 3
    want = queries.batch_rollup_dedup(spark, str(tmp_path)).collect()
    pick = lambda found: sorted((r.batch_number, r.nombre_modeles, round(r.rmse_global, 9)) for r in found)
    assert pick(got) == pick(want) and len(got) > 1


KEYED = "id bigint, store_id string, product_id string, day date, y double"


@pytest.mark.parametrize("dedup", [["id", "store_id", "product_id", "day", "y"], ["id", "day"], ["id"], []])
def test_repeats_are_found_in_several_passes(spark, tmp_path, monkeypatch, dedup):
    """Repeats inside an arrival and of earlier ones, null keys, an arrival without rows and one that comes again."""
    monkeypatch.setattr(arrivals, "PASS_ROWS", 50, raising=False)
    days = [range(0, 70), range(60, 130)]
    first, second = ([(None if i % 97 == 0 else n * 1000 + i, *r) for i, r in enumerate(sales_rows(d, n))] for n, d in enumerate(days))
    parts = [[], first + first[::3], second + first[::2] + second[::5], first + second]
    config = dataclasses.replace(CONFIG, dedup=dedup)
    out = arrivals.Outputs.below(str(tmp_path))
    columns = ["id", "store_id", "product_id", "day", "y"]
    key = lambda r: tuple(r[columns.index(c)] for c in dedup or columns)
    batch = lambda r: (r[3] - START).days // 30
    seen = {}
    for n in (0, 1, 2, 2, 3):
        got = [tuple(r) for r in arrivals._unseen(spark.createDataFrame(parts[n], KEYED), n, out, config).select(columns).collect()]
        least = {}
        for r in sorted(parts[n], key=lambda r: (r[1:], r[0] is not None, r[0] or 0)):
            least.setdefault(key(r), r)
        want = {(k, batch(r)): r for k, r in least.items() if seen.get((k, batch(r)), n) == n}
        seen.update(dict.fromkeys(want, n))
        assert sorted(got, key=str) == sorted(want.values(), key=str)
    assert spark.read.parquet(out.keys).count() == len(seen)
    assert len(arrivals._shares({b: 100 for b in range(1, 6)})) == 5
    spark.createDataFrame([("0f", 1)], "_key string, _batch int").write.partitionBy("_batch").parquet(f"{tmp_path}/old/keys/arrival=0")
    with pytest.raises(AnalysisException):
        arrivals._unseen(spark.createDataFrame(first, KEYED), 1, arrivals.Outputs.below(f"{tmp_path}/old"), config)


def test_dedup_of_arrivals_leaves_little_on_disk(spark, tmp_path, monkeypatch):
    """First copies take less room than a digest in letters, and what a pass shuffled is gone before the next one."""
    monkeypatch.setattr(arrivals, "PASS_ROWS", 10_000, raising=False)
    rng = np.random.default_rng(3)
    days = [START + datetime.timedelta(days=int(d)) for d in np.sort(rng.integers(0, 300, 30_000))]
    rows = pd.DataFrame({"id": rng.permutation(30_000), "store_id": "S001", "product_id": "P001", "day": days, "y": rng.integers(1, 50, 30_000) * 1.0})
    path = str(tmp_path / "sales")
    spark.createDataFrame(rows, KEYED).write.parquet(path)
    local = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda tops, like: {str(f): f.stat().st_size for top in tops for f in pathlib.Path(top).rglob(like)}
    out = arrivals.Outputs.below(str(tmp_path / "out"))
    config = dataclasses.replace(CONFIG, dedup=["id", "day"])
    before = files(local, "shuffle_*.data")
    for n in range(2):
        assert arrivals._unseen(spark.read.parquet(path), n, out, config).count() == (0 if n else 30_000)
    assert sum(files([out.keys], "*.parquet").values()) < 40 * 30_000
    for _ in range(100):  # deleted by a thread of its own
        left = sum(size for name, size in files(local, "shuffle_*.data").items() if name not in before)
        if left < 100_000:
            break
        time.sleep(0.1)
    assert left < 100_000


def test_repeated_arrival_changes_nothing(spark, tmp_path):
    parts = [sales_rows(range(0, 60)), sales_rows(range(60, 120), 1)]
    out = arrivals.Outputs.below(str(tmp_path))
    for n, rows in enumerate(parts):
        for _ in range(2):
            arrivals.process_arrival(spark.createDataFrame(rows, SALES), n, out, CONFIG)
    assert tables(spark, out) == expected(spark, parts)[0]


def test_in_order_arrivals_read_a_bounded_tail(spark, tmp_path):
    out = arrivals.Outputs.below(str(tmp_path))
    for n in range(6):
        part = sales_rows(range(n * 30, n * 30 + 30), n)
        arrivals.process_arrival(spark.createDataFrame(part, SALES), n, out, CONFIG)
        if n < 5:
            tail = arrivals._previous_tail(spark, out, n + 1)
            # The newest batch, and 60 rows or three batches before it, for each of two series.
            assert tail.count() <= 2 * (30 + 90)
    assert spark.read.parquet(out.history).count() == 2 * 180
    # An arrival whose predecessor left no tail falls back to the history.
    assert arrivals._previous_tail(spark, out, 9) is None


def test_stream_without_origin_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        arrivals.monitor_stream(spark.createDataFrame([], SALES), str(tmp_path), MonitorConfig())


EVENTS = "id int, kind string, ts timestamp, value double"


def event_parts(n=4, per=40):
    rng = np.random.default_rng(2)
    start = datetime.datetime(2024, 1, 1)
    return [
        [
            (p * per + i, "ab"[int(rng.integers(2))], start + datetime.timedelta(hours=float(p * 48 + rng.random() * 60)), float(i))
            for i in range(per)
        ]
        for p in range(n)
    ]


def test_daily_and_sliding_totals(spark, tmp_path):
    parts = event_parts()
    write_files(spark, str(tmp_path), parts, EVENTS)
    flat = [r for p in parts for r in p]
    schema = spark.createDataFrame([], EVENTS).schema
    newest = max(r[2] for r in flat)
    for length, make in ((1, events.daily_totals), (3, events.sliding_totals)):
        options = {"days": 3} if length == 3 else {}
        stream = events.file_stream(spark, f"{tmp_path}/*", schema, max_files=1)
        got = sinks.run_available(spark, make(stream, ["kind"], delay="2 days", **options), "t").collect()
        want = {}
        for _, kind, ts, value in flat:
            day = ts.replace(hour=0, minute=0, second=0, microsecond=0)
            for back in range(length):
                start = day - datetime.timedelta(days=back)
                if start + datetime.timedelta(days=length) <= newest - datetime.timedelta(days=2):
                    n, total = want.get((start, kind), (0, 0.0))
                    want[start, kind] = (n + 1, total + value)
        assert {(r.window_start, r.kind): (r.n, r.total) for r in got} == want


@pytest.mark.parametrize("salts", [1, 4])
def test_repeats_are_dropped_across_batches(spark, tmp_path, salts):
    parts = event_parts(3)
    hot = parts[0][0]
    parts = [parts[0] + [hot] * 30, parts[0][:10] + parts[1], parts[2]]
    write_files(spark, str(tmp_path), parts, EVENTS)
    schema = spark.createDataFrame([], EVENTS).schema
    stream = events.file_stream(spark, f"{tmp_path}/*", schema, max_files=1)
    once = events.drop_repeats(stream, ["id"], delay="10 days", salts=salts)
    ids = [r.id for r in sinks.run_available(spark, once, "d").collect()]
    assert sorted(ids) == list(range(120))


def test_drift_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(9)
    schema = "store_id string, product_id string, day date, y double, batch_number int"
    parts = []
    for b in range(1, 6):
        part = []
        for s in ("S001", "S002", "S003"):
            level = 5.0 if s == "S003" else 100 + (40 if s == "S002" and b >= 4 else 0) + rng.normal(0, 3, 20)
            for i, y in enumerate(np.broadcast_to(level, 20)):
                part.append((s, "P001", START + datetime.timedelta(days=b * 20 + i), float(y), b))
        parts.append(part)
    halves = [half for p in parts for half in (p[::2], p[1::2])]
    write_files(spark, str(tmp_path), halves, schema)
    panel = spark.createDataFrame([r for p in parts for r in p], schema)
    stream = events.file_stream(spark, f"{tmp_path}/*", panel.schema, max_files=1)
    rule = DriftRule(threshold=4.0, reference_batches=2)
    got = sinks.run_latest(spark, drift_state.drift_stream(stream, rule), ["store_id", "product_id", "batch_number"], "s")
    want = drift_flags(panel, rule)
    key = ["store_id", "product_id", "batch_number"]
    both = got.join(want.withColumnsRenamed({"drift_score": "z", "has_concept_drift": "f"}), key, "full")
    assert got.count() == want.count() == 15
    same = F.coalesce(F.abs(F.col("z") - F.col("drift_score")), F.lit(0.0)) < 1e-9
    assert both.filter(same & (F.col("f") == F.col("has_concept_drift"))).count() == 15
    assert got.filter("has_concept_drift").count() >= 1


def test_sessions_merge_split_keys_and_keep_open_ones(spark, tmp_path):
    """Rows in any order and several micro-batches: late rows join two sessions, or begin one earlier."""
    rng = np.random.default_rng(2)
    base = datetime.datetime(2025, 3, 1)
    rows = [(i, None if i % 97 == 0 else i % 5, base + datetime.timedelta(seconds=int(s))) for i, s in enumerate(rng.integers(0, 40_000, 400))]
    rows += [(1000 + i, 1, base + datetime.timedelta(seconds=777)) for i in range(150)] + [(5000, 1, None)]
    order = rng.permutation(len(rows))
    write_files(spark, str(tmp_path), [[rows[i] for i in part] for part in np.array_split(order, 5)], "id int, k int, ts timestamp")
    stream = events.file_stream(spark, f"{tmp_path}/*", spark.createDataFrame([], "id int, k int, ts timestamp").schema, max_files=1)
    changes = sessions.open_sessions(stream, ["k"], 300)
    got = sinks.run_latest(spark, changes, ["k", "started_at"], "sessions").filter("n_runs > 0")
    want = idle_groups(spark.createDataFrame(rows, "id int, k int, ts timestamp"), "ts", 300, ["k"])
    key = lambda df: sorted((-1 if r.k is None else r.k, r.started_at, r.ended_at, r.n_runs) for r in df.collect())
    assert key(got) == key(want) and sum(r.n_runs for r in got.collect()) == 550


def test_sessions_of_a_key_are_read_and_written_once():
    """Three keys in one bucket, twenty sessions each; a key without rows isn't touched, and a timer forgets what is closed."""

    class Held(dict):
        calls = 0

        def getValue(self, key):
            self.calls += 1
            return self.get(key)

        def updateValue(self, key, value):
            self.calls += 1
            self[key] = value

        def removeKey(self, key):
            del self[key]

        def iterator(self):
            return iter(self.items())

    class Handle:
        def __init__(self):
            self.held, self.timers = Held(), []
            self.registerTimer = self.timers.append

        def getMapState(self, *form):
            return self.held

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    handle, processor = Handle(), sessions.OpenSessions(1_000, ["session_key", "first", "last", "n_runs"])
    processor.init(handle)
    rows = pd.DataFrame({"session_key": list("abc") * 20, "event_micros": np.repeat(np.arange(20) * 10_000 + 5_000_000, 3)})
    (out,) = processor.handleInputRows((7,), iter([rows[:31], rows[31:]]), At(0))
    assert len(out) == 60 and set(out.n_runs) == {1} and handle.held.calls == 6
    late = pd.DataFrame({"session_key": ["b"], "event_micros": [5_000_900]})
    (out,) = processor.handleInputRows((7,), iter([late]), At(0))
    assert out.values.tolist() == [["b", 5_000_000, 5_000_900, 2]] and handle.held.calls == 8
    assert max(handle.timers) == 5_000_000 // 1000 + 192
    next(processor.handleExpiredTimer((7,), At(5_190), None))
    assert [len(blob) for (blob,) in handle.held.values()] == [24] * 3
    next(processor.handleExpiredTimer((7,), At(5_192), None))
    assert not handle.held


def test_cut_and_merged_sessions():
    assert sessions.cut(np.array([], np.int64), 5) == []
    assert sessions.cut(np.array([20, 1, 6, 14]), 5) == [(1, 6, 2), (14, 14, 1), (20, 20, 1)]
    assert sessions.merged([(10, 12, 2), (1, 3, 1), (4, 8, 5)], 1) == [(1, 8, 6), (10, 12, 2)]
    assert sessions.merged([(1, 3, 1), (9, 9, 1), (3, 8, 2)], 1) == [(1, 9, 4)]


def test_rows_of_batches_that_come_too_late_are_counted(spark, tmp_path):
    schema = "store_id string, product_id string, day date, y double, batch_number int"
    row = lambda b, i: ("S1", "P1", START + datetime.timedelta(days=b * 20 + i), float(i), b)
    parts = [[row(b, i) for i in range(5)] for b in (1, 9)] + [[row(2, i) for i in range(3)], [row(9, 7), row(1, 8)]]
    write_files(spark, str(tmp_path), parts, schema)
    stream = events.file_stream(spark, f"{tmp_path}/*", spark.createDataFrame([], schema).schema, max_files=1)
    flags = drift_state.drift_stream(stream, DriftRule(reference_batches=2), late_batches=3)
    got = sinks.run_latest(spark, flags, ["store_id", "product_id", "batch_number"], "late").collect()
    assert {r.batch_number: r.rows_skipped for r in got} == {1: 0, 9: 4}
