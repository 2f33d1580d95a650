"""A small hand-written tree of run records."""

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.text import parse_metric_line, parse_run_name
from tidewatch.operators import history
from tidewatch.operators.rollup import audit_rollups, batch_rollup
from tidewatch.sources import run_tree as R
from tidewatch.sources.tables import read_batch, write_runs

RUNS = {
    # a run in drift, with all its scores
    "a" * 32: (
        {"mlflow.runName": "Model_P001_S001_#2", "Product_ID": "P001", "Store_ID": "S001", "batch_number": "2"},
        {
            "rmse": "1000 5.0 0", "mae": "1001 4.0 0", "r2": "1002 -0.25 0", "data_points": "1003 180.0 0",
            "has_concept_drift": "1004 1.0 0", "training_period_days": "1005 226.0 0", "batch_number": "999 2.0 0",
        },
    ),
    # one metric only
    "b" * 32: (
        {"mlflow.runName": "Model_P001_S002_#2", "Product_ID": "P001", "Store_ID": "S002", "batch_number": "2"},
        {"has_concept_drift": "2000 0.0 0"},
    ),
    # no metrics folder at all
    "c" * 32: ({"mlflow.runName": "Model_P002_S001", "Product_ID": "P002", "Store_ID": "S001"}, {}),
    # the key of the first run once more, later, with a history of three points
    "d" * 32: (
        {"mlflow.runName": "Model_P001_S001_#2", "Product_ID": "P001", "Store_ID": "S001", "batch_number": "2"},
        {"rmse": "5000 9.0 0\n5002 7.0 2\n5001 8.0 1", "has_concept_drift": "5003 0.0 0"},
    ),
    # roll-ups: of a partial batch, and without a batch
    "e" * 32: (
        {"mlflow.runName": "Global_Metrics_#2", "Type": "Global_Metrics", "batch_number": "2"},
        {"rmse_global": "9000 6.5 0", "nombre_modeles": "9001 15.0 0", "modeles_avec_derive": "9002 1.0 0"},
    ),
    "f" * 32: (
        {"mlflow.runName": "Global_Metrics", "Type": "Global_Metrics"},
        {"mae_global": "9500 1.5 0"},
    ),
    # legacy counter per run
    "0" * 32: (
        {
            "mlflow.runName": "Model_P003_S001_#17", "Product_ID": "P003", "Store_ID": "S001",
            "execution_number": "17", "mlflow.user": "somebody",
        },
        {"execution_number": "300 17.0 0", "rmse": "301 2.0 0"},
    ),
}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("runs")
    for run_id, (tags, metrics) in RUNS.items():
        for kind, files in (("tags", tags), ("metrics", metrics)):
            for key, text in files.items():
                path = root / run_id / kind / key
                path.parent.mkdir(parents=True, exist_ok=True)
                path.write_text(text)
    return str(root)


@pytest.fixture(scope="module")
def wide(spark, tree):
    return R.to_wide(R.scan_runs(spark, tree)).cache()


def test_scan_reads_one_row_per_wanted_file(spark, tree):
    got = R.scan_runs(spark, tree)
    wanted = sum(len([k for k in t if k != "mlflow.user"]) + len(m) for t, m in RUNS.values())
    assert got.count() == wanted
    assert got.filter("key = 'mlflow.user'").count() == 0
    only = R.scan_runs(spark, tree, tags=["Type"], metrics=["rmse"])
    assert {(r.kind, r.key) for r in only.collect()} == {("tags", "Type"), ("metrics", "rmse")}


def test_metric_points_and_latest(spark, tree):
    points = R.parse_metric(R.scan_runs(spark, tree))
    assert points.filter(F.col("run_id") == "d" * 32).count() == 4
    newest = R.latest_points(points).filter((F.col("run_id") == "d" * 32) & (F.col("key") == "rmse")).first()
    assert (newest.value, newest.step) == (7.0, 2)


def test_wide_has_nulls_for_lost_values(wide):
    got = {r.run_id: r for r in wide.collect()}
    assert len(got) == len(RUNS)
    assert got["b" * 32].metric_rmse is None
    assert got["c" * 32].logged_at is None
    assert got["d" * 32].metric_rmse == 7.0
    assert got["a" * 32].metric_r2 == -0.25


def test_kinds_and_tables(wide):
    models, rollups = R.split_kinds(wide)
    assert (models.count(), rollups.count()) == (5, 2)
    table = {r.run_id: r for r in R.model_table(wide).collect()}
    first = table["a" * 32]
    assert (first.batch_number, first.data_points, first.training_period_days) == (2, 180, 226)
    assert first.has_concept_drift is True and table["b" * 32].has_concept_drift is False
    assert table["c" * 32].has_concept_drift is None
    assert table["0" * 32].execution_number == 17 and table["0" * 32].batch_number is None
    totals = {r.run_id: r for r in R.global_table(wide).collect()}
    assert totals["e" * 32].nombre_modeles == 15 and totals["f" * 32].batch_number is None


def test_identity(wide):
    assert R.check_identity(wide).count() == 0
    wrong = wide.withColumn("tag_Store_ID", F.lit("S009"))
    assert R.check_identity(wrong).count() == 7
    odd = wide.withColumn("tag_mlflow_runName", F.lit("something else"))
    assert R.check_identity(odd).count() == 7


def test_latest_run_of_a_key_run_twice(wide):
    runs = R.model_table(wide)
    latest = history.latest_runs(runs).filter("store_id = 'S001' and product_id = 'P001'").collect()
    assert [r.run_id for r in latest] == ["d" * 32]


def test_rollup_skips_missing_scores(wide):
    got = batch_rollup(R.model_table(wide).filter("batch_number = 2")).first()
    assert (got.nombre_modeles, got.modeles_avec_derive) == (3, 1)
    assert got.rmse_global == pytest.approx(6.0)
    assert got.mae_global == pytest.approx(4.0)


def test_rollup_audit(wide):
    models, rollups = R.model_table(wide), R.global_table(wide)
    got = {r.batch_number: r for r in audit_rollups(models, rollups).collect()}
    assert (got[2].members, got[2].reported, got[2].agrees) == (3, 15, False)
    same = rollups.withColumn("nombre_modeles", F.lit(3).cast("bigint"))
    again = {r.batch_number: r for r in audit_rollups(models, same).collect()}
    # Two of the three members still have their rmse, so the stored mean is not held against them.
    assert again[2].agrees and again[2].members_in_drift == 1


def test_records_without_a_batch_take_that_of_their_rollup(wide):
    models, rollups = R.model_table(wide), R.global_table(wide)
    got = {r.run_id: r for r in history.close_runs(models, rollups).collect()}
    assert len(got) == 5
    legacy = got["0" * 32]
    assert legacy.rollup_id == "e" * 32 and legacy.batch_number == 2
    assert got["c" * 32].rollup_id is None


def test_long_form_round_trip(wide):
    runs = R.model_table(wide).filter("batch_number is not null and logged_at is not null")
    again = R.model_table(R.to_wide(R.model_long(runs)))
    same = [c for c in runs.columns if c != "logged_at"]
    assert sorted(runs.select(same).collect()) == sorted(again.select(same).collect())


def test_names_and_lines(spark):
    names = ["Model_P005_S002_#7", "Model_P002_S008", "Global_Metrics_#5", "Global_Metrics", "Model_X", ""]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [tuple(r.p) for r in df.select(parse_run_name(F.col("name")).alias("p")).collect()]
    assert got == [
        ("model", "P005", "S002", 7), ("model", "P002", "S008", None),
        ("global", None, None, 5), ("global", None, None, None),
        (None, None, None, None), (None, None, None, None),
    ]
    lines = spark.createDataFrame([("1748825013876 8.5 0",), ("x y",), ("12",)], "line string")
    parsed = [r.p for r in lines.select(parse_metric_line(F.col("line")).alias("p")).collect()]
    assert parsed[0].value == 8.5 and parsed[0].step == 0 and parsed[0].ts.microsecond == 876000
    assert parsed[1].ts is None and parsed[1].value is None and parsed[2].value is None


def test_write_replaces_only_its_batches(spark, tmp_path):
    path = str(tmp_path / "runs")
    make = lambda n, v: spark.createDataFrame([(n, v)], "batch_number int, v int")
    write_runs(make(1, 10).unionByName(make(2, 20)), path)
    write_runs(make(2, 21), path)
    assert sorted((r.batch_number, r.v) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 21)]
    one = read_batch(spark, path, 2)
    assert [r.v for r in one.collect()] == [21]
    assert "PartitionFilters: [isnotnull(batch_number" in one._jdf.queryExecution().executedPlan().toString()
