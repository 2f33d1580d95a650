import math

import numpy as np
import pytest
from plans_seen import plan_of
from pyspark.sql import functions as F

from tidewatch.operators import selection

PS = [0.0, 0.1, 0.5, 0.999, 1.0]


def check(spark, groups, ps=PS, rows=4096):
    data = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "k int, v double").repartition(4)
    got = {(r.k, r.probability): r.quantile for r in selection.quantiles(df, ["k"], "v", ps, rows).collect()}
    assert set(got) == {(k, p) for k, vs in groups.items() if len(vs) for p in ps}
    for k, vs in groups.items():
        for p in ps:
            want = float(np.quantile(np.array(vs, float), p))
            assert got[k, p] == pytest.approx(want, rel=1e-12, abs=1e-300), (k, p)


def test_one_key_of_nine_tenths_and_keys_of_three_rows(spark):
    rng = np.random.default_rng(0)
    groups = {0: rng.normal(size=36_000)}
    groups |= {k: rng.normal(size=3) for k in range(1, 1300)}
    data = [(k, float(v)) for k, vs in groups.items() for v in vs]
    df = spark.createDataFrame(data, "k int, v double")
    out = selection.quantiles(df, ["k"], "v", [0.25, 0.5, 0.9], rows=64)
    got = {(r.k, r.probability): r.quantile for r in out.collect()}
    assert len(got) == 3 * len(groups)
    for k in (0, 1, 700, 1299):
        for p in (0.25, 0.5, 0.9):
            assert got[k, p] == pytest.approx(float(np.quantile(groups[k], p)), abs=1e-12)


def test_ties_outliers_and_values_of_all_sizes(spark):
    rng = np.random.default_rng(1)
    tied = np.where(rng.random(3000) < 0.34, 1.0, rng.random(3000) * 3)
    powers = [2.0**-k for k in range(0, 1000, 9)] + [-(3.0**k) for k in range(0, 600, 9)]
    outlier = np.append(rng.random(2000), [1e300, -1e308, 1.7e308])
    tiny = [5e-324 * k for k in range(200)]
    check(spark, {0: tied, 1: powers, 2: outlier, 3: tiny, 4: [7.0] * 5000, 5: [3.0, 1.0], 6: [2.0]}, rows=32)


def test_infinite_values_sort_at_the_ends(spark):
    values = [math.inf] * 30 + [-math.inf] * 30 + list(range(100))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("k", F.lit(1))
    got = {r.probability: r.quantile for r in selection.quantiles(df, ["k"], "v", [0.0, 0.5, 1.0], rows=4).collect()}
    assert got == {0.0: -math.inf, 0.5: 49.5, 1.0: math.inf}


def test_nulls_nan_null_keys_and_empty_tables(spark):
    rows = [(None, 1.0), (None, 3.0), (1, None), (1, math.nan), (2, math.nan), (2, 5.0)]
    df = spark.createDataFrame(rows, "k int, _v double")
    got = {(r.k, r.probability): r.quantile for r in selection.quantiles(df, ["k"], "_v", [0.5]).collect()}
    assert got == {(None, 0.5): 2.0, (2, 0.5): 5.0}
    assert selection.quantiles(df.filter("k > 5"), ["k"], "_v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        selection.quantiles(df, [], "_v", [0.5])


def test_no_value_decides_where_a_row_goes(spark):
    df = spark.range(50_000).select((F.col("id") % 3).alias("k"), F.rand(seed=1).alias("v"))
    known = df.select(F.col("k").alias("_k0"), F.col("v").alias("_v"))
    brackets = known.groupBy("_k0").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).select(
        "_k0", F.lit(100).cast("bigint").alias("_rank"), "_lo", "_hi", F.lit(0).cast("bigint").alias("_below"), F.lit(17_000).cast("bigint").alias("_inside")
    )
    plan = plan_of(selection._narrowed(known, brackets, ["_k0"], False))
    assert "raise_error" not in plan
    for line in plan.splitlines():
        if "hashpartitioning" in line:
            assert "_v" not in line.split("hashpartitioning")[1].split(")")[0]
    assert "partial_count" in plan
