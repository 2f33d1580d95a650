from pyspark.sql import functions as F

from tidewatch.llm import secret_scans


def test_rare_true_findings_stay_in_the_sample(spark, make_docs):
    """Three true findings beside 600 false ones, with room for 40: all of them teach and stand."""
    rows = [(k, f"entry 2024-01-{k:04d} done") for k in range(600)]
    rows += [(1000 + k, f"set token = a{k}b7Xq9Zr4Lk2Wd8Pm{k} here") for k in range(6)]
    known = [(k, 1, 0.0) for k in range(600)] + [(1000 + k, 3, 1.0) for k in range(3)]
    labelled = spark.createDataFrame(known, "doc_id long, word_no int, label double")
    got = secret_scans.scan(make_docs(rows), F.col("lang"), labelled, secret_scans.Forest(sample=40)).collect()
    assert {r.doc_id for r in got if r.is_secret} == set(range(1000, 1006))


def test_quotas_hold_both_labels():
    assert secret_scans.quotas({0.0: 100_000, 1.0: 5}, 20) == {0.0: 15, 1.0: 5}
    assert secret_scans.quotas({0.0: 100, 1.0: 100}, 20) == {0.0: 10, 1.0: 10}


def test_true_labels_stand_whatever_the_forest_says(spark, make_docs):
    """Findings of one shape, of which one was seen to be true."""
    rows = [(k, f"entry 2024-01-{k:04d} done") for k in range(200)]
    labelled = spark.createDataFrame([(k, 1, float(k == 7)) for k in range(200)], "doc_id long, word_no int, label double")
    got = secret_scans.scan(make_docs(rows), F.col("lang"), labelled).collect()
    assert {r.doc_id for r in got if r.is_secret} == {7}
