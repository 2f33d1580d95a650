import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from tidewatch.llm import bagminhash, secret_scans

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER).cache()
        assert after.columns == docs.columns, name
        assert after.dtypes == docs.dtypes, name
        ids = {r.doc_id for r in after.collect()}
        assert ids <= {r.doc_id for r in before.collect()}
        before = after
    texts = [r.text for r in before.collect()]
    bags = [set(bagminhash.shingle_hashes([t], 5)[0].tolist()) for t in texts]
    assert all(len(a & b) < 0.8 * len(a | b) for i, a in enumerate(bags) for b in bags[:i] if a)
    assert not any(r.is_secret for r in secret_scans.scan(before, before.source).filter("keyword_inside = 1").collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in before.collect()}


def test_run_equals_the_stages_one_by_one(spark):
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert {p.doc_id for p in whole} and sum(p.length for p in whole if p.sequence_id == 0) == 2048


def test_entry_works_without_the_subpackage():
    """As if both folders and the pipeline were deleted."""
    code = """
import sys
sys.modules["tidewatch.llm"] = sys.modules["corpus_pipeline"] = None
import __spark_entry__ as e
assert "batch_rollup" in e.queries() and "pipeline" not in e.queries() and not any(k.startswith("op") for k in e.queries())
assert set(e.oracle_sql()) <= set(e.queries()) and not any(k.startswith("tidewatch.llm.") for k in sys.modules)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
