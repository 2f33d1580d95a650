import os
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import sharding


def texts(odd_rows, more=4000):
    rows = [r for r in odd_rows if len(r[1] or "") < 1000]
    return rows + [(100 + k, "w" * (k * 37 % 211)) for k in range(more)] + [(None, "again")] * 200


@pytest.fixture(scope="module")
def resharded(make_docs, odd_rows, tmp_path_factory):
    """Documents of three uneven old shards, one of them null, in five new ones, and the folder they lie in."""
    path = str(tmp_path_factory.mktemp("layout") / "layout")
    rows = texts(odd_rows)
    docs = make_docs(rows).withColumn("home", F.lit("taken"))
    old = F.when(F.col("doc_id") % 7 == 0, 2).when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(1)
    return path, rows, docs, sharding.shard_documents(docs, old, 5, path).collect()


def test_documents_lie_where_the_result_says(spark, resharded):
    path, rows, docs, got = resharded
    kept = [f for f in docs.schema if f.name not in ("home", "block", "_row", "shard")]
    lying = sharding.read_layout(spark, path, kept).collect()
    assert {f.name for f in kept} <= set(lying[0].asDict())
    assert sorted((str(r.doc_id), r.text or "") for r in lying) == sorted((str(i), t or "") for i, t in rows)
    own = lambda r, text: (str(r.doc_id), len(text) + 1, zlib.crc32(text), r.shard)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard) for r in got) == sorted(own(r, (r.text or "").encode()) for r in lying)


def test_at_most_one_block_of_a_transfer_is_rewritten(spark, resharded):
    path, _, _, got = resharded
    blocks = {(home, block) for home in os.listdir(f"{path}/version=0") if "=" in home for block in os.listdir(f"{path}/version=0/{home}")}
    rewritten = {
        (home, block)
        for shard in os.listdir(f"{path}/version=1") if "=" in shard
        for home in os.listdir(f"{path}/version=1/{shard}")
        for block in os.listdir(f"{path}/version=1/{shard}/{home}")
    }
    held = {}
    for home, block in blocks:
        name = f"{path}/version=0/{home}/{block}"
        held[home] = held.get(home, 0) + spark.read.parquet(name).select(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1)).first()[0]
    sizes = [held.get(f"home={k}", 0) for k in range(5)]
    plan = sharding.fewest_bytes(sizes, sharding.equal_capacities(sum(sizes), 5))
    moves = [t for t in plan if t[0] != t[1]]
    assert 0 < len(rewritten) <= len(moves) and rewritten <= blocks and len(blocks) == 3 * sharding.LEAST_BLOCKS
    still = spark.read.parquet(f"{path}/manifest").collect()
    assert {(f"home={r.home}", f"block={r.block}") for r in still} == blocks - rewritten
    spread = [sum(r.size for r in got if r.shard == k) for k in range(5)]
    assert max(spread) - min(spread) <= 0.002 * max(spread)


def test_shards_that_are_even_stay_as_they_are(spark, make_docs, tmp_path):
    docs = make_docs([(k, "same") for k in range(400)])
    got = sharding.shard_documents(docs, F.col("doc_id") % 4, 4, str(tmp_path / "even")).collect()
    assert all(r.shard == r.doc_id % 4 for r in got)
    assert not [d for d in os.listdir(tmp_path / "even" / "version=1") if "=" in d]


def test_empty_table(make_docs):
    assert sharding.shard_documents(make_docs([]), F.lit(0), 4).count() == 0
