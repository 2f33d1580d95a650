import random

import pyarrow as pa
import pytest

from tidewatch.llm import common


def least_of(edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {x: root(x) for x in parent}


def graph(seed):
    """A long way in random order, a star around its largest node, small pieces, repeated and turned edges."""
    rnd = random.Random(seed)
    names = rnd.sample(range(10_000), 1200)
    way, star = names[:300], sorted(names[300:600])
    edges = [*zip(way, way[1:], strict=False), *((star[-1], x) for x in star[:-1])]
    edges += [(a, b) for a, b in (rnd.sample(names[600:], 2) for _ in range(250))]
    edges += [(b, a) for a, b in rnd.sample(edges, 100)] + rnd.sample(edges, 100)
    rnd.shuffle(edges)
    return edges


@pytest.mark.parametrize(("kind", "coalesce", "most"), [("bigint", "true", 5), ("binary", "false", 8)])
def test_components_equal_the_definition_in_few_tables(spark, monkeypatch, kind, coalesce, most):
    """Each table costs a write and shuffles; the large and small stars that took turns here before wrote 9 of them either way."""
    edges, written = graph(3), []
    name = (lambda x: x) if kind == "bigint" else (lambda x: x.to_bytes(8, "big"))
    monkeypatch.setattr(common, "staged", lambda df, purpose, real=common.staged: written.append(purpose) or real(df, purpose))
    rows = [(name(a), name(b)) for a, b in edges] + [(name(10_001), name(10_001)), (None, name(10_002))]
    with_parts = spark.createDataFrame(rows, f"a {kind}, b {kind}").repartition(16)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        found = [(bytes(n) if kind == "binary" else n, bytes(c) if kind == "binary" else c) for n, c in common.components(with_parts).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert sorted(found) == sorted((name(n), name(c)) for n, c in least_of(edges).items())
    assert len(written) <= most


def test_no_edge_and_one_edge(spark):
    assert common.components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).collect() == []
    got = common.components(spark.createDataFrame([(2, 1), (1, 2)], "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1)]


@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_forest_keeps_what_is_connected(limit):
    edges = sorted({e for a, b in graph(4) for e in ((a, b), (b, a))})
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges[k : k + 5], strict=True)], ["a", "b"]) for k in range(0, len(edges), 5)]
    got = [(r["a"], r["b"]) for b in common.forest(iter(batches), limit) for r in b.to_pylist()]
    assert all(a > b for a, b in got) and least_of(got) == least_of(edges)
    # The edges of one node in order of their other end: all get its smallest one, whatever the limit.
    star = [pa.RecordBatch.from_arrays([pa.array([50] * 3, pa.int64()), pa.array(range(k, k + 3), pa.int64())], ["a", "b"]) for k in (1, 51, 60, 70)]
    assert {b for out in common.forest(iter(star), limit) for b in out.column("b").to_pylist()} == {1}
