"""What the operators share: tables between steps, values kept per worker process, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.session import shared_dir
from tidewatch.sources.tables import read_table

T = TypeVar("T")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` below the shared folder and read it back: lineage ends, a lost executor costs no rerun."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def per_process(slot: str, make: Callable[[], T], key: str = "") -> T:
    """The value of `make`, made once per Python process although functions are shipped with each task.

    A slot holds the value of the last key only.
    """
    store = sys.modules.setdefault("_tidewatch_llm_store", types.ModuleType("_tidewatch_llm_store"))
    held = getattr(store, slot, None)
    if held is None or held[0] != key:
        held = (key, make())
        setattr(store, slot, held)
    return held[1]


def hashed_sample(df: DataFrame, size: int, rows: int, *by: str) -> DataFrame:
    """At most `size` of the `rows` rows of `df`, chosen by a hash of `by`; all of them if they are no more.

    A share of the hash range is taken first, so what meets in one task is about `size` rows however many
    partitions there are.
    """
    spread = 1 << 30
    share = min(1.0, 1.3 * size / max(rows, 1))
    near = df.filter(F.pmod(F.xxhash64(*by), F.lit(spread)) < F.lit(int(share * spread)))
    return near.orderBy(F.xxhash64(*by), *by).limit(size)


def read_local(path: str) -> str:
    """A vocabulary file on the driver; it travels to the executors by broadcast."""
    with open(path, encoding="utf-8") as file:
        return file.read()


class Bounded(dict):
    """A dictionary that computes missing values and holds at most twice `limit` of them.

    Once full, it starts anew and keeps the entries before for one more round, so what is asked for often stays.
    Keys longer than `longest` are computed each time, so the size in bytes is bounded too.
    """

    def __init__(self, compute: Callable, limit: int = 250_000, longest: int = 48) -> None:
        super().__init__()
        self.compute, self.limit, self.longest, self.before = compute, limit, longest, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def forest(batches: Iterator[pa.RecordBatch], limit: int = 200_000) -> Iterator[pa.RecordBatch]:
    """The edges (a, b) of a task as (node, smallest node that they reach from it), for about `limit` edges at a time.

    What the last `a` reached is carried on, so the edges of one `a` that come in order of `b` all get its smallest.
    """
    parent: dict = {}

    def root(node):
        while (above := parent[node]) != node:
            parent[node] = parent[above]
            node = parent[node]
        return node

    def out(schema: pa.Schema) -> pa.RecordBatch:
        found = [(node, least) for node in parent if (least := root(node)) != node]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], schema.field(k).type) for k in (0, 1)], ["a", "b"])

    held, schema, a = 0, None, None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
        held += batch.num_rows
        if held >= limit:
            yield out(schema)
            least = root(a)
            parent.clear()
            parent[a] = parent[least] = least
            held = 0
    if held:
        yield out(schema)


def components(edges: DataFrame, purpose: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component) of an undirected graph given as (a, b): the smallest node that can be reached.

    A round brings the neighbours of each node together and hangs them on the smallest one, until every node hangs on its
    smallest member and on nothing else. Tasks join whatever their own edges connect and hold a bounded number of them, so a
    component is spread over as many rows as it has nodes. Rounds grow with the logarithm of the longest way in a
    component; nodes without edges don't appear.
    """
    pair = edges.select("a", "b")
    form = pair.schema
    now = staged(pair.filter("a != b").mapInArrow(forest, form), purpose)
    for _ in range(rounds):
        ends = now.select(F.col("a").alias("node"), "b").unionByName(now.select(F.col("b").alias("node"), F.lit(None).cast(form["b"].dataType).alias("b")))
        known = ends.groupBy("node").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.bool_or(F.col("b").isNull()).alias("top"))
        if not known.filter("lo != hi or (lo is not null and top)").take(1):
            return known.select("node", F.coalesce("lo", "node").alias("component"))
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = staged(both.repartition("a").sortWithinPartitions("a", "b").mapInArrow(forest, form), purpose)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def offsets(totals: DataFrame, part: str, amount: str) -> DataFrame:
    """(part, offset): the sum of `amount` over all smaller parts; one row per part, so the order is cheap."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(amount).over(before), F.lit(0)).alias("offset"))
