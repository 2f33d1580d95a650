"""Resharding by minimum-cost flow: the fewest bytes that bring old shards to new capacities.

The old layout lies in one file set per shard and block; a block is a share of the rows of a shard, about `TARGET` bytes or
a `LEAST_BLOCKS`-th of the shard if that is less. The flow runs over shard totals, a few numbers that the driver holds, and
is carried out on blocks: those that lie whole in one transfer change their shard in the manifest of the layout and
none of their bytes are touched. Only a block that a border between two transfers cuts is rewritten, at most one for each
transfer; its documents go where their middle lies. What the size of a document on a border left over is evened
out by a second flow among the documents that are rewritten anyway, the smallest first; only where documents are about as
large as blocks, further blocks are opened for it.

A null text has no bytes and counts as size 1 with checksum 0; a null doc_id is kept; a null old shard is shard 0; equal
rows each get a slot; an empty table gives an empty one. The columns that are made here (shard, block, home, _row) replace
columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidewatch.llm.common import staged
from tidewatch.session import shared_dir

#: (from, to, bytes)
Transfer = tuple[int, int, int]

#: Bytes of text in a block, and blocks of a shard at least: a block is read and written by one task.
TARGET, LEAST_BLOCKS = 512 << 20, 16

#: The share of the bytes of a shard for which no block is rewritten.
EVEN = 0.001

#: Where a document lay: its old shard and block. Also what tells blocks of a new shard apart.
BLOCK = ["home", "block"]

#: Names a row through the layouts; equal rows have a name each.
ROW = "_row"


def fewest_bytes(
    held: Sequence[int], capacities: Sequence[int], cost: Callable[[int, int], int] = lambda i, j: int(i != j)
) -> list[Transfer]:
    """Minimum-cost flow from old shards to new capacities by successive shortest paths.

    Moving a byte from shard i to shard j costs `cost(i, j)`; by default staying is free and all moves cost the same.
    The result also lists what stays (from = to). Raises ValueError if the capacities can't hold everything.
    """
    if sum(held) > sum(capacities):
        raise ValueError(f"{sum(held)} bytes do not fit into {sum(capacities)}")
    n, m = len(held), len(capacities)
    source, sink = n + m, n + m + 1
    room: dict[tuple[int, int], int] = {}
    price: dict[tuple[int, int], int] = {}

    def edge(a: int, b: int, most: int, each: int) -> None:
        room[a, b], room[b, a], price[a, b], price[b, a] = most, 0, each, -each

    for i, size in enumerate(held):
        edge(source, i, size, 0)
        for j in range(m):
            edge(i, n + j, size, cost(i, j))
    for j, most in enumerate(capacities):
        edge(n + j, sink, most, 0)
    left = sum(held)
    while left:
        reach, came = {source: 0}, {}
        changed = True
        while changed:
            changed = False
            for (a, b), free in room.items():
                if free and a in reach and reach[a] + price[a, b] < reach.get(b, 1 << 62):
                    reach[b], came[b], changed = reach[a] + price[a, b], a, True
        path, node = [], sink
        while node != source:
            path.append((came[node], node))
            node = came[node]
        amount = min(left, *(room[e] for e in path))
        for a, b in path:
            room[a, b] -= amount
            room[b, a] += amount
        left -= amount
    return [(i, j, room[n + j, i]) for i in range(n) for j in range(m) if room[n + j, i]]


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (k < total % shards) for k in range(shards)]


# --- the layout ----------------------------------------------------------------------------------


def _size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + 1


def write_blocks(docs: DataFrame, old_shard: Column, path: str) -> DataFrame:
    """Write `docs` as version 0 of the layout at `path`, a file set per (home, block), and read it back."""
    home = F.coalesce(old_shard.cast("int"), F.lit(0))
    totals = docs.select(home.alias("home"), _size(F.col("text")).alias("size")).groupBy("home").agg(F.sum("size").alias("size")).collect()
    blocks = {r["home"]: max(LEAST_BLOCKS, -(-r["size"] // TARGET)) for r in totals}
    of = F.create_map(*[F.lit(x) for item in (blocks or {0: 1}).items() for x in item])
    kept = StructType([f for f in docs.schema if f.name not in (*BLOCK, "shard", ROW)])
    rows = docs.select(*kept.names, home.alias("home"), F.monotonically_increasing_id().alias(ROW))
    rows = rows.withColumn("block", F.pmod(F.xxhash64(ROW), F.element_at(of, F.col("home"))).cast("int"))
    _write(rows.repartition(*BLOCK), f"{path}/version=0", BLOCK)
    return _read(docs.sparkSession, f"{path}/version=0", kept, BLOCK)


def _write(rows: DataFrame, path: str, by: list[str]) -> None:
    rows.write.option("compression", "zstd").partitionBy(*by).parquet(path)


def _read(spark: SparkSession, path: str, kept: StructType, by: list[str]) -> DataFrame:
    """The schema is given: an empty table writes no file that would show it."""
    form = StructType([*kept, StructField(ROW, LongType()), *[StructField(c, IntegerType()) for c in by]])
    return spark.read.schema(form).option("basePath", path).parquet(path)


def read_layout(spark: SparkSession, path: str, kept: StructType) -> DataFrame:
    """All documents of the layout with their shard: blocks by the manifest, and what was rewritten."""
    manifest = spark.read.schema("home int, block int, shard int").parquet(f"{path}/manifest")
    still = _read(spark, f"{path}/version=0", kept, BLOCK).join(manifest, BLOCK)
    return still.unionByName(_read(spark, f"{path}/version=1", kept, ["shard", *BLOCK]))


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, size, text_crc32, home, block, _row) and `keep` of documents as they lie in the layout, without the text."""
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return docs.select(F.col("doc_id").cast("bigint"), _size(F.col("text")).alias("size"), crc.alias("text_crc32"), *BLOCK, ROW, *keep)


# --- the plan ------------------------------------------------------------------------------------


def shard_sizes(rows: DataFrame, by: str, shards: int) -> list[int]:
    """Bytes of each shard: one row per shard comes to the driver."""
    found = {r[0]: r[1] for r in rows.groupBy(by).agg(F.sum("size")).collect()}
    return [found.get(k, 0) for k in range(max([shards, *(k + 1 for k in found)]))]


def target_at(shard: Column, at: Column, transfers: Sequence[Transfer]) -> Column:
    """The new shard of the byte at a place of an old shard: its first bytes move, its last ones stay."""
    target = F.lit(None).cast("int")
    for i in sorted({t[0] for t in transfers}):
        low, choice = 0, F.lit(None).cast("int")
        own = sorted((t for t in transfers if t[0] == i), key=lambda t: t[1] == i)
        bounds = []
        for _, j, amount in own:
            low += amount
            bounds.append((low, j))
        for high, j in reversed(bounds):
            choice = F.when(at < high, F.lit(j)).otherwise(choice)
        target = F.when(shard == i, choice).otherwise(target)
    return target


def placed_blocks(rows: DataFrame, transfers: Sequence[Transfer]) -> DataFrame:
    """(home, block, size, start, shard): blocks in order with their first byte; `shard` is null where a border cuts one."""
    totals = rows.groupBy(*BLOCK).agg(F.sum("size").alias("size"))
    before = Window.partitionBy("home").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*BLOCK, "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    first = target_at(F.col("home"), F.col("start"), transfers)
    last = target_at(F.col("home"), F.col("start") + F.col("size") - 1, transfers)
    return starts.withColumn("shard", F.when(first == last, first))


def cut_apart(rows: DataFrame, cut: DataFrame, transfers: Sequence[Transfer]) -> DataFrame:
    """Documents of the cut blocks with the shard in which the middle of each lies.

    The order in a block is by a hash, so that both sides of a border have small documents to even out with.
    """
    inside = Window.partitionBy(*BLOCK).orderBy(F.xxhash64(ROW), ROW).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.floor(F.col("size") / 2)
    return rows.join(cut.select(*BLOCK, "start"), BLOCK).withColumn("shard", target_at(F.col("home"), at, transfers)).drop("start")


def blocks_to_open(whole: DataFrame, pool: DataFrame, small: Sequence[Transfer]) -> DataFrame | None:
    """Blocks to rewrite after all where the documents of cut blocks are less than twice what has to leave their shard.

    A document larger than what has to leave does not count, and a share of EVEN may stay uneven. That takes documents about as large as blocks; otherwise
    there are no such blocks.
    """
    out = {i: sum(n for a, j, n in small if a == i and j != i) for i in sorted({t[0] for t in small})}
    per_shard = lambda amounts: F.try_element_at(
        F.create_map(*[F.lit(x) for item in amounts.items() for x in item]), F.col("shard")
    )
    if not any(out.values()):
        return None
    fit = pool.filter(F.col("size") <= per_shard(out)).groupBy("shard").agg(F.sum("size").alias("size")).collect()
    loose = {r["shard"]: r["size"] for r in fit}
    held = {i: sum(n for a, _, n in small if a == i) for i in out}
    need = {i: 2 * n - loose.get(i, 0) for i, n in out.items() if 2 * n > loose.get(i, 0) and n > EVEN * held[i]}
    if not need:
        return None
    before = Window.partitionBy("shard").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = whole.withColumn("_at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return placed.filter(F.col("_at") < per_shard(need)).drop("_at")


def evened(pool: DataFrame, transfers: Sequence[Transfer]) -> DataFrame:
    """`pool` with `shard` changed by small transfers: the smallest documents of a shard go first, by their middles.

    Sums of (shard, size class, home, block) first, then a running sum inside of each.
    """
    kinds = ["shard", "size_class", *BLOCK]
    classed = pool.withColumn("size_class", F.floor(F.log2(F.col("size").cast("double"))).cast("int"))
    totals = classed.groupBy(*kinds).agg(F.sum("size").alias("total"))
    before = Window.partitionBy("shard").orderBy(*kinds[1:]).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*kinds, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*kinds).orderBy("size", ROW).rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.floor(F.col("size") / 2)
    placed = classed.join(starts, kinds).withColumn("_at", at)
    return placed.withColumn("shard", target_at(F.col("shard"), F.col("_at"), transfers)).select(*pool.columns)


# --- carrying it out -----------------------------------------------------------------------------


def rewrite_cut(old: DataFrame, pool: DataFrame, cut: list[tuple[int, int]], path: str) -> None:
    """Write the documents of the cut blocks as version 1, by new shard and the block they come from.

    Only the files of those blocks are read; there are at most as many as transfers.
    """
    wanted = F.lit(False)
    for home in sorted({h for h, _ in cut}):
        wanted = wanted | ((F.col("home") == home) & F.col("block").isin([b for h, b in cut if h == home]))
    moves = pool.select(F.col(ROW).alias("_moved"), "shard")
    rows = old.filter(wanted).join(moves, F.col(ROW) == F.col("_moved")).drop("_moved")
    _write(rows.repartition("shard", *BLOCK), f"{path}/version=1", ["shard", *BLOCK])


def with_slots(rows: DataFrame) -> DataFrame:
    """`slot`: the place of a document in its shard, gapless from 0; counts of blocks first, then places inside."""
    group = ["shard", *BLOCK]
    counts = rows.groupBy(*group).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*group).orderBy("doc_id", "text_crc32", ROW)
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1).join(starts, group)
    return numbered.withColumn("slot", F.col("first") + F.col("inside")).drop("first", "inside")


def shard_documents(docs: DataFrame, old_shard: Column, shards: int = 16, path: str | None = None) -> DataFrame:
    """All documents in `shards` shards of near equal bytes, with the fewest bytes moved from `old_shard`.

    The old layout is written at `path`, the plan is carried out on it, and sizes, checksums and slots are those of the
    files: a block that only changed its shard is measured where it lies, a rewritten document where it lies now.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "layout")
    old = write_blocks(docs, old_shard, path)
    kept = StructType([f for f in old.schema if f.name not in (*BLOCK, ROW)])
    rows = staged(measured(old), "sizes")
    held = shard_sizes(rows, "home", shards)
    capacities = equal_capacities(sum(held), shards)
    transfers = fewest_bytes(held, capacities)
    blocks = staged(placed_blocks(rows, transfers), "blocks")
    whole, cut = blocks.filter("shard is not null"), blocks.filter("shard is null")
    pool = staged(cut_apart(rows, cut, transfers), "cut")
    loose = shard_sizes(pool, "shard", shards)
    still = shard_sizes(whole, "shard", shards)
    small = fewest_bytes([a + b for a, b in zip(loose, still)], capacities)
    opened = blocks_to_open(whole, pool, small)
    if opened is not None:
        opened = staged(opened, "opened")
        whole = whole.join(opened.select(*BLOCK), BLOCK, "left_anti")
        cut = cut.unionByName(opened.withColumn("shard", F.lit(None).cast("int")).select(*cut.columns))
        pool = staged(pool.unionByName(rows.join(opened.select(*BLOCK, "shard"), BLOCK)), "cut")
    whole.select(*BLOCK, "shard").write.parquet(f"{path}/manifest")
    pool = staged(evened(pool, small), "evened")
    rewrite_cut(old, pool, [tuple(r) for r in cut.select(*BLOCK).collect()], path)

    moved = rows.join(whole.select(*BLOCK, "shard"), BLOCK)
    rewritten = measured(_read(spark, f"{path}/version=1", kept, ["shard", *BLOCK]), "shard")
    return with_slots(moved.unionByName(rewritten)).drop("home", "block")
