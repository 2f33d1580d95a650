"""Near-duplicates by BagMinHash signatures of word shingles, banded and verified.

A document is the multiset of its shingles (five words, lower case, marks around words taken off). Each shingle owns
Poisson processes over weight: one for weights up to 1, one for 1 to 2, 2 to 4, and so on, with as many
points per unit of weight and time for each register. A point counts if its weight level lies inside the shingle's
multiplicity; a register keeps the earliest point that falls on it. Two documents agree in a register with the
probability of their weighted Jaccard similarity. Points are drawn only up to a time that fills all registers, so
the work per document hardly depends on its length.

Equal texts form a class and are compared once. A null text is taken as empty; a text without a word has its class of equal
texts, but is like no other one; a text of fewer than five words has one shingle of all of them. Null ids and repeated rows
are kept as rows; extra columns pass through `first_of_groups`; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Bounded, components, per_process, staged

SKETCH = "doc_id bigint, node binary, n bigint, signature binary"
BAG = "node binary, bag binary"
PAIR = "a binary, b binary"


@dataclass(frozen=True)
class Scheme:
    """`similarity` is the weighted Jaccard similarity from which on two texts are linked.

    With 16 bands of 4 registers a pair at 0.8 is missed with probability 0.0002. `stars` is the number of rounds in which the members
    of a bucket are compared with one of them; what is then still apart is compared in blocks of `block` texts.
    `near` is the share of equal registers from which on such a pair is verified (five standard deviations below).
    """

    words: int = 5
    similarity: float = 0.8
    bands: int = 16
    rows: int = 4
    stars: int = 3
    block: int = 512
    near: float = 0.55

    @property
    def registers(self) -> int:
        return self.bands * self.rows


# --- signatures ----------------------------------------------------------------------------------

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _nth(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLD) & (1 << 64) - 1)


#: Marks that are taken off the ends of a word.
_MARKS = string.punctuation.encode()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hash(word: bytes) -> int:
    """64 bits of a word without the marks around it; 0 if nothing is left."""
    core = word.strip(_MARKS)
    core = core.lower() if core.isascii() else core.decode("utf-8", "replace").lower().encode()
    return xxhash.xxh3_64_intdigest(core) | 1 if core else 0


def shingle_hashes(texts: list[str], words: int) -> list[np.ndarray]:
    """For each text the 48-bit hashes of its shingles, in order of the text."""
    known = per_process("bag_words", lambda: Bounded(word_hash))
    out = []
    for text in texts:
        parts = text.encode("utf-8", "replace").split()
        h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        h = h[h > 0]
        if not len(h):
            out.append(h)
            continue
        size = min(words, len(h))
        total = np.full(len(h) - size + 1, size, np.uint64)
        for k in range(size):
            total = (total + h[k : len(h) - size + 1 + k]) * _GOLD
            total ^= total >> np.uint64(29)
        out.append(mix(total) >> np.uint64(16))
    return out


def multisets(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, shingle, multiplicity) of all texts, by owner and shingle."""
    owner = np.repeat(np.arange(len(hashes), dtype=np.uint64), [len(h) for h in hashes])
    key = np.sort((owner << np.uint64(48)) | np.concatenate(hashes)) if len(owner) else owner
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count


def bag_minhash(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Earliest arrival per text and register; rows of texts without a shingle stay infinite."""
    best = np.full((n, registers), np.inf)
    total = np.bincount(owner, weight, n)
    open_ = total > 0
    limit = (math.log(registers) + 5) / np.maximum(total, 1)
    while open_.any():
        use = open_[owner]
        _arrivals(owner[use], shingle[use], weight[use], limit, best)
        # A register that nothing fell on in time: look further, for that text alone.
        open_ &= np.isinf(best).any(1)
        best[open_] = np.inf
        limit = np.where(open_, limit * 2, limit)
    return best


def _arrivals(owner, shingle, weight, limit, best) -> None:
    registers = best.shape[1]
    flat = best.reshape(-1)
    low, width, level = 0, 1, 0
    while True:
        use = weight > low
        if not use.any():
            return
        who, seed, w = owner[use], mix(shingle[use] + _nth(level)), weight[use]
        # Most shingles of a long text have no point in time: told by the draw itself, before any logarithm.
        draw = mix(seed + _nth(1))
        late = np.exp(-limit * (registers * width) * 1.000001) * 2.0**53 - 1
        soon = (draw >> np.uint64(11)).astype(np.float64) >= late[who]
        who, seed, w, draw = who[soon], seed[soon], w[soon], draw[soon]
        time, end, step = np.zeros(len(who)), limit[who], 1
        while len(who):
            if step > 1:
                draw = mix(seed + _nth(step))
            step += 1
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * width)
            keep = time <= end
            who, seed, w, time, end = who[keep], seed[keep], w[keep], time[keep], end[keep]
            spot = mix(draw[keep] ^ _GOLD)
            counts = low + 1 + (spot >> np.uint64(32)).astype(np.int64) % width <= w
            place = who * registers + ((spot & np.uint64(0xFFFFFFFF)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat, place[counts], time[counts])
        low, width, level = low + width, max(1, low + width), level + 1


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    parts = signature.astype(np.uint64).reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) + np.uint64(1), parts.shape[:2])
    for k in range(parts.shape[2]):
        key = mix(key * _GOLD + parts[:, :, k])
    return key


def by_chunk(docs: DataFrame, describe: Callable[[list, list[str]], pa.RecordBatch], schema: str, chunk_chars: int = 1 << 20) -> DataFrame:
    """`describe` over (doc_id, text) in chunks of about `chunk_chars` characters; null texts come as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= chunk_chars or len(texts) >= 2048:
                    yield describe(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield describe(ids, texts)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def digests(texts: list[str]) -> pa.Array:
    return pa.array([hashlib.md5(t.encode("utf-8", "replace")).digest() for t in texts], pa.binary())


def sketches(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """Number of shingles and signature of every document in one narrow pass; `node` is the digest of its text."""

    def describe(ids: list, texts: list[str]) -> pa.RecordBatch:
        hashes = shingle_hashes(texts, scheme.words)
        best = bag_minhash(*multisets(hashes), len(texts), scheme.registers)
        registers = (mix(best.view(np.uint64)) >> np.uint64(32)).astype("<u4")
        counts = pa.array([len(h) for h in hashes], pa.int64())
        signs = pa.array([r.tobytes() for r in registers], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), digests(texts), counts, signs], [f.split()[0] for f in SKETCH.split(", ")])

    return by_chunk(docs, describe, SKETCH)


def bags(docs: DataFrame, wanted: DataFrame, scheme: Scheme) -> DataFrame:
    """The multisets of the wanted texts (node, first: digest and one id), written as all hashes, then all multiplicities.

    Only these texts cross the network, and only once; the join filters them before Python reads them.
    """

    def describe(ids: list, texts: list[str]) -> pa.RecordBatch:
        hashes = shingle_hashes(texts, scheme.words)
        owner, shingle, weight = multisets(hashes)
        keys, counts = shingle.astype("<u8"), weight.astype("<u4")
        cut = np.searchsorted(owner, np.arange(len(texts) + 1))
        found = [keys[i:j].tobytes() + counts[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)]
        return pa.RecordBatch.from_arrays([digests(texts), pa.array(found, pa.binary())], ["node", "bag"])

    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", digest.alias("digest"))
    same = (F.col("digest") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("first"))
    return staged(by_chunk(rows.join(wanted, same, "left_semi"), describe, BAG).dropDuplicates(["node"]), "bags")


# --- links ---------------------------------------------------------------------------------------


def overlap(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two multisets, written as all hashes and then all multiplicities."""
    m, n = len(a) // 12, len(b) // 12
    x, y = np.frombuffer(a, "<u8", m), np.frombuffer(b, "<u8", n)
    p, q = np.frombuffer(a, "<u4", m, 8 * m).astype(np.int64), np.frombuffer(b, "<u4", n, 8 * n).astype(np.int64)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = int(np.minimum(p[i], q[j]).sum())
    total = int(p.sum()) + int(q.sum()) - shared
    return shared / total if total else 0.0


def promising(pairs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose signatures agree in enough registers."""
    one = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("sign_a"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("sign_b"))
    both = pairs.join(one, "a").join(two, "b").filter(F.least("n_a", "n_b") >= scheme.similarity * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in ("sign_a", "sign_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= scheme.near if batch.num_rows else [], pa.bool_()))

    return both.select("a", "b", "sign_a", "sign_b").mapInArrow(run, PAIR)


def verified(pairs: DataFrame, multisets_: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough; a text that is in many pairs is a skewed key that AQE splits."""
    one = multisets_.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    two = multisets_.select(F.col("node").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "bag_a", "bag_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_ = zip(batch.column("bag_a"), batch.column("bag_b"), strict=True)
            near = [overlap(x.as_py(), y.as_py()) >= scheme.similarity for x, y in pairs_]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return staged(both.mapInArrow(run, PAIR), "links")


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def blocks(rows: DataFrame, scheme: Scheme) -> DataFrame:
    """Verified links between texts of one bucket that lie in different components, as edges that span them.

    `rows` has key, node, component, signature and bag. A bucket is cut into blocks of about `block` texts and each pair
    of blocks is a group of its own, so no group grows with the bucket. Pairs are tried inside the task, those that
    agree in most registers first: once two components are joined, their other pairs need not be tried, and pairs
    that are not linked never leave it. A pair that shares several buckets is tried in that of its first shared band.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / scheme.block).cast("int").alias("parts"))
    cut = rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "signature", "bag"
    )

    def compare(table: pa.Table) -> pa.Table:
        key = np.int64(table.column("key")[0].as_py()).astype(np.uint64)
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        nodes, bags_ = table.column("node").to_pylist(), table.column("bag").to_pylist()
        group = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(len(nodes), -1)
        bands = band_keys(sign, scheme.bands)
        left = np.flatnonzero(own == i[0])
        right = left if i[0] == j[0] else np.flatnonzero(own == j[0])
        tries = []
        for x in left:
            near = right[group[right] != group[x]]
            near = near[near > x] if i[0] == j[0] else near
            agree = (sign[near] == sign[x]).mean(1)
            near, agree = near[agree >= scheme.near], agree[agree >= scheme.near]
            first = (bands[near] == bands[x]).argmax(1)
            here = bands[x][first] == key
            tries += zip((-agree[here]).tolist(), [int(x)] * int(here.sum()), near[here].tolist(), strict=True)
        parent = list(range(int(group.max()) + 1))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        edges = []
        for _, x, y in sorted(tries):
            p, q = root(group[x]), root(group[y])
            if p != q and overlap(bags_[x], bags_[y]) >= scheme.similarity:
                parent[p] = q
                edges.append((nodes[x], nodes[y]))
        return pa.table({"a": pa.array([a for a, _ in edges], pa.binary()), "b": pa.array([b for _, b in edges], pa.binary())})

    return staged(dealt.groupBy("key", "i", "j").applyInArrow(compare, PAIR), "links")


def linked(docs: DataFrame, sketched: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """(node, component) of the texts that are linked to another; `sketched` is a written table of sketches of `docs`.

    Rounds of stars compare the members of each bucket with one of them; members of one component need no further link.
    Buckets that still hold several components are then compared in blocks, so no link between them is lost.
    """
    # Any row of a class serves, since n and signature depend on the text alone; `first` names one.
    alike = sketched.filter("n > 0").groupBy("node")
    each = alike.agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("signature").alias("signature"))
    classes = staged(each, "classes")
    bands = scheme.bands

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sign = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(batch.num_rows, -1)
            values = band_keys(sign, bands).astype(np.int64).reshape(-1) if batch.num_rows else np.zeros(0, np.int64)
            at = np.repeat(np.arange(batch.num_rows), bands)
            yield pa.RecordBatch.from_arrays([pa.array(values), batch.column("node").take(pa.array(at))], ["key", "node"])

    keyed = classes.select("node", "signature").mapInArrow(keys, "key bigint, node binary")
    shared = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    left = staged(keyed.join(shared, "key", "left_semi"), "buckets").withColumn("component", F.col("node"))
    wanted = left.select("node").distinct().join(classes.select("node", "first"), "node")
    known = bags(docs, wanted, scheme)
    tested = found = None
    for round_ in range(scheme.stars + 1):
        # Each bucket has a star of its own, so a text meets as many different ones as it has bands.
        rank = F.struct(F.xxhash64("node", "key", F.lit(round_)).alias("r"), "node", "component")
        groups = left.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min(rank).alias("star"))
        apart = staged(left.join(groups.filter("lo <> hi").drop("lo", "hi"), "key"), "apart")
        if not apart.take(1):
            break
        if round_ < scheme.stars:
            star = apart.filter("component <> star.component")
            pairs = star.select(*ordered(F.col("node"), F.col("star.node"))).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = staged(promising(pairs, classes, scheme), "pairs")
            new = verified(pairs, known, scheme)
            tested = pairs if tested is None else tested.unionByName(pairs)
        else:
            new = blocks(apart.drop("star").join(classes.select("node", "signature"), "node").join(known, "node"), scheme)
        if not new.take(1):
            left = apart.drop("star")
            continue
        # The components so far are stars, which stand for all links before.
        links = new if found is None else new.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = components(links, "near")
        left = apart.drop("star", "component").join(found, "node", "left")
        left = left.withColumn("component", F.coalesce("component", "node"))
    if found is None:
        return classes.select("node", F.col("node").alias("component")).limit(0)
    return found


def groups(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """doc_id, class_id, group_id, kept of every row, with the digest of its text.

    class_id is the smallest doc_id with the same text, group_id the smallest one of the near-duplicates; kept marks the
    row of that id (all rows of it, if the very same row comes several times).
    """
    sketched = staged(sketches(docs, scheme), "sketches")
    found = linked(docs, sketched, scheme)
    rows = sketched.select("doc_id", "node")
    classes = rows.groupBy("node").agg(F.min("doc_id").alias("class_id"))
    placed = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    firsts = placed.groupBy("component").agg(F.min(F.struct(F.col("class_id").isNull(), "class_id", "node")).alias("first"))
    known = placed.join(firsts, "component").select("node", "class_id", F.col("first.class_id").alias("group_id"), F.col("first.node").alias("group_node"))
    both = rows.join(staged(known, "groups"), "node")
    return both.select(
        "doc_id",
        "class_id",
        "group_id",
        ((F.col("node") == F.col("group_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
        "node",
    )


def first_of_groups(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """The documents with one of each group left, with their own columns.

    Rows that go are matched by id and text. Of a kept row that comes several times one is left.
    """
    found = staged(groups(docs, scheme), "kept")
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).distinct()
    words = found.filter("kept").groupBy("doc_id", "node").agg(F.count("*").alias("c")).filter("c > 1")
    again = words.select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    rows = docs.select(F.struct("*").alias("row"), F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("node"))
    same = F.col("row.doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("node") == F.col("_node"))
    once = rows.join(gone, same, "left_anti")
    gone_or_again = gone.unionByName(again).distinct()
    single = rows.join(gone_or_again, same, "left_anti")
    if not again.take(1):
        return once.select("row.*")
    repeated = rows.join(again, same, "left_semi").dropDuplicates(["row", "node"])
    return single.unionByName(repeated).select("row.*")
