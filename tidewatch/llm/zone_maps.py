"""Centroid clustering over zone maps: blocks of vectors in Hilbert order, each with the box that holds it.

`cluster(vectors)` takes (vec_id, embedding) and gives every kept vector its cluster and squared distance. Components
become whole numbers, so sums, centroids and distances are exact and do not depend on the order of the rows.

Vectors are put in the order of a Hilbert curve through all dimensions and written once in blocks with their smallest and
largest components and their sums. In a round, a centroid is a candidate of a block unless another one is nearer to all
of its box: the difference of two squared distances is linear, so its largest value over a box is exact. A block with one
candidate adds its stored sums, the others compare every vector with the candidates. Centroids are `k` rows on the driver.

Left out are vectors that are null, hold null or non-finite entries, or have another width. Repeated rows count as vectors
each and may lie in different partitions; a null vec_id comes last among the first centroids and is kept; equal ids are
told apart by their components; fewer vectors than centroids give fewer centroids, and an empty table gives an empty one.
Other columns are left behind. Components of 2^26 and more (65,536 before scaling) would overflow a distance and raise
an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import staged
from tidewatch.llm.dense import binary, matrix, of_width


@dataclass(frozen=True)
class Plan:
    """`block` bounds the vectors under one box; `bits` is the depth of the curve in each dimension."""

    k: int = 8
    rounds: int = 10
    width: int = 64
    scale: int = 1024
    seed: str = "3"
    block: int = 256
    bits: int = 4


#: Beyond it a squared distance of 64 components might not fit 64 bits.
LARGEST = 1 << 26

#: Sums of products below it are exact in double precision.
EXACT = 1 << 53

KEPT = "vec_id bigint, x binary"
BLOCK = "n int, ids array<bigint>, x binary, lo binary, hi binary, sums binary"
TOTAL = "cluster int, dim int, total bigint, n bigint"
ASSIGNED = "vec_id bigint, cluster int, distance bigint"


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    x = np.floor(values * scale)
    if x.size and np.abs(x).max() >= LARGEST:
        raise OverflowError(f"a component is {LARGEST} or more after scaling")
    return x.astype(np.int32)


def kept(vectors: DataFrame, plan: Plan) -> DataFrame:
    """(vec_id, x): usable vectors as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = of_width(batch.column("embedding"), plan.width)
            ids = batch.column("vec_id").take(pa.array(places))
            yield pa.RecordBatch.from_arrays([ids, binary(whole_numbers(values, plan.scale))], ["vec_id", "x"])

    return vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(run, KEPT)


# --- order along the curve -----------------------------------------------------------------------


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of small whole numbers along a Hilbert curve, as bytes that sort like it.

    Follows Skilling, "Programming the Hilbert curve" (2004): undo the excess turns from the highest bit down, Gray-code
    across the dimensions, then read the bits of all dimensions from the highest down.
    """
    x = cells.astype(np.uint32).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(dims):
            turned = (x[i] & np.uint32(q)) != 0
            swap = np.where(turned, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def extent(rows: DataFrame, plan: Plan) -> tuple[np.ndarray, np.ndarray] | None:
    """Smallest and largest value of every dimension; one row per dimension and task is combined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [matrix(b.column("x"), "<i4", plan.width) for b in batches]
        found = [np.stack([m.min(0), m.max(0)]) for m in found if len(m)]
        if found:
            lo, hi = np.min([f[0] for f in found], axis=0), np.max([f[1] for f in found], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(plan.width), pa.int32()), pa.array(lo), pa.array(hi)], ["dim", "lo", "hi"])

    ends = rows.select("x").mapInArrow(run, "dim int, lo int, hi int").groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    got = sorted(ends.collect())
    return (np.array([r["lo"] for r in got]), np.array([r["hi"] for r in got])) if got else None


def blocks(rows: DataFrame, plan: Plan) -> DataFrame | None:
    """Vectors in Hilbert order, `plan.block` to a row with their box and sums; None if there are no vectors.

    Rows that agree in everything are told apart by their number in the scan, so copies spread over partitions.
    """
    ends = extent(rows, plan)
    if ends is None:
        return None
    lo, span = ends[0].astype(np.int64), np.maximum(ends[1].astype(np.int64) - ends[0] + 1, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), "<i4", plan.width)
            keys = binary(hilbert(((x - lo) << plan.bits) // span, plan.bits))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], ["vec_id", "x", "row", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), "<i4", plan.width)
            starts = range(0, len(x), plan.block)
            parts = [x[s : s + plan.block] for s in starts]
            ids = [batch.column("vec_id").slice(s, plan.block).to_pylist() for s in starts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(map(len, parts), pa.int32()),
                    pa.array(ids, pa.list_(pa.int64())),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                    pa.array([p.min(0).tobytes() for p in parts], pa.binary()),
                    pa.array([p.max(0).tobytes() for p in parts], pa.binary()),
                    pa.array([p.sum(0, dtype=np.int64).tobytes() for p in parts], pa.binary()),
                ],
                ["n", "ids", "x", "lo", "hi", "sums"],
            )

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    placed = numbered.mapInArrow(place, f"{KEPT}, row bigint, key binary")
    order = ["key", "vec_id", "row"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(ordered.select("vec_id", "x").mapInArrow(cut, BLOCK), "zones")


# --- rounds --------------------------------------------------------------------------------------


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that are nearest to some point of a box, as far as the box can tell.

    |x-a|^2 - |x-b|^2 = |a|^2 - |b|^2 - 2x(a-b) is largest where each component of x lies on one end of the box. If it is
    below 0 there, b is never the nearest; at 0, b loses to an a with a smaller number.
    """
    step = centroids[:, None, :] - centroids[None, :, :]
    size = (centroids * centroids).sum(1)
    most = size[:, None] - size[None, :] - 2 * np.minimum(step * lo, step * hi).sum(2)
    k = len(centroids)
    beaten = (most < 0) | ((most == 0) & (np.arange(k)[:, None] < np.arange(k)[None, :]))
    return np.flatnonzero(~beaten.any(0))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smallest of equals, and the squared distance; all exact."""
    size = (centroids * centroids).sum(1)
    bound = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if 4 * int(bound) ** 2 * x.shape[1] < EXACT:
        score = size - 2.0 * (x.astype(np.float64) @ centroids.T.astype(np.float64))
    else:
        score = size - 2 * (x.astype(np.int64) @ centroids.T)
    of = score.argmin(1)
    gap = x.astype(np.int64) - centroids[of]
    return of, (gap * gap).sum(1)


def _walk(batches: Iterator[pa.RecordBatch], plan: Plan, centroids: np.ndarray):
    """(ids, x, candidates, sums) of every block."""
    for batch in batches:
        for n, ids, x, lo, hi, sums in zip(*[batch.column(c) for c in ("n", "ids", "x", "lo", "hi", "sums")]):
            box = [np.frombuffer(v.as_py(), "<i4").astype(np.int64) for v in (lo, hi)]
            yield ids.values, x, candidates(*box, centroids), np.frombuffer(sums.as_py(), "<i8"), n.as_py()


def totals(zones: DataFrame, plan: Plan, centroids: np.ndarray) -> list:
    """(cluster, dim, total, n) rows: exact sums of the vectors nearest to each centroid, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for _, x, near, sums, rows in _walk(batches, plan, centroids):
            if len(near) == 1:
                total[near[0]] += sums
                n[near[0]] += rows
                continue
            values = np.frombuffer(x.as_py(), "<i4").reshape(-1, plan.width)
            of = near[nearest(values, centroids[near])[0]]
            for c in np.unique(of).tolist():
                total[c] += values[of == c].sum(0, dtype=np.int64)
            n += np.bincount(of, minlength=len(n))
        cluster, dim = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster.ravel(), pa.int32()), pa.array(dim.ravel(), pa.int32()), pa.array(total.ravel()), pa.array(n[cluster.ravel()])],
            ["cluster", "dim", "total", "n"],
        )

    parts = zones.mapInArrow(run, TOTAL)
    return parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()


def moved(centroids: np.ndarray, sums: list) -> np.ndarray:
    """The floor of the mean of each cluster and dimension; empty clusters stay where they are."""
    after = centroids.copy()
    for row in sums:
        if row["n"]:
            after[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return after


def assigned(zones: DataFrame, plan: Plan, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, near, _, _ in _walk(batches, plan, centroids):
            of, distance = nearest(np.frombuffer(x.as_py(), "<i4").reshape(-1, plan.width), centroids[near])
            yield pa.RecordBatch.from_arrays([ids, pa.array(near[of], pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return zones.mapInArrow(run, ASSIGNED)


def seeds(rows: DataFrame, plan: Plan) -> np.ndarray:
    """The vectors with the smallest digest of `seed:vec_id`; a top-k of each task, then of those."""
    digest = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "x").limit(plan.k).collect()
    return np.array([np.frombuffer(bytes(r["x"]), "<i4") for r in first], np.int64).reshape(-1, plan.width)


def digest_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def fit(vectors: DataFrame, plan: Plan = Plan()) -> tuple[DataFrame, np.ndarray] | None:
    """The zone maps of the vectors and the final centroids; None if no vector can be used."""
    rows = kept(vectors, plan)
    zones = blocks(rows, plan)
    if zones is None:
        return None
    centroids = seeds(rows, plan)
    for _ in range(plan.rounds):
        centroids = moved(centroids, totals(zones, plan, centroids))
    return zones, centroids


def cluster(vectors: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Every kept vector with its cluster, squared distance, the sums of distances and the digest of its centroid."""
    fitted = fit(vectors, plan)
    columns = f"{ASSIGNED}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], columns)
    zones, centroids = fitted
    rows = assigned(zones, plan, centroids)
    spread = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    own = {r["cluster"]: int(r["d"]) for r in spread}
    one_of = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        one_of([own.get(c, 0) for c in range(len(centroids))], "bigint").alias("cluster_inertia"),
        F.lit(sum(own.values())).cast("bigint").alias("inertia"),
        one_of(map(digest_of, centroids), "string").alias("centroid_sha256"),
    )
