"""Whitening of vectors by polarisation: covariances from variances of dimensions and of sums of two dimensions.

`whiten(vectors)` takes (vec_id, embedding) and gives every usable vector its exact squared deviation from the mean and
its whitened components. Entries c become whole numbers floor(64*c)+1000000. For each dimension i and each pair i<j the
exact sum of squares of the centred x_i and of the centred x_i+x_j is aggregated; then
cov(i, j) = (var(i+j) - var(i) - var(j)) / 2. Centring is exact: values are taken against the floor of the mean, which is
whole and near them, and what the floor left over is subtracted from the sums of squares at the end in whole numbers.

Passes over the vectors: width, sums, squares, check, output. Each adds up in its task first; what comes to the
driver is one number per pair of dimensions, however many rows there are, and nothing is shuffled but those.

Left out are vectors that are null or empty, hold null or non-finite entries, or differ in width from the most frequent
one (of equals the larger): no covariance exists across widths. Repeated rows count each; a null vec_id is kept; other
columns are left behind. Components whose variance is rounding only (fewer vectors than dimensions, constant
dimensions, a single vector) have no whitened value and are left out; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.dense import by_width, of_width

SCALE, SHIFT = 64, 1_000_000

#: Whole numbers of this size or more would lose digits on the way through double precision.
LARGEST = 1 << 40

#: Squares of sums of two centred values are added in 64 bits while they stay below it.
ROOM = 1 << 62

WHITE = "vec_id bigint, deviation decimal(38,0), whitened array<double>"


@dataclass(frozen=True)
class Whitening:
    """What was fitted: `components` has a unit vector per column, by falling `variance`."""

    n: int
    sums: list[int]
    mean_floor: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variance: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.variance / self.trace


def whole_numbers(values: np.ndarray) -> np.ndarray:
    x = np.floor(values * SCALE)
    if x.size and np.abs(x).max() >= LARGEST:
        raise OverflowError(f"a component is {LARGEST} or more after scaling")
    return x.astype(np.int64) + SHIFT


def usual_width(vectors: DataFrame) -> int | None:
    """The most frequent width of usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for width, places, _ in by_width(batch.column("embedding")):
                seen[width] = seen.get(width, 0) + len(places)
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int32()), pa.array(seen.values(), pa.int64())], ["width", "n"])

    counted = vectors.select("embedding").mapInArrow(run, "width int, n bigint").groupBy("width").agg(F.sum("n").alias("n"))
    first = counted.filter("n > 0").orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    return first[0]["width"] if first else None


def added(vectors: DataFrame, width: int, places: int, part) -> list[int]:
    """Sums over all vectors of the `places` whole numbers that `part` gives for a matrix; exact at any number of rows.

    Each task gives one row per place and starts a new one before 64 bits would overflow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, np.int64)
        for batch in batches:
            x = whole_numbers(of_width(batch.column("embedding"), width)[1])
            for step in part(x):
                if int(np.abs(total).max(initial=0)) + int(np.abs(step).max(initial=0)) >= ROOM:
                    yield _rows(total)
                    total = np.zeros(places, np.int64)
                total = total + step
        yield _rows(total)

    parts = vectors.select("embedding").mapInArrow(run, "place int, total bigint")
    got = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    out = [0] * places
    for row in got:
        out[row["place"]] = int(row["total"])
    return out


def _rows(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "total"])


def sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""

    def part(x: np.ndarray) -> Iterator[np.ndarray]:
        yield np.append(x.sum(0), len(x))

    *per_dimension, n = added(vectors, width, width + 1, part)
    return n, per_dimension


def squares(vectors: DataFrame, width: int, mean_floor: np.ndarray) -> list[int]:
    """Sums of squares of every centred dimension, then of the sum of every two: (0,1), (0,2), ..., (1,2), ..."""

    def part(x: np.ndarray) -> Iterator[np.ndarray]:
        z = x - mean_floor
        most = max(2 * int(np.abs(z).max(initial=0)), 1)
        rows = max(1, ROOM // (most * most))
        if most * most >= ROOM:
            raise OverflowError("the square of a centred value does not fit 64 bits")
        for start in range(0, len(z), min(rows, 4096)):
            some = np.ascontiguousarray(z[start : start + min(rows, 4096)].T)
            out = [np.einsum("ij,ij->i", some, some)]
            for i in range(width - 1):
                pair = some[i + 1 :] + some[i]
                out.append(np.einsum("ij,ij->i", pair, pair))
            yield np.concatenate(out)

    return added(vectors, width, width * (width + 1) // 2, part)


def covariance(n: int, rest: list[int], squared: list[int]) -> np.ndarray:
    """The covariance matrix, each entry rounded once.

    `rest` has the sums of the centred dimensions (below n each): n * variance = sum of squares - rest^2 / n.
    """
    d = len(rest)
    own = [n * q - r * r for q, r in zip(squared, rest)]
    v = np.zeros((d, d))
    pairs = iter(squared[d:])
    for i in range(d):
        v[i, i] = own[i] / (n * n)
        for j in range(i + 1, d):
            together = n * next(pairs) - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = (together - own[i] - own[j]) / (2 * n * n)
    return v


def fit(vectors: DataFrame, components: int = 32) -> Whitening | None:
    """Mean, components and variances of all usable vectors; None if there are none."""
    width = usual_width(vectors)
    if width is None:
        return None
    n, total = sums(vectors, width)
    floor = [s // n for s in total]
    rest = [s - n * f for s, f in zip(total, floor)]
    v = covariance(n, rest, squares(vectors, width, np.array(floor, np.int64)))
    variance, basis = np.linalg.eigh(v)
    order = np.argsort(-variance, kind="stable")[:components]
    trace = float(np.trace(v))
    order = order[variance[order] > width * np.finfo(float).eps * max(trace, 0.0)]
    basis = basis[:, order]
    # The largest entry of a component is positive, so every run gives the same sign.
    basis = basis * np.sign(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])]) if len(order) else basis
    return Whitening(n, total, np.array(floor, np.int64), np.array(rest, np.int64), basis, variance[order], trace)


def _white(x: np.ndarray, fitted: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Centred whole numbers and the whitened components."""
    z = x - fitted.mean_floor
    centred = z - fitted.rest / fitted.n
    return z, centred @ fitted.components / np.sqrt(fitted.variance)


def _deviations(z: np.ndarray, fitted: Whitening) -> list[int]:
    """Sum of (n*x - S)^2 over the dimensions: n*x - S is n*z - rest, both whole."""
    n, rest = fitted.n, fitted.rest
    reach = int(np.abs(z).max(initial=0)) * n + int(rest.max(initial=0))
    if reach * reach * max(z.shape[1], 1) < ROOM:
        gap = z * n - rest
        return (gap * gap).sum(1).tolist()
    gap = z.astype(object) * n - rest.astype(object)
    return (gap * gap).sum(1).tolist()


def whitened(vectors: DataFrame, fitted: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every usable vector."""
    width = len(fitted.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.decimal128(38, 0)
        for batch in batches:
            places, values = of_width(batch.column("embedding"), width)
            z, white = _white(whole_numbers(values), fitted)
            ends = pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(places)),
                    pa.array(list(map(Decimal, _deviations(z, fitted))), kind),
                    pa.ListArray.from_arrays(ends, pa.array(white.ravel())),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    return vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(run, WHITE)


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors less the identity, measured over all of them."""
    width, k = len(fitted.sums), fitted.components.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            white = _white(whole_numbers(of_width(batch.column("embedding"), width)[1]), fitted)[1]
            products += white.T @ white
            total += white.sum(0)
        flat = np.concatenate([products.ravel(), total])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["place", "total"])

    parts = vectors.select("embedding").mapInArrow(run, "place int, total double")
    got = parts.groupBy("place").agg(F.sum("total").alias("total")).collect()
    flat = np.zeros(k * k + k)
    for row in got:
        flat[row["place"]] = row["total"]
    mean = flat[k * k :] / fitted.n
    measured = flat[: k * k].reshape(k, k) / fitted.n - np.outer(mean, mean)
    return float(np.abs(measured - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 32) -> DataFrame:
    """Every usable vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    fitted = fit(vectors, components)
    columns = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.variance):
        return vectors.sparkSession.createDataFrame([], columns)
    error = identity_error(vectors, fitted)
    share = F.element_at(F.array(*[F.lit(float(e)) for e in fitted.explained]), F.col("component"))
    return (
        whitened(vectors, fitted)
        .select("vec_id", "deviation", F.posexplode("whitened").alias("_place", "whitened"))
        .select("vec_id", (F.col("_place") + 1).alias("component"), "deviation", "whitened")
        .select(
            "vec_id",
            "component",
            F.lit(fitted.n).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            share.alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
