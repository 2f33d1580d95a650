"""Document fingerprints from closed syncmers.

A k-mer of characters is an anchor if the least hash of its inner s-mers lies at its first or last place. Whether it is
depends on nothing but its own characters, so an edit changes the anchors it touches and no others. A fingerprint
holds all anchors, by hash, each with its place in the text, so it grows with the text; two fingerprints are compared by
the anchors that they share at one common shift.

A null text is taken as empty. An empty text has the empty fingerprint; a text without an anchor has its own hash as
its only one. Two empty fingerprints are alike (1), an empty and a filled one are not (0). Null ids come last in
order; rows of one id are ordered by text; repeated rows are kept; columns besides doc_id and text are left behind;
an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, S = 24, 8

SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def anchors(texts: list[str], limit: int | None = None) -> list[np.ndarray]:
    """For each text its anchors (hash, place) as a 2-column array, by hash; all of them, or the `limit` least ones."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found: list[np.ndarray | None] = [None] * len(texts)
    if len(codes) >= K:
        h = _mix(codes + np.uint64(1))
        for step in (1, 2, 4):
            h = h[:-step] * _power(step) + h[step:]
        inner = _mix(h)
        long = h[: -(K - S)] * _power(2 * S) + h[S : -(K - 2 * S)] * _power(S) + h[2 * S :]
        least = inner
        for step in (1, 2, 4, 8, 1):
            least = np.minimum(least[:-step], least[step:])
        chosen = np.flatnonzero((inner[: len(least)] == least) | (inner[K - S :] == least))
        owner = np.searchsorted(ends, chosen, "right")
        inside = chosen + K <= ends[owner]
        chosen, owner = chosen[inside], owner[inside]
        key = _mix(long[chosen]) >> np.uint64(32)
        place = (chosen - (ends - sizes)[owner]).astype(np.uint64)
        order = np.argsort((owner.astype(np.uint64) << np.uint64(32)) | key, kind="stable")
        key, place, owner = key[order], place[order], owner[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        pairs, owner = np.stack([key[first], place[first]], 1), owner[first]
        low, high = np.searchsorted(owner, np.arange(len(texts))), np.searchsorted(owner, np.arange(len(texts)), "right")
        for i in np.flatnonzero(high > low):
            found[i] = pairs[low[i] : high[i]][:limit]
    for i, text in enumerate(texts):
        if found[i] is None:
            whole = [[int(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16), 0]] if text else []
            found[i] = np.array(whole, np.uint64).reshape(-1, 2)
    return found


def as_text(print_: np.ndarray) -> str:
    """Eight hexadecimal digits of hash and eight of place per anchor."""
    return print_.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both texts that both have, at the shift that most shared ones agree on."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, i, j = np.intersect1d(a[:, 0], b[:, 0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    shift = a[i, 1].astype(np.int64) - b[j, 1].astype(np.int64)
    shared = np.count_nonzero(np.abs(shift - np.median(shift)) <= K)
    return shared / (len(a) + len(b) - len(i))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket, guest) in which a document is followed by its successor once a bucket is sorted.

    Buckets are ranges of doc_id, about four times the square root of the number of rows, cut at quantiles. The first document
    of a bucket is also a guest at the end of the bucket before, the very first at the end of the last one.
    """
    slim = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    ids = slim.select(F.col("doc_id").cast("double").alias("order"))
    wanted = 4 * math.isqrt(ids.count()) + 1
    cuts = ids.approxQuantile("order", [k / wanted for k in range(1, wanted)], 0.2 / wanted) if wanted > 1 else []
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) > 2:
        ranged = Bucketizer(splits=splits, inputCol="order", outputCol="range", handleInvalid="keep")
        rows = ranged.transform(slim.withColumn("order", F.col("doc_id").cast("double")))
        rows = rows.select("doc_id", "text", F.coalesce("range", F.lit(float(len(splits)))).alias("bucket"))
    else:
        rows = slim.withColumn("bucket", F.lit(0.0))
    # One row per bucket: its least id, null only where it has no other, and the bucket before it.
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("least"))
    order = Window.orderBy("bucket")
    last = F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    hosts = firsts.select("bucket", "least", F.coalesce(F.lag("bucket").over(order), last).alias("host"))
    joined = rows.join(F.broadcast(hosts), "bucket").filter(F.col("doc_id").eqNullSafe(F.col("least")))
    one = joined.withColumn("text_id", F.sha2("text", 256))
    least = one.groupBy("bucket", "doc_id", "host").agg(F.min(F.struct("text_id", "text")).alias("m"))
    guests = least.select("doc_id", "m.text", F.col("host").alias("bucket"), F.lit(1).alias("guest"))
    return rows.withColumn("guest", F.lit(0)).unionByName(guests)


def fingerprints(docs: DataFrame, chunk_chars: int = 1 << 19) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next text's are.

    The text crosses the network once; a worker holds about `chunk_chars` characters at a time.
    """
    sorted_rows = (
        with_next(docs)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), F.sha2("text", 256))
        .select("bucket", "guest", "doc_id", "text")
    )

    def described(rows: list[tuple]) -> pa.RecordBatch:
        """`rows` follow each other in one bucket; the last one only serves as next."""
        own = [text for _, text in rows]
        edited = []
        for (_, text), (_, after) in zip(rows, rows[1:], strict=False):
            part = len(text) // 4
            edited.append(text[: len(text) - part] + after[:part])
        found = anchors(own + edited)
        prints, changed = found[: len(own)], found[len(own) :]
        columns = [
            pa.array([i for i, _ in rows[:-1]], pa.int64()),
            pa.array([len(t) for t in own[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([as_text(p) for p in prints[:-1]], pa.string()),
            pa.array([as_text(p) for p in changed], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(prints[:-1], changed, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(prints, prints[1:], strict=False)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bucket, size = None, 0
        for batch in batches:
            for b, guest, doc_id, text in zip(*(batch.column(i) for i in range(4)), strict=True):
                b, text = b.as_py(), text.as_py()
                if b != bucket:
                    held, bucket, size = [], b, 0
                held.append((doc_id.as_py(), text))
                size += len(text)
                if (guest.as_py() or size >= chunk_chars) and len(held) > 1:
                    yield described(held)
                    held, size = held[-1:], len(text)

    return sorted_rows.mapInArrow(run, SCHEMA)
