"""Concatenate and cut: all documents end to end, cut into sequences of a fixed number of ids.

Ids and token totals are written once, by input partition (pass one); prefix sums over the totals of the partitions give
each document its place in the whole (pass two); the fixed windows follow from the place, and a document that crosses
a border gets one boundary record (piece) per window. All sequences but the last are full.

A null text is taken as empty and packs as the end id alone; repeated rows are packed once each; a null doc_id is
kept; columns besides doc_id and text are not carried along, so their names cannot clash; an empty table gives no
pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from struct import pack

import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import PATTERN, byte_letters
from tidewatch.llm.common import Bounded, offsets, per_process, read_local, staged

ENCODED = "doc_id bigint, part int, before bigint, doc_tokens bigint, ids binary"

_WIDE = re.compile(r"\s ")


class Encoder:
    """Ids of the library for a byte-level vocabulary, as little-endian unsigned 32-bit bytes.

    Words between spaces that follow no white space don't influence each other and are remembered.
    """

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(of_letter[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.word = Bounded(lambda word: self.ids_of(" " + word))

    def ids_of(self, text: str) -> bytes:
        ids = self.bpe.encode_ordinary(text)
        return pack(f"<{len(ids)}I", *ids)

    def plain(self, text: str) -> bytes:
        if _WIDE.search(text):
            return self.ids_of(text)
        first, *rest = text.split(" ")
        return self.ids_of(first) + b"".join(map(self.word.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return self.plain(text)
        parts = (p for p in self.cut.split(text) if p)
        return b"".join(pack("<I", self.special[p]) if p in self.special else self.plain(p) for p in parts)


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Ids of every document with its end id, its partition and the ids before it there; written once."""
    content = docs.sparkSession.sparkContext.broadcast(read_local(vocabulary))
    end = pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = f"pack_{hashlib.sha1(content.value.encode()).hexdigest()}"
        encoder = per_process(key, lambda: Encoder(content.value))
        part, total = TaskContext.get().partitionId(), 0
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                ids = [encoder.encode(text.as_py() or "") + end for text in batch.column("text")]
                counts = [len(x) // 4 for x in ids]
                before = []
                for n in counts:
                    before.append(total)
                    total += n
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([part] * len(ids), pa.int32()),
                        pa.array(before, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "part", "before", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ENCODED)
    return staged(rows, "packing")


def placed(rows: DataFrame) -> DataFrame:
    """`rows` with `place`, the number of ids before the document in the whole.

    The table of totals has one row per input partition, a few MB for a million partitions, and is broadcast.
    """
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    starts = offsets(totals, "part", "total")
    return rows.join(F.broadcast(starts), "part").withColumn("place", F.col("before") + F.col("offset"))


def cut(rows: DataFrame, length: int) -> DataFrame:
    """One record per document and window of `length` ids that it reaches into, with the ids of the piece."""
    last = F.col("place") + F.col("doc_tokens") - 1
    windows = F.sequence(F.floor(F.col("place") / length), F.floor(last / length))
    pieces = rows.withColumn("sequence_id", F.explode(windows))
    low = F.greatest(F.col("sequence_id") * length, F.col("place"))
    high = F.least((F.col("sequence_id") + 1) * length, F.col("place") + F.col("doc_tokens"))
    sized = pieces.withColumns({"start": low - F.col("place"), "length": high - low, "offset": low - F.col("sequence_id") * length})
    piece = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    return sized.select("doc_id", "start", "length", piece.alias("piece"), "doc_tokens", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents in sequences of `length` ids; `piece` holds the ids themselves."""
    return cut(placed(encoded(docs, vocabulary, end_id)), length)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.withColumn("piece", F.crc32("piece")).withColumnRenamed("piece", "ids_crc32")
