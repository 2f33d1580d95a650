"""Token counts of whole texts under a lower-case vocabulary with word ends, without making the ids.

`count_tokens(docs, vocabulary)` gives one row per row of (doc_id, text). A null text is taken as empty and has 0
tokens; repeated rows give repeated rows; other columns are left behind; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import WIDTH, byte_letters, pieces_of
from tidewatch.llm.common import Bounded, per_process, read_local

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"

#: Characters at which str.split cuts although the vocabulary's pattern takes them for symbols.
_SEPARATORS = re.compile("[\x1c-\x1f]")

#: Capitals of Unicode 16 and 17, whose small letters the library knows and str.lower may not.
_SMALL = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7DC: 0x19B} | {c: c + 1 for c in (0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
_SMALL |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_CAPITALS = re.compile("[" + "".join(map(chr, _SMALL)) + "]")


def count_merges(symbols: list[int], ranks: dict[int, int], products: list[int]) -> int:
    """How many merges a word allows: the lowest-ranked adjacent pair, leftmost first, until none is left."""
    n = len(symbols)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    rank_of = ranks.get
    heap = [
        rank * n + i
        for i in range(n - 1)
        if (rank := rank_of(symbols[i] * WIDTH + symbols[i + 1])) is not None
    ]
    heapify(heap)
    merges = 0
    while heap:
        rank, i = divmod(heappop(heap), n)
        j = right[i]
        if j >= n or symbols[i] < 0 or rank_of(symbols[i] * WIDTH + symbols[j]) != rank:
            continue
        merges += 1
        symbols[i], symbols[j] = products[rank], -1
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < n and (rank := rank_of(symbols[a] * WIDTH + symbols[b])) is not None:
                heappush(heap, rank * n + a)
    return merges


class Counter:
    """Counts tokens as the library does: special strings, NFC, white space, lower case, pieces, merges."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        vocab, merges, suffix = spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"] or ""
        self.inner = [vocab[c] for c in byte_letters()]
        self.last = [vocab[c + suffix] for c in byte_letters()]
        self.ranks = {vocab[a] * WIDTH + vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.products = [vocab[a + b] for a, b in merges]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pieces = regex.compile(pattern)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = tuple(special)
        self._cut = re.compile("|".join(map(re.escape, special)))
        self._piece = Bounded(self._of_piece)
        self._word = Bounded(self._of_text)

    def _of_piece(self, piece: str) -> int:
        *rest, end = piece.encode()
        symbols = [*map(self.inner.__getitem__, rest), self.last[end]]
        n = len(symbols)
        return n - count_merges(symbols, self.ranks, self.products) if n > 1 else n

    def _of_text(self, text: str) -> int:
        return sum(map(self._piece.__getitem__, pieces_of(self._pieces, text)))

    def _plain(self, text: str) -> int:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # Letter by letter as the library does: a capital sigma never becomes a final one.
        text = text.replace("Σ", "σ").lower()
        if not text.isascii() and _CAPITALS.search(text):
            text = text.translate(_SMALL)
        if _SEPARATORS.search(text):
            return self._of_text(text)
        return sum(map(self._word.__getitem__, text.split()))

    def count(self, text: str) -> int:
        if not any(s in text for s in self.special):
            return self._plain(text)
        parts = self._cut.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def counter_of(content: str) -> Counter:
    return per_process(f"counter_{hashlib.sha1(content.encode()).hexdigest()}", lambda: Counter(content))


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Bytes and tokens of every document and whether it has more than `limit` tokens; one narrow pass."""
    content = docs.sparkSession.sparkContext.broadcast(read_local(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(content.value)
        for batch in batches:
            counts = [counter.count(text.as_py() or "") for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes")
    return docs.select(F.col("doc_id").cast("bigint"), "text", size).mapInArrow(run, SCHEMA)
