"""Byte-level byte-pair encoding and decoding of whole texts.

`encode_decode(docs, vocabulary)` adds token counts and digests to (doc_id, text). A null text is taken as
empty; an empty text has no ids; repeated rows give repeated rows; other columns are not carried along, so their
names cannot clash; a null doc_id stays null; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from struct import pack

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import Bounded, per_process, read_local

# Fixed value: the pre-tokenization pattern of the public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed value: letters and numbers of Unicode 17 and 18, which the engine of the tokenizers library takes for symbols.
NEWER = re.compile(
    "[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f]"
)

#: Above every id, so that a pair of ids is one number.
WIDTH = 1 << 20

#: A space after white space; without one, no run of white space holds two cut points.
_WIDE = re.compile(r"\s ")

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next free one above 255."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def merge(symbols: Sequence[int], ranks: dict[int, int], products: Sequence[int]) -> list[int]:
    """Apply the merges to a list of symbols, the lowest rank first and of equal ranks the leftmost.

    `ranks` has the rank of a pair under left * WIDTH + right, `products` the symbol that a rank makes. The symbols
    form a doubly linked list; a priority queue holds rank * length + place of the pairs that can merge. An entry
    whose place no longer holds a pair of its rank is stale and skipped.
    """
    item = list(symbols)
    n = len(item)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank_of = ranks.get
    queue = [
        rank * n + i
        for i in range(n - 1)
        if (rank := rank_of(item[i] * WIDTH + item[i + 1])) is not None
    ]
    heapify(queue)
    while queue:
        rank, i = divmod(heappop(queue), n)
        j = after[i]
        if j >= n or item[i] < 0 or rank_of(item[i] * WIDTH + item[j]) != rank:
            continue
        product = item[i] = products[rank]
        item[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = rank_of(product * WIDTH + item[k])
            if rank is not None:
                heappush(queue, rank * n + i)
        h = before[i]
        if h >= 0:
            rank = rank_of(item[h] * WIDTH + product)
            if rank is not None:
                heappush(queue, rank * n + h)
    return [x for x in item if x >= 0]


def pieces_of(pattern: regex.Pattern, text: str) -> list[str]:
    """What `pattern` finds in a text, by the letters and numbers that the library knows."""
    if text.isascii() or not NEWER.search(text):
        return pattern.findall(text)
    known = NEWER.sub("\U0010ffff", text)  # neither letter nor number in any version
    return [text[m.start() : m.end()] for m in pattern.finditer(known)]


class Codec:
    """Encoder and decoder of one vocabulary file; ids travel as little-endian unsigned 32-bit bytes."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        of_letter = {c: b for b, c in enumerate(letters)}
        self.symbol = [vocab[c] for c in letters]
        self.ranks = {vocab[a] * WIDTH + vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.products = [vocab[a + b] for a, b in merges]
        self.strings = {i: bytes(of_letter[c] for c in s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._pieces = regex.compile(PATTERN)
        self._piece = Bounded(self._merge_piece)
        self._word = Bounded(lambda word: self._ids_of(" " + word))

    def _merge_piece(self, piece: str) -> bytes:
        ids = merge([self.symbol[b] for b in piece.encode()], self.ranks, self.products)
        return pack(f"<{len(ids)}I", *ids)

    def _ids_of(self, text: str) -> bytes:
        return b"".join(map(self._piece.__getitem__, pieces_of(self._pieces, text)))

    def _plain(self, text: str) -> bytes:
        """A text without special strings.

        A space that follows no white space starts a piece, whatever stands around it. So words between
        such spaces can be encoded and remembered one by one.
        """
        if _WIDE.search(text):
            return self._ids_of(text)
        first, *rest = text.split(" ")
        return self._ids_of(first) + b"".join(map(self._word.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not self.special or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join(
            pack("<I", self.special[part]) if part in self.special else self._plain(part)
            for part in self._cut.split(text)
            if part
        )

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings put end to end; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.strings.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def codec_of(content: str) -> Codec:
    return per_process(f"codec_{hashlib.sha1(content.encode()).hexdigest()}", lambda: Codec(content))


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded text of every document; one narrow pass."""
    content = docs.sparkSession.sparkContext.broadcast(read_local(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(content.value)
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column("text"):
                ids = codec.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)
