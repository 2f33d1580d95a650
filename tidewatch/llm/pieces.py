"""SentencePiece encoding and decoding of whole texts through tables of distinct chunks.

`encode_decode(docs, model)` gives (doc_id, ids, decoded) per row of (doc_id, text); `decode_ids(encoded, model)` gives
the text of any list of ids. A null text is taken as empty, and an empty text has no ids; repeated rows give repeated
rows and a null doc_id stays null; other columns are left behind, so their names cannot clash; an empty table gives an
empty one. Texts of any length are encoded whole.

No piece of the vocabulary reaches across a white-space marker, between letters that never meet in a piece (of two
scripts, a letter and a sign), nor across a character that stands in no longer piece (digits, line ends). So a text falls into chunks that are segmented independently. The documents of a
task are worked through in blocks of `BLOCK` characters: the chunks of a block go into a table of distinct ones, each of
those is segmented once, and its ids are joined back to the places where it stands. What came before in the same process
is looked up in a memory of bounded size.

The table is one per block and not one per corpus: to join one corpus-wide table back, every place of every rare
chunk would have to be shuffled to it and back, several times the bytes of the text. This way nothing moves.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tidewatch.llm.common import Bounded, per_process

#: Stands for a space inside of pieces.
MARK = "▁"

#: Characters of the documents that share a table of chunks.
BLOCK = 1 << 20

#: Chunks of more symbols are merged by a queue, shorter ones by a scan for the least rank.
SHORT = 48

SCHEMA = "doc_id bigint, ids array<int>, decoded string"

#: Above every symbol, so that a pair of symbols is one number.
WIDTH = 1 << 21

#: Above every rank.
_NONE = 1 << 40


def merge_short(parts: list[int], rank_of: dict[int, int], union_of: dict[int, int]) -> list[int]:
    """Merge the adjacent symbols whose union has the least rank, the leftmost of equals, until no union has one."""
    rank = rank_of.get
    ranks = [rank(a * WIDTH + b, _NONE) for a, b in zip(parts, parts[1:])]
    while ranks and (least := min(ranks)) != _NONE:
        i = ranks.index(least)
        del ranks[i]
        union = parts[i] = union_of[parts[i] * WIDTH + parts.pop(i + 1)]
        if i:
            ranks[i - 1] = rank(parts[i - 1] * WIDTH + union, _NONE)
        if i < len(ranks):
            ranks[i] = rank(union * WIDTH + parts[i + 1], _NONE)
    return parts


def merge_long(parts: list[int], rank_of: dict[int, int], union_of: dict[int, int]) -> list[int]:
    """The same for long chunks: a queue of (rank, place) over a doubly linked list, stale entries skipped."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [
        rank * n + i
        for i in range(n - 1)
        if (rank := rank_of.get(parts[i] * WIDTH + parts[i + 1])) is not None
    ]
    heapify(queue)
    while queue:
        rank, i = divmod(heappop(queue), n)
        j = after[i]
        if parts[i] < 0 or j >= n or rank_of.get(pair := parts[i] * WIDTH + parts[j]) != rank:
            continue
        parts[i], parts[j] = union_of[pair], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (rank := rank_of.get(parts[a] * WIDTH + parts[b])) is not None:
                heappush(queue, rank * n + a)
    return [p for p in parts if p >= 0]


def meeting(pieces: Iterable[str]) -> list[set[str]]:
    """Letters that stand next to each other in some piece, directly or by way of others; the largest kind first."""
    kind_of: dict[str, set[str]] = {}
    for a, b in {pair for p in pieces for pair in zip(p.strip(MARK), p.strip(MARK)[1:] or p.strip(MARK))}:
        own, other = kind_of.setdefault(a, {a}), kind_of.setdefault(b, {b})
        if own is not other:
            own |= other
            kind_of.update(dict.fromkeys(other, own))
    return sorted({id(k): k for k in kind_of.values()}.values(), key=lambda k: (-len(k), min(k)))


class Pieces:
    """Encoder and decoder of one model file of the byte-pair kind."""

    def __init__(self, content: bytes) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(content)
        kind, shape = sentencepiece_model_pb2.ModelProto.SentencePiece, model.normalizer_spec
        if (
            model.trainer_spec.model_type != sentencepiece_model_pb2.TrainerSpec.BPE
            or shape.precompiled_charsmap
            or shape.remove_extra_whitespaces
            or not shape.escape_whitespaces
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)
        ):
            raise ValueError("only byte-pair models with byte fallback and without rules for characters are read")
        self.prefix = MARK if shape.add_dummy_prefix else ""
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        longer = [p for p in normal if len(p) > 1]
        letters = {c for p in longer for c in p}
        # Symbols are the ids of pieces; a letter that is no piece by itself gets a number above them.
        spare = {c: len(model.pieces) + k for k, c in enumerate(sorted(letters - normal.keys()))}
        self.symbol_of = {**{p: i for p, i in normal.items() if len(p) == 1}, **spare}
        self.bytes_of = {k: c.encode() for c, k in spare.items()}
        # Equal scores share a rank, so the place decides between them.
        scores = sorted({model.pieces[normal[p]].score for p in longer}, reverse=True)
        place = {score: rank for rank, score in enumerate(scores)}
        symbols = {**normal, **spare}
        self.rank_of, self.union_of = {}, {}
        for p in longer:
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is not None and right is not None:
                    pair = left * WIDTH + right
                    self.rank_of[pair], self.union_of[pair] = place[model.pieces[normal[p]].score], normal[p]
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.marked = {i for p, i in normal.items() if p.startswith(MARK)}
        self.string_of = {i: p.replace(MARK, " ") for p, i in normal.items()}
        self.string_of |= {i: "" for i, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        self.string_of |= {i: model.trainer_spec.unk_surface for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN}
        if any(MARK in p[1:] and p.strip(MARK) for p in normal):
            raise ValueError("a piece reaches across a white-space marker")
        # A run of markers with the letters of one kind after it; a run of markers alone; any other character by itself.
        kinds = "|".join(f"[{re.escape(''.join(sorted(k)))}]+" for k in meeting(longer))
        self._chunks = re.compile(f"{MARK}*(?:{kinds})|{MARK}+|." if kinds else f"{MARK}+|.", re.DOTALL)
        self.memory = Bounded(self.segment)

    def chunks(self, text: str) -> list[str]:
        """The text in marked form, cut where no piece can reach across."""
        return self._chunks.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def ids_of(self, chunk: str) -> list[int]:
        if len(chunk) == 1:
            known = self.symbol_of.get(chunk)
            if known is None or known in self.bytes_of:
                return [self.byte_id[b] for b in chunk.encode()]
            return [known]
        merge = merge_short if len(chunk) <= SHORT else merge_long
        ids = merge(list(map(self.symbol_of.__getitem__, chunk)), self.rank_of, self.union_of)
        if self.bytes_of and not self.bytes_of.keys().isdisjoint(ids):
            return [i for s in ids for i in ([self.byte_id[b] for b in self.bytes_of[s]] if s in self.bytes_of else [s])]
        return ids

    def segment(self, chunk: str) -> tuple[bytes, str]:
        """Ids of a chunk as 32-bit bytes, and what they stand for with a space for each marker."""
        ids = self.ids_of(chunk)
        return array("i", ids).tobytes(), self.strings(ids)

    def strings(self, ids: list[int]) -> str:
        """Vocabulary strings put end to end. Runs of byte ids are read as UTF-8, each wrong byte as U+FFFD."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join(map(self.string_of.__getitem__, ids))
        out, run = [], bytearray()
        for i in ids:
            if (byte := self.byte_of.get(i)) is not None:
                run.append(byte)
                continue
            if run:
                out.append(_read(run))
                run = bytearray()
            out.append(self.string_of[i])
        return "".join(out) + _read(run)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a list of ids, without the space of a marker that encoding puts in front."""
        ids = list(ids)
        text = self.strings(ids)
        first = next((i for i in ids if self.string_of.get(i) != ""), None)
        return text[1:] if self.prefix and first in self.marked else text

    def block(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded text of each text of a block, by way of its table of distinct chunks."""
        cut = list(map(self.chunks, texts))
        table = dict.fromkeys(chain.from_iterable(cut))
        for chunk in table:
            table[chunk] = self.memory[chunk]
        ids, decoded = [], []
        for chunks in cut:
            entries = list(map(table.__getitem__, chunks))
            ids.append(b"".join(map(itemgetter(0), entries)))
            decoded.append("".join(map(itemgetter(1), entries))[len(self.prefix) :])
        return ids, decoded


def _read(run: bytearray) -> str:
    """Bytes as UTF-8; a byte that begins no character becomes U+FFFD by itself."""
    if not run:
        return ""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(run[i : i + n]).decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        i += n
    return "".join(out)


def pieces_of(content: bytes) -> Pieces:
    return per_process(f"pieces_{hashlib.sha1(content).hexdigest()}", lambda: Pieces(content))


def _blocks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Consecutive texts, about BLOCK characters at a time; a longer text is a block of its own."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(i) // 4 for i in ids]], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def _read_model(docs: DataFrame, model: str):
    """The model file on the driver; it is of fixed size and travels to the executors by broadcast."""
    with open(model, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode_decode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every document; one narrow pass."""
    content = _read_model(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(content.value)
        for batch in batches:
            start = 0
            for texts in _blocks(t.as_py() for t in batch.column("text")):
                ids, decoded = pieces.block(texts)
                own = batch.column("doc_id").slice(start, len(texts))
                start += len(texts)
                yield pa.RecordBatch.from_arrays([own, _lists(ids), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, SCHEMA)


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, decoded) of rows of (doc_id, ids); null ids are taken as none."""
    content = _read_model(encoded, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(content.value)
        for batch in batches:
            decoded = [pieces.decode(ids.as_py() or ()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.string())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(run, "doc_id bigint, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Number of ids, digest of the decimal ids joined by commas and digest of the decoded text."""
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
