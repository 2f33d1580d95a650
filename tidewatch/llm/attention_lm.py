"""Scores of texts under a causal self-attention model on subword ids.

A word is its subword ids and an end mark. The model predicts the first id of a word from the first ids of the words
before it, and each further id (or the end mark) from the ids of the same word: one network, two masks. So the
second part depends on the word alone and is computed once per word and worker. Texts are cut into overlapping windows; each
window scores its last part, so every token is scored once with context before it. Every id that the training
documents hold has an input and an output of its own: the most frequent ones directly, the others in groups, so a
prediction costs a choice of group and one inside it. Ids that never came share one.

The probability of a token mixes the network with the base: additive smoothing of the token counts, in which all words that
were never seen are one event. So the mixture is one over the seen words and that event, of which the network's share is
the sum over all unseen words; of this sum the score takes the word at hand alone, so it is a lower bound of the event's
probability and the whole sums to 1 at most. The weight of the base is learned on training documents that were set aside.
Word and id counts come from all training documents, and the weights from all but those: every task trains on its own
windows, the weights are averaged in a tree, and the next round goes on from there.

A null text is taken as empty and has its end as the only token. A null doc_id counts as a training document. Equal rows are
scored each; long words and texts are scored whole; without training tokens all counts are 0 and the
network keeps its first weights. Columns besides doc_id and text are left behind; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.bpe import byte_letters
from tidewatch.llm.common import per_process, read_local, staged
from tidewatch.llm.packing import Encoder

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The key of the end of a text among the words; no word is empty.
END_WORD = b""
WHITE = re.compile(r"\s")


@dataclass(frozen=True)
class Shape:
    """`words` and `starts` are (context, new) slots of a window inside a word and over first ids.

    `frequent` words are known to every worker, at most `longest` bytes each; rarer ones get their counts by a join.
    `outputs` classes are predicted directly, the others in groups of `group`. Training documents fit the weights, in
    `rounds` parts between which weights are averaged; a worker holds `sample` of them at a time, a task gets about
    `share` tokens and goes over each part `passes` times, with `batch` windows of texts a step, whatever the size of the table.
    Rows of the large tables move `row_rate` times as fast as other weights.
    One training document in `aside` fits no weights: the weight of the base in the mixture is learned on these; `mixed` is
    its first value.
    """

    outputs: int = 128
    group: int = 128
    width: int = 16
    hidden: int = 32
    words: tuple[int, int] = (8, 8)
    starts: tuple[int, int] = (16, 32)
    frequent: int = 131_072
    longest: int = 48
    sample: int = 1200
    batch: int = 256
    passes: int = 1
    aside: int = 20
    rounds: int = 4
    share: int = 2_000_000
    rate: float = 1.5e-2
    row_rate: float = 20
    mixed: float = 0.6
    seed: int = 11


def tokens_of(text: str) -> list[bytes]:
    """Words with A to Z in lower case; bytes.split cuts at the six white space characters of ASCII."""
    return text.encode("utf-8", "replace").translate(LOWER).split()


def word_pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Consecutive rows with about `size` bytes of text (one row at least), their `tokens_of` end to end, and the number of each row."""
    for batch in batches:
        texts = batch.column("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64) + 1)
        low = 0
        while low < len(texts):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + size, "right")))
            split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(low, high - low), "")))
            words = split.flatten()
            some = pc.greater(pc.binary_length(words), 0)
            borders = np.r_[0, np.cumsum(some.to_numpy(zero_copy_only=False))][split.offsets.to_numpy()]
            yield batch.slice(low, high - low), words.filter(some).cast(pa.binary()), np.diff(borders)
            low = high


def indexed(words: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, and for each word its place among them."""
    found = words.dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()


def binary_rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Per row the bytes of as many unsigned 32-bit numbers as `lengths` says, which lie end to end in `values`."""
    borders = np.r_[0, np.cumsum(lengths) * 4].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(borders), pa.py_buffer(values.astype("<u4"))])


def numbers_of(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of `binary_rows` end to end, and how many each row has."""
    lengths = pc.binary_length(rows).to_numpy().astype(np.int64) // 4
    borders = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1] if len(rows) else np.zeros(1, np.int32)
    data = rows.buffers()[2]
    held = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    return held.view("<u4").astype(np.int64), lengths


class Recent:
    """A number of 0 and more for each key, computed for all unknown keys of a call together.

    Once more than `limit` are held, it starts anew and keeps the ones before for one more round; keys longer than `longest` are
    computed each time.
    """

    def __init__(self, compute: Callable[[list[bytes]], np.ndarray], limit: int = 250_000, longest: int = 48) -> None:
        self.compute, self.limit, self.longest, self.held, self.before = compute, limit, longest, {}, {}

    def __call__(self, keys: list[bytes]) -> np.ndarray:
        if len(self.held) > self.limit:
            self.before, self.held = self.held, {}
        out = np.fromiter(map(self.held.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(out < 0)
        if len(new):
            asked = [keys[k] for k in new.tolist()]
            known = np.fromiter(map(self.before.get, asked, repeat(-1)), np.int64, len(asked))
            rest = np.flatnonzero(known < 0)
            if len(rest):
                known[rest] = self.compute([asked[k] for k in rest.tolist()])
            out[new] = known
            self.held.update((k, v) for k, v in zip(asked, known.tolist(), strict=True) if len(k) <= self.longest)
        return out


def first_ids(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return ids[np.cumsum(lengths) - lengths]


def inserted(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths with an end each, and which places of the rows end to end are no end."""
    longer = lengths + 1
    rest = np.ones(int(longer.sum()), bool)
    rest[np.cumsum(longer) - 1] = False
    return longer, rest


# --- network -------------------------------------------------------------------------------------


#: Logits within this are raised to powers as they are.
LIMIT = 60


def flat(t: np.ndarray) -> np.ndarray:
    return t.reshape(-1, t.shape[-1])


def powers(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the logits `z`, which they overwrite, and the logits at `at`; by row less the largest if some are large."""
    if max(z.max(initial=0), -z.min(initial=0)) > LIMIT:
        z -= z.max(1, keepdims=True)
    picked = z[np.arange(len(z)), at]
    return np.exp(z, out=z), picked


def totals(z: np.ndarray) -> np.ndarray:
    return z @ np.ones(z.shape[1], z.dtype)


class Network:
    """One layer of causal self-attention and one of rectified units, in float32.

    The first `direct` outputs are predicted at once; the others in groups of `group`, whose choice is predicted with them.
    """

    def __init__(self, shape: Shape, inputs: int, outputs: int) -> None:
        self.direct, self.group = min(outputs, shape.outputs), shape.group
        others = outputs - self.direct
        groups = -(-others // self.group)
        rng = np.random.default_rng(shape.seed)
        d, h = shape.width, shape.hidden
        normal = lambda *size, s=None: (rng.normal(size=size) * (s or size[0] ** -0.5)).astype(np.float32)
        self.w = {
            "embed": normal(inputs, d, s=0.3),
            "starts": normal(sum(shape.starts), d, s=0.1),
            "words": normal(sum(shape.words), d, s=0.1),
            "query": normal(d, d), "key": normal(d, d), "value": normal(d, d), "mix": normal(d, d, s=0.1),
            "up": normal(d, h), "up0": np.zeros(h, np.float32), "down": normal(h, d, s=0.1),
            "out": normal(d, self.direct + groups, s=0.05), "out0": np.zeros(self.direct + groups, np.float32),
            "tail": np.concatenate([normal(others, d, s=0.05), np.zeros((others, 1), np.float32)], 1),
        }

    def start_at(self, seen: np.ndarray) -> None:
        """Outputs start at the frequencies of their classes."""
        seen = seen + 0.5
        low = np.arange(self.direct, len(seen), self.group)
        head = np.r_[seen[: self.direct], np.add.reduceat(seen, low) if len(low) else []]
        self.w["out0"] += np.log(head / head.sum()).astype(np.float32)
        for g, at in enumerate(low):
            self.w["tail"][at - self.direct : at - self.direct + self.group, -1] += np.log(seen[at : at + self.group] / head[self.direct + g])

    def heads(self, target: np.ndarray) -> np.ndarray:
        """The direct output of each target, or that of its group."""
        return np.where(target < self.direct, target, self.direct + (target - self.direct) // self.group)

    def inside(self, y: np.ndarray, target: np.ndarray) -> Iterator[tuple[np.ndarray, slice, np.ndarray, np.ndarray, np.ndarray]]:
        """Per group that `target` has: rows, place in the tail, place of the target in the group, powers of all its outputs, logs of the target."""
        late = np.flatnonzero(target >= self.direct)
        place = target[late] - self.direct
        order = np.argsort((place // self.group).astype(np.uint32 if len(self.w["tail"]) >> 16 else np.uint16), kind="stable")
        late, place = late[order], place[order]
        groups = place // self.group
        borders = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(late)] if len(late) else [0]
        of_late = y[late]
        for low, high in zip(borders, borders[1:], strict=False):
            g = int(groups[low])
            part = slice(g * self.group, (g + 1) * self.group)
            at = place[low:high] - part.start
            z, picked = powers(of_late[low:high] @ self.w["tail"][part].T, at)
            yield late[low:high], part, at, z, picked

    def forward(self, kind: str, context: int, ids: np.ndarray, ok: np.ndarray, want: np.ndarray) -> dict:
        """What the outputs of the slots in `want` (windows x new slots) come from; `ok` marks the filled slots of the windows.

        Queries and keys meet in one matrix, as do values and `mix`, so the slots themselves serve as keys and values; a column of
        ones gives the sums of the weights, and the bias of the outputs.
        """
        w, (n, size) = self.w, ids.shape
        d, kept = len(w["query"]), w["query"].dtype
        x1 = np.ones((n, size, d + 1), kept)
        x = x1[..., :d]
        np.add(w["embed"].take(ids, 0), w[kind][-size:], out=x)
        new = np.ascontiguousarray(x[:, context:])
        q = (flat(new) @ self.meeting()).reshape(new.shape)
        e = q @ x.transpose(0, 2, 1)
        seen = np.arange(size)[None, :] <= np.arange(context, size)[:, None]
        whole = ok.all()
        if max(e.max(initial=0), -e.min(initial=0)) > LIMIT:
            e[~(seen & ok[:, None, :])] = -1e9
            e -= e.max(2, keepdims=True)
        np.exp(e, out=e)
        e *= seen.astype(kept)
        if not whole:
            e *= ok[:, None, :].astype(kept)
        c = e @ x1
        at = slice(None) if want.all() else np.flatnonzero(want)
        c = flat(c)[at]
        # Slots that see nothing are not wanted.
        r = 1 / c[:, d:]
        c = c[:, :d] * r
        h = np.ones((len(c), d + 1), kept)
        np.add(flat(new)[at], c @ (w["value"] @ w["mix"]), out=h[:, :d])
        u = h @ np.concatenate([w["up"], w["up0"][None]])
        np.maximum(u, 0, out=u)
        y = np.ones((len(c), d + 1), kept)
        np.add(h[:, :d], u @ w["down"], out=y[:, :d])
        return {"x1": x1, "new": new, "q": q, "e": e, "at": at, "r": r, "c": c, "h": h, "u": u, "y": y}

    def meeting(self) -> np.ndarray:
        return self.w["query"] @ self.w["key"].T * self.w["query"].dtype.type(len(self.w["query"]) ** -0.5)

    def log_probability(self, kind: str, context: int, ids, ok, want, target, rows: int = 64) -> np.ndarray:
        """Natural logarithm of the probability of each wanted slot's target; `rows` windows at a time up to the outputs.

        Windows without context go through without its slots. Full windows, which need no mask but the order, go together.
        """
        sizes = want.sum(1)
        bare = ~ok[:, :context].any(1)
        full = want.all(1) & (bare | ok.all(1))
        sort = bare * 2 + full
        order = np.argsort(sort, kind="stable")
        sort, sizes, starts = sort[order], sizes[order], (np.cumsum(sizes) - sizes)[order]
        ends = np.cumsum(sizes)
        slots = np.repeat(starts - (ends - sizes), sizes) + np.arange(sizes.sum())
        y = np.empty((len(slots), len(self.w["out"]) + 1), self.w["out"].dtype)
        borders = [0, *(np.flatnonzero(np.diff(sort)) + 1).tolist(), len(order)]
        for first, last in zip(borders, borders[1:], strict=False):
            for low in range(first, last, rows):
                high = min(low + rows, last)
                at, cut = order[low:high], context if sort[low] > 1 else 0
                found = self.forward(kind, context - cut, ids[at, cut:], ok[at, cut:], want[at])["y"]
                y[ends[low] - sizes[low] : ends[high - 1]] = found
        out = np.empty(len(slots), y.dtype)
        out[slots] = self.target_logs(y, target[slots])
        return out

    def direct_outputs(self) -> np.ndarray:
        return np.concatenate([self.w["out"], self.w["out0"][None]])

    def target_logs(self, y: np.ndarray, target: np.ndarray, rows: int = 1024) -> np.ndarray:
        """Log probability of the targets; the direct outputs in parts that fit a cache, each group once for all rows."""
        head, out, weights = self.heads(target), np.empty(len(y), y.dtype), self.direct_outputs()
        for low in range(0, len(y), rows):
            z, picked = powers(y[low : low + rows] @ weights, head[low : low + rows])
            out[low : low + rows] = picked - np.log(totals(z))
        for at, _, _, z, picked in self.inside(y, target):
            out[at] += picked - np.log(totals(z))
        return out

    def gradients(
        self, kind: str, context: int, ids, ok, want, target, weight=None, whole=None, rows: int = 1024, some: int = 2048
    ) -> tuple[dict, dict, float]:
        """Gradients of the mean loss of the targets, or of their mean under `weight`, of which `whole` is the sum: arrays, and rows of the large tables.

        Of inputs and grouped outputs only the rows that the batch holds are computed, as lists of (rows, gradient). Up to the
        outputs about `some` slots go through at a time, so that they stay in a cache.
        """
        w, size = self.w, ids.shape[1]
        step = max(1, some // (size - context))
        blocks = [slice(low, low + step) for low in range(0, len(ids), step)]
        found = [self.forward(kind, context, ids[b], ok[b], want[b]) for b in blocks]
        m, d, scale = len(target), len(w["query"]), w["query"].dtype.type(len(w["query"]) ** -0.5)
        y = np.concatenate([f["y"] for f in found])
        part = np.full(m, 1 / m, y.dtype) if weight is None else (weight / (weight.sum() if whole is None else whole)).astype(y.dtype)
        head, losses, dy = self.heads(target), np.empty(m, y.dtype), np.empty((m, d), y.dtype)
        weights = self.direct_outputs()
        out = np.zeros_like(weights)
        back = np.ascontiguousarray(w["out"].T)
        sparse: dict = {"tail": []}
        for low in range(0, m, rows):
            at = slice(low, low + rows)
            p, picked = powers(y[at] @ weights, head[at])
            total = totals(p)
            losses[at] = np.log(total) - picked
            # Powers over `total` are probabilities; the narrow sides are divided, not all outputs.
            p[np.arange(len(p)), head[at]] -= total
            by = (part[at] / total)[:, None]
            out += (y[at] * by).T @ p
            dy[at] = (p @ back) * by
        for late, place, at, q, picked in self.inside(y, target):
            total, own = totals(q), part[late]
            losses[late] -= picked - np.log(total)
            q[np.arange(len(late)), at] -= total
            by = (own / total)[:, None]
            sparse["tail"].append((place, q.T @ (y[late] * by)))
            dy[late] += (q @ w["tail"][place, :-1]) * by
        g: dict = {"out": out[:-1], "out0": out[-1]}
        to, on = self.meeting(), w["value"] @ w["mix"]
        sums = {"down": 0, "up": 0, "on": 0, "to": 0, kind: 0}
        inputs, low = [], 0
        for f in found:
            own, low = dy[low : low + len(f["y"])], low + len(f["y"])
            sums["down"] += f["u"].T @ own
            du = own @ w["down"].T
            du *= f["u"] > 0
            sums["up"] += f["h"].T @ du
            dh = own + du @ w["up"].T
            sums["on"] += f["c"].T @ dh
            dc = (dh @ on.T) * f["r"]
            new, x = f["new"], f["x1"][..., :d]
            d1 = np.zeros((new.shape[0] * new.shape[1], d + 1), y.dtype)
            d1[f["at"], :d], d1[f["at"], d] = dc, -np.einsum("ij,ij->i", dc, f["c"])
            d1 = d1.reshape(*new.shape[:2], d + 1)
            ds = d1 @ f["x1"].transpose(0, 2, 1)
            ds *= f["e"]
            dq = flat(ds @ x)
            sums["to"] += flat(new).T @ dq
            dx = ds.transpose(0, 2, 1) @ f["q"]
            dx += f["e"].transpose(0, 2, 1) @ d1[..., :d]
            more = dq @ to.T
            more[f["at"]] += dh
            dx[:, context:] += more.reshape(new.shape)
            sums[kind] += dx.sum(0)
            inputs.append(flat(dx))
        g |= {"down": sums["down"], "up": sums["up"][:-1], "up0": sums["up"][-1]}
        g["query"], g["key"] = sums["to"] @ w["key"] * scale, sums["to"].T @ w["query"] * scale
        g["value"], g["mix"] = sums["on"] @ w["mix"].T, w["value"].T @ sums["on"]
        g[kind] = np.zeros_like(w[kind])
        g[kind][-size:] = sums[kind]
        if len(w["embed"]) <= 1 << 16:
            ids = ids.astype(np.uint16)
        order = np.argsort(ids, axis=None, kind="stable")
        ids = ids.reshape(-1)[order]
        first = np.r_[0, np.flatnonzero(ids[1:] != ids[:-1]) + 1]
        sparse["embed"] = [(ids[first].astype(np.int64), np.add.reduceat(np.concatenate(inputs).take(order, 0), first))]
        return g, sparse, float((losses * part).sum())


def windows(sizes: np.ndarray, ids: np.ndarray, context: int, new: int, empty: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over sequences that lie end to end in `ids`: ids, filled slots, wanted slots.

    A sequence starts a window of its own, so its scores don't depend on what stands beside it. The wanted slots, in order, are
    the entries of `ids`, each once; the context is the end of the window before.
    """
    blocks = -(-sizes // new)
    start = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    row = np.repeat(start * new - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(ids))
    flat = np.full(total * new, empty, ids.dtype)
    filled = np.zeros(total * new, bool)
    flat[row], filled[row] = ids, True
    flat, filled = flat.reshape(total, new), filled.reshape(total, new)
    out = np.full((total, context + new), empty, ids.dtype)
    ok = np.zeros((total, context + new), bool)
    out[:, context:], ok[:, context:] = flat, filled
    later = np.ones(total, bool)
    later[start[sizes > 0]] = False
    later = np.flatnonzero(later)
    out[later, :context], ok[later, :context] = flat[later - 1, new - context :], filled[later - 1, new - context :]
    # Slots without a token still need one key to look at; what they give is not used.
    return out, ok, filled


# --- model ---------------------------------------------------------------------------------------


@dataclass
class Model:
    """Weights, classes of ids and counts; made on the driver and sent to the workers, which keep what they find under `key`."""

    shape: Shape
    vocabulary: str
    network: Network
    classes: np.ndarray
    first_rest: np.ndarray
    later_rest: np.ndarray
    counts: dict[bytes, int]
    ends: int
    total: int
    distinct: int
    mixed: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    OTHER, END, EOW = 0, 1, 2

    @property
    def begin(self) -> int:
        """Input ids are outputs and one more: what stands before the first word."""
        return len(self.network.w["embed"]) - 1


def classes_of(first: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Output of every id by falling count (0: it never came), and the log share of each such id among them, as first and later id."""
    total = first + later
    best = np.argsort(-total, kind="stable")[: np.count_nonzero(total)]
    classes = np.zeros(len(total), np.int64)
    classes[best] = np.arange(3, 3 + len(best))
    rest = classes == 0
    shares = []
    for counts in (first, later):
        weight = np.where(rest, counts + 0.5, 0)
        with np.errstate(divide="ignore"):
            shares.append(np.where(rest, np.log(weight / max(weight.sum(), 0.5)), 0.0))
    return classes, *shares


def ids_of_word(encoder: Encoder, word: bytes) -> list[int]:
    return encoder.bpe.encode_ordinary(" " + word.decode("utf-8", "replace"))


class WordIds:
    """`ids_of_word` of many words at a time.

    Words without white space beyond ASCII go through the encoder as one text: a word's first id alone starts with a space,
    and nothing joins across words.
    """

    def __init__(self, content: str) -> None:
        self.encoder = Encoder(content)
        space, vocabulary = byte_letters()[32], json.loads(content)["model"]["vocab"]
        self.opens = np.zeros(1 + max(vocabulary.values()), bool)
        self.opens[[i for s, i in vocabulary.items() if s.startswith(space)]] = True

    def __call__(self, words: list[bytes], some: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
        """The ids end to end, and how many each word has."""
        found = [self.few(words[low : low + some]) for low in range(0, len(words), some)] or [(np.zeros(0, np.int64),) * 2]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    def few(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = b"\n".join(words).decode("utf-8", "replace").split("\n")
        odd = [k for k, text in enumerate(texts) if not text.isascii() and WHITE.search(text)]
        others = [ids_of_word(self.encoder, words[k]) for k in odd]
        for k in reversed(odd):
            del texts[k]
        ids = np.array(self.encoder.bpe.encode_ordinary(" " + " ".join(texts)) if texts else [], np.int64)
        plain = np.ones(len(words), bool)
        plain[odd] = False
        lengths = np.zeros(len(words), np.int64)
        lengths[plain] = np.diff(np.r_[np.flatnonzero(self.opens[ids]), len(ids)])
        if not others:
            return ids, lengths
        lengths[~plain] = [len(x) for x in others]
        out, of_plain = np.empty(lengths.sum(), np.int64), np.repeat(plain, lengths)
        out[of_plain], out[~of_plain] = ids, [i for x in others for i in x]
        return out, lengths


def word_counts(docs: DataFrame, limit: int = 300_000) -> DataFrame:
    """(word, c) over all rows, the end of a text as the empty word; counted in the workers before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, texts = [], 0, 0

        def joined() -> pa.Table:
            found = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
            return found.select(["word", "c_sum"]).rename_columns(["word", "c"])

        for rows, words, _ in word_pieces(batches, 4 << 20):
            found = words.value_counts()
            held.append(pa.table([found.field("values"), found.field("counts")], ["word", "c"]))
            waiting, texts = waiting + len(found), texts + rows.num_rows
            if waiting > 3 * limit:
                held = [joined()]
                waiting = len(held[0])
                if waiting > limit:
                    yield from held.pop().to_batches()
                    waiting = 0
        held.append(pa.table([pa.array([END_WORD], pa.binary()), pa.array([texts], pa.int64())], ["word", "c"]))
        yield from joined().filter(pc.greater(pc.field("c"), 0)).to_batches()

    parts = docs.select("text").mapInArrow(run, "word binary, c bigint")
    return staged(parts.groupBy("word").agg(F.sum("c").alias("c")), "words")


def id_counts(words: DataFrame, vocabulary: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of ids as first and as later id of a word over all training tokens; as many rows as ids come back."""
    content = words.sparkSession.sparkContext.broadcast(vocabulary)
    sha1 = hashlib.sha1(vocabulary.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = per_process("lm_ids", lambda: WordIds(content.value), sha1)
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            some = batch.filter(pc.greater(pc.binary_length(batch.column("word")), 0))
            ids, lengths = encoded(some.column("word").to_numpy(zero_copy_only=False).tolist())
            place = np.ones(len(ids), np.int64)
            place[np.cumsum(lengths) - lengths] = 0
            np.add.at(counts, (place, ids), np.repeat(some.column("c").to_numpy(), lengths))
        kind, i = np.nonzero(counts)
        columns = [pa.array(kind.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(counts[kind, i])]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "id", "c"])

    parts = words.mapInArrow(run, "kind int, id int, c bigint").groupBy("kind", "id").agg(F.sum("c").alias("c"))
    out = np.zeros((2, size))
    for kind, i, c in parts.collect():
        out[kind, i] = c
    return out[0], out[1]


class Steps:
    """Steps on the weights of a network: Adam for the small arrays, for the large tables a scale per row from its squared gradients.

    Of the input and grouped output rows only those move that a step concerns. `moved` counts the steps of each such row,
    so that averages give a row the weights of the tasks that met it.
    """

    SPARSE = ("embed", "tail")

    def __init__(self, network: Network, shape: Shape, rate: float) -> None:
        self.network, self.shape, self.rate, self.step = network, shape, rate, 0
        small = {k: v for k, v in network.w.items() if k not in self.SPARSE}
        self.first = {k: np.zeros_like(v) for k, v in small.items()}
        self.second = {k: np.zeros_like(v) for k, v in small.items()}
        self.moved = {k: np.zeros(len(network.w[k]), np.float32) for k in self.SPARSE}
        self.scale = {k: np.zeros(len(network.w[k]), np.float32) for k in self.SPARSE}

    def __call__(self, batches: list[tuple]) -> None:
        """One step on the sum of the mean losses of both kinds of `batches`, which are (kind, ids, ok, wanted, targets, weights)."""
        total: dict[str, np.ndarray] = {}
        found, sums = [], Counter()
        for kind, _, _, wanted, _, weights in batches:
            sums[kind] += float(wanted.sum(1) @ weights)
        for kind, ids, ok, wanted, targets, weights in batches:
            each = np.broadcast_to(weights[:, None], wanted.shape)[wanted]
            g, sparse, _ = self.network.gradients(kind, ids.shape[1] - wanted.shape[1], ids, ok, wanted, targets[wanted], each, sums[kind])
            found.append(sparse)
            for name, value in g.items():
                total[name] = total[name] + value if name in total else value
        self.step += 1
        rate = self.rate * min(1, self.step / 10)
        for name, g in total.items():
            first, second = self.first[name], self.second[name]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            a, b = first / (1 - 0.9**self.step), second / (1 - 0.99**self.step)
            self.network.w[name] -= (rate * a / (np.sqrt(b) + 1e-8)).astype(np.float32)
        for sparse in found:
            for name, parts in sparse.items():
                for rows, g in parts:
                    self.row_step(name, rows, g, self.shape.row_rate * rate)

    def row_step(self, name: str, rows, g: np.ndarray, rate: float) -> None:
        scale = self.scale[name][rows] + np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.scale[name][rows] = scale
        g *= (rate / np.sqrt(scale + 1e-20))[:, None]
        self.network.w[name][rows] -= g
        self.moved[name][rows] += 1


def by_context(kind: str, ids, ok, want, goal, weights, context: int) -> list[tuple]:
    """The windows without context, cut to their new slots, and the others."""
    bare = ~ok[:, :context].any(1)
    out = [(kind, ids[bare, context:], ok[bare, context:], *(v[bare] for v in (want, goal, weights)))]
    return [x for x in [*out, (kind, *(v[~bare] for v in (ids, ok, want, goal, weights)))] if len(x[1])]


def train_on(
    stepper: Steps, lines: np.ndarray, line_lengths: np.ndarray, words: np.ndarray, word_lengths: np.ndarray, counts: np.ndarray, passes: int, rng: np.random.Generator
) -> None:
    """`passes` passes over all windows of `lines` (first ids of texts, end to end) and of `words`, which count as often as they came."""
    shape, begin = stepper.shape, len(stepper.network.w["embed"]) - 1
    sets = []
    if len(line_lengths):
        lengths, rest = inserted(line_lengths)
        inputs, targets = np.full(len(rest), begin), np.full(len(rest), Model.END)
        targets[rest] = lines
        inputs[1:][rest[:-1]] = lines
        found = sequences(inputs, targets, lengths, shape.starts, begin)
        sets += by_context("starts", *found, np.ones(len(found[0]), np.float32), shape.starts[0])
    if len(word_lengths):
        targets = np.r_[words[1:], Model.EOW]
        targets[np.cumsum(word_lengths) - 1] = Model.EOW
        found = sequences(words, targets, word_lengths, shape.words, begin)
        each = np.repeat(counts.astype(np.float32), -(-word_lengths // shape.words[1]))
        sets += by_context("words", *found, each, shape.words[0])
    sizes = {"starts": shape.batch, "words": 4 * shape.batch}
    for _ in range(passes):
        steps = max(1, *(-(-len(x[1]) // sizes[x[0]]) for x in sets)) if sets else 0
        dealt = [[x, np.array_split(rng.permutation(len(x[1])), steps)] for x in sets]
        for k in range(steps):
            some = [(x[0], *(v[part[k]] for v in x[1:])) for x, part in dealt if len(part[k])]
            stepper(some)


def packed(before: dict[str, np.ndarray], stepper: Steps) -> np.ndarray:
    """What the steps changed times their number, and that number; by row where only rows were moved."""
    out = []
    for name, old in before.items():
        change = stepper.network.w[name] - old
        if name in stepper.moved:
            n = stepper.moved[name][:, None]
            out.append(np.concatenate([change * n, n], 1).ravel())
        else:
            out.append(np.r_[change.ravel() * np.float32(stepper.step), np.float32(stepper.step)])
    return np.concatenate(out).astype("<f4")


def averaged(before: dict[str, np.ndarray], total: np.ndarray, sparse: tuple = Steps.SPARSE) -> dict[str, np.ndarray]:
    """The weights after the mean of the changes in `total`, the sum of `packed` vectors."""
    out, at = {}, 0
    for name, old in before.items():
        if name in sparse:
            rows = total[at : at + old.size + len(old)].reshape(len(old), old.shape[1] + 1)
            change, at = rows[:, :-1] / np.maximum(rows[:, -1:], 1), at + rows.size
        else:
            change, at = total[at : at + old.size].reshape(old.shape) / max(total[at + old.size], 1), at + old.size + 1
        out[name] = (old + change).astype(np.float32)
    return out


TRAINING = "part int, line binary, c bigint"


def training_rows(docs: DataFrame, words: DataFrame, vocabulary: str, classes: np.ndarray, shape: Shape, tasks: int) -> DataFrame:
    """Classes of the first ids of every text (c null) and of the ids of every word with its count, mixed over `tasks` tasks."""
    content = docs.sparkSession.sparkContext.broadcast((vocabulary, classes))
    key, sha1 = uuid.uuid4().hex, hashlib.sha1(vocabulary.encode()).hexdigest()

    def rows_of(values: np.ndarray, lengths: np.ndarray, c: pa.Array, at: int) -> pa.RecordBatch:
        part = (at + np.arange(len(lengths))) % shape.rounds
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), binary_rows(values, lengths), c], ["part", "line", "c"])

    def ids_here() -> WordIds:
        return per_process("lm_ids", lambda: WordIds(content.value[0]), sha1)

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, at = ids_here(), 0
        first = per_process("lm_first", lambda: Recent(lambda words: content.value[1][first_ids(*encoded(words))]), key)
        for rows, words, lengths in word_pieces(batches, 1 << 20):
            distinct, spots = indexed(words)
            yield rows_of(first(distinct)[spots], lengths, pa.nulls(rows.num_rows, pa.int64()), at)
            at += rows.num_rows

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded, at = ids_here(), 0
        for batch in batches:
            ids, lengths = encoded(batch.column("word").to_numpy(zero_copy_only=False).tolist())
            yield rows_of(content.value[1][ids], lengths, batch.column("c"), at)
            at += batch.num_rows

    own = words.filter(F.octet_length("word") > 0).select("word", "c").mapInArrow(of_words, TRAINING)
    return staged(docs.select("text").mapInArrow(of_texts, TRAINING).unionByName(own).repartition(tasks), "training")


def fit(network: Network, rows: DataFrame, shape: Shape, slices: int = 16) -> None:
    """Rounds of training in every task on its own rows; the changes are summed in a tree and averaged on the driver."""
    context, rounds, passes = rows.sparkSession.sparkContext, shape.rounds, shape.passes
    for round_ in range(rounds):
        sent = context.broadcast(network)
        rate = shape.rate * (1 - round_ / rounds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = pickle.loads(pickle.dumps(sent.value))  # noqa: B023
            task = TaskContext.get().partitionId()
            stepper, rng = Steps(own, shape, rate), np.random.default_rng((shape.seed, round_, task))  # noqa: B023
            held, n, size = [], 0, 0

            def use() -> None:
                values, lengths = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
                counts, texts = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])
                of_texts = np.repeat(texts, lengths)
                train_on(stepper, values[of_texts], lengths[texts], values[~of_texts], lengths[~texts], counts[~texts], passes, rng)

            for batch in batches:
                values, lengths = numbers_of(batch.column("line"))
                texts = batch.column("c").is_null().to_numpy(zero_copy_only=False)
                counts = pc.fill_null(batch.column("c"), 0).to_numpy()
                ends, ranks = np.cumsum(lengths), np.cumsum(texts)
                low = 0
                while low < len(lengths):
                    sizes, ranked = (v - (v[low - 1] if low else 0) for v in (ends, ranks))
                    high = 1 + min(np.searchsorted(sizes, 250_000 - size), np.searchsorted(ranked, shape.sample - n))
                    high = max(low + 1, min(int(high), len(lengths)))
                    own = slice(low, high)
                    held.append((values[ends[low] - lengths[low] : ends[high - 1]], lengths[own], counts[own], texts[own]))
                    n, size, low = n + int(texts[own].sum()), size + int(lengths[own].sum()), high
                    if n >= shape.sample or size >= 250_000:
                        use()
                        held, n, size = [], 0, 0
            if held:
                use()
            if stepper.step:
                parts = [x.tobytes() for x in np.array_split(packed(sent.value.w, stepper), slices)]  # noqa: B023
                columns = [pa.array(range(slices), pa.int32()), pa.array([task % 16] * slices, pa.int32()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "branch", "sums"])

        def added(table: pa.Table) -> pa.Table:
            total = None
            for blob in table.column("sums"):
                part = np.frombuffer(blob.as_py(), "<f4").astype(np.float64)
                total = part if total is None else total + part
            branch = table.column("branch")[0].as_py()
            columns = [table.column("slice").slice(0, 1), pa.array([branch], pa.int32()), pa.array([total.astype("<f4").tobytes()], pa.binary())]
            return pa.table(columns, names=["slice", "branch", "sums"])

        kept = rows.filter(F.col("part") == round_)
        form = "slice int, branch int, sums binary"
        sums = kept.mapInArrow(run, form).groupBy("slice", "branch").applyInArrow(added, form)
        found = dict(sums.groupBy("slice").applyInArrow(added, form).select("slice", "sums").collect())
        if found:
            network.w = averaged(network.w, np.concatenate([np.frombuffer(found[k], "<f4") for k in range(slices)]))
        sent.unpersist()


def frequent_words(words: DataFrame, shape: Shape) -> DataFrame:
    """The words of highest counts, `shape.frequent` at most.

    A histogram of eighths of the logarithm of the counts gives the level from which on no more than that many
    words lie, so nothing has to be put in order. Words beyond it get their counts by the join.
    """
    short = words.filter(F.octet_length("word").between(1, shape.longest))
    level = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted((tuple(r) for r in short.groupBy(level).count().collect()), reverse=True)
    kept, lowest = 0, bins[0][0] + 1 if bins else 0
    for at, n in bins:
        if kept + n > shape.frequent:
            break
        kept, lowest = kept + n, at
    return short.filter(level >= lowest)


def train(docs: DataFrame, words: DataFrame, vocabulary: str, shape: Shape) -> Model:
    """Counts and weights from all training documents."""
    spec = json.loads(vocabulary)
    size = 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    first, later = id_counts(words, vocabulary, size)
    classes, first_rest, later_rest = classes_of(first, later)
    outputs = max(3, int(classes.max(initial=0)) + 1)
    network = Network(shape, outputs + 1, outputs)
    total, distinct = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    counts = {bytes(r[0]): r[1] for r in frequent_words(words, shape).collect()}
    end = words.filter(F.octet_length("word") == 0).first()
    model = Model(shape, vocabulary, network, classes, first_rest, later_rest, counts, end[1] if end else 0, total, distinct, shape.mixed)
    if total > model.ends:
        seen = np.bincount(classes, first + later, outputs)
        seen[Model.END], seen[Model.EOW] = model.ends, total - model.ends
        network.start_at(seen)
        aside = F.pmod(F.xxhash64("text"), F.lit(shape.aside)) == 0
        rows = training_rows(docs.filter(~aside | F.col("text").isNull()), words, vocabulary, classes, shape, -(-total // shape.share))
        fit(network, rows, shape)
        model.mixed = learned_weight(docs.filter(aside), words, model)
    return model


def learned_weight(docs: DataFrame, words: DataFrame, model: Model, rounds: int = 100) -> float:
    """The weight of the base under which the mixture gives `docs` the highest probability.

    The counts hold these documents, so one is taken from the count of each token. What the weight depends on is the
    ratio of both probabilities: a histogram of its logarithm is all that comes to the driver.
    """
    sent, floor = docs.sparkSession.sparkContext.broadcast(model), model.total + 0.5 * (model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("lm", lambda: Scorer(sent.value), sent.value.key)
        known = np.zeros(801, np.int64)
        for _, words, n_words in word_pieces(batches, 1 << 20):
            spot, logs, _, rest = scorer.score(words, n_words)
            count = np.r_[scorer.count, float(sent.value.ends)][spot]
            ratio = logs - np.log(((count - 1).clip(0) + 0.5) / floor)
            tenths = np.abs(ratio).clip(0, 40) * 10
            level = np.sign(ratio) * np.floor(tenths + 0.5)
            known += np.bincount(level[count >= 0].astype(np.int64) + 400, minlength=801)
            late = np.flatnonzero(count < 0)
            rare, n = words.take(pa.array((np.cumsum(rest) - 1)[late])), len(late)
            yield pa.RecordBatch.from_arrays([rare, pa.array(logs[late]), pa.nulls(n, pa.int32()), pa.array(np.ones(n, np.int64))], ["word", "lp", "level", "n"])
        at = np.flatnonzero(known)
        n = len(at)
        columns = [pa.nulls(n, pa.binary()), pa.nulls(n, pa.float64()), pa.array((at - 400).astype(np.int32)), pa.array(known[at])]
        yield pa.RecordBatch.from_arrays(columns, ["word", "lp", "level", "n"])

    every = docs.select("text").mapInArrow(run, "word binary, lp double, level int, n bigint")
    ratio = F.col("lp") - F.log((F.greatest(F.col("c") - 1, F.lit(0)) + 0.5) / floor)
    level = F.round(F.greatest(F.least(ratio, F.lit(40.0)), F.lit(-40.0)) * 10).cast("int")
    both = every.join(words.withColumnRenamed("word", "w").hint("shuffle_hash"), F.col("word") == F.col("w"), "left")
    bins = both.groupBy(F.coalesce("level", level).alias("level")).agg(F.sum("n")).filter("level is not null").collect()
    if not bins:
        return model.mixed
    ratios, n = np.exp(np.array([b[0] for b in bins]) / 10), np.array([b[1] for b in bins], float)
    weight = model.mixed
    for _ in range(rounds):
        weight = float(np.average(weight / (weight + (1 - weight) * ratios), weights=n))
    return min(max(weight, 0.01), 0.99)


def sequences(inputs: np.ndarray, targets: np.ndarray, lengths: np.ndarray, sizes: tuple[int, int], empty: int) -> tuple:
    """Windows over sequences of `lengths` that lie end to end: ids, filled slots, wanted slots, targets of the slots."""
    ids, ok, want = windows(lengths, inputs, *sizes, empty)
    goal = np.zeros(want.shape, np.int64)
    goal[want] = targets
    return ids, ok, want, goal


class Scorer:
    """Scores in one worker. What depends on a word alone is kept until `limit` words besides the frequent ones are known."""

    def __init__(self, model: Model, limit: int = 300_000) -> None:
        self.model, self.limit = model, limit
        self.encoded = WordIds(model.vocabulary)
        self.fresh()

    def fresh(self) -> None:
        self.index: dict[bytes, int] = {}
        self.first = np.zeros(0, np.int64)
        self.inside, self.count = np.zeros(0), np.zeros(0)

    def shrink(self) -> None:
        """Frequent words stay."""
        kept = self.count >= 0
        words = [w for w, k in self.index.items() if kept[k]]
        places = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.first, self.inside, self.count = self.first[places], self.inside[places], self.count[places]
        self.index = dict(zip(words, range(len(words)), strict=True))

    def learn(self, words: list[bytes]) -> None:
        """Class of the first id, log probability of all else inside the word, and count (-1: not frequent)."""
        m = self.model
        ids, lengths = self.encoded(words)
        begins = np.cumsum(lengths) - lengths
        inputs = m.classes[ids]
        # What follows an id: the next one of the word, or the end mark.
        target = np.r_[inputs[1:], 0]
        rest = np.r_[m.later_rest[ids[1:]], 0.0]
        last = begins + lengths - 1
        target[last], rest[last] = Model.EOW, 0.0
        gained = self.logs("words", m.shape.words, lengths, inputs, target) + rest
        self.first = np.r_[self.first, inputs[begins]]
        self.inside = np.r_[self.inside, np.add.reduceat(gained, begins) + m.first_rest[ids[begins]]]
        self.count = np.r_[self.count, np.fromiter(map(m.counts.get, words, repeat(-1)), float, len(words))]

    def logs(self, kind: str, sizes: tuple[int, int], lengths, inputs, targets, rows: int = 16_384) -> np.ndarray:
        """Log probability of every target, window by window in batches of bounded size."""
        context, new = sizes
        ids, ok, want = windows(lengths, inputs, context, new, self.model.begin)
        out, at = np.zeros(len(inputs)), 0
        for low in range(0, len(ids), rows):
            part = slice(low, low + rows)
            n = int(want[part].sum())
            out[at : at + n] = self.model.network.log_probability(kind, context, ids[part], ok[part], want[part], targets[at : at + n], 2048 // new)
            at += n
        return out

    def score(self, words: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of texts with `lengths` words: of all tokens end to end the places in the index (-1: end) and the log probabilities; sizes; which are no ends."""
        if len(self.index) > self.limit + len(self.model.counts):
            self.shrink()
        distinct, at = indexed(words)
        found = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        if len(new):
            unknown = [distinct[k] for k in new.tolist()]
            self.learn(unknown)
            found[new] = len(self.index) + np.arange(len(new))
            self.index.update(zip(unknown, found[new].tolist(), strict=True))
        spots = found[at]
        sizes, rest = inserted(lengths)
        places, more = np.full(len(rest), -1), np.zeros(len(rest))
        inputs, targets = np.full(len(rest), self.model.begin), np.full(len(rest), Model.END)
        places[rest], targets[rest], more[rest] = spots, self.first[spots], self.inside[spots]
        inputs[1:][rest[:-1]] = targets[rest]
        return places, self.logs("starts", self.model.shape.starts, sizes, inputs, targets) + more, sizes, rest


DOC = pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
PART = "row bigint, word binary, lp double, doc struct<doc_id bigint, n_tokens bigint, n_known bigint, base double, score double>"


def parts(docs: DataFrame, model: Model, chunk: int = 1 << 20) -> DataFrame:
    """A row per document with the sums over its frequent words and its end, and one per occurrence of another word.

    The row of a document has a key in place of the word that no word can equal: it starts with a space. Texts are scored
    together up to about `chunk` bytes.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(model), model.key
    mixed, floor = model.mixed, model.total + 0.5 * (model.distinct + 1)
    end = pa.array([END_WORD], pa.binary())

    def described(scorer: Scorer, ids: pa.Array, row: np.ndarray, words: pa.Array, n_words: np.ndarray) -> pa.RecordBatch:
        spot, logs, lengths, rest = scorer.score(words, n_words)
        owner = np.repeat(np.arange(len(row)), lengths)
        count = np.r_[scorer.count, float(model.ends)][spot]
        settled = count >= 0
        share = (count.clip(0) + 0.5) / floor
        score = np.log10(mixed * share + (1 - mixed) * np.exp(logs))
        base = np.log10(share)
        add = lambda v: np.bincount(owner, np.where(settled, v, 0.0), len(row))
        known = add(count > 0).astype(np.int64)
        late = np.flatnonzero(~settled)
        place = np.where(rest, np.cumsum(rest) - 1, len(words))[late]
        names = pa.array([b" %d" % r for r in row.tolist()], pa.binary())
        own = pa.StructArray.from_arrays([ids, pa.array(lengths), pa.array(known), pa.array(add(base)), pa.array(add(score))], fields=list(DOC))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[row, row[owner[late]]]),
                pa.concat_arrays([names, pa.concat_arrays([words, end]).take(pa.array(place))]),
                pa.concat_arrays([pa.nulls(len(row), pa.float64()), pa.array(logs[late])]),
                pa.concat_arrays([own, pa.nulls(len(late), DOC)]),
            ],
            ["row", "word", "lp", "doc"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("lm", lambda: Scorer(sent.value), key)
        row = TaskContext.get().partitionId() << 33
        for rows, words, n_words in word_pieces(batches, chunk):
            yield described(scorer, rows.column("doc_id"), row + np.arange(rows.num_rows), words, n_words)
            row += rows.num_rows

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, PART)


def score_documents(docs: DataFrame, vocabulary: str, shape: Shape = Shape(), folds: int = 5, held: int = 1) -> DataFrame:
    """Base and model score of every document; those whose fold is `held` are not learned from."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    learned = rows.filter(fold != held)
    words = word_counts(learned)
    model = train(learned, words, read_local(vocabulary), shape)
    floor = model.total + 0.5 * (model.distinct + 1)
    known = words.withColumnRenamed("word", "w")
    # A partition of the counts holds a word once, so it is small and needs no order.
    both = parts(rows, model).join(known.hint("shuffle_hash"), F.col("word") == F.col("w"), "left")
    rare, c = F.col("lp").isNotNull(), F.coalesce("c", F.lit(0)).cast("double")
    share = (c + 0.5) / floor
    mixed = model.mixed
    base = F.when(rare, F.log10(share)).otherwise(F.col("doc.base"))
    score = F.when(rare, F.log10(share * mixed + F.exp("lp") * (1 - mixed))).otherwise(F.col("doc.score"))
    summed = both.groupBy("row").agg(
        F.max("doc.doc_id").alias("doc_id"),
        F.sum("doc.n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("doc.n_known", F.lit(0)) + (rare & (c > 0)).cast("int")).alias("n_known"),
        F.sum(base).alias("base_score"),
        F.sum(score).alias("score"),
    )
    return summed.select(
        "doc_id",
        (fold == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(model.total)).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
