import hashlib
import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import sharding, syncmers


def test_fewest_bytes_against_all_plans():
    rng = np.random.default_rng(3)
    for _ in range(20):
        held = rng.integers(0, 5, 3).tolist()
        capacities = sharding.equal_capacities(sum(held), 3)
        price = lambda i, j: abs(i - j)
        best = min(
            sum(price(i, j) * n for (i, _), j in zip(units, plan, strict=True) for n in (1,))
            for units in [[(i, k) for i, n in enumerate(held) for k in range(n)]]
            for plan in set(itertools.permutations([j for j, n in enumerate(capacities) for _ in range(n)]))
        )
        got = sharding.fewest_bytes(held, capacities, price)
        assert sum(price(i, j) * n for i, j, n in got) == best
        assert [sum(n for i, _, n in got if i == k) for k in range(3)] == held
        assert [sum(n for _, j, n in got if j == k) for k in range(3)] == capacities
    with pytest.raises(ValueError):
        sharding.fewest_bytes([5], [4])


def test_shards_are_even_gapless_and_whole(make_docs, odd_rows):
    rows = odd_rows + [(100 + k, "w" * (k % 97)) for k in range(3000)]
    old = F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.coalesce(F.col("doc_id") % 5, F.lit(1)))
    got = sharding.shard_documents(make_docs(rows), old, 4).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    sizes = [sum(r.size for r in got if r.shard == k) for k in range(4)]
    assert max(sizes) - min(sizes) < 200
    for k in range(4):
        slots = sorted(r.slot for r in got if r.shard == k)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(make_docs([]), F.lit(0), 4).count() == 0


def plain_anchors(text):
    """Closed syncmers one by one."""
    code = np.array([ord(c) for c in text], np.uint64)
    hashes = syncmers.anchors([text], limit=1 << 30)[0]
    inner = {}
    for i in range(len(text) - syncmers.S + 1):
        h = syncmers._mix(code[i : i + syncmers.S] + np.uint64(1))
        total = 0
        for x in h:
            total = (total * syncmers._BASE + int(x)) & syncmers._MASK
        inner[i] = int(syncmers._mix(np.array([total], np.uint64))[0])
    places = []
    for i in range(len(text) - syncmers.K + 1):
        window = [inner[i + j] for j in range(syncmers.K - syncmers.S + 1)]
        if min(window) in (window[0], window[-1]):
            places.append(i)
    return places, sorted(hashes[:, 1].tolist())


def test_anchors_are_closed_syncmers():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdefgh é😀"), 400))
    places, found = plain_anchors(text)
    assert places == found
    shifted = syncmers.anchors(["zz" + text], limit=1 << 30)[0]
    own = {tuple(x) for x in syncmers.anchors([text], limit=1 << 30)[0].tolist()}
    assert own <= {(h, p - 2) for h, p in shifted.tolist()}


def test_fingerprints_of_odd_rows(make_docs, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None and r != (9, "one two three")] + [(20 + k, f"{k} " * 50) for k in range(30)]
    got = {r.doc_id: r for r in syncmers.fingerprints(make_docs(rows).repartition(4)).collect()}
    order = sorted(rows)
    assert set(got) == {i for i, _ in rows}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        part = len(text) // 4
        edited = text[: len(text) - part] + after[:part]
        own, changed, next_ = syncmers.anchors([text, edited, after])
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == syncmers.as_text(own) and got[i].edited_fingerprint == syncmers.as_text(changed)
        assert got[i].near_edited == syncmers.likeness(own, changed) and got[i].near_next == syncmers.likeness(own, next_)
    assert got[0].fingerprint == got[1].fingerprint and got[2].fingerprint == ""
    assert got[5].near_edited > 0.4


def test_fingerprints_of_repeated_null_and_no_rows(make_docs, odd_rows):
    got = syncmers.fingerprints(make_docs(odd_rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_rows)
    assert syncmers.fingerprints(make_docs([])).count() == 0
    (one,) = syncmers.fingerprints(make_docs([(5, "only this text is here, and it is its own next one")])).collect()
    assert one.near_next == 1.0
