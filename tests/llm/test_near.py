import random
from collections import Counter

import numpy as np
import pytest

from tidewatch.llm import bagminhash, lattice


def words_of(text):
    hashes = bagminhash.shingle_hashes([text], 5)[0]
    return Counter(hashes.tolist())


def grouped(rows, linked):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if linked(rows[a], rows[b]):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return [root(k) for k in range(len(rows))]


def jaccard(x, y):
    both = sum((x | y).values())
    return sum((x & y).values()) / both if both else 0.0


@pytest.fixture(scope="module")
def texts():
    """Bases with chains of edits, so that ends of a chain are not alike; repeated phrases give multiplicities."""
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(120)] + ["again and again and"] * rnd.randint(0, 30)
        for _ in range(6):
            base = list(base)
            for _ in range(rnd.randint(0, 3)):
                base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            out.append(" ".join(base))
    return out


def test_signatures_are_unbiased():
    rnd = random.Random(2)
    a = " ".join(rnd.choice("abcdefghij") for _ in range(600))
    b = " ".join(a.split()[:420]) + " " + " ".join(rnd.choice("klmnopqrst") for _ in range(200))
    hashes = bagminhash.shingle_hashes([a, b], 2)
    best = bagminhash.bag_minhash(*bagminhash.multisets(hashes), 2, 8192)
    want = jaccard(*(Counter(h.tolist()) for h in hashes))
    assert max(Counter(hashes[0].tolist()).values()) > 5
    assert abs((best[0] == best[1]).mean() - want) < 4 * (want * (1 - want) / 8192) ** 0.5


def test_overlap_counts_multiplicities():
    one = np.array([1, 2], "<u8").tobytes() + np.array([70_000, 1], "<u4").tobytes()
    two = np.array([1, 3], "<u8").tobytes() + np.array([35_000, 1], "<u4").tobytes()
    assert bagminhash.overlap(one, two) == 35_000 / 70_002


@pytest.mark.parametrize("scheme", [bagminhash.Scheme(), bagminhash.Scheme(stars=0, block=8)])
def test_groups_against_brute_force(make_docs, texts, odd_rows, scheme):
    rows = [(k * 3 + 100, t) for k, t in enumerate(texts)] + [(1000 + k, texts[7]) for k in range(40)]
    rows += [r for r in odd_rows if r[0] is not None] + [(2000 + k, ["", "-----", "--"][k % 3]) for k in range(30)]
    random.Random(1).shuffle(rows)
    rows.sort(key=lambda r: r[0])
    # Texts without a word are like equal ones only.
    bags = [words_of(t or "") or Counter([("whole", t or "")]) for _, t in rows]
    roots = grouped(bags, lambda x, y: jaccard(x, y) >= 0.8)
    got = bagminhash.groups(make_docs(rows).repartition(4), scheme).collect()
    assert Counter((r.doc_id, r.group_id) for r in got) == Counter((i, rows[roots[k]][0]) for k, (i, _) in enumerate(rows))
    least = {}
    for i, t in rows:
        least[t or ""] = min(i, least.get(t or "", i))
    assert all(r.class_id == least[t or ""] for r in got for i, t in rows if i == r.doc_id)
    assert {r.doc_id for r in got if r.kept} == {r.group_id for r in got}


def test_one_row_of_each_group_is_left(make_docs, odd_rows, texts):
    rows = odd_rows + [(200 + k, t) for k, t in enumerate(texts[:12])] + [(200, texts[0])]
    docs = make_docs(rows)
    left = bagminhash.first_of_groups(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert sum(r.doc_id == 9 for r in kept) == 1 and sum(r.doc_id == 200 for r in kept) == 1
    assert not any(r.doc_id == 1 for r in kept) and any(r.doc_id == 0 for r in kept)
    assert {r.doc_id for r in kept} >= {2, 4, 5, 6, 7}
    assert not any(r.doc_id == 3 for r in kept), "a null text is taken as empty"
    bags = [words_of(r.text or "") for r in kept]
    assert all(jaccard(bags[a], bags[b]) < 0.8 for a in range(len(bags)) for b in range(a))
    assert bagminhash.groups(make_docs([])).count() == 0
    assert bagminhash.first_of_groups(make_docs([])).count() == 0


# --- vectors -------------------------------------------------------------------------------------

ROWS = "vec_id long, embedding array<float>, label int, node string, key int"


def test_nearest_is_the_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8)) * 2
    point = lattice.nearest(x)
    rest = ((x - point) ** 2).sum(1)
    assert all(((x - point - r) ** 2).sum(1).min() >= 0 and (((x - point - r) ** 2).sum(1) >= rest - 1e-9).all() for r in lattice.roots())
    assert len(lattice.roots()) == 240 and rest.max() <= 1 + 1e-9


@pytest.mark.parametrize("setting", [lattice.Lattice(), lattice.Lattice(block=7)])
def test_links_and_components_against_brute_force(spark, setting):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(60):
        center = rng.normal(size=16)
        for _ in range(rng.integers(1, 7)):
            rows.append((center + rng.normal(size=16) * 0.18, int(k % 3)))
    hub = rng.normal(size=16)
    rows += [(hub + rng.normal(size=16) * 0.1, 1) for _ in range(60)] + [(hub, 1)] * 20 + [(hub, 2)] * 3
    bodies = [x.astype(np.float32) for x, _ in rows]
    data = [(k, x.tolist(), l, "n", 1) for k, (x, (_, l)) in enumerate(zip(bodies, rows, strict=True))]
    odd = [([], 1), (None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] * 16, 1), (hub.tolist(), None), ([1.0, None], 1), ([2.0], 1), ([3.0], 1), ([-2.0], 1)]
    data += [(2000 + k, v, l, "n", 1) for k, (v, l) in enumerate(odd)]
    got = {r.vec_id: r for r in lattice.near_vectors(spark.createDataFrame(data, ROWS).repartition(5), setting).collect()}
    unit = [x.astype(float) / np.linalg.norm(x.astype(float)) for x in bodies]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if rows[a][1] == rows[b][1] and unit[a] @ unit[b] >= 0.93]
    near = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
    roots = grouped(list(range(len(rows))), lambda a, b: (a, b) in near)
    counts = Counter(a for a, _ in near)
    assert len(pairs) > 2000
    assert {k: (got[k].n_links, got[k].component_id) for k in range(len(rows))} == {k: (counts[k], roots[k]) for k in range(len(rows))}
    assert all((got[2000 + k].n_links, got[2000 + k].component_id) == (0, 2000 + k) for k in (0, 1, 2, 3, 4, 5, 6, 9))
    assert got[2007].n_links == got[2008].n_links == 1 and got[2008].component_id == 2007
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_no_vectors(spark):
    assert lattice.near_vectors(spark.createDataFrame([], ROWS)).count() == 0


def test_pairs_at_the_threshold_meet():
    """Recall of the cells alone, at cosine 0.93 exactly."""
    rng = np.random.default_rng(8)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=a.shape)
    b -= (a * b).sum(1)[:, None] * a
    b = 0.93 * a + (1 - 0.93**2) ** 0.5 * b / np.linalg.norm(b, axis=1)[:, None]
    setting = lattice.Lattice()
    (ha, pa), (hb, pb) = (lattice.cells(x, ["l"] * len(x), setting) for x in (a, b))
    met = (ha == hb) | (pb == ha[:, :, None]).any(2) | (pa == hb[:, :, None]).any(2)
    assert met.any(1).mean() >= 0.99
