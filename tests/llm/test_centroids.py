import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import whitening, zone_maps

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, ids string, key string, row long, place int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 1, "y", "z", 2, 3) for i, v in rows], SCHEMA)


def some_vectors(n=300, width=64, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, width))
    return (middle[rng.integers(0, 5, n)] + 0.3 * rng.normal(size=(n, width))).astype(np.float32)


@pytest.fixture(scope="module")
def odd(spark):
    """Vectors in groups with null, short, empty and non-finite ones, many copies, repeated rows and a null id."""
    vectors = [v.tolist() for v in some_vectors()]
    rows = list(enumerate(vectors))
    rows += [(1000 + i, vectors[7]) for i in range(200)] + [rows[3]] * 3 + [(None, vectors[0])]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [math.nan] + [1.0] * 63, [math.inf] + [1.0] * 63]
    rows += [(2000 + i, v) for i, v in enumerate(bad)]
    return rows, table(spark, rows)


def lloyd(rows, k=8, rounds=10):
    """Centroids by the definition, in whole numbers of any size."""
    x = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows]
    first = sorted(x, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in x:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(c) // len(o) for c in zip(*o)] if o else old for o, old in zip(own, centroids)]
    return [(i, *nearest(v)[::-1]) for i, v in x], centroids


def usable(rows):
    return [(i, v) for i, v in rows if v and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]


def test_clusters_equal_brute_force(odd):
    rows, df = odd
    want, centroids = lloyd(usable(rows))
    got = zone_maps.cluster(df, zone_maps.Plan(block=16)).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got if r.vec_id is not None) == sorted(w for w in want if w[0] is not None)
    assert [(r.cluster, r.distance) for r in got if r.vec_id is None] == [w[1:] for w in want if w[0] is None]
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_clusters_of_few_and_no_vectors(spark):
    few = [(i, v.tolist()) for i, v in enumerate(some_vectors(3))]
    got = zone_maps.cluster(table(spark, few)).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(0, 0), (1, 0), (2, 0)]
    empty = zone_maps.cluster(table(spark, []))
    assert empty.count() == 0 and empty.columns == zone_maps.cluster(table(spark, few)).columns
    assert zone_maps.cluster(table(spark, [(1, None)])).count() == 0


def test_components_that_are_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="after scaling"):
        zone_maps.cluster(table(spark, [(1, [3e38] * 64)])).count()


@settings(max_examples=200, deadline=None)
@given(data=st.data())
def test_no_candidate_of_a_box_is_lost(data):
    numbers = st.integers(-50, 50)
    points = np.array(data.draw(st.lists(st.lists(numbers, min_size=3, max_size=3), min_size=1, max_size=12)))
    centroids = np.array(data.draw(st.lists(st.lists(numbers, min_size=3, max_size=3), min_size=1, max_size=6)))
    near = zone_maps.candidates(points.min(0), points.max(0), centroids)
    of, distance = zone_maps.nearest(points.astype(np.int32), centroids)
    assert set(of.tolist()) <= set(near.tolist())
    again, same = zone_maps.nearest(points.astype(np.int32), centroids[near])
    assert near[again].tolist() == of.tolist() and same.tolist() == distance.tolist()


def test_a_tight_box_has_one_candidate():
    centroids = np.array([[0, 0], [100, 0], [0, 100], [0, 0]])
    assert zone_maps.candidates(np.array([-5, -5]), np.array([5, 5]), centroids).tolist() == [0]
    assert zone_maps.candidates(np.array([-5, -5]), np.array([95, 5]), centroids).tolist() == [0, 1]


def test_large_values_are_compared_exactly():
    x = np.array([[zone_maps.LARGEST - 1, 0]], np.int32)
    of, distance = zone_maps.nearest(x, np.array([[-5, 1], [-5, 0]]))
    assert of.tolist() == [1] and distance.tolist() == [(zone_maps.LARGEST + 4) ** 2]


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 1)])
def test_the_curve_visits_every_cell_by_single_steps(dims, bits):
    side = np.arange(1 << bits)
    cells = np.stack(np.meshgrid(*[side] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = [bytes(k) for k in zone_maps.hilbert(cells, bits)]
    assert len(set(keys)) == len(cells)
    path = cells[np.argsort(np.array([int.from_bytes(k, "big") for k in keys]))]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


# --- whitening -----------------------------------------------------------------------------------


def by_definition(rows, components=32):
    """Exact deviations, and whitened values from the plain covariance."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, total = len(x), x.sum(0)
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, total)) for row in x]
    centred = (x - (total // n)).astype(float) - np.array([(s % n) / n for s in total])
    v = centred.T @ centred / n
    e, basis = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    return n, deviation, centred @ basis[:, order] / np.sqrt(e[order]), e[order] / np.trace(v)


def check_white(rows, got, components):
    n, deviation, white, share = by_definition(rows, components)
    assert len(got) == n * components
    order = {i: k for k, (i, _) in enumerate(rows)}
    cell = np.zeros((n, components))
    for r in got:
        cell[order[r.vec_id], r.component - 1] = r.whitened
        assert (r.n, int(r.deviation)) == (n, deviation[order[r.vec_id]])
        assert r.explained == pytest.approx(share[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    sign = np.sign((cell * white).sum(0))
    assert np.allclose(cell, white * sign, atol=1e-8)


def test_whitened_values_equal_the_definition(odd):
    rows, df = odd
    once = [(i, v) for i, v in usable(rows) if i is not None]
    once = list({i: (i, v) for i, v in once}.values())
    keep = df.filter("vec_id is not null").dropDuplicates(["vec_id"])
    check_white(once, whitening.whiten(keep).collect(), 32)


def test_repeated_rows_and_null_ids_count(odd):
    rows, df = odd
    got = whitening.whiten(df, components=2).collect()
    assert len(got) == 2 * len(usable(rows)) and {r.n for r in got} == {len(usable(rows))}
    assert sum(r.vec_id is None for r in got) == 2 and sum(r.vec_id == 3 for r in got) == 8


def test_other_widths_and_constant_dimensions(spark):
    vectors = some_vectors(40, 5)
    vectors[:, 2] = 0.25
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got = whitening.whiten(table(spark, rows + [(100, [1.0, 2.0]), (101, [3.0, 4.0])])).collect()
    check_white(rows, got, 4)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(table(spark, rows)).count() == 0


def test_sums_beyond_64_bits_are_exact():
    fitted = whitening.Whitening(10**9, [0, 0], np.zeros(2, np.int64), np.array([1, 2]), np.eye(2), np.ones(2), 2.0)
    z = np.array([[10**4, -(10**4)]])
    assert whitening._deviations(z, fitted) == [(10**13 - 1) ** 2 + (-(10**13) - 2) ** 2]
    assert whitening.covariance(2, [1, 1], [10**30, 10**30, 4 * 10**30])[0, 1] == 10**30 / 2 - 0.25


def test_large_components_start_new_partial_sums(spark):
    rows = [(i, [c, c * (i % 5), 1.0]) for i, c in enumerate([2.4e6, -2.4e6, 2.0e6, 1e5] * 3)]
    check_white(rows, whitening.whiten(table(spark, rows), components=2).collect(), 2)
