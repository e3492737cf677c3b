"""Whitening, exact top-k and clustering against brute force, and on odd and empty tables."""

import hashlib
import math

import numpy as np
import pytest

from lessonlens.llm import clusters, topk, vectors, whitening
from llm_rows import SMALL

EMBEDDING = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def embeddings(llm):
    return llm.read.parquet(f"{SMALL}/embeddings.parquet")


def frame(llm, rows):
    """A table of (vec_id, vector) with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    table = llm.createDataFrame([(i, v, None) for i, v in rows], EMBEDDING)
    return table.withColumns({c: F.lit(1) for c in (
        "vec", "pivot", "dist", "shard", "ask", "floor", "rank", "score", "cluster", "distance", "n", "component", "key",
        "hash", "query", "ids", "rows", "low", "high")})


def odd_vectors(length=64, seed=5):
    """Nulls, bad entries, other lengths, ties, repeated rows and ids."""
    rng = np.random.default_rng(seed)
    plain = [(i, rng.normal(size=length).tolist()) for i in range(120)]
    tied = [(200 + i, plain[3][1]) for i in range(30)] + [(50, plain[3][1]), plain[7], plain[7], (None, plain[9][1])]
    bad = [(300, None), (301, []), (302, [None] + plain[0][1][1:]), (303, [NAN] + plain[0][1][1:]),
           (350, [INF] + plain[0][1][1:]), (351, [-INF] + plain[0][1][1:]), (None, None), (352, [3e38] * length)]
    other = [(400 + 10 * i, rng.normal(size=length // 2).tolist()) for i in range(11)]
    return plain + tied + bad + other


def usable(rows, scale, offset=0, length=None, limit=2.0 ** 26):
    out = []
    for i, v in rows:
        if not v or any(c is None or not math.isfinite(c) or abs(scale * c) >= limit for c in v):
            continue
        if length is None or len(v) == length:
            out.append((i, [math.floor(scale * float(np.float32(c))) + offset for c in v]))
    return out


def data(table):
    return [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]


# ---- whitening

def check_whitening(table, length=64):
    rows = usable(data(table), 64, 1_000_000, length, 2.0 ** 40)
    distinct = sorted({tuple(v) for _, v in rows})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    z = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in distinct])
    covariance = z.T @ z / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.whitened(table).collect()
    assert len(got) == 16 * len(rows)
    of = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-10)
        of.setdefault((r.vec_id, r.deviation), []).append((r.component, r.whitened))
    expected = {}
    for i, v in rows:
        y = np.array([float(n * c - s) / n for c, s in zip(v, sums)]) @ axes[:, :16] / np.sqrt(values[:16])
        expected.setdefault((i, sum((n * c - s) ** 2 for c, s in zip(v, sums))), []).extend(enumerate(y, 1))
    assert of.keys() == expected.keys()
    sign = {}
    for key in expected:
        for (a, x), (b, y) in zip(sorted(of[key]), sorted(expected[key])):
            assert a == b and abs(x) == pytest.approx(abs(y), abs=1e-6)
            if abs(x) > 1e-3:      # a component has one sign for all rows
                assert sign.setdefault(a, x * y > 0) == (x * y > 0)


def test_whitening(embeddings):
    check_whitening(embeddings)


def test_whitening_of_odd_rows(llm):
    check_whitening(frame(llm, odd_vectors()))


def test_whitening_far_from_the_origin(llm):
    rng = np.random.default_rng(1)
    rows = [(i, (1e5 + rng.normal(size=64)).tolist()) for i in range(150)]
    check_whitening(frame(llm, rows))


def test_whitening_with_few_directions(llm):
    rng = np.random.default_rng(2)
    assert whitening.whitened(frame(llm, [])).collect() == []
    assert whitening.whitened(frame(llm, [(1, None), (2, []), (3, [NAN])])).collect() == []
    assert whitening.whitened(frame(llm, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = rng.normal(size=(40, 3)) @ rng.normal(size=(3, 8)) * 50
    got = whitening.whitened(frame(llm, [(i, v.tolist()) for i, v in enumerate(flat)])).collect()
    assert {r.component for r in got} == set(range(1, 9)) and max(r.identity_error for r in got) < 1e-6
    two = whitening.whitened(frame(llm, [(1, [1.0, 2.0]), (2, [4.0, 2.0])])).collect()
    assert [(r.component, r.explained) for r in two] == [(1, 1.0)] * 2
    assert sorted(r.whitened for r in two) == pytest.approx([-1.0, 1.0])


@pytest.mark.parametrize("rank", [0, 1, 7, 20, 33])
def test_cholesky_and_jacobi(rank):
    rng = np.random.default_rng(rank)
    b = rng.normal(size=(33, rank)) * np.logspace(0, -5, rank) if rank else np.zeros((33, 0))
    a = b @ b.T
    l = whitening.pivoted_cholesky(a)
    assert l.shape == (33, rank) and np.allclose(l @ l.T, a, atol=1e-13 * (1 + np.abs(a).max()))
    values, axes = whitening.jacobi(l)
    assert np.allclose(values, np.linalg.svd(b, compute_uv=False) ** 2, rtol=1e-9)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-12) and np.allclose(axes * values @ axes.T, a, atol=1e-12)


def test_deviation_beyond_a_long():
    f = whitening.Fit(10 ** 9, np.array([0]), np.array([0]), 1.0, np.ones(1), np.ones((1, 1)))
    assert whitening.deviations(np.array([[1], [10]]), f) == [10 ** 18, None]


# ---- top-k

def plain_topk(rows, k=5):
    out = []
    rows = usable(rows, 256)
    for i, q in rows:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), math.inf if j is None else j) for j, v in rows
                  if j != i and len(v) == len(q)]
        out += [(i, n, None if j == math.inf else j, -s) for n, (s, j) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(table):
    return sorted((tuple(r) for r in topk.query(table).collect()), key=repr)


def test_topk(embeddings):
    assert found(embeddings) == plain_topk(data(embeddings))


def test_topk_of_odd_rows(llm):
    table = frame(llm, odd_vectors())
    assert found(table) == plain_topk(data(table))


def test_topk_of_few_rows(llm):
    assert found(frame(llm, [])) == []
    assert found(frame(llm, [(50, [1.0])])) == []
    assert found(frame(llm, [(50, [1.0]), (7, [2.0]), (None, [2.0]), (8, [1.0, 2.0])])) == [
        (50, 1, 7, 256 * 512), (50, 2, None, 256 * 512)]


def grouped(seed, n=6000, centres=12, length=8):
    rng = np.random.default_rng(seed)
    return np.floor(256 * (3 * rng.normal(size=(centres, length))[rng.integers(0, centres, n)]
                           + 0.05 * rng.normal(size=(n, length)))).astype(np.int64)


@pytest.mark.parametrize("scale", [1, 40, 2 ** 12])
def test_annuli_give_the_best_and_leave_out_the_rest(scale, monkeypatch):
    x = grouped(4) * scale
    pivots = {8: np.concatenate([np.zeros((1, 8), np.int64), x[:12]])}
    d = topk.distances(x, pivots)
    near = d.argmin(1)
    order = np.lexsort((d[np.arange(len(x)), near], near))
    x, near, dist = x[order], near[order], d[order, near[order]]
    ids = np.random.default_rng(0).permutation(len(x))
    met, real = [], topk.inner
    monkeypatch.setattr(topk, "inner", lambda a, b: met.append(len(a) * len(b)) or real(a, b))
    pick = np.arange(0, len(x), 50)
    best = topk.Annuli(ids, x, near, dist, 128).search(x[pick], ids[pick], np.full(len(pick), topk.LOW), 5, pivots)
    scores = x[pick].astype(object) @ x.T.astype(object)
    for row, q in enumerate(pick):
        expected = sorted((-s, i) for s, i in zip(scores[row], ids) if i != ids[q])[:5]
        own = best.query == row
        assert list(zip((-best.score[own]).tolist(), best.id[own].tolist())) == expected
    assert sum(met) < 0.5 * len(pick) * len(x)      # the bounds leave out over half of the pairs


def test_topk_over_many_shards(llm, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 40)
    rows = [(int(i), (v / 256).tolist()) for i, v in enumerate(grouped(9, 700))]
    table = frame(llm, rows)
    assert found(table) == plain_topk(data(table))


def test_inner_products_are_exact():
    rng = np.random.default_rng(0)
    for most in (100, 2 ** 20, 2 ** 26 - 1):
        a, b = rng.integers(-most, most + 1, (20, 64)), rng.integers(-most, most + 1, (30, 64))
        assert (vectors.inner(a, b) == a.astype(object) @ b.T.astype(object)).all()


# ---- clusters

def plain_clusters(rows, k=16, rounds=3):
    rows = usable(rows, 64, length=64)
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)[:k]
    c = [v for _, v in first]

    def assigned():
        for _, v in rows:
            yield min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = [j for _, j in assigned()]
        for j in set(of):
            own = [v for (_, v), o in zip(rows, of) if o == j]
            c[j] = [sum(x) // len(own) for x in zip(*own)]
    last = list(assigned())
    spent = {j: sum(d for d, o in last if o == j) for j in range(k)}
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, j, d, spent[j], sum(spent.values()), digest[j]) for (i, _), (d, j) in zip(rows, last)), key=repr)


def clustered(table):
    return sorted((tuple(r) for r in clusters.cluster(table).collect()), key=repr)


def test_clusters(embeddings):
    assert clustered(embeddings) == plain_clusters(data(embeddings))


def test_clusters_of_odd_rows(llm):
    table = frame(llm, odd_vectors(64))
    assert clustered(table) == plain_clusters(data(table))


def test_clusters_of_few_rows(llm):
    assert clustered(frame(llm, [])) == []
    assert clustered(frame(llm, [(1, [0.5] * 63), (None, [0.5] * 64)])) == []
    table = frame(llm, [(i, [float(i)] * 64) for i in range(5)])
    assert clustered(table) == plain_clusters(data(table))


def test_hilbert_neighbours_are_one_step_apart():
    for d, bits in ((2, 5), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(2 ** bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = [k.tobytes() for k in clusters.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[sorted(range(len(cells)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_boxes_keep_the_nearest_and_leave_out_far_centroids():
    rng = np.random.default_rng(3)
    c = rng.integers(-100, 100, (16, 6))
    left = 0
    for _ in range(200):
        x = rng.integers(-100, 100, 6) + rng.integers(-15, 15, (20, 6))
        near, d = clusters.assign(x, x.min(0), x.max(0), c)
        every = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (near == every.argmin(1)).all() and (d == every.min(1)).all()
        left += 16 - len(clusters.candidates(x.min(0), x.max(0), c))
    assert left > 200 * 4
