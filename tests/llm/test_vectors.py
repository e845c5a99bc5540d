"""Exact top-k search and near-duplicate vectors against brute force."""

import random

import numpy as np
import pytest

from sideline.llm import knn_join, multi_index
from tests.llm.brute import components_of

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, cell int, rank int, grp int"
ODD = [None, [], [float("nan"), 1.0], [float("inf"), 0.0], [1.0, None], [0.0, 0.0]]


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2, 3, 4) for i, v in rows], SCHEMA)


def _vectors(n=300, width=8, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(20, width))
    x = base[rng.integers(0, 20, n)] + rng.normal(scale=0.12, size=(n, width))
    x[:60] = x[0]  # one vector that a fifth of the rows share
    x[60:70] *= 3
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows += [(1000 + i, v) for i, v in enumerate(ODD)] + [(None, rows[0][1]), (2000, [0.5, 0.25]), rows[5], rows[5]]
    return rows


def _whole(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def _top(rows, queries, k):
    ready = [(i, [int(np.floor(64 * c)) for c in v]) for i, v in rows if i is not None and _whole(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for qi, q in {(i, tuple(v)) for i, v in ready if i in queries}:
        found = sorted((-dot(q, v), i) for i, v in ready if i != qi)[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"query_rows": 7, "data_rows": 50, "pivots": 9}, {"pivots": 1, "query_rows": 3}])
def test_top_k(spark, blocks):
    rows = _vectors()
    df = _frame(spark, rows)
    queries = {i for i, _ in rows if i is not None and i % 5 == 0}
    got = knn_join.top_k(df.filter("vec_id % 5 = 0"), df, k=6, **blocks).collect()
    assert sorted(map(tuple, got)) == _top(rows, queries, 6)


def test_top_k_of_a_repeated_query(spark):
    """The longest vector comes more than k + 1 times under one id, in one cell and in several."""
    others = [(i, [3.0, i / 64]) for i in range(2, 20)]
    for own in ([(1, [4.0, 0.0])] * 30, [(1, [4.0, i / 64]) for i in range(12)]):
        df = _frame(spark, own + others)
        got = knn_join.top_k(df.filter("vec_id = 1"), df, k=3).collect()
        assert sorted(map(tuple, got)) == _top(own + others, {1}, 3)


def test_top_k_small_and_empty(spark):
    df = _frame(spark, _vectors()[:3])
    got = knn_join.top_k(df, df).collect()
    assert len(got) == 6 and {r["rank"] for r in got} == {1, 2}
    assert knn_join.top_k(df.limit(0), df).count() == 0
    assert knn_join.top_k(df, df.limit(0)).count() == 0


def test_top_k_large_numbers(spark):
    df = _frame(spark, [(1, [1e9, 3.0]), (2, [1e9, 5.0]), (3, [-1e9, 1.0])])
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in knn_join.top_k(df, df).collect()}
    big = int(np.floor(64 * float(np.float32(1e9)))) ** 2
    assert got[1, 1] == (2, min(big + 192 * 320, 2**63 - 1)) and got[1, 2][0] == 3


def test_top_k_between_doubles_and_longs(spark):
    """Products beyond 2^53 that fit a long are exact, and ranks follow their last digits."""
    rng = random.Random(7)
    rows = [(i, [float(rng.randrange(-10**7, 10**7)) + 0.5 for _ in range(4)]) for i in range(30)]
    rows += [(100, [1e7, 0.0, 1e7, 1.0]), (101, [1e7, 0.0, 1e7, 2.0]), (102, [1e7, 0.0, 1e7, 1.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v in rows}
    got = knn_join.top_k(df, df, k=5).collect()
    want = []
    for i, v in whole.items():
        best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole.items() if j != i)[:5]
        want += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want) and any(2**53 < abs(w[3]) < 2**63 for w in want)


def _near(rows, threshold):
    ok = lambda v: _whole(v) and any(v)
    pad = lambda v: np.pad(np.array(v, float), (0, 8 - len(v)))
    use = [(k, i, pad(v)) for k, (i, v) in enumerate(rows) if i is not None and ok(v)]
    x = np.array([v for _, _, v in use])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = components_of([use[a][1] for a in range(len(use))], [(use[a][1], use[b][1]) for a, b in zip(*np.nonzero(near), strict=True)])
    out = {k: (i, int(near[n].sum()), comp[i], comp[i] == i) for n, (k, i, _) in enumerate(use)}
    return sorted((out.get(k, (i, 0, i, True)) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("options", [{}, {"block": 16, "cell_rows": 10}, {"sample": 40, "cell_rows": 2}])
def test_near_duplicates(spark, options):
    rows = _vectors()
    got = multi_index.near_duplicates(_frame(spark, rows), recall=1.0, probes=4096, **options).collect()
    assert sorted(map(tuple, got), key=str) == _near(rows, 0.95)


def test_near_duplicates_empty(spark):
    df = _frame(spark, [])
    assert multi_index.near_duplicates(df).count() == 0
    alone = multi_index.near_duplicates(_frame(spark, [(7, None), (None, None)])).collect()
    assert sorted(map(tuple, alone), key=str) == [(7, 0, 7, True), (None, 0, None, True)]


def test_recall_of_the_visits(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(200, 16))
    x = np.concatenate([base, base + rng.normal(scale=0.05, size=base.shape)])
    df = _frame(spark, [(i, r.tolist()) for i, r in enumerate(x)])
    got = {r.vec_id: r.n_links for r in multi_index.near_duplicates(df, cell_rows=4, probes=64, sample=128).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    true = (u @ u.T >= 0.95).sum(1) - 1
    found = sum(got.values())
    assert all(got[i] <= true[i] for i in got) and found >= 0.95 * true.sum()


def _pairs(n, width, cosine, seed):
    """``n`` random unit vectors and a neighbour of each at the cosine."""
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=(2, n, width))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    return np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * b])


@pytest.mark.parametrize("large", [0, 200])
def test_every_link_at_the_threshold(spark, large):
    """Few links next to many vectors, without and with a group of near copies that has most links."""
    rng = np.random.default_rng(8)
    alone, pairs = rng.normal(size=(800, 32)), _pairs(40 if not large else 200, 32, 0.9505, 4)
    hot = rng.normal(size=32) + rng.normal(scale=0.01, size=(large, 32))
    x = np.concatenate([pairs, alone, hot])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in multi_index.near_duplicates(df, cell_rows=2, block=256).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    comp = components_of(list(range(len(x))), list(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near))), strict=True)))
    assert [got[i].n_links for i in range(len(x))] == near.sum(1).tolist()
    assert all(got[i].component_id == comp[i] for i in range(len(x)))


def test_multi_sequence_order():
    rng = np.random.default_rng(3)
    grid = multi_index.Grid(rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    x = rng.normal(size=(11, 6))
    d1, d2 = grid.distances(x)
    whole = (d1[:, :, None] + d2[:, None, :]).reshape(11, -1)
    for count in (1, 4, 12, 35, 99):
        seen = grid.visits(x, count)
        expected = np.sort(whole, axis=1)[:, :count]
        assert np.allclose(np.take_along_axis(whole, seen.astype(int), 1), expected)
