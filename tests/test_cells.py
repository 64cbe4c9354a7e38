"""Exact vector searches against brute force, with many small cells."""

import numpy as np
import pytest

from leafmill.operators import cells, dedup, joins, selection


@pytest.fixture
def rows(spark, monkeypatch):
    monkeypatch.setattr(cells, "CHUNK", 16)
    monkeypatch.setattr(cells, "SLICE", 40)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((12, 6))
    x = base[rng.integers(0, 12, 300)] + 0.15 * rng.standard_normal((300, 6))
    x[7] = x[3]
    x[11] = 0
    df = spark.createDataFrame([(i, v, ["a", "b", None][i % 3]) for i, v in enumerate(x.tolist())], "id long, v array<double>, label string")
    return df, x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def test_k_nearest(rows):
    df, x = rows
    sims = np.round(x @ x.T, 12)
    np.fill_diagonal(sims, -np.inf)
    want = {(i, r + 1): int(j) for i in range(len(x)) for r, j in enumerate(sorted(range(len(x)), key=lambda j: (-sims[i, j], j))[:4])}
    assert {(r.src, r.rank): r.dst for r in joins.k_nearest(df, df, "id", "v", 4).collect()} == want
    few = df.filter("id < 3")
    assert joins.k_nearest(df, few, "id", "v", 5).groupBy("src").count().filter("count > 3").count() == 0
    assert joins.k_nearest(df, df.limit(0), "id", "v", 5).count() == 0


def test_density(rows):
    df, x = rows
    got = {r.id: r.density for r in selection.density(df, df, "id", "v", 0.2).collect()}
    want = (np.round(x @ x.T, 12) > 0.8).mean(axis=1)
    assert np.allclose([got[i] for i in range(len(x))], want)


def test_greedy_near_duplicates(rows):
    df, x = rows
    kept = {r.id: r.kept for r in dedup.greedy_near_duplicates(df, "label", "id", "v", ["id"], 0.9).collect()}
    for i in range(len(x)):
        earlier = [j for j in range(i) if j % 3 == i % 3 and kept[j]]
        assert kept[i] == (i % 3 == 2 or not earlier or not (x[earlier] @ x[i] > 0.9).any())


def test_thinning_holds_no_matrix(rows):
    _, x = rows
    ids, _ = selection.thin_to(40)(np.arange(100), x[100:200], None)
    d, alive = np.round(1 - x[100:200] @ x[100:200].T, 12), list(range(100))
    while len(alive) > 40:
        near = {i: min(d[i, j] for j in alive if j != i) for i in alive}
        alive.remove(max(i for i in alive if near[i] == min(near.values())))
    assert ids.tolist() == alive


def test_farthest_points_over_many_rounds(rows):
    df, x = rows
    got = [r.id for r in selection.farthest_points(df, "id", "v", 30).orderBy("pick").collect()]
    want, near = [0], np.full(len(x), 2.0)
    for _ in range(29):
        near = np.minimum(near, np.round(1 - x @ x[want[-1]], 12))
        near[want] = -1
        want.append(int(near.argmax()))
    assert got == want


def test_rare_elements_decide_who_meets(spark):
    small = spark.createDataFrame([(1, ["c", "x"]), (2, ["c"]), (3, ["c", "z"]), (4, [])], "n int, a array<string>")
    large = spark.createDataFrame([(i, ["c", "y"]) for i in range(5)] + [(9, ["c", "x", "y"])], "m int, b array<string>")
    assert sorted((r.n, r.m) for r in joins.contained(small, large, "a", "b").collect()) == [(1, 9), *((2, i) for i in (0, 1, 2, 3, 4, 9))]
