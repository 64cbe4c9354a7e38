import heapq
import tracemalloc

import numpy as np
import pytest

from leafmill.llm import vectors


def brute(rows, threshold=0.93):
    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n, out = len(rows), []
    linked = [set() for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and a[0] is not None and b[0] is not None and a[2] is not None and a[2] == b[2] and fine(a[1]) and fine(b[1]) and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    linked[i].add(j)
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        root = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(linked[i]), root))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 8))
    rows = [(i, (base[i % 30] + 0.08 * rng.standard_normal(8)).astype("float32").tolist(), i % 2) for i in range(90)]
    rows += [(200 + i, rows[0][1], 0) for i in range(5)] + [(300, [2 * x for x in rows[0][1]], 0), (301, rows[0][1], None)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [0.0] * 8, 1), (403, [float("nan")] * 8, 1), (404, [1.0, None], 1), (405, [1.0, 2.0, 3.0], 1), (406, [1.0, 2.0, 3.0], 1), (None, rows[0][1], 0), (407, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as n", "2 as rep", "3 as component")
    got = vectors.near_duplicates(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_crowded_cells_are_cut(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 8)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((4, 6))
    rows = [(i, (base[i % 4] + 0.12 * rng.standard_normal(6)).tolist(), 1) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()), key=str)
    want = brute(rows)
    assert [g[2] for g in got] == [w[2] for w in want]
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def multi_sequence(da, db, cells):
    """The traversal with a heap, one row at a time."""
    oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
    heap, pushed, out = [(da[oa[0]] + db[ob[0]], 0, 0)], {(0, 0)}, []
    while heap and len(out) < cells:
        _, i, j = heapq.heappop(heap)
        out.append(int(oa[i]) * len(db) + int(ob[j]))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(oa) and q < len(ob) and (p, q) not in pushed:
                pushed.add((p, q))
                heapq.heappush(heap, (da[oa[p]] + db[ob[q]], p, q))
    return out


@pytest.mark.parametrize("codes,cells", [((5, 7), 35), ((5, 7), 6), ((12, 12), 9), ((1, 3), 2), ((40, 30), 100)])
def test_traversal_order(codes, cells):
    rng = np.random.default_rng(5)
    da, db = rng.random((50, codes[0])), rng.random((50, codes[1]))
    got = vectors.traverse(da, db, cells)
    for i in range(50):
        assert got[i].tolist() == multi_sequence(da[i], db[i], cells)
    where = got[:, cells // 2]
    assert (vectors.reached_at(da, db, where // codes[1], where % codes[1]) == cells // 2).all()


def test_memory_does_not_grow_with_the_grid():
    rng = np.random.default_rng(6)
    index = vectors.MultiIndex(rng.standard_normal((256, 16)), rng.standard_normal((256, 16)), 32, 40)
    x = rng.standard_normal((10_000, 32))
    tracemalloc.start()
    index.visited(x)
    assert tracemalloc.get_traced_memory()[1] < 500e6
    tracemalloc.stop()
    sample = rng.standard_normal((4096, 32))
    tracemalloc.start()
    vectors.fit(sample / np.linalg.norm(sample, axis=1, keepdims=True), codes=256)
    assert tracemalloc.get_traced_memory()[1] < 1e9
    tracemalloc.stop()


def test_recall_on_thousands_of_links(spark):
    """Over 5000 rows with a partner at a cosine from 0.93 up, among as many others."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = unit(rng.standard_normal((6000, 48)))
    noise = rng.standard_normal((3000, 48))
    noise = unit(noise - (noise * base[:3000]).sum(axis=1, keepdims=True) * base[:3000])
    cos = rng.uniform(0.931, 0.99, (3000, 1))
    x = np.concatenate([base, cos * base[:3000] + np.sqrt(1 - cos**2) * noise])
    rows = [(i, v, 1) for i, v in enumerate(x.tolist())]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    found = {r.vec_id: r.n_links for r in got.collect()}
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert (want > 0).sum() >= 5000 and all(found[i] <= n for i, n in enumerate(want.tolist()))
    assert sum(found.values()) >= 0.99 * want.sum()
