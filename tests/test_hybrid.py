import numpy as np
from leafmill.operators import selection


def test_farthest_points_begin_with_chosen_vectors(spark):
    x = np.random.default_rng(8).standard_normal((60, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(3)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near, want = (1 - u @ u[[20, 30, 40]].T).min(axis=1), []
    for _ in range(6):
        want.append(int(np.argmax(near)))
        near = np.minimum(near, 1 - u @ u[want[-1]])
    got = selection.farthest_points(df, "id", "v", 6, chosen=df.filter("id in (20, 30, 40)")).orderBy("pick").collect()
    assert [r.id for r in got] == want


def test_boundary_is_far_from_medoids(spark):
    x = np.random.default_rng(9).standard_normal((80, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(3).cache()
    found = selection.hybrid(df, "id", "v", 12, trim=0.0).collect()
    inner, outer = ([r.id for r in found if r.kind == k] for k in ("medoid", "boundary"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (1 - u @ u[inner].T).min(axis=1)
    assert len(found) == len(set(inner + outer)) == 12
    assert set(outer) == set(np.argsort(-near)[: len(outer)].tolist())
