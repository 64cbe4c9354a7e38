import numpy as np
import pytest
from leafmill.operators import joins
from leafmill.plans import catalogue


@pytest.mark.parametrize("cut", [4096, 5])
def test_sums_and_products_equal_all_pairs(spark, monkeypatch, cut):
    """Labels of near, of far and of odd vectors; n and mean of all, the least of those over the bound."""
    monkeypatch.setattr(joins, "ROWS", cut)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=6)
    rows = [(i, int(i % 4), [float(x) for x in (centre if i % 4 < 2 else 0) + rng.normal(size=6) * 0.3]) for i in range(90)]
    rows += [(90, 1, None), (91, 0, [0.0] * 6), (92, None, rows[0][2]), (93, 2, [None] + rows[1][2][1:]), (94, 7, None)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "vec_id % 7 as k")
    want = {}
    cosine = lambda x, y: None if x is None or y is None or None in [*x, *y] or not any(x) or not any(y) else round(float(np.float32(x).astype(float) @ np.float32(y).astype(float) / np.sqrt((np.float32(x).astype(float) ** 2).sum() * (np.float32(y).astype(float) ** 2).sum())), 9)
    for i, a, x in rows:
        for j, b, y in rows:
            if a is not None and b is not None and a < b and i % 7 == j % 7:
                want.setdefault((a, b), []).append(cosine(x, y))
    got = {(r.a, r.b): r for r in joins.pair_cosines(df, "label", "embedding", "k", 0.2, [0.5]).collect()}
    assert got.keys() == want.keys()
    for k, c in want.items():
        r, real = got[k], [x for x in c if x is not None]
        assert r.n == len(c)
        if not real:
            assert r.mean is None and r.least is None
            continue
        assert abs(r.mean - np.mean(real)) < 1e-8
        assert r.least == pytest.approx(min(real), abs=1e-8) if r.mean > 0.2 else min(real) <= r.least <= 0.2
    assert got[0, 1].mean > 0.2 and got[2, 3].mean < 0.2


def test_verdicts_make_no_pairs(spark):
    plan = catalogue.QUERIES["pair_verdicts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "embedding" not in plan and "zip_with" not in plan.lower()
