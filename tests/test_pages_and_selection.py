import numpy as np
from pyspark.sql import functions as F

from leafmill.functions import pages
from leafmill.operators import selection


def test_page_predicates(spark):
    df = spark.createDataFrame([(210.0, 297.0, 2000.0), (216.0, 279.0, 2000.0), (297.0, 210.0, 2000.0), (210.0, 290.0, 1500.0), (210.0, 297.0, 900.0)], "w double, h double, n double")
    ok = [r[0] for r in df.select(pages.page_ok(F.col("h") / F.col("w"), F.col("n"))).collect()]
    assert ok == [True, False, False, True, False]
    status = [r[0].status for r in df.select(pages.crop(F.col("w"), F.col("h"))).collect()]
    assert status == ["none", "unfit", "unfit", "cut", "none"]


def test_classes_keys_and_staleness(spark):
    one = spark.range(1)
    lit = F.lit
    row = one.select(
        pages.writing_class(lit(11), lit(4)), pages.writing_class(lit(3), lit(11)), pages.writing_class(lit(0), lit(0)), pages.packed_key(lit(7), lit(5)), pages.packed_key(lit(7), lit(100_000)),
        pages.scan_flag(lit(True), lit("text")), pages.scan_flag(lit(True), lit(None).cast("string")), pages.scan_flag(lit(False), lit("text")), pages.window_fill(lit(0.5), lit(-0.5), lit(0.0), lit(0.5), lit(1.0)),
        pages.stale(F.array(lit(1), lit(0)), lit(5), lit(5)), pages.stale(F.array(lit(0)), lit(5), lit(5)), pages.stale(F.array(lit(0), lit(1)), lit(6), lit(5)), pages.stale(F.array(lit(0), lit(1)), lit(601), lit(600)), pages.stale(F.array(lit(0)), lit(-1), lit(5)),
    ).first()
    assert tuple(row) == (2, 1, 0, 700005, None, False, True, True, 0.25, False, True, True, False, False)
    rows = spark.createDataFrame([(1, 2, 4), (1, 2, 4), (2, 1, 1), (3, 2, 5)], "doc int, cls int, pages int")
    assert {r.doc: r["class"] for r in pages.document_class(rows, "doc", "cls", "pages").collect()} == {1: "handwritten", 2: "filled", 3: "none"}


def test_boxes_grids_and_tiles(spark):
    words = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (1, 1.2, 0.0, 2.0, 1.0), (1, 9.0, 0.0, 9.5, 1.0), (1, 0.0, 5.0, 1.0, 6.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.x0, r.x1, r.words) for r in pages.line_boxes(words, "page").collect()) == [(0.0, 1.0, 1), (0.0, 2.0, 2), (9.0, 9.5, 1)]
    unit = spark.createDataFrame([(1, 0.0, 0.0, 0.2, 0.2), (1, 0.8, 0.8, 1.0, 1.0)], "page int, x0 double, y0 double, x1 double, y1 double")
    got = pages.layout_grid(unit, "page").first()
    assert got.n == 2 and abs(got.area - 0.08) < 1e-9 and got.grid[0] == 0.5 and got.grid[-1] == 0.5 and sum(got.grid) == 1
    tiles = pages.tile_means(spark.createDataFrame([(1, 0.1, 0.1, 1.0), (1, 0.2, 0.2, 0.0), (1, 1.0, 1.0, 1.0)], "page int, x double, y double, ink double"), "page", 2)
    assert sorted((r.tx, r.ty, r["mean"]) for r in tiles.collect()) == [(0, 0, 0.5), (1, 1, 1.0)]


def frame(spark, n=80, d=6):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, d))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(3)


def test_spaces(spark):
    x, df = frame(spark)
    fused = selection.fused(df, [("v", 1.0), ("v", 0.5)]).orderBy("id").collect()
    c = x - x.mean(axis=0)
    assert np.allclose([r.fused for r in fused], np.concatenate([c, 0.5 * c], axis=1))
    assert selection.neighbour_agreement(df, df, "id", "v", 5).first().agreement == 1.0
    texts = spark.createDataFrame([("t", [1.0, 0.0, 0.0])], "name string, tv array<double>")
    s = {r.id: r.score for r in selection.text_scores(df, "id", "v", texts, "name", "tv").collect()}
    assert abs(s[4] - x[4, 0] / np.linalg.norm(x[4, :3])) < 1e-9
    border = selection.border_by_direction(df, "id", "v", 3).collect()
    assert len(border) == 6 and {r.side for r in border} == {"low", "high"}


def test_quotas_hold_in_vector_samples(spark):
    _, df = frame(spark)
    pruned = selection.prune_by_density(df, "id", "v", 20, 4).collect()
    assert len({r.id for r in pruned}) == 20
    sample = selection.hierarchical_sample(df, "id", "v", 18, 6, 3).collect()
    assert len({r.id for r in sample}) == 18


def test_landings_take_a_point_once(spark):
    new = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.99, 0.1]), (3, [0.0, 1.0]), (4, [-1.0, 0.0])], "id long, v array<double>")
    points = spark.createDataFrame([(10, [1.0, 0.02]), (11, [0.02, 1.0])], "id long, v array<double>")
    assert sorted((r.src, r.dst) for r in selection.landings(new, points, "id", "v", 0.05).collect()) == [(1, 10), (3, 11)]
