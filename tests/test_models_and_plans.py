import numpy as np
from pyspark.sql import functions as F

from leafmill.functions import decoding, text
from leafmill.operators import learned, planning, selection


def frame(spark, n=120, d=5, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)) * [3, 1, 1, 0.5, 0.1]
    rows = [(i, v.tolist(), float(v[1] + 0.3 * rng.standard_normal() > 0), [float(2 * v[0] - v[2] + 1)], f"g{i % 9}") for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, v array<double>, y double, t array<double>, g string").repartition(4)


def test_projection_whitening_and_ridge(spark):
    x, df = frame(spark)
    mean, axes = learned.principal_axes(df, "v", 2)
    values, want = np.linalg.eigh(np.cov(x.T, bias=True))
    assert np.allclose(mean, x.mean(axis=0)) and np.allclose(np.abs(axes[:, 0] @ want[:, -1]), 1)
    got = np.array([r.p for r in learned.apply_matrix(df, "v", axes, mean, "p").orderBy("id").collect()])
    assert np.allclose(got, (x - x.mean(axis=0)) @ axes)
    m, w = learned.whitening(df, "v", "g", 0.0)
    groups = np.arange(len(x)) % 9
    centred = np.concatenate([x[groups == g] - x[groups == g].mean(axis=0) for g in range(9)])
    z = centred @ w
    assert np.allclose(z.T @ z / len(z), np.eye(5), atol=1e-8)
    mx, b, my = learned.ridge(df, "v", "t", 1e-9)
    assert np.allclose(b[:, 0], [2, 0, -1, 0, 0], atol=1e-6) and np.allclose(my - mx @ b, 1)


def test_scores_folds_and_reviews(spark):
    _, df = frame(spark)
    scored = learned.logistic_scores(df, df, "v", "y").select("y", "p").toPandas()
    assert ((scored.p > 0.5) == (scored.y > 0)).mean() > 0.85
    folds = learned.out_of_fold(df, "v", "y", "g", 3)
    assert folds.count() == 120 and folds.filter("p is null").count() == 0
    status = df.withColumn("s", F.when(F.col("id") < 40, F.when(F.col("y") > 0, "accepted").otherwise("rejected")))
    kept = learned.accepted_or_confident(status, "s", "v", 0.7)
    assert kept.filter("s = 'rejected'").count() == 0 and kept.filter("s = 'accepted'").count() == status.filter("s = 'accepted'").count()


def test_forward_search_and_importance(spark):
    errors = {("a",): 0.5, ("b",): 0.4, ("b", "a"): 0.3, ("c",): 0.6, ("b", "c"): 0.45, ("b", "a", "c"): 0.3}
    assert learned.forward_search({"a": ["a"], "b": ["b"], "c": ["c"]}, lambda cols: errors[tuple(cols)]) == ["b", "a"]
    df = spark.range(200).select((F.col("id") % 2).alias("y"), (F.col("id") % 2).alias("good"), (F.col("id") % 7).alias("noise"))
    drop = learned.permutation_importance(df, lambda d: d.agg(F.avg((F.col("y") == F.col("good")).cast("int"))).first()[0], ["good", "noise"])
    assert drop["good"] > 0.3 and drop["noise"] == 0


def test_passages_fit_their_pages(spark):
    pages = spark.createDataFrame([("en", 1, 100), ("en", 2, 50), ("de", 3, 10)], "lang string, page int, room int")
    texts = spark.createDataFrame([("en", "a", 95, 1), ("en", "b", 98, 2), ("en", "c", 48, 1), ("en", "d", 47, 3), ("fr", "e", 5, 4)], "lang string, text string, size int, doc int")
    got = planning.assign_passages(pages, texts, "lang", "page", "room", "text", "size", "doc").collect()
    assert sorted((r.page, r.text) for r in got) == [(1, "a"), (2, "d")]


def test_under_represented_families_come_in_turn():
    families = {"x": {"L": ["x1", "x2"]}, "y": {"C": ["y1"], "D": ["y2"]}, "z": {"L": ["z1"]}}
    assert planning.under_represented([(i, "x") for i in range(4)], families) == [(0, "y1"), (1, "z1"), (2, "y2"), (3, "z1")]


def test_factor_plan_has_exact_marginals_and_no_reuse(spark):
    rows = spark.range(101).withColumnRenamed("id", "k")
    plan = planning.factor_plan(rows, "k", {"paper": {"a": 0.5, "b": 0.3, "c": 0.2}, "light": {"day": 1, "night": 1}})
    assert {r.paper: r["count"] for r in plan.groupBy("paper").count().collect()} == {"a": 51, "b": 30, "c": 20}
    assert sorted(r["count"] for r in plan.groupBy("light").count().collect()) == [50, 51]
    pages = spark.range(40).select(F.col("id").alias("page"), F.lit("a").alias("paper"))
    used = planning.without_reuse(plan, pages, ["paper"], "k", "page").select("page").collect()
    assert len(used) == 40 == len({r.page for r in used})


def test_decoding(spark):
    df = spark.createDataFrame([("abcab", "ABCDEF+Kruti-Dev010 Bold"), (None, "Other"), ("xyz", "krutidev")], "t string, f string")
    longest = decoding.decoder({"a": "1", "ab": "2", "c": "three"})
    assert [r[0] for r in df.select(longest(F.col("t"))).collect()] == ["2three2", None, "xyz"]
    assert df.select(decoding.decoder({"a": "ä", "x": "ξ"})(F.col("t"))).first()[0] == "äbcäb"
    routes = spark.createDataFrame([("kruti", "chain", "k"), ("krutidev", "table", "kd")], "family string, kind string, argument string")
    got = {r.f: (r.kind, r.argument) for r in decoding.route(df, "f", routes).collect()}
    assert got == {"ABCDEF+Kruti-Dev010 Bold": ("table", "kd"), "Other": (None, None), "krutidev": ("table", "kd")}
    words = spark.createDataFrame([("िकत", "אבג 12.5 דה", "CafÃ© schÃ¶n", "plain")], "a string, b string, c string, d string")
    row = words.select(decoding.spoken_order(F.col("a")), decoding.reversed_keeping_numbers(F.col("b")), decoding.repaired(F.col("c")), decoding.repaired(F.col("d"))).first()
    assert tuple(row) == ("कित", "הד 12.5 גבא", "Café schön", "plain")


def test_table_agreement(spark):
    traces = spark.createDataFrame([("f", c, c.upper()) for c in "abcdefghij"], "font string, code string, read string")
    tables = spark.createDataFrame([("good", c, c.upper()) for c in "abcdefghij"] + [("bad", c, "x") for c in "abcdefghij"] + [("small", "a", "A")], "table string, code string, text string")
    assert [tuple(r) for r in decoding.table_agreement(traces, tables, ["font"]).collect()] == [("f", "good", 1.0)]


def test_text_functions(spark):
    df = spark.createDataFrame([("One two,  three four. Fivé six",)], "t string")
    row = df.select(text.phrases(F.col("t"), 2), text.first_graphemes(F.lit("éabc"), 2), text.first_words(F.col("t"), 2), text.native_digits(F.lit("a12"), "٠١٢٣٤٥٦٧٨٩"), text.html_rows(F.array(F.lit("a<b&c")))).first()
    assert row[0] == ["One two,", "three four.", "Fivé six"] and row[1] == "éa" and row[2] == "One two," and row[3] == "a١٢"
    assert row[4] == "<table><tr><td>a&lt;b&amp;c</td></tr></table>"
    names = df.select(text.target_name(F.lit("0123456789ab"), F.lit("en"), F.lit("pdf"), F.lit("x/old.pdf")), text.target_name(F.lit("zz"), F.lit("en"), F.lit("pdf"), F.lit("x")), text.target_name(F.lit("0123456789ab"), F.lit("en"), F.lit("pdf"), F.lit("x/0123456789ab_en.pdf"))).first()
    assert tuple(names) == ("0123456789ab_en.pdf", None, None)


def test_one_per_document(spark):
    df = spark.createDataFrame([(1, "a", 0.9), (1, "b", 0.8), (2, "a", 0.7), (3, "a", 0.6)], "doc int, cls string, s double")
    got = selection.one_per_document(df, "doc", [F.desc("s")], ["cls"], 2).collect()
    assert sorted((r.doc, r.cls) for r in got) == [(1, "a"), (2, "a")]
