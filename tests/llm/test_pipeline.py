import random

import corpus_pipeline as pipeline
from leafmill.llm import packing, tokens


def rows(seed=1):
    rng = random.Random(seed)
    words = {"en": "the of and house river stone walk light green".split(), "de": "der die und haus fluss stein gehen licht gruen".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice("abcdefgh") * rng.randrange(2) for _ in range(n))
    out = [(i, text(lang := rng.choice(["en", "de"]), rng.choice([20, 60, 200])), lang, f"s{i % 4}", 0) for i in range(120)]
    passage = text("en", 70)
    out += [(200 + i, f"{text('en', 40)}\n{passage}\n{text('en', 40)}", "en", "s1", 0) for i in range(4)]
    out += [(300, out[3][1], "en", "s2", 0), (301, out[3][1], "en", "s2", 0), (302, "12 345 ...", "en", "s0", 0), (303, None, None, None, None), (304, "", "de", "s0", 0), (305, out[5][1] + " x", None, "s3", 0), (5, out[5][1] + " y", "de", "s1", 0), (None, out[7][1], "en", None, 0)]
    return out


def test_stages_take_effect(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as mark_", "2 as id")
    a = pipeline.materialise(pipeline.identify(spark, docs, ""))
    ids = {r.doc_id for r in a.select("doc_id").collect()}
    assert not ids & {302, 303, 304} and set(range(120)) <= ids and a.columns == list(pipeline.COLUMNS)
    assert a.filter("lang is null").count() == 0
    b = pipeline.materialise(pipeline.one_of_each_group(spark, a, ""))
    kept = [r.doc_id for r in b.select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and 3 in kept and not {300, 301} & set(kept)
    c = pipeline.materialise(pipeline.without_repeats(spark, b, ""))
    long = {r.doc_id: len(r.text.split()) for r in c.filter("doc_id between 200 and 203").collect()}
    assert long[200] == 150 and all(long[i] == 80 for i in (201, 202, 203))
    d = pipeline.materialise(pipeline.mixed(spark, c, ""))
    assert 0 < d.count() and {r.doc_id for r in d.select("doc_id").collect()} <= set(kept)
    assert max(r["count"] for r in d.groupBy("doc_id").count().collect()) <= 3
    e = pipeline.packed(spark, d, "")
    count = tokens.Tokens(tokens.load_vocabulary(tokens.VOCABULARY)).count
    assert e.agg({"n_tokens": "sum"}).first()[0] == sum(count(r.text)[1] for r in d.collect())
    # Whole texts, however often they were mixed in, come back from the batches' own rows.
    pieces = sorted((r.doc_id or -1, r.text) for r in e.collect())
    assert pieces == sorted((r.doc_id or -1, r.text) for r in d.collect()) and max(count(t)[1] for _, t in pieces) <= packing.MAX_LEN


def test_run_leaves_no_stage_behind(spark, tmp_path):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len({(r.batch_id, r.slot) for r in got}) > 0 and all(r.text for r in got)


def test_empty_tables_pass(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
