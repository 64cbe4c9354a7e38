"""Work that must grow with the rows, not with their square or with a table copied to each of them."""

from leafmill.operators import records


def test_a_bank_is_not_copied_to_each_field(spark):
    """One copy of the bank for a part of the fields, at any number of fields."""
    bank = spark.range(300).selectExpr("'en' as lang", "concat(repeat('x', cast(id % 60 as int) + 5), id) as line", "cast(id as string) as key", "cast(id as string) as stem")
    fields = spark.range(2000).selectExpr("'en' as lang", "id as form", "0 as field", "40 as cap").unionAll(spark.range(2000).selectExpr("'en' as lang", "id as form", "1 as field", "60 as cap"))
    out = records.pick_lines(fields, bank)
    assert "bank_" not in out._jdf.queryExecution().analyzed().toString()
    rows = out.collect()
    assert len(rows) == 4000 and all(len(r.line) <= (40, 60)[r.field] for r in rows)
    assert len({(r.form, r.line) for r in rows}) == 4000


def test_lines_do_not_hang_on_the_parts(spark, monkeypatch):
    bank = spark.range(90).selectExpr("if(id % 3 = 0, null, 'en') as lang", "repeat('y', cast(id as int) + 1) as line", "cast(id as string) as key", "cast(id % 40 as string) as stem")
    fields = spark.range(60).selectExpr("if(id % 10 = 9, null, if(id % 10 = 8, 'de', 'en')) as lang", "id as form", "explode(sequence(0, 3)) as field").selectExpr("*", "if(form = 7 and field = 1, null, 20 + 20 * field) as cap")
    whole = {tuple(r) for r in records.pick_lines(fields, bank).collect()}
    monkeypatch.setattr(records, "FIELDS_A_PART", 7)
    assert {tuple(r) for r in records.pick_lines(fields, bank).collect()} == whole
    assert {r[0] for r in whole} == {"en"} and (7, 1) not in {r[1:3] for r in whole}


def test_a_large_shard(spark):
    """Offsets of one shard of 60,000 ids are a running sum and each id takes its own slice; ties and null lists too."""
    import time

    from leafmill.sources import files

    rows = spark.range(60_000).selectExpr("0 as shard", "cast(id % 20000 as int) as doc", "cast(id % 3 as int) as page", "if(id % 7 = 0, null, if(id % 4 = 0, array(), transform(sequence(1, cast(id % 4 as int)), i -> id))) as cls")
    start = time.time()
    shards = files.rows_to_ragged(rows, ["shard"])
    got = sorted((r.doc, r.page, r.cls) for r in files.ragged_to_rows(shards).collect())
    assert time.time() - start < 60
    assert got == sorted((r.doc, r.page, r.cls or []) for r in rows.collect())
    r = shards.first()
    assert len(r.offsets) == 60_001 and r.offsets[-1] == len(r.cls) and r.offsets[0] == 0


def test_shapes_of_many_glyphs(spark):
    """Equal bitmaps are compared once, shapes meet by their rarest cells; the result is the one of all pairs."""
    import random

    from leafmill.functions import decoding

    rng = random.Random(3)
    bitmap = lambda: sorted(rng.sample(range(9), rng.randrange(0, 9)))
    known = [(f"w{i}", bitmap()) for i in range(120)] + [(None, [1, 2])]
    glyphs = [(i, bitmap()) for i in range(200)] + [(200, None)]
    k, g = spark.createDataFrame(known, "label string, b array<int>"), spark.createDataFrame(glyphs, "k long, b array<int>")
    for least in (0.5, 0.8, 2 / 3):
        want = {}
        for i, a in glyphs:
            scores = [(len(set(a) & set(b)) / len(set(a) | set(b)), x) for x, b in known if x and a and set(a) & set(b)]
            if scores and max(scores)[0] >= least:
                want[i] = max(scores)[::-1]
        assert {r.k: (r.label, r.score) for r in decoding.nearest_shapes(g, k, "k", "b", "label", least).collect()} == want
    # 20,000 glyphs and 20,000 labels of two bitmaps: 4 * 10**8 pairs.
    many = lambda c, n: spark.range(n).selectExpr(f"{c}", "if(id % 2 = 0, array(1, 2, 3), array(1, 2, 3, 4)) as b")
    out = decoding.nearest_shapes(many("id as k", 20_000), many("id as label", 20_000), "k", "b", "label").groupBy("label", "score").count().collect()
    assert sorted(tuple(r) for r in out) == [(19_998, 1.0, 10_000), (19_999, 1.0, 10_000)]


def test_a_field_has_a_line_as_long_as_one_is_left(spark):
    """Tries look at some lines only; a field goes without one only if each that fits has a key or stem of its form."""
    stems = [("a", 90), ("b", 3), ("c", 1), ("d", 1)]
    bank = [("en", s * (4 + k % 11) + str(k), f"{s}{k}", s) for s, n in stems for k in range(n)] + [("en", "zz", "a1", "z"), ("en", "zzzzzzzz", None, None)]
    fields = [("en", f, k, 20) for f in range(60) for k in range(7)] + [("en", 100, k, 3 if k == 8 else 20) for k in range(9)] + [("en", 200, k, 6) for k in range(2)]
    made = spark.createDataFrame(fields, "lang string, form int, field int, cap int"), spark.createDataFrame(bank, "lang string, line string, key string, stem string")
    got = {}
    for r in records.pick_lines(*made).collect():
        got.setdefault(r.form, {})[r.field] = r.line
    known = {line: (key, stem) for _, line, key, stem in bank}
    for f in {x[1] for x in fields}:
        used, of = [], {k: cap for _, g, k, cap in fields if g == f}
        for k, cap in sorted(of.items()):
            free = [x for x, (key, stem) in known.items() if len(x) <= cap and key not in {u[0] for u in used} and stem not in {u[1] for u in used}]
            assert (k in got.get(f, {})) == bool(free)
            if free:
                assert got[f][k] in free
                used.append(known[got[f][k]])


def test_lines_are_picked_from_the_whole_bank(spark):
    """More lines of a language than any bound on a bank: the only ones that fit come last."""
    bank = spark.range(30_000).selectExpr("'en' as lang", "if(id >= 29990, concat('s', id), concat(repeat('x', 30), id)) as line", "cast(id as string) as key", "cast(id as string) as stem")
    fields = spark.range(200).selectExpr("'en' as lang", "id as form", "explode(sequence(0, 9)) as field", "8 as cap")
    assert records.pick_lines(fields, bank).groupBy("form").count().filter("count = 10").count() == 200
