"""Tables and trees of pages, selections, decoders and sources that have no SQL."""

import json
import random
import sqlite3

import numpy as np
import pytest

from leafmill.functions import decoding, language
from leafmill.operators import selection
from leafmill.operators.structure import Item, page_tables, tree, with_tables
from leafmill.sources.sqlite import read_sqlite, sql_over


def cell(text, x, y, kind="l"):
    return Item(kind, text, x, y, x + 40, y + 10, 10)


def test_rows_side_by_side_become_a_table():
    items = [cell("Title", 0, 0, "h"), Item("p", "long paragraph", 0, 30, 300, 90, 10)]
    items += [cell(f"r{r}c{c}", 100 * c, 120 + 20 * r) for r in range(3) for c in range(3) if (r, c) != (1, 1)]
    got = with_tables(items)
    assert [x.kind for x in got] == ["h", "p", "table"] and got[2].rows == [["r0c0", "r0c1", "r0c2"], ["r1c0", "", "r1c2"], ["r2c0", "r2c1", "r2c2"]]
    assert (got[2].x0, got[2].y0, got[2].x1, got[2].y1) == (0, 120, 240, 170)
    far = [cell("a", 0, 0), cell("b", 100, 0), cell("c", 0, 100), cell("d", 100, 100)]
    assert all(x.kind == "l" for x in with_tables(far))
    tall = [Item("p", f"t{i}", 200 * i, 0, 200 * i + 150, 300, 10) for i in range(2)] + [Item("p", f"u{i}", 200 * i, 310, 200 * i + 150, 500, 10) for i in range(2)]
    assert all(x.kind == "p" for x in with_tables(tall))


def test_pages_are_cut_into_columns():
    items = [Item("h", "head", 0, 0, 300, 20, 12)] + [Item("p", f"c{c}r{r}", 160 * c, 40 + 60 * r + 7 * c, 160 * c + 140, 85 + 60 * r + 7 * c, 10) for c in range(2) for r in range(3)] + [Item("p", "foot", 0, 300, 300, 320, 10)]
    got = tree(items)
    assert got[0] == {"kind": "h", "text": "head"} and got[-1] == {"kind": "p", "text": "foot"}
    assert [[x["text"] for x in col["items"]] for col in got[1]["items"]] == [[f"c{c}r{r}" for r in range(3)] for c in range(2)]
    assert tree([]) == []
    rng = random.Random(1)
    for _ in range(30):
        items = [Item("p", str(i), x := rng.randrange(300), y := rng.randrange(300), x + rng.randrange(1, 90), y + rng.randrange(1, 40), 10) for i in range(rng.randrange(1, 15))]

        def leaves(nodes):
            return [t for n in nodes for t in ([n["text"]] if "text" in n else leaves(n["items"]))]

        assert sorted(leaves(tree(items))) == sorted(x.text for x in items)


def test_page_query(spark):
    rows = [(p, "l", f"{p}{r}{c}", 100.0 * c, 20.0 * r, 100.0 * c + 40, 20.0 * r + 10, 10.0) for p in range(3) for r in range(2) for c in range(2)]
    got = {r.page: json.loads(r.tables) for r in page_tables(spark.createDataFrame(rows, "page int, kind string, text string, x0 double, y0 double, x1 double, y1 double, size double"), "page").collect()}
    assert got == {p: [[[f"{p}00", f"{p}01"], [f"{p}10", f"{p}11"]]] for p in range(3)}


def test_herding_and_elimination():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, _ = selection.herding(6)(np.arange(60), x, None)
    k = np.exp(-(2 - 2 * np.round(x @ x.T, 12)) / 0.5)
    picks = []
    for step in range(6):
        score = np.round(k.mean(axis=1) - (k[picks].sum(axis=0) if picks else 0) / (step + 1), 12)
        score[picks] = -np.inf
        picks.append(int(score.argmax()))
    assert ids.tolist() == picks
    kept, _ = selection.elimination(1.0, 10)(np.arange(60), x, None)
    d = lambda rows: np.sort(np.where(np.eye(len(rows)) > 0, 9, np.sqrt(np.maximum(2 - 2 * x[rows] @ x[rows].T, 0))), axis=1)[:, 0].min()
    assert len(kept) == 10 and d(kept) > max(d(rng.choice(60, 10, replace=False)) for _ in range(50))


def test_seeds_cover_targets(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((40, 3))
    rows = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(x.tolist())], "id long, v array<double>, lang int")
    gaps = spark.createDataFrame([(100 + i, v) for i, v in enumerate(rng.standard_normal((6, 3)).tolist())], "id long, v array<double>")
    got = selection.seed_rounds(rows, gaps, "id", "v", (np.zeros(3), np.eye(3), np.zeros(3)), "lang", 1, 10, 0.05).collect()
    assert len({r.id for r in got}) == len(got) == len({r.target for r in got}) and len(got) <= 6
    assert all(sum(r["round"] == t and r.lang == lang for r in got) <= 1 for t in range(10) for lang in (0, 1))


def test_decoders_in_a_chain_and_by_likelihood(spark):
    rows = spark.createDataFrame([("привет 123".encode("cp1251").decode("latin-1"),), (None,)], "t string")
    assert [r.x for r in rows.select(decoding.chained(rows.t, [("page", "windows-1251"), ("reversed", None)]).alias("x")).collect()] == ["123 тевирп", None]
    docs = spark.createDataFrame([("en", "the cat and the dog and the house\nthe cat sat on the mat")] * 3, "lang string, t string")
    model = language.TrigramModel(docs, "t", "lang")
    coded = spark.createDataFrame([("en", "f", "uhe cau aod uhe dog")], "lang string, font string, t string")
    tables = spark.createDataFrame([("right", "u", "t"), ("right", "o", "n"), ("wrong", "u", "o"), ("wrong", "a", "x")], "table string, code string, text string")
    assert [(r.font, r.table) for r in decoding.likeliest_table(coded, tables, model, "font", "t", "lang").collect()] == [("f", "right")]


def test_sqlite_tables_beside_parquet(spark, tmp_path):
    path = str(tmp_path / "a.db")
    con = sqlite3.connect(path)
    con.execute("create table done (k integer, w real, name text, body blob)")
    con.executemany("insert into done values (?, ?, ?, ?)", [(i, i / 2, f"n{i}", bytes([i % 7])) for i in range(100)])
    con.execute("create table empty_one (k integer)")
    con.commit()
    con.close()
    done = read_sqlite(spark, path, "done", 4)
    assert done.dtypes == [("k", "bigint"), ("w", "double"), ("name", "string"), ("body", "binary")]
    assert sorted((r.k, r.w, r.name, bytes(r.body)) for r in done.collect()) == [(i, i / 2, f"n{i}", bytes([i % 7])) for i in range(100)]
    assert read_sqlite(spark, path, "empty_one").count() == 0
    left = sql_over(spark, "select n_nationkey from nation_files left anti join done on k = n_nationkey where n_name like 'N%'", {"nation_files": "/root/testdata/sf0.001/nation*.parquet", "done": done.filter("k > 3")})
    assert sorted(r[0] for r in left.collect()) == [0, 1, 2, 3]
    with pytest.raises(Exception, match="readonly|read-only|unable"):
        from leafmill.sources.sqlite import _open

        _open(path).execute("insert into done values (1, 1, '', null)")
