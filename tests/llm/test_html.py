import random
import time

import pytest

from leafmill.llm import html

PAGE = "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a>Home</a></nav>{0}<footer>&copy; x</footer></body></html>"


def content(page):
    found = html.blocks(page)
    return [found[i][1] for i in html.chosen(found)[0]]


def test_blocks():
    page = PAGE.format("<div class=ad>buy</div><article><h1>A &amp; B</h1><p><b>one<br><p>two\n <i>th</i>ree<form>f</form><section class='comments'><p>hi</p></section></article>")
    assert content(page) == ["A & B", "one", "two three"]
    assert [t for p, t in html.blocks(page) if p == html.NOISE] == ["Home", "buy", "f", "hi", "© x"]
    assert html.blocks(None) == html.blocks("") == []
    assert content(PAGE.format("<p class=notice>n<p>x<aside>s</aside>")) == ["x"]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article class='post has-sidebar'><p>a</p></article>", ["a"]),
        ("<div class='layout right-sidebar'><nav>n</nav><article><p>a</p><aside>s</aside></article></div>", ["a"]),
        ("<form id=aspnet><article><p>a</p><form>f</form></article></form>", ["a"]),
        ("<div class=sidebar><article><p>a</p><p class=promo>s</p></article></div>", ["a"]),
        ("<div class=related><article>teaser</article></div><p>much longer text in the open</p>", ["much longer text in the open"]),
        ("<div class=related><article>teaser</article></div><article>a</article>", ["a"]),
        ("<ul><li class='nav-item'>Home<li class='nav-item'>About</ul><article><p>a</p></article>", ["a"]),
        ("<article><ul><li class='share'>s<li>kept<li class='ad'>t</ul><p>a</p></article>", ["kept", "a"]),
        ("<article><p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> holds</p></article>", ["E = mc2 holds"]),
        ("<article><template><style>..</style> x </template><p>a</p></article>", ["a"]),
        ("<article><p>one <span class=share>share this</span> two</p></article>", ["one two"]),
        ("<article><p style='overflow:hidden' title=\"id of a menu\">x</p><p hidden>y</p><div aria-hidden=true>z</div><figure><figcaption data-role=menu>cap</figcaption></figure></article>", ["x", "cap"]),
        ("<article class='comment'><p>c</p></article><article><p>a</p></article>", ["a"]),
        ("<article><table><tr><td>1<td>2<tr><td>3</div></table><p>a</article>", ["1 2", "3", "a"]),
        ("<article>a<script>x</article></script><STYLE>y</style>b<!-- <p>c --></article>", ["ab"]),
        ("<div class=ad>x<div>y</div><article><p>a", ["a"]),
    ],
)
def test_places(page, want):
    assert content(PAGE.format(page)) == want


def brute(pages, run, least):
    """pages: (marks, texts, owner). Masks of covered tokens by comparing all stretches, blocks that stand on enough pages."""
    where, whole = {}, {}
    streams = []
    for marks, texts, owner in pages:
        stream = []
        for mark, text in zip(marks, texts):
            stream += [None] if mark == 2 else [*text.split(" "), "\n"]
            if mark != 2:
                whole.setdefault(text, set()).add(owner)
        streams.append(stream)
        for i in range(len(stream) - run + 1):
            if None not in (w := tuple(stream[i : i + run])):
                where.setdefault(w, set()).add(owner)
    out = []
    for (marks, texts, _), stream in zip(pages, streams):
        gone = {k for i in range(len(stream) - run + 1) if len(where.get(tuple(stream[i : i + run]), ())) >= least for k in range(i, i + run)}
        kept, at = [], 0
        for mark, text in zip(marks, texts):
            if mark == 2:
                kept.append(text)
                at += 1
                continue
            tokens = text.split(" ")
            left = [t for k, t in enumerate(tokens, at) if k not in gone]
            at += len(tokens) + 1
            if mark == 1 and len(whole[text]) < least and left:
                kept.append(" ".join(left))
        out.append("\n\n".join(kept) if 1 in marks else None)
    return out


def made_up(rng, n):
    runs = [[rng.choice("abc") for _ in range(rng.randrange(2, 7))] for _ in range(2)]
    pages = []
    for k in range(n):
        texts = [" ".join([rng.choice("abcd") for _ in range(rng.randrange(1, 9))] + (rng.choice(runs) if rng.random() < 0.6 else [])) for _ in range(rng.randrange(4))]
        pages.append((bytes(rng.choice([0, 1, 1, 2]) for _ in texts), texts, rng.randrange(k + 1)))
    return pages


def test_array_against_all_stretches():
    rng = random.Random(7)
    for _ in range(60):
        pages = made_up(rng, rng.randrange(9))
        got = html.Unit([p[:2] for p in pages], [p[2] for p in pages], 2).texts_of(2)
        assert got == brute(pages, 4, 2)


def test_array_takes_what_the_host_repeats(spark):
    """A thousand pages of one host give the same text in one unit and in many, the same as by brute force, and
    another one without the array."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    lines = [text(rng.randrange(2, 14)) for _ in range(30)]
    rows = []
    for i in range(1000):
        body = "".join(f"<p>{text(rng.randrange(1, 30))}</p>" + (f"<div>{rng.choice(lines)}</div>" if rng.random() < 0.5 else "") for _ in range(rng.randrange(1, 5)))
        if i % 5 == 0:
            body = f"<article><p>{text(9)}</p><div class='left-sidebar'>{rng.choice(lines)} {text(3)}</div></article>" + body
        rows.append((i, f"http://www.h.org/{i}", PAGE.format(body)))
    rows += [(2000 + i, None, rows[i][2]) for i in range(3)] + [(3000, "http://h.org/copy", rows[1][2].replace("Home", "Start"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    whole = {r.page_id: r.text for r in html.extract(df).collect()}
    for unit in (3000, 20_000):
        assert {r.page_id: r.text for r in html.extract(df.repartition(2), unit=unit).collect()} == whole
    assert {r.page_id: r.text for r in html.extract(df, pages=10**6).collect()} != whole
    for host in (lambda u: u is None, lambda u: u is not None):
        mine = [r for r in rows if host(r[1])]
        parsed = [html.blocks(h) for _, _, h in mine]
        want = brute([(m, t.split("\n"), html.identity(p)) for p in parsed for m, t in [html.evidence(p)]], 8, 3)
        assert all(whole[r[0]] == w for r, w in zip(mine, want, strict=True))
    assert all(whole[i].startswith(html.blocks(rows[i][2])[1][1]) for i in range(0, 1000, 5))


def test_odd_pages(spark):
    long = "<article>" + "".join(f"<p>word{i} &amp; more</p>" for i in range(60_000)) + "</article>"
    rows = [(1, None, None), (2, "odd", ""), (3, "http://a.org", PAGE.format("<p>x")), (3, "http://a.org", PAGE.format("<p>x")), (None, "http://a.org", "<b>" * 20_000 + "y"), (4, "http://a.org", long), (5, "http://a.org", "plain < text > &lt;p&gt;")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "'t' as text", "2 as host", "3 as host_", "4 as unit", "5 as ident")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "text"]
    found = sorted((r.page_id or 0, r.text) for r in got.collect())
    assert found[:5] == [(0, "y"), (1, ""), (2, ""), (3, "x"), (3, "x")] and found[6] == (5, "plain < text > <p>")
    assert found[5] == (4, "\n\n".join(f"word{i} & more" for i in range(60_000)))
    assert html.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ["<a", "<a '", '<a "', "<", "<p class=", "<!", "<li>", "<div", "&", "<script"])
def test_odd_markup_is_read_in_one_go(piece):
    began = time.process_time()
    html.blocks(piece * 50_000 + "<p>x</p>")
    assert time.process_time() - began < 20
