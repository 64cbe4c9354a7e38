import itertools
import json
import random

import numpy as np
import pytest

from leafmill.llm import classifier, langid, packing, quality, tokens


# Quality rules


def brute_quality(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 5)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), failed


def test_quality_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "the " * 30, "x y z u v x y z u v w w w w w", "é#ü | <b> the of and\nline\n\nline\nline \nother the end of it all now then", "\x1cq \x85 w"]
    texts += ["\n".join(" ".join(rng.choice(["the", "of", "a", "big", "cat", "#", "É"]) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(12))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as words_")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(df).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}
    assert not any(r.kept for r in quality.judge(df).filter("base_failed").collect())
    assert quality.judge(df.limit(0)).count() == 0


def test_rules_reject_and_keep(spark):
    good = "The cat sat on the mat and looked at all of the birds in a tree by the house. It was a fine day for it, with sun and wind."
    rows = [(1, good), (2, good.upper()), (3, good.replace(" ", "### ")), (4, "\n".join(f"- {w}" for w in good.split())), (5, " ".join(f"xq{i}zz" for i in range(60)))]
    got = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_ellipses_end_lines_and_stop_words_go_by_language(spark):
    line = "the end of it is near and so on it goes..."
    rows = [(1, "\r\n".join([line] * 3 + ["that is all"]), "en"), (2, " ".join(["slovo"] * 3 + [f"reka{i}" for i in range(80)]), "ru"), (3, " ".join(f"reka{i}" for i in range(80)), "en"), (4, " ".join(["der", *(f"reka{i}" for i in range(80))]), "de"), (5, " ".join(["der", *(f"reka{i}" for i in range(80))]), None), (6, " ".join(["der", *(f"reka{i}" for i in range(80))]), "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as lang_")
    found = {r.doc_id: r for r in quality.judge(df, lang_col="lang").collect()}
    assert abs(found[1].ellipsis_line_ratio - 0.75) < 1e-9
    assert [found[i].stop_word_ratio is None for i in range(1, 7)] == [True, True, False, False, False, False]
    assert [found[i].kept for i in range(2, 7)] == [True, False, True, True, False]


def test_quality_of_a_long_text(spark):
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(10)) for i in range(40_000))
    r = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_words, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (400_000, 0, 0, False)


# Packing


@pytest.mark.parametrize("k", [1, 2, 3, 5, 9])
def test_boundaries_are_optimal(k):
    rng = np.random.default_rng(k)
    lengths = np.sort(rng.choice(60, 8, replace=False) + 1)
    counts = rng.integers(1, 30, 8)
    cost = lambda ends: sum(c * (min(e for e in ends if e >= x) - x) for x, c in zip(lengths, counts, strict=True))
    best = min(cost((*c, lengths[-1])) for m in range(min(k, 8)) for c in itertools.combinations(lengths[:-1], m))
    found = packing.boundaries(lengths, counts, k)
    assert cost(found) == best and len(found) <= k and found[-1] == lengths[-1]
    assert packing.boundaries(np.array([]), np.array([]), k) == []


@pytest.mark.parametrize("by_tokens", [False, True])
def test_batches_are_rebuilt_from_the_rows_alone(spark, vocabulary, by_tokens):
    rng = random.Random(3)
    rows = [(i, " \n".join(rng.choice(["w", "the", "cats"]) for _ in range(rng.choice([0, 1, 7, 30, 31, 100])))) for i in range(150)]
    rows += [(7, "w w")] * 40 + [(None, "w"), (900, None), (901, " "), (902, "x" * 500), (903, "w " * 100_000), (904, "é! " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as boundary", "3 as tag", "4 as piece")
    got = packing.pack(df, vocabulary=vocabulary if by_tokens else None, max_len=30, buckets=3, batch_tokens=90).collect()
    counter = tokens.Tokens(tokens.load_vocabulary(vocabulary))
    size = (lambda t: counter.count(t)[1]) if by_tokens else (lambda t: len(t.split()))
    assert all(r.n_tokens == size(r.text) and 0 <= r.padding == r.boundary - r.n_tokens and r.n_tokens <= 30 for r in got)
    texts = {}
    for r in sorted(got, key=lambda r: r.piece):
        texts.setdefault((r.doc_id, r.doc_id == 7 and len(r.text) < 4), []).append(r)
    for i, t in rows:
        mine = texts.get((i, i == 7 and t == "w w"), [])
        if i != 7:
            assert [t[r.first_char : r.first_char + len(r.text)] for r in mine] == [r.text for r in mine]
            assert "".join("".join(r.text for r in mine).split()) == "".join((t or "").split())
    assert sum(r.doc_id == 7 and r.text == "w w" for r in got) == 40
    batches = {}
    for r in got:
        batches.setdefault((r.boundary, r.batch_id), []).append(r.slot)
    assert len({b for _, b in batches}) == len(batches)
    for (boundary, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, 90 // boundary)
    for boundary in {b for b, _ in batches}:
        sizes = sorted(len(x) for (b, _), x in batches.items() if b == boundary)
        assert all(n == max(1, 90 // boundary) for n in sizes[1:])
    assert packing.pack(df.limit(0)).count() == 0


# Token counts


def greedy(pieces, word):
    found, at = 0, 0
    while at < len(word):
        n = next((n for n in range(len(word) - at, 0, -1) if tuple(word[at : at + n]) in pieces), 0)
        if not n:
            return 1
        found, at = found + 1, at + n
    return found


def test_automaton_is_greedy_longest_match():
    rng = random.Random(5)
    for _ in range(40):
        pieces = {tuple(rng.choices(range(3), k=rng.randrange(1, 6))) for _ in range(rng.randrange(1, 14))} | ({(0,), (1,), (2,)} if rng.random() < 0.6 else set())
        automaton = tokens.Automaton(pieces)
        for _ in range(150):
            word = rng.choices(range(3), k=rng.randrange(1, 12))
            assert automaton.count(word) == greedy(pieces, word), (pieces, word)


@pytest.fixture
def vocabulary(tmp_path):
    path = tmp_path / "v.json"
    alphabet = {b: c for c, b in tokens.byte_alphabet().items()}
    names = [alphabet[b] + end for b in range(256) for end in ("", "</w>")] + ["th", "the</w>", "cat</w>", "ca"]
    path.write_text(json.dumps({"model": {"vocab": {n: i for i, n in enumerate(names)}}}))
    return str(path)


def test_token_counts(spark, vocabulary):
    rows = [(1, "The cats!"), (2, None), (3, ""), (4, "é don't"), (5, "cat cat\ncat"), (5, "cat cat\ncat"), (6, "the " * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens", "2 as text_", "3 as text_to_count_")
    found = tokens.count_tokens(df, ["doc_id", "n_tokens", "text_"], vocabulary)
    assert found.columns == ["doc_id", "text_", "n_words", "n_tokens"]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in found.collect()}
    assert got == {1: (3, 1 + 3 + 1), 2: (0, 0), 3: (0, 0), 4: (3, 2 + 3 + 2), 5: (3, 3), 6: (300_000, 300_000)} and found.count() == 7
    assert tokens.count_tokens(df.limit(0), ["doc_id"], vocabulary).count() == 0


def test_tokens_same_as_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("create view documents as select * from read_parquet('/root/testdata/sf0.001/documents.parquet')")
    got = sorted((r.doc_id, r.n_words, r.n_tokens) for r in tokens.op4_tokens(spark, "/root/testdata/sf0.001").collect())
    assert got == sorted(con.execute(tokens.OP4_SQL).fetchall())


# Language identification


def test_language_backoff(spark):
    rng = random.Random(6)
    kinds = {"aa": "abcde", "bb": "efghi"}
    rows = [(i, " ".join("".join(rng.choices(kinds[lang], k=5)) for _ in range(30)), lang) for i in range(80) for lang in [rng.choice(list(kinds))]]
    rows += [(900, None, "aa"), (901, "123 ... ² Ⅷ ٣", "bb"), (902, "abcab", None), (None, "efg", "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "1 as score", "2 as gram", "3 as share", "4 as text_to_judge_", "5 as lang_")
    model = langid.train(df)
    found = langid.predict(df, model, ["doc_id", "lang", "lang_pred", "score", "share"])
    assert found.columns == ["doc_id", "lang", "share", "lang_pred", "score"]
    assert all(r.lang_pred == (langid.UNKNOWN if r.doc_id in (900, 901) else r.lang or "aa") and 0 <= r.score <= 1 for r in found.collect())
    unseen = langid.predict(spark.createDataFrame([("HIHIHIHI fgfgf",), ("qqq",), ("m² x² 5",), ("abcde " * 300_000,)], "text string"), model, []).collect()
    assert unseen[0].lang_pred == "bb" and abs(unseen[1].score - 0.5) < 1e-9 and unseen[1].lang_pred == "aa" and unseen[2].lang_pred != "und" and unseen[3].lang_pred == "aa"
    empty = langid.train(df.limit(0))
    assert [(r.lang_pred, r.score) for r in langid.predict(df.limit(2), empty, []).collect()] == [("und", 0.0)] * 2


def test_letters_and_marks_make_words():
    assert langid.words_of("m² x² 5 हिन्दी É́a naïve3x Ⅷ") == ["m", "x", "हिन्दी", "é́a", "naïve", "x"]


def test_scores_against_brute_force(spark):
    """Every prediction and score again, from counts of the whole sample and one word at a time."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    counts = {}
    for r in rows:
        if r.lang is not None and r.text is not None:
            for w in langid.words_of(r.text):
                for level in range(langid.LONGEST + 1):
                    for g in langid.grams_of(w, level) if level else [w]:
                        counts.setdefault((level, g), {}).setdefault(r.lang, 0)
                        counts[level, g][r.lang] += 1
    often = {k: {lang: n for lang, n in v.items() if n >= langid.LEAST_COUNT} for k, v in counts.items()}
    often = {k: v for k, v in often.items() if v}
    langs = sorted({lang for v in often.values() for lang in v})
    sums = {(level, lang): sum(v.get(lang, 0) + langid.SMOOTHING for (at, _), v in often.items() if at == level) for level in range(langid.LONGEST + 1) for lang in langs}
    log = lambda level, g: np.array([np.log((often[level, g].get(lang, 0) + langid.SMOOTHING) / sums[level, lang]) for lang in langs])

    def word(w):
        for level in (0, *range(langid.LONGEST, 0, -1)):
            known = [log(level, g) for g in (langid.grams_of(w, level) if level else [w]) if (level, g) in often]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(langs))

    got = {r.doc_id: r for r in langid.predict(docs, langid.train(docs, docs_per_language=10**9), ["doc_id"]).collect()}
    for r in rows[:60]:
        words = langid.words_of(r.text)
        if not words:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        total = np.sum([word(w) for w in words], axis=0)
        fair = np.exp((total - total.max()) * min(len(words), langid.EVIDENCE_WORDS) / len(words))
        assert got[r.doc_id].lang_pred == langs[int(total.argmax())] and abs(got[r.doc_id].score - fair.max() / fair.sum()) < 1e-4


# Classifier


def test_sites_shrink_and_evidence_counts(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        bad = rng.random() < 0.3
        text = " ".join(rng.choices([f"w{k}" for k in "abcdefgh"], k=20)) + (" vile nasty" if bad else " kind")
        rows.append((i, text, f"s{i % 5}", "en"))
        labels.append((i, int(not bad), int(bad and i % 5 == 0)))
    rows += [(900, None, None, None), (901, "", "new", "en"), (902, "vile nasty wa", "s1", "xx"), (None, "kind", "s1", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "1 as id", "'p' as path", "0 as quality")
    marks = spark.createDataFrame([*labels, (5, None, None), (None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classifier.classify(docs, marks.filter("coalesce(doc_id, 0) % 2 = 0")).collect()}
    right = [(got[i].p_quality >= 0.5) == bool(q) for i, q, _ in labels]
    assert sum(right) > 0.98 * len(right) and got[902].p_quality < 0.5
    assert all(0 < r.p_toxic < 1 for r in got.values()) and len(got) == len(rows)
    none = classifier.classify(docs, marks.limit(0)).collect()
    assert all(abs(r.p_quality - 0.5) < 1e-9 for r in none)


def test_strength_follows_the_spread(spark):
    cells = lambda rows: spark.createDataFrame(rows, "k double, n double")
    from pyspark.sql import functions as F

    assert classifier.strength_of(cells([(50.0, 100.0)] * 10), F.lit(0.5)) == classifier.STRONGEST
    assert classifier.strength_of(cells([(0.0, 100.0), (100.0, 100.0)] * 5), F.lit(0.5)) == classifier.WEAKEST


def test_posteriors_against_brute_force(spark):
    """Every probability again: rates of paths drawn to sites and of sites to the whole by the spread of the rates."""
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(9)], k=12)) + rng.choice([" vile", " kind", ""]), rng.choice(["s1", "s2", "s3", None]), rng.choice(["en", "de", None])) for i in range(500)]
    rows += [(900, None, "s1", "en"), (901, "", "new", "xx"), (902, "w1 " * 100_000, "s2", "fr"), (3, rows[3][1], rows[3][2], rows[3][3])]
    marks = {i: (int("vile" not in t), int(rng.random() < (0.5 if s == "s1" else 0.1))) for i, t, s, _ in rows[:400]}
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "1 as site", "2 as rate", "3 as k")
    labels = spark.createDataFrame([(i, *m) for i, m in marks.items()], "doc_id long, quality int, toxic int").selectExpr("*", "1 as text")
    got = {r.doc_id: r for r in classifier.classify(docs, labels, sample=10**6).collect()}
    logit = lambda p: np.log(p / (1 - p))

    def strength(cells, prior):
        p = [min(max(prior(c), 1e-6), 1 - 1e-6) for c in cells]
        excess = sum((k - n * q) ** 2 - n * q * (1 - q) for (k, n), q in zip(cells.values(), p, strict=True))
        room = sum(q * (1 - q) * n * (n - 1) for (_, n), q in zip(cells.values(), p, strict=True))
        return classifier.STRONGEST if not room or excess <= 0 else min(classifier.STRONGEST, max(classifier.WEAKEST, room / excess - 1))

    for t, name in enumerate(("p_quality", "p_toxic")):
        known = [(r, marks[r[0]][t]) for r in rows if r[0] in marks]
        paths, sites = {}, {}
        for r, y in known:
            for cells, key in ((paths, (r[2], r[3])), (sites, r[2])):
                k, n = cells.get(key, (0, 0))
                cells[key] = k + y, n + 1
        rate = (sum(y for _, y in known) + 0.5) / (len(known) + 1)
        a = strength(sites, lambda c: rate)
        site = {c: (k + a * rate) / (n + a) for c, (k, n) in sites.items()}
        b = strength(paths, lambda c: site[c[0]])
        path = {c: (k + b * site[c[0]]) / (n + b) for c, (k, n) in paths.items()}
        linear = classifier.fit_linear([classifier.features(r[1]) for r, _ in known], np.array([y for _, y in known], dtype=float))
        for r in rows:
            shift = logit(path.get((r[2], r[3]), site.get(r[2], rate))) - logit(rate)
            assert abs(logit(got[r[0]][name]) - linear.logit(classifier.features(r[1])) - shift) < 1e-3
