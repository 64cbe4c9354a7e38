import random

import numpy as np
import pytest

from leafmill.llm import substring


def brute(rows, window):
    first = {}
    split = [(i, t.encode().split() if t else []) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        out.append((i, b" ".join(x for p, x in enumerate(w) if p not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=str)


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["é", " x"]
    passage = " ".join(rng.choice(words) for _ in range(14))
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        if i % 2:
            text += "  \n" + passage + "\t" + " ".join(rng.choice(words) for _ in range(rng.randrange(0, 8)))
        rows.append((i * 3, text))
    rows += [(500, rows[7][1]), (501, rows[7][1]), (501, rows[9][1]), (501, rows[9][1]), (502, None), (503, ""), (None, rows[7][1]), (504, "a " * 300), (505, "a " * 200)]
    return rows


@pytest.mark.parametrize("crowd", [1, 3, 20, 4096])
def test_against_brute_force(spark, crowd):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mini", "'x' as spans", "2 as id", "3 as tag").repartition(5)
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in substring.deduplicate(df, window=6, gram=3, longer=4, crowd=crowd).collect()), key=str)
    assert got == brute(rows, 6)


def test_layout_and_empty(spark):
    rows = [(1, "a b c d e f"), (2, "x  y\na b c d e f\tz"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' as source")
    got = {r.doc_id: (r.text, r.source) for r in substring.deduplicate(df, columns=("source",), window=6, gram=3, layout="original").collect()}
    assert got == {1: ("a b c d e f", "s"), 2: ("x  y\nz", "s"), 3: (None, "s")}
    assert substring.deduplicate(df.limit(0)).count() == 0


def test_first_owners_survives_digest_collisions(monkeypatch):
    strings, owners = [b"a b c d", b"b c d a", b"a b c x"], np.array([5, 3, 9])
    of, inside, first = substring.first_owners(strings, owners, 3)
    want = {(0, 0): 5, (0, 1): 3, (1, 0): 3, (1, 1): 3, (2, 0): 5, (2, 1): 9}
    assert {(int(a), int(b)): int(c) for a, b, c in zip(of, inside, first, strict=True)} == want
    monkeypatch.setattr(substring, "_digests", lambda h, s, e, b: np.zeros(len(s), dtype=np.uint64))
    of, inside, first = substring.first_owners(strings, owners, 3)
    assert {(int(a), int(b)): int(c) for a, b, c in zip(of, inside, first, strict=True)} == want


def test_crowded_minimisers_and_very_long_texts(spark):
    """One minimiser with thousands of strings, and a text of a million words that are all the same."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(20)]
    rows = [(i, " ".join([*(f"l{rng.randrange(99)}" for _ in range(rng.randrange(3, 12))), *common, *(f"r{rng.randrange(99)}" for _ in range(rng.randrange(3, 12)))])) for i in range(900)]
    rows += [(2000 + k, rows[k][1] + " and more") for k in range(0, 900, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in substring.deduplicate(df, window=25, gram=4, longer=8, crowd=50).collect()), key=str)
    assert got == brute(rows, 25)
    one = "la " * 1_000_000
    long = spark.createDataFrame([(1, "la " * 60), (2, one), (3, " ".join(f"w{i}" for i in range(600_000))), (4, f"x w7 {' '.join(f'w{i}' for i in range(500, 600))} y")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring.deduplicate(long).select("doc_id", "n_words", "n_removed").collect()}
    assert got == {1: (60, 0), 2: (1_000_000, 1_000_000), 3: (600_000, 0), 4: (103, 100)}
    h = np.zeros(1_000_000, dtype=np.uint64)
    assert substring.super_kmers(h, np.array([1_000_000]))[2].max() == substring.WINDOW - substring.GRAM + 1
