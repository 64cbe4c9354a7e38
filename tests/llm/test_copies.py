import random

import corpus_pipeline as pipeline
import numpy as np
import pytest
from leafmill.llm import simhash

VOCABULARY = [f"w{i}" for i in range(400)]


def near_copies(seed=4):
    """Texts with copies of 1 to 6 changed words, a large group of them, and a line that many texts have."""
    rng = random.Random(seed)
    text = lambda n: [rng.choice(VOCABULARY) for _ in range(n)]

    def edited(words, n):
        out = list(words)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(VOCABULARY)
        return " ".join(out)

    line = text(12)
    bases = [text(rng.choice([8, 40, 90, 200])) for _ in range(25)]
    out = [" ".join(b) for b in bases] + [edited(b, k) for b in bases for k in (1, 3, 6)]
    out += [" ".join(text(30) + line + text(20)) for _ in range(40)]
    hot = text(80)
    out += [edited(hot, k % 4) for k in range(60)] + ["One two", "one TWO", "three", " ", None, None]
    rng.shuffle(out)
    return list(enumerate(out))


def brute(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t in rows}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))]
    while True:
        old = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if old == label:
            return label


@pytest.mark.parametrize("most,crowd", [(1024, 32), (9, 3), (1024, 10**6)])
def test_groups_equal_brute_force(spark, monkeypatch, most, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component for r in simhash.near_copies(docs, most=most).collect()} == brute(rows)


def test_stage_drops_near_copies(spark):
    rows = [(i, t, "en", "s", 0) for i, t in near_copies() if t and t.strip()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute([r[:2] for r in rows])
    kept = [r.doc_id for r in pipeline.one_of_each_group(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_odd_rows(spark):
    rows = [(3, "a b c d e f"), (1, "A b c D e f"), (None, "a b c d e f"), (9, "quite another text than that"), (9, "one more of nine"), (12, "one more of nine"), (7, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as h", "3 as node", "4 as n", "5 as component", "6 as bits_")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component) for r in simhash.near_copies(docs).collect())
    assert got == [(-1, None), (1, 1), (3, 1), (5, 5), (7, 5), (9, 9), (9, 9), (12, 9)]
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_shared_shingles():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 30_000, n)) for n in (0, 5, 900, 20_000, 3, 20_000)]
    i, j = (x.ravel() for x in np.meshgrid(range(6), range(6)))
    assert simhash.shared_shingles(sets, i, j).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]


def test_a_crowd_of_loose_copies(spark):
    """Texts of one template that are mostly under the similarity: every pair is compared, few are linked."""
    rng = random.Random(8)
    base = [rng.choice(VOCABULARY) for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([2, 3, 4, 5])):
            words[k] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and 1 < len(set(got.values())) < 150


def loose_families(rng, families, size, words, changed):
    out = []
    for _ in range(families):
        base = [rng.choice(VOCABULARY) for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for k in rng.sample(range(words), changed):
                w[k] = rng.choice(VOCABULARY)
            out.append(" ".join(w))
    return list(enumerate(out))


def test_sets_are_not_sent_once_a_bucket(spark, monkeypatch):
    """Families whose texts meet in many buckets: a text's set is sent to be compared once at most, not once a bucket."""
    monkeypatch.setattr(simhash, "CROWD", 8)
    sent, real = spark.sparkContext.accumulator(0), simhash._near_and_similar

    def counted(*args):
        run = real(*args)

        def seen(batches):
            for batch in batches:
                sent.add(batch.num_rows)
                yield batch

        return lambda batches: run(seen(batches))

    monkeypatch.setattr(simhash, "_near_and_similar", counted)
    rows = loose_families(random.Random(5), 6, 24, 220, 9)
    got = {r.doc_id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)
    assert sent.value <= len(rows)


def test_sets_in_turns(spark, monkeypatch):
    """Every crowded part is compared with whole sets, a few at a time."""
    for name, value in (("CROWD", 3), ("PAIRS_A_ROW", 0), ("TURN", 1), ("FEW", 7)):
        monkeypatch.setattr(simhash, name, value)
    rows = loose_families(random.Random(6), 2, 20, 120, 4)
    got = {r.doc_id: r.component for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), most=12).collect()}
    assert got == brute(rows)


def test_shuffle_files_go_with_their_statement(spark):
    import time

    from leafmill.sources import scratch

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    written = lambda: sum(f.getName().startswith("shuffle_") for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles()))
    before = written()
    table = scratch.materialise(spark.range(1000).repartition(7, "id"))
    end = time.time() + 10  # files are deleted beside the next statements
    while written() > before and time.time() < end:
        time.sleep(0.1)
    assert written() <= before and table.count() == 1000
    scratch.forget(table)


def test_shingles_of_many_texts_at_once(monkeypatch):
    """Sets of the near copies are made of whole batches, not shingle by shingle, and tell the same shingles apart."""
    import pyarrow as pa

    rng = random.Random(9)
    words = [*VOCABULARY, "É", "\x1c", "a\x00", "a\x00\x00", "12345678", "123456789", "x" * 255, "x" * 256, "x" * 257, "x" * 3000 + "y", "x" * 3000 + "z"]
    texts = [rng.choice(["", " ", "\n"]) + rng.choice([" ", "\t\x0b\r\f", "\n"]).join(rng.choices(words, k=rng.randrange(12))) for _ in range(300)] + [None, "", "A B c", "a b C", " ".join(words), " ".join(words[::-1])]
    want = {}
    for text in texts:
        for h in simhash.shingle_hashes(text, 5).tolist():
            want.setdefault(h, len(want))
    old = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    monkeypatch.setattr(simhash, "shingle_hashes", None)
    for kind in (pa.string(), pa.large_string()):
        for piece in (1, 500, 10**6):
            monkeypatch.setattr(simhash, "PIECE", piece)
            column = pa.array(["before", *texts], kind).slice(1)
            got = [list_.values.to_numpy().view(np.uint64) for batch in simhash._sets(5)(iter([pa.RecordBatch.from_arrays([column], names=["text"])])) for list_ in batch.column(1)]
            assert [len(s) for s in got] == [len(s) for s in old] and all((np.diff(s.astype(object)) > 0).all() for s in got)
            assert len(np.unique(np.concatenate(got))) == len(want)
            for i in range(0, len(texts), 7):
                assert [len(np.intersect1d(got[i], s)) for s in got] == [len(np.intersect1d(old[i], s)) for s in old]


def test_majorities():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 254, 255, 256, 700, 70_000):
        hashes = rng.integers(0, 2**63, n, dtype=np.uint64) | rng.integers(0, 2**63, n, dtype=np.uint64)
        assert simhash.majorities(hashes) == (simhash.majority(hashes), simhash.majority(simhash._second(hashes)))


def test_frequent_shingles_are_told_by_a_share_of_the_documents(spark, monkeypatch):
    """A sample of a fixed number of documents would let buckets grow with the table."""
    monkeypatch.setattr(simhash, "SAMPLE", 10)
    monkeypatch.setattr(simhash, "SHARE", 0.5)
    docs = spark.range(4000).selectExpr("id", "concat_ws(' ', 'a', 'common', 'line', 'of', if(id % 50 = 0, 'words', cast(id as string)), cast(id as string)) as text")
    keys, counts = simhash._frequent(docs, 5)
    assert len(keys) == 1 and 20 <= counts[0] <= 60


def test_small_buckets_give_all_their_pairs():
    """They are done after one comparison; of larger ones only the nearest are linked at first."""
    from fractions import Fraction

    import pyarrow as pa

    fps = pa.array([0, 1, 3, 0, 1, 3], pa.int64())
    node, yes = pa.array(range(6), pa.int64()), pa.array([True] * 6)
    columns = {"key": pa.array([1, 1, 1, 2, 2, 2], pa.int64()), "node": node, "n": pa.array([10] * 6, pa.int64()), "f1": fps, "f2": fps, "c": node, "asks": yes, "small": pa.array([True] * 3 + [False] * 3)}
    near = simhash._near(Fraction(4, 5), 44, False, 64, 16)
    found = [(r["a"], r["b"]) for b in near(iter([pa.RecordBatch.from_pydict(columns)])) for r in b.to_pylist()]
    assert set(found) == {(0, 1), (0, 2), (1, 2), (3, 4), (4, 5)}
