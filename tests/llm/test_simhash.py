import numpy as np
import pytest
import xxhash

from leafmill.llm import simhash


def brute(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode().split() if text else []
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "A b C d", "x y z " * 40, "Élan ÉÀ b c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 5, 44, 200])
@pytest.mark.parametrize("words", [1, 2])
def test_bit_slices_equal_popcounts(radius, words):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, (40, words), dtype=np.uint64)
    fps = np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(2**40 + 2), base ^ np.uint64(7), base ^ np.uint64(2**20 - 1)])
    rows, ok = fps[::3], rng.random((len(fps[::3]), len(fps))) < 0.5
    i, j = simhash.near_in_block(rows, fps, simhash._mask(ok), radius)
    far = np.bitwise_count(rows[:, None] ^ fps[None, :]).sum(axis=2)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero((far <= radius) & ok)), strict=True))


def reach(ids, fps, radius=2):
    label = dict(zip(ids, ids, strict=True))
    for _ in ids:
        for a, fa in zip(ids, fps, strict=True):
            for b, fb in zip(ids, fps, strict=True):
                if bin(fa ^ fb).count("1") <= radius:
                    label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("most", [1024, 4])
def test_links_connect_all_within_radius(spark, most):
    rng = np.random.default_rng(2)
    fps = [int(x) for x in rng.integers(0, 2**62, 12)]
    fps += [fps[0] ^ (1 << k) for k in range(40)] + [fps[3] ^ (i << 20 | i << 8) for i in range(40)] + [fps[1] ^ 3, fps[1] ^ 15, fps[1] ^ 63, fps[2] ^ (1 << 61)]
    fps = list(dict.fromkeys(fps))
    rows = [(f, i) for i, f in enumerate(fps)]
    edges = simhash.links(spark.createDataFrame(rows, "fp long, rep long"), most)
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    want = reach(range(len(fps)), fps)
    assert {i: got.get(i, i) for i in range(len(fps))} == want


def test_query_shape_and_odd_rows(spark):
    rows = [(3, "A b c d e f"), (1, "a B c d E f"), (7, None), (5, ""), (None, "a b c d e f"), (9, "quite another text than that one"), (9, "quite another text than that one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as component", "'x' as id")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component) for r in simhash.near_duplicates(docs).collect())
    assert got == [(-1, None), (1, 1), (3, 1), (5, 5), (7, 5), (9, 9), (9, 9)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_text_is_hashed_whole():
    words = [f"w{i % 977} " for i in range(200_000)]
    text = "".join(words)
    hashes = np.array([xxhash.xxh64_intdigest("".join(words[i : i + 3]).strip(), seed=42) for i in range(len(words) - 2)], dtype=np.uint64)
    ones = ((hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(hashes))
