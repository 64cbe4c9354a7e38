"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that may be near meet in a bucket. There they are stored as bit planes, 64 lanes to a machine word;
carry-save counters add up the distances of all lanes at once, and a block is given up as soon as every lane has
passed the radius.

near_duplicates() links by the fingerprints alone: two that differ in two bits at most agree in two of four 16-bit blocks,
which name the bucket; a crowded bucket is cut again by the blocks of the bits that are left.

near_copies() links by the Jaccard similarity of word shingles. Two sets of similarity t or more share one of their first
n - ceil(t n) + 1 shingles, whatever order all sets keep, so a shared first shingle names the bucket; pairs whose
fingerprints are near there are verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import forget, materialise, maybe_broadcast, split_by, table
from leafmill.llm.components import components

SEED = 42
#: The rule of the digests: shingles of three words, two bits.
SHINGLE, RADIUS = 3, 2
#: The rule of the near copies: shingles of five words, four fifths of which are shared.
COPY_SHINGLE, SIMILARITY = 5, 0.8
#: Fingerprints of near copies have two words. Those of sets of similarity 0.8 differ in 19 bits on average (24 in the
#: smallest sets) with a deviation of 4, unrelated ones in 64 with one of 6.
COPY_RADIUS = 44
#: A bucket of more distinct fingerprints is cut.
BLOCK = 1024
#: Rows that are compared as one block, whole buckets, and bytes that may wait to be cut into blocks.
LANES, WAITING = 256, 32_000_000
#: Rounds in which nodes are linked to their nearest ones in other groups before all that is left is compared.
NEAREST_ROUNDS = 4
#: Of a bucket of at most so many nodes all near pairs are taken in the first round, and it is done.
WHOLE = 8
#: A part of a bucket of more rows than CROWD with more near pairs than PAIRS_A_ROW for each of them sends no pairs: its
#: rows are sent again with their whole sets and verified where they are compared.
CROWD, PAIRS_A_ROW = 64, 16
#: Whole sets are sent to be verified in turns of at most TURN times as many as there are, or FEW; a turn's files go after it.
TURN, FEW = 4, 20_000
#: Shingles that are counted at a time when sets are compared as bits.
COLUMNS = 8192
#: Documents whose shingles tell the frequent ones, as a number and as a share of all if that is more, so that buckets do
#: not grow with the table, and how many of these shingles are told apart at most.
SAMPLE, SHARE, FREQUENT = 2000, 0.01, 50_000
#: Rows of a batch, and bytes of text whose words are hashed together.
SLICE, PIECE = 500, 1_000_000
PAIRS = tuple(combinations(range(4), 2))
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Words of more bytes are not hashed eight bytes at a time.
LONG = 256
#: An odd number, by which a hash is taken before the next part of a word comes in.
FIRST = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle of a text, A-Z lower-cased; a text of fewer words is one shingle, null or no word none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, which are counted in slices of bounded memory."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; 0 for a text without words or null."""
    hashes = shingle_hashes(text, shingle)
    return majority(hashes) if len(hashes) else 0


# Bit-sliced comparison


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(n, words) -> (64 * words, lanes / 64): plane b holds bit b of every fingerprint."""
    lanes = -(-len(fps) // 64) * 64
    padded = np.zeros((lanes, fps.shape[1]), dtype="<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, -1), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _beyond(counters: list[list[np.ndarray]], radius: int) -> np.ndarray:
    """Lanes whose count is over the radius. counters[k] holds the planes of weight 2**k, two at most."""
    shape = next(c[0] for c in counters if c)
    total, carry = [], None
    for level in counters:
        planes = [*level, *([] if carry is None else [carry])]
        carry = None
        if len(planes) == 3:
            a, b, c = planes
            half = a ^ b
            total.append(half ^ c)
            carry = (a & b) | (half & c)
        elif len(planes) == 2:
            total.append(planes[0] ^ planes[1])
            carry = planes[0] & planes[1]
        else:
            total.append(planes[0] if planes else np.zeros_like(shape))
    if carry is not None:
        total.append(carry)
    if radius >> len(total):
        return np.zeros_like(shape)
    over, equal = np.zeros_like(shape), np.full_like(shape, ALL)
    for k in range(len(total) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & total[k]
        else:
            over |= equal & total[k]
            equal = equal & ~total[k]
    return over


def near_in_block(rows: np.ndarray, lanes: np.ndarray, allowed: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and a lane that `allowed` (rows x lanes/64, a bit for each lane) lets be compared and whose
    fingerprints, (n, words) each, differ in at most `radius` bits.

    Planes of equal weight are added three at a time into a sum and a carry of double weight. Now and then the counts
    so far are looked at: when no allowed lane is within the radius any more, the block is given up."""
    planes, counters = bit_planes(lanes), [[]]
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if not allowed.any():
        return none
    for b in range(64 * rows.shape[1]):
        mine = np.where((rows[:, b >> 6] >> np.uint64(b & 63)) & np.uint64(1), ALL, np.uint64(0))
        plane, level = planes[b][None, :] ^ mine[:, None], 0
        while True:
            here = counters[level]
            here.append(plane)
            if len(here) < 3:
                break
            x, y, z = here
            half = x ^ y
            counters[level] = [half ^ z]
            plane = (x & y) | (half & z)
            level += 1
            if level == len(counters):
                counters.append([])
        if b % 32 == 31 and (near := allowed & ~_beyond(counters, radius)) is not None and not near.any():
            return none
    return np.nonzero(np.unpackbits(np.ascontiguousarray(near).view(np.uint8), axis=1, bitorder="little"))


def _mask(ok: np.ndarray) -> np.ndarray:
    """(rows, lanes) of booleans as bits, lanes filled up to whole words."""
    return np.packbits(np.pad(ok, ((0, 0), (0, -ok.shape[1] % 64))), axis=1, bitorder="little").view("<u8")


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n items linked by a and b, the least item that each reaches."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _blocks(batches: Iterator[pa.RecordBatch], lanes: int = LANES) -> Iterator[pa.Table]:
    """Rows sorted by their first column, in blocks of whole buckets and about `lanes` rows (or one larger bucket)."""
    held: pa.Table | None = None

    def cut(whole: pa.Table, last: bool) -> Iterator[pa.Table]:
        keys = whole.column(0).to_numpy()
        at, end = 0, len(keys) if last else int(np.searchsorted(keys, keys[-1], side="left"))
        while at < end:
            to = min(at + lanes, end)
            if to < len(keys):
                first = int(np.searchsorted(keys, keys[to], side="left"))
                to = first if first > at else int(np.searchsorted(keys, keys[at], side="right"))
            yield whole.slice(at, to - at)
            at = to
        nonlocal held
        held = whole.slice(end) if end < len(keys) else None

    for batch in batches:
        held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        if held.num_rows >= 16 * lanes or held.nbytes >= WAITING:
            yield from cut(held, False)
    if held is not None and held.num_rows:
        yield from cut(held, True)


def _columns(block: pa.Table) -> list[np.ndarray]:
    return [block.column(c).to_numpy() for c in range(block.num_columns)]


# Links by the fingerprints alone


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def _link(radius: int):
    """Rows (key, fp, rep) sorted by key -> links of rep to the least rep of its group within a block of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            keys, fps, reps = _columns(block)
            fps = fps.view(np.uint64)[:, None]
            ahead = (keys[:, None] == keys[None, :]) & (np.arange(len(keys))[None, :] > np.arange(len(keys))[:, None])
            i, j = near_in_block(fps, fps, _mask(ahead), radius)
            if len(i):
                order = np.argsort(reps, kind="stable")
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                label = least_labels(len(reps), place[i], place[j])
                moved = np.nonzero(label != np.arange(len(reps)))[0]
                ranked = reps[order]
                yield pa.RecordBatch.from_arrays([pa.array(ranked[label[moved]]), pa.array(ranked[moved])], names=["a", "b"])

    return run


def links(distinct: DataFrame, most: int = BLOCK) -> DataFrame:
    """(fp, rep) with distinct fp and rep -> links (a, b) between reps enough to connect all within RADIUS bits.

    Two differing bits touch two of four blocks, so the pair agrees in the two others. A bucket of over `most` is cut by
    four blocks of the bits that its members need not share, 8 bits wide and then 4, after which a bucket holds 256
    fingerprints at most: no pair within the radius is parted, whatever the bucket's size."""
    parts = max(1, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows, found, used = distinct.select("fp", "rep", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key")), [], []
    for width in (16, 8, 4):
        part = [F.shiftrightunsigned("rest", width * i).bitwiseAND(F.lit((1 << width) - 1).cast("long")) for i in range(4)]
        cells = []
        for n, (i, j) in enumerate(PAIRS):
            k, m = (x for x in range(4) if x not in (i, j))
            cells.append(F.struct(F.xxhash64("key", F.lit(n), part[i], part[j]).alias("key"), F.shiftleft(part[k], width).bitwiseOR(part[m]).alias("rest")))
        cut = rows.select("fp", "rep", F.explode(F.array(*cells)).alias("cell")).select("fp", "rep", "cell.key", "cell.rest")
        crowds = cut.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
        met = materialise(cut.join(crowds, "key"))
        used.append(met)
        usual = met if width == 4 else met.filter(F.col("n") <= most)
        found.append(materialise(usual.select("key", "fp", "rep").repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_link(RADIUS), "a long, b long")))
        rows = met.filter(F.col("n") > most).select("fp", "rep", "rest", "key")
        if width == 4 or not rows.limit(1).count():
            break
    forget(*used)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    return whole


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, fp (signed long), component (least id reachable over links of two bits or fewer).

    Equal fingerprints are one node, so any number of copies costs one comparison. A null or empty text has
    fingerprint 0 and is linked like any other; a long text is hashed whole. Rows of equal id are one document with
    several fingerprints; a row of null id keeps null as component and links nothing. Other columns are ignored,
    whatever their names. An empty table gives no rows."""
    # Row ids may repeat; nodes are ids, and every id that has a fingerprint is tied to that fingerprint's least id.
    fps = materialise(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints, "id long, fp long"))
    known = fps.filter("id is not null")
    distinct = materialise(known.groupBy("fp").agg(F.min("id").alias("rep")))
    same_id = known.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").join(known, "id").join(distinct, "fp")
    edges = links(distinct).unionAll(same_id.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    groups = components(edges)
    label = distinct.join(groups, distinct["rep"] == groups["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    found = fps.join(label, "fp", "left")
    return found.select(F.col("id").alias(id_col), "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


# Links by the similarity of shingles


def _second(hashes: np.ndarray) -> np.ndarray:
    """Other bits of the same shingles, for the second word of a fingerprint."""
    return _stirred(hashes)


def _stirred(hashes: np.ndarray) -> np.ndarray:
    """A reversible mix of 64 bits."""
    x = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majorities(hashes: np.ndarray) -> tuple[int, int]:
    """The bits set in over half of the hashes, and of their second words: ones are added up in bytes, 255 rows at a time."""
    ones = np.zeros(128, dtype=np.int64)
    for at in range(0, len(hashes), 65_280):
        part = hashes[at : at + 65_280]
        bits = np.unpackbits(np.stack([part, _second(part)], axis=1).astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        ones += np.add.reduce(bits[:whole].reshape(-1, 255, 128), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += np.add.reduce(bits[whole:], axis=0, dtype=np.uint8)
    return tuple(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8").tolist())


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """For each text its distinct word shingles as 64-bit hashes in increasing order; words as in shingle_hashes().

    All words of some texts are hashed at once; a shingle is the sum of its words' hashes, each times a number of its
    place, stirred."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + PIECE, side="right")))
        yield from _piece(texts.slice(at, to - at), shingle)
        at = to


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings without nulls: eight bytes at a time are added and stirred in, a step that parts whatever
    differs; the length comes first. Words of over LONG bytes have their XXH64."""
    kind = np.int64 if pa.types.is_large_string(words.type) else np.int32
    _, places, data = words.buffers()
    places = np.frombuffer(places, dtype=kind)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    raw = np.frombuffer(b"" if data is None else data, dtype=np.uint8)[places[0] : places[-1]]
    raw = np.concatenate([raw, np.zeros(8, dtype=np.uint8)])
    eights = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    at, left = places[:-1] - places[0], np.diff(places)
    found, which = _stirred(left.astype(np.uint64) + FIRST), np.nonzero((left > 0) & (left <= LONG))[0]
    for k in np.nonzero(left > LONG)[0]:
        found[k] = xxhash.xxh64_intdigest(raw[at[k] : at[k] + left[k]].tobytes(), SEED)
    while len(which):
        here = np.minimum(left[which], 8).astype(np.uint64)
        part = eights[at[which]] & (ALL >> (np.uint64(64) - np.uint64(8) * here))
        found[which] = _stirred(found[which] * FIRST + part)
        at[which] += 8
        left[which] -= 8
        which = which[left[which] > 0]
    return found


def _piece(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    flat = lists.flatten()
    words, sizes = _word_hashes(flat), pc.binary_length(flat).to_numpy(zero_copy_only=False)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    places = np.array([xxhash.xxh64_intdigest(b"%d" % k, SEED) | 1 for k in range(shingle + 1)], dtype=np.uint64)
    sums = np.full(max(0, len(words) - shingle + 1), np.uint64(shingle) * places[shingle], dtype=np.uint64)
    for k in range(shingle):
        sums += words[k : k + len(sums)] * places[k]
    whole = _stirred(sums)
    for n, end in zip(counts.tolist(), counts.cumsum().tolist(), strict=True):
        start = end - n
        if not n or not sizes[start]:  # a text without words is one empty word here
            yield np.empty(0, dtype=np.uint64)
        elif n < shingle:
            yield _stirred((words[start:end] * places[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n) * places[shingle : shingle + 1])
        else:
            s = np.sort(whole[start : end - shingle + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]


def _node(s: np.ndarray) -> int:
    """Equal sets are one node."""
    return xxhash.xxh3_64_intdigest(s.astype("<u8").tobytes(), SEED) - (1 << 63)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of bounded memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _sets(shingle: int):
    """(text) -> (node, set): the distinct shingles in increasing order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = list(shingle_sets(batch.column(0), shingle))
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in found], pa.int64()), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["node", "set"])

    return run


def _firsts(shingle: int, t: Fraction, frequent):
    """(id, text) -> (id, node, n, f1, f2, firsts): size, fingerprint and first shingles of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = frequent.value
        for batch in _slices(batches):
            nodes, sizes, f1, f2, firsts = [], [], [], [], []
            for s in shingle_sets(batch.column(1), shingle):
                nodes.append(_node(s))
                sizes.append(len(s))
                for f, bits in zip((f1, f2), majorities(s), strict=True):
                    f.append(bits)
                ordered = s
                if len(s) and len(keys):
                    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
                    if (hit := keys[at] == s).any():
                        ordered = np.concatenate([s[~hit], s[hit][np.argsort(counts[at[hit]], kind="stable")]])
                firsts.append(ordered[: len(s) + 1 + (-t.numerator * len(s) // t.denominator)].view(np.int64))
            words = [pa.array(np.array(f, dtype=np.uint64).view(np.int64)) for f in (f1, f2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *words, pa.array(firsts, pa.list_(pa.int64()))], names=["id", "node", "n", "f1", "f2", "firsts"])

    return run


def _frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several documents of a sample, sorted, and in how many they are. They come last in the order of the
    shingles; the sample decides how full buckets are, never which pairs are found."""
    share = min(1.0, max(SHARE, SAMPLE / max(1, docs.count())))
    some = docs.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(share * 1_000_000)).select("text")
    each = some.mapInArrow(_sets(shingle), "node long, set array<long>").select(F.explode("set").alias("h"))
    found = each.groupBy("h").agg(F.count("*").alias("n")).filter("n > 2").orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    keys, counts = found.column("h").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def _near(t: Fraction, radius: int, all_pairs: bool, crowd: int, most: int):
    """(key, node, n, f1, f2, c, asks, small) sorted by key -> pairs (a, b) of nodes of one key and different c, one of
    which asks, whose sizes allow the similarity and whose fingerprints are near: all of them, or in keys that are not
    small of each node that with the nearest other and that with the nearest one before it. Where all are asked for and a key of more than `crowd` rows has
    more than `most` pairs a row, the key comes instead of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            key, node, n, f1, f2, c = _columns(block.select(range(6)))
            asks = np.nonzero(block.column(6).to_numpy(zero_copy_only=False))[0]
            small = block.column(7).to_numpy(zero_copy_only=False)
            fps = np.stack([f1, f2], axis=1).view(np.uint64)
            names, which, rows = np.unique(key, return_inverse=True, return_counts=True)
            for at in range(0, len(asks), BLOCK):
                q = asks[at : at + BLOCK]
                ok = (key[q][:, None] == key[None, :]) & (c[q][:, None] != c[None, :])
                ok &= t.denominator * np.minimum(n[q][:, None], n[None, :]) >= t.numerator * np.maximum(n[q][:, None], n[None, :])
                i, j = near_in_block(fps[q], fps, _mask(ok), radius)
                if not len(i):
                    continue
                i, dense = q[i], np.empty(0, dtype=np.int64)
                if all_pairs:
                    many = (np.bincount(which[i], minlength=len(names)) > most * rows) & (rows > crowd)
                    dense, sparse = names[many], ~many[which[i]]
                    i, j = i[sparse], j[sparse]
                else:
                    far = np.bitwise_count(fps[i] ^ fps[j]).sum(axis=1)
                    kept = [np.nonzero(small[i] & (j < i))[0]]
                    for use in (np.nonzero(~small[i])[0], np.nonzero(~small[i] & (j < i))[0]):
                        order = use[np.lexsort((j[use], far[use], i[use]))]
                        kept.append(order[np.diff(i[order], prepend=-1) != 0])
                    kept = np.unique(np.concatenate(kept))
                    i, j = i[kept], j[kept]
                a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                none = lambda k: pa.nulls(k, pa.int64())
                if len(a):
                    yield pa.RecordBatch.from_arrays([none(len(a)), pa.array(a), pa.array(b)], names=["dense", "a", "b"])
                if len(dense):
                    yield pa.RecordBatch.from_arrays([pa.array(dense), none(len(dense)), none(len(dense))], names=["dense", "a", "b"])

    return run


def shared_shingles(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The number of common elements of the sets i and j, pair by pair: the sets as rows of bits, some columns at a time."""
    _, rank = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(rank, kind="stable")
    rank, row, found = rank[order], row[order], np.zeros(len(i), dtype=np.int64)
    for low in range(0, int(rank[-1]) + 1 if len(rank) else 0, COLUMNS):
        a, b = np.searchsorted(rank, [low, low + COLUMNS])
        here, place = np.unique(row[a:b], return_inverse=True)
        bits = np.zeros((len(here) + 1, COLUMNS), dtype=bool)  # the last row stands for sets without any of them
        bits[place, rank[a:b] - low] = True
        bits = np.packbits(bits, axis=1).view("<u8")
        at = np.full(len(sets), len(here))
        at[here] = np.arange(len(here))
        for k in range(0, len(i), 16_384):
            found[k : k + 16_384] += np.bitwise_count(bits[at[i[k : k + 16_384]]] & bits[at[j[k : k + 16_384]]]).sum(axis=1, dtype=np.int64)
    return found


def _near_and_similar(t: Fraction, radius: int):
    """(key, node, n, f1, f2, c, asks, set) sorted by key -> links enough to connect all nodes of one key and different c,
    one of which asks, that are near and similar. Pairs never leave the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            key, node, n, f1, f2, c = _columns(block.select(range(6)))
            asks = np.nonzero(block.column(6).to_numpy(zero_copy_only=False))[0]
            sets = [x.values.to_numpy(zero_copy_only=False) for x in block.column(7)]
            fps = np.stack([f1, f2], axis=1).view(np.uint64)
            for at in range(0, len(asks), BLOCK):
                q = asks[at : at + BLOCK]
                ok = (key[q][:, None] == key[None, :]) & (c[q][:, None] != c[None, :])
                ok &= t.denominator * np.minimum(n[q][:, None], n[None, :]) >= t.numerator * np.maximum(n[q][:, None], n[None, :])
                i, j = near_in_block(fps[q], fps, _mask(ok), radius)
                if not len(i):
                    continue
                i = q[i]
                both = shared_shingles(sets, i, j)
                real = t.denominator * both >= t.numerator * (n[i] + n[j] - both)
                nodes, place = np.unique(np.concatenate([node[i[real]], node[j[real]]]), return_inverse=True)
                label = least_labels(len(nodes), place[: len(place) // 2], place[len(place) // 2 :])
                moved = np.nonzero(label != np.arange(len(nodes)))[0]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[label[moved]]), pa.array(nodes[moved])], names=["a", "b"])

    return run


def _turns(rows: DataFrame, by: str, sent: int, nodes: int) -> Iterator[DataFrame]:
    """rows, which send `sent` sets of `nodes` nodes, in parts by the hash of a column that send few enough at a time."""
    turns = max(1, -(-sent // max(FEW, TURN * nodes)))
    for k in range(turns):
        yield rows.filter(F.pmod(F.xxhash64(by, F.lit("turn")), F.lit(turns)) == k) if turns > 1 else rows


def _all_of(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionAll(more)
    return whole


def _verified(pairs: DataFrame, sets_of, t: Fraction) -> DataFrame:
    """Of written different pairs (a, b) of nodes those whose sets have the similarity t or more, written."""
    held = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    both, found = F.size(F.array_intersect("x", "y")), []
    for some in _turns(pairs, "a", pairs.count(), held.count()):
        met = some.join(held.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(held.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
        found.append(materialise(met.filter(t.denominator * both >= t.numerator * (F.size("x") + F.size("y") - both)).select("a", "b")))
    forget(held)
    return _all_of(found)


def similar(met: DataFrame, sets_of, t: Fraction, radius: int = COPY_RADIUS, most: int = BLOCK) -> DataFrame:
    """(h, node, n, f1, f2, m), a row for each first shingle of a node with the number of nodes that have it, and a function that reads the sets of nodes ->
    links enough to connect all nodes of similarity t or more.

    Buckets of at most WHOLE nodes are compared once. For the others, first some rounds: each node is linked to its nearest ones outside its group in each bucket, a crowded bucket being
    cut by a hash that differs from bucket to bucket and round to round, with two of its members in every part. What this
    joins needs no more comparison: then the members that are outside the largest group of their bucket are compared with
    all of the bucket that are not linked to them by now, block by block, by their fingerprints. The near pairs, most of
    which come from many buckets, are verified once each; where they are too many for that, as in a large family of loose
    copies, the rows are compared again with their sets, so that pairs, a square of its size, never become rows. Sets are
    sent in turns, so the disk they take is a few times what they have, however many pairs and buckets there are."""
    spark = met.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    near = lambda rows, all_pairs: rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_near(t, radius, all_pairs, CROWD, PAIRS_A_ROW), "dense long, a long, b long").distinct()
    row = ["node", "n", "f1", "f2"]
    place = lambda n, *seeds: F.pmod(F.xxhash64("node", *seeds), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = met.withColumn("small", F.col("m") <= min(WHOLE, most)).drop("m")
    links_, live, groups = None, met.withColumn("c", F.col("node")), None
    for turn in range(NEAREST_ROUNDS):
        mark = lambda seed, turn=turn: F.struct(F.xxhash64("node", "h", F.lit(2 * turn + seed)), *row, "c")
        crowds = materialise(live.groupBy("h").agg(F.count("*").alias("m"), F.min(mark(0)).alias("p1"), F.min(mark(1)).alias("p2")).filter(F.col("m") > most).withColumn("cuts", F.ceil(F.col("m") / most).cast("int")))
        cut = live.join(maybe_broadcast(crowds.select(F.col("h").alias("h_"), "cuts")), F.col("h") == F.col("h_"), "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
        own = cut.select(F.xxhash64("h", place("cuts", F.col("h"), F.lit(turn))).alias("key"), *row, "c", "small")
        leads = crowds.withColumn("cut", every("cuts")).withColumn("p", F.explode(F.array("p1", "p2")))
        rows = own.unionAll(leads.select(F.xxhash64("h", F.col("cut").cast("int")).alias("key"), *[F.col(f"p.{x}") for x in (*row, "c")], F.lit(False).alias("small")))
        pairs = materialise(near(rows.select("key", *row, "c", F.lit(True).alias("asks"), "small"), False).select("a", "b"))
        if not turn:
            # Who is near nobody in any bucket that was compared whole is done.
            some = pairs.select(F.explode(F.array("a", "b")).alias("x_")).unionAll(cut.filter("cuts > 1").select("node")).distinct()
            met = materialise(met.filter("not small").join(some, F.col("node") == F.col("x_"), "left_semi"))
        new = _verified(pairs, sets_of, t)
        forget(pairs)
        links_ = new if links_ is None else links_.unionAll(new)
        label = materialise(components(links_))
        # Only buckets in which there is more than one group by now are looked at again.
        named = met.join(label, "node", "left").select("h", *row, F.coalesce("component", "node").alias("c"), "small")
        cells = named.groupBy("h", "c").agg(F.count("*").alias("k"))
        open_ = cells.groupBy("h").agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("m"), F.count("*").alias("groups")).filter("groups > 1")
        open_ = materialise(open_.select(F.col("h").alias("h_"), F.col("top.c").alias("big"), F.col("top.k").alias("k"), "m", "groups"))
        before, live = live, materialise(named.join(open_, F.col("h") == F.col("h_")).drop("h_"))
        forget(before, crowds, label, open_)
        open_pairs = live.select("h", "m", "k").distinct().agg(F.sum((F.col("m") - F.col("k")) * F.col("m")).alias("x")).first().x or 0
        if not open_pairs or (groups is not None and open_pairs > groups / 2):
            break
        groups = open_pairs

    # A grid for each bucket: all of it in cuts, those outside its largest group also in slices.
    sized = live.withColumn("cuts", F.ceil(F.col("m") / most).cast("int")).withColumn("slices", F.ceil((F.col("m") - F.col("k")) / most).cast("int"))
    told = sized.withColumn("cut", place("cuts", F.lit(3))).withColumn("slice", every("slices")).select(F.xxhash64("h", "cut", "slice").alias("key"), *row, "c", F.lit(False).alias("asks"))
    ask = sized.filter("c != big").withColumn("slice", place("slices", F.lit(4))).withColumn("cut", every("cuts")).select(F.xxhash64("h", "cut", "slice").alias("key"), *row, "c", F.lit(True).alias("asks"))
    cells = told.unionAll(ask)
    seen = materialise(near(cells.withColumn("small", F.lit(False)), True))
    rest = _verified(seen.filter("dense is null").select("a", "b"), sets_of, t)
    crowded = materialise(cells.join(seen.filter("dense is not null").select(F.col("dense").alias("key")), "key", "left_semi"))
    held = sets_of(crowded.select("node").distinct())
    sets = held.select(F.col("node").alias("node_"), "set")
    last = []
    for some in _turns(crowded, "key", crowded.count(), held.count()):
        whole = some.join(sets, F.col("node") == F.col("node_")).drop("node_")
        last.append(materialise(whole.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_near_and_similar(t, radius), "a long, b long").distinct()))
    forget(seen, crowded, held, live, met)
    return links_.unionAll(rest).unionAll(_all_of(last))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = COPY_SHINGLE, similarity: float = SIMILARITY, radius: int = COPY_RADIUS, most: int = BLOCK) -> DataFrame:
    """One row per row of docs: id, component (least id reachable over links of two texts whose sets of word shingles
    have a Jaccard similarity of `similarity` or more).

    Words are split at white space and lower-cased as in the digests. A null or empty text has the empty set, which is
    linked to its like only; a long text is read whole. Rows of equal id are one document; a row of null id keeps null and
    links nothing. Other columns are ignored, whatever their names. An empty table gives no rows. Buckets of any size
    are compared whole. A pair exactly at the similarity is missed if its fingerprints differ in over `radius` bits,
    less than once in 100,000 such pairs of the shortest texts and once in 10**9 of others."""
    t = Fraction(str(similarity))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(base, shingle))
    rows = materialise(base.mapInArrow(_firsts(shingle, t, frequent), "id long, node long, n long, f1 long, f2 long, firsts array<long>"))
    known = rows.filter("id is not null")
    # Nodes are sets; of each the least id is read again for its whole set.
    nodes = materialise(known.groupBy("node").agg(F.min("id").alias("rep")))
    one = known.join(nodes.select(F.col("node").alias("node_"), "rep"), (F.col("node") == F.col("node_")) & (F.col("id") == F.col("rep"))).dropDuplicates(["node", "id"])
    one = materialise(one.select("node", "n", "f1", "f2", "firsts"))
    # Exploded when it is read: as files the rows would be a multiple of the texts.
    spread = one.select(F.explode("firsts").alias("h"), "node", "n", "f1", "f2")
    shared = materialise(spread.groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("m")).filter("low < high").select(F.col("h").alias("h_"), "m"))
    may, _ = split_by(spread, "h", shared, "h_")
    met = materialise(may.join(shared, F.col("h") == F.col("h_")).drop("h_"))
    slim = materialise(rows.select("id", "node"))
    forget(rows, one, shared)
    known = slim.filter("id is not null")

    def sets_of(few: DataFrame) -> DataFrame:
        few = materialise(few)
        ids = materialise(few.join(nodes, "node").select(F.col("rep").alias("id_")).distinct())
        may, _ = split_by(base, "id", ids, "id_")
        found = materialise(may.select("text").mapInArrow(_sets(shingle), "node long, set array<long>").join(few, "node", "left_semi").dropDuplicates(["node"]))
        forget(few, ids)
        return found

    links_ = similar(met, sets_of, t, radius, most)
    forget(met)
    # Several texts of one id are tied to each other.
    same_id = known.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").join(known.select("id", "node"), "id").select("a", F.col("node").alias("b"))
    groups = components(links_.unionAll(same_id))
    named = nodes.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = named.groupBy("c").agg(F.min("rep").alias("least"))
    label = named.join(least, "c").select("node", "least")
    found = materialise(known.select("id", "node").join(label, "node").select(F.col("id").alias(id_col), F.col("least").alias("component")).unionAll(slim.filter("id is null").select(F.col("id").alias(id_col), F.lit(None).cast("long").alias("component"))))
    forget(slim, nodes)
    return found


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
