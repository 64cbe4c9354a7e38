"""Substring dedup by super-k-mers of words.

A window is K consecutive words. Its minimiser is the least hash among its M-word grams, so equal windows have equal
minimisers. Consecutive windows of one text with the same minimiser form a super-k-mer, of K - M + 1 windows at most.
Only digests travel first: they show which minimisers occur in two documents, and which super-k-mers there are equal as
wholes (by 64 bits of the minimiser and 64 of the words). Where different super-k-mers share a minimiser, each distinct
one is sent once, as one packed string, to its minimiser's bucket; there the windows of all strings are sorted and
compared word by word, which gives each window's first document exactly. A crowded bucket's strings are cut again by a
second minimiser over longer grams, and what is crowded even then into windows, which are compared as strings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import forget, materialise, maybe_broadcast, split_by, table

WINDOW = 50
GRAM = 8
#: Words of the grams of the second minimiser.
LONGER_GRAM = 24
#: A bucket of more strings is cut by the next minimiser, so that none is left to a single task.
CROWD = 512
#: Strings and bytes of the buckets that are sorted together.
ROWS, BYTES = 4096, 4_000_000
#: Words handled as one array.
SLICE = 500_000
CACHE = 1_000_000

A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _inverse(x: np.uint64) -> np.uint64:
    """Of an odd number modulo 2**64."""
    return np.uint64(pow(int(x), -1, 1 << 64))


def _powers(x: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, x, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * A
    x = (x ^ (x >> np.uint64(29))) * B
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """word -> 64-bit hash, kept for the words met so far, within bounds."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _digests(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of each run h[start:end], whatever stands before it."""
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * _powers(base, len(h)), dtype=np.uint64)])
    back = _powers(_inverse(base), len(h) + 1)
    return _mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * C)


def super_kmers(h: np.ndarray, sizes: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Word hashes of texts laid end to end -> text number, first window in the text, number of windows, minimiser
    and digest of every super-k-mer."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    counts = np.maximum(sizes - window + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = np.zeros(len(h) - gram + 1, dtype=np.uint64)
    for j in range(gram):
        grams = grams * C + h[j : len(h) - gram + 1 + j]
    least, width, want = _mixed(grams), 1, window - gram + 1
    while width < want:
        step = min(width, want - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    text = np.repeat(np.arange(len(sizes)), counts)
    before = np.concatenate([[0], np.cumsum(counts)])[:-1]
    inside = np.arange(total) - before[text]
    at = offsets[text] + inside
    mini = least[at]
    new = np.ones(total, dtype=bool)
    new[1:] = (mini[1:] != mini[:-1]) | (text[1:] != text[:-1])
    # Where one word is repeated the minimiser never changes; such a run is cut into pieces of bounded size.
    order = np.arange(total)
    new |= (order - np.maximum.accumulate(np.where(new, order, 0))) % want == 0
    first = np.nonzero(new)[0]
    n = np.diff(np.concatenate([first, [total]]))
    start = at[first]
    return text[first], inside[first], n, mini[first], _digests(h, start, start + n + window - 1, A)


def _slices(batches: Iterator[pa.RecordBatch], column: int, hashes: WordHashes):
    """Groups of rows with about SLICE words: (batch, rows, hashes of all words, words in each row)."""
    for batch in batches:
        rows, parts, n = [], [], 0
        for i, text in enumerate(batch.column(column)):
            value = text.as_py()
            h = hashes.of(value.encode("utf-8", "surrogatepass").split()) if value else np.empty(0, dtype=np.uint64)
            rows.append(i)
            parts.append(h)
            n += len(h)
            if n >= SLICE:
                yield batch, np.array(rows), np.concatenate(parts), np.array([len(p) for p in parts])
                rows, parts, n = [], [], 0
        if n:
            yield batch, np.array(rows), np.concatenate(parts), np.array([len(p) for p in parts])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _occurrences(window: int, gram: int):
    """(id, tag, text) -> a row for each super-k-mer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, h, sizes in _slices(batches, 2, WordHashes()):
            text, pos, n, mini, digest = super_kmers(h, sizes, window, gram)
            of = pa.array(rows[text])
            yield pa.RecordBatch.from_arrays(
                [_signed(mini), _signed(digest), batch.column(0).take(of), batch.column(1).take(of), pa.array(pos.astype(np.int32)), pa.array(n.astype(np.int32))], names=["mini", "digest", "id", "tag", "pos", "n"]
            )

    return run


#: Strings on their way: the bucket, the super-k-mer they come from, its owner, and where in it they begin.
SENT = "key long, mini long, digest long, owner long, off int, packed binary"


def _sent(key: np.ndarray, mini, digest, owner, off: np.ndarray, strings: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_signed(key), mini, digest, owner, pa.array(off.astype(np.int32)), pa.array(strings, pa.binary())], names=["key", "mini", "digest", "owner", "off", "packed"])


def _packed(window: int, gram: int):
    """(id, wanted, text) -> the packed string of each super-k-mer of the text whose digest is wanted, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for i in range(batch.num_rows):
                words = batch.column(2)[i].as_py().encode("utf-8", "surrogatepass").split()
                h = hashes.of(words)
                _, pos, n, mini, digest = super_kmers(h, np.array([len(h)]), window, gram)
                _, once = np.unique(digest, return_index=True)
                once = once[np.isin(digest.view(np.int64)[once], batch.column(1)[i].values.to_numpy(zero_copy_only=False))]
                if len(once):
                    strings = [b" ".join(words[p : p + k + window - 1]) for p, k in zip(pos[once].tolist(), n[once].tolist(), strict=True)]
                    yield _sent(mini[once], _signed(mini[once]), _signed(digest[once]), pa.array([batch.column(0)[i].as_py()] * len(once), pa.int64()), np.zeros(len(once)), strings)

    return run


def _cut(window: int, gram: int):
    """Packed strings of crowded buckets -> their parts by the minimiser over grams of `gram` words; with as many words
    as a window has, its single windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [x.split() for x in part.column(5).to_pylist()]
                sizes = np.array([len(t) for t in texts])
                row, pos, n, mini, _ = super_kmers(hashes.of([w for t in texts for w in t]), sizes, window, gram)
                if not len(row):
                    continue
                keys, offs = part.column(0).to_numpy().view(np.uint64), part.column(4).to_numpy()
                strings = [b" ".join(texts[r][p : p + k + window - 1]) for r, p, k in zip(row.tolist(), pos.tolist(), n.tolist(), strict=True)]
                take = pa.array(row)
                yield _sent(_mixed(mini + keys[row] * A), part.column(1).take(take), part.column(2).take(take), part.column(3).take(take), offs[row] + pos, strings)

    return run


def first_owners(strings: list[bytes], owners: np.ndarray, window: int = WINDOW):
    """For packed strings: string number, window number and least owner of that window among all strings."""
    ids: dict[bytes, int] = {}
    coded = [np.fromiter((ids.setdefault(w, len(ids)) for w in s.split()), dtype=np.int64) for s in strings]
    sizes = np.array([len(c) for c in coded])
    words = np.concatenate(coded)
    counts = np.maximum(sizes - window + 1, 0)
    of = np.repeat(np.arange(len(coded)), counts)
    inside = np.arange(int(counts.sum())) - (np.cumsum(counts) - counts)[of]
    at = (np.cumsum(sizes) - sizes)[of] + inside
    key = _digests(_mixed(words.astype(np.uint64) + A), at, at + window, B)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    group = np.cumsum(new) - 1
    lead = at[order[np.nonzero(new)[0]]][group]
    same = np.ones(len(order), dtype=bool)
    for j in range(window):
        same &= words[at[order] + j] == words[lead + j]
    if not same.all():  # equal digests of different windows: compare the words themselves
        exact: dict[bytes, int] = {}
        label = np.array([exact.setdefault(words[a : a + window].tobytes(), len(exact)) for a in at.tolist()])
        order = np.argsort(label, kind="stable")
        new[1:] = label[order[1:]] != label[order[:-1]]
        group = np.cumsum(new) - 1
    least = np.minimum.reduceat(owners[of][order], np.nonzero(new)[0])[group]
    first = np.empty(len(order), dtype=np.int64)
    first[order] = least
    return of, inside, first


def _count(window: int):
    """(key, mini, digest, owner, off, packed) sorted by key -> for each super-k-mer the stretches of windows that an
    earlier owner has as well. Buckets are handled whole, many at a time."""

    def flush(batch: pa.Table) -> pa.RecordBatch:
        owners, offs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("owner", "off"))
        of, inside, first = first_owners(batch.column("packed").to_pylist(), owners, window)
        early = first < owners[of]
        of, inside = of[early], inside[early]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (inside[1:] != inside[:-1] + 1)
        start = np.nonzero(new)[0]
        end = np.concatenate([start[1:], [len(of)]]) - 1 if len(of) else start
        row = pa.array(of[start])
        spans = [pa.array((offs[of[start]] + x).astype(np.int32)) for x in (inside[start], inside[end] + 1)]
        return pa.RecordBatch.from_arrays([batch.column("mini").combine_chunks().take(row), batch.column("digest").combine_chunks().take(row), *spans], names=["mini", "digest", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                held.append(batch.slice(at, ROWS))
                rows, size = rows + held[-1].num_rows, size + held[-1].nbytes
                if rows >= ROWS or size >= BYTES:
                    whole = pa.Table.from_batches(held)
                    keys = whole.column("key").to_numpy()
                    if cut := int(np.searchsorted(keys, keys[-1], side="left")):
                        yield flush(whole.slice(0, cut))
                        held = whole.slice(cut).to_batches()
                        rows, size = whole.num_rows - cut, sum(x.nbytes for x in held)
        if rows:
            yield flush(pa.Table.from_batches(held))

    return run


def _finish(window: int, layout: str, names: list[str]):
    """(columns..., text, spans) -> columns..., kept text, number of words, number removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, spans in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1), strict=True):
                value = text.as_py()
                raw = value.encode("utf-8", "surrogatepass") if value else b""
                words = raw.split()
                sizes.append(len(words))
                if not spans.is_valid or not len(spans):
                    texts.append(b" ".join(words).decode("utf-8", "surrogatepass") if layout == "words" else value)
                    removed.append(0)
                    continue
                code = spans.values.to_numpy(zero_copy_only=False)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, code >> 32, 1)
                np.add.at(edge, np.minimum((code & 0xFFFFFFFF) + window - 1, len(words)), -1)
                keep = np.cumsum(edge[:-1]) == 0
                removed.append(int(len(words) - keep.sum()))
                if layout == "words":
                    kept = b" ".join([words[i] for i in np.nonzero(keep)[0].tolist()])
                else:
                    places = np.array([m.span() for m in _WORDS.finditer(raw)])
                    runs = np.diff(np.concatenate([[0], keep.astype(np.int8), [0]]))
                    kept = b"\n".join(raw[places[a, 0] : places[b - 1, 1]] for a, b in zip(np.nonzero(runs == 1)[0], np.nonzero(runs == -1)[0], strict=True))
                texts.append(kept.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())], names=names)

    return run


def _stretches(sent: DataFrame, window: int, longer: int, crowd: int) -> tuple[DataFrame, list[DataFrame]]:
    """(mini, digest, a, b) of the windows of packed strings that an earlier owner has, and the tables it is read from."""
    parts = max(1, int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    compared = lambda rows: rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_count(window), "mini long, digest long, a int, b int")
    found, used = None, []
    for gram in (longer, window):
        crowds = materialise(sent.groupBy(F.col("key").alias("key_")).agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("key_"))
        used.append(crowds)
        if not crowds.limit(1).count():
            new = compared(sent)
            return (new if found is None else found.unionAll(new)), used
        few = maybe_broadcast(crowds)
        new = compared(sent.join(few, F.col("key") == F.col("key_"), "left_anti"))
        found = new if found is None else found.unionAll(new)
        sent = materialise(sent.join(few, F.col("key") == F.col("key_"), "left_semi").mapInArrow(_cut(window, gram), SENT))
        used.append(sent)
    least = sent.groupBy(F.col("packed").alias("packed_")).agg(F.min("owner").alias("first"))
    early = sent.join(least, (F.col("packed") == F.col("packed_")) & (F.col("first") < F.col("owner")))
    return found.unionAll(early.select("mini", "digest", F.col("off").alias("a"), (F.col("off") + 1).alias("b"))), used


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", columns: tuple[str, ...] = (), window: int = WINDOW, gram: int = GRAM, longer: int = LONGER_GRAM, crowd: int = CROWD, layout: str = "words") -> DataFrame:
    """One row per row of docs: id, `columns`, text (what is kept), n_words, n_removed.

    A word goes if a window over it also starts in a row with a smaller id; windows are judged on the input. layout
    "words" joins the kept words by one blank; "original" keeps the white space between neighbours and puts a line
    feed where words went. Texts are taken whole, however long; null, empty and short texts have no window and lose
    nothing (a null stays null in the original layout). A row of null id neither loses words nor takes any from others.
    Rows of equal id don't take words from each other. Columns that are not named are dropped, whatever their names. An
    empty table gives no rows. `crowd` decides how a bucket is compared, never what is found."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.hash(text_col).alias("tag"), *[F.col(c).alias(f"c{i}_") for i, c in enumerate(columns)], F.col(text_col).alias("text"))
    known = base.filter("id is not null and text is not null").select("id", "tag", "text")
    seen = materialise(known.mapInArrow(_occurrences(window, gram), "mini long, digest long, id long, tag int, pos int, n int"))

    wholes = seen.groupBy("mini", "digest").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    minis = wholes.groupBy("mini").agg(F.min("owner").alias("first_"), F.max("last").alias("last_"), F.count("*").alias("kinds")).filter("first_ < last_")
    shared = materialise(wholes.drop("last").join(minis.select("mini", "kinds"), "mini"))

    asked = materialise(shared.filter("kinds > 1").groupBy(F.col("owner").alias("owner_")).agg(F.collect_list("digest").alias("wanted")))
    owners, _ = split_by(known.select("id", "text"), "id", asked, "owner_")
    sent = materialise(owners.join(asked, F.col("id") == F.col("owner_")).select("id", "wanted", "text").mapInArrow(_packed(window, gram), SENT))
    early, used = _stretches(sent, window, longer, crowd)
    stretches = early.groupBy("mini", "digest").agg(F.collect_list(F.struct("a", "b")).alias("parts"))
    found = materialise(shared.select("mini", "digest", "owner").join(stretches, ["mini", "digest"], "left"))
    forget(shared, asked, sent, *used)

    # Whoever comes after the owner of a super-k-mer loses all of it; the owner loses what earlier owners have.
    hit = (F.col("id") > F.col("owner")) | ((F.col("id") == F.col("owner")) & F.col("parts").isNotNull())
    here = found.select(F.col("mini").alias("m_"), F.col("digest").alias("d_"), "owner", "parts")
    hits = seen.join(here, (F.col("mini") == F.col("m_")) & (F.col("digest") == F.col("d_")) & hit)
    # A stretch of windows as one number: first window in the high half, the one after the last in the low half.
    code = lambda a, b: F.shiftleft((F.col("pos") + a).cast("long"), 32) + F.col("pos") + b
    codes = F.when(F.col("id") > F.col("owner"), F.array(code(F.lit(0), F.col("n")))).otherwise(F.transform("parts", lambda x: code(x["a"], x["b"])))
    spans = hits.select("id", "tag", codes.alias("codes")).groupBy(F.col("id").alias("id_"), F.col("tag").alias("tag_")).agg(F.array_distinct(F.flatten(F.collect_list("codes"))).alias("spans"))
    spans = materialise(spans)
    forget(seen, found)
    # Only texts that lose words, and few others, are shuffled again.
    changed, whole = split_by(base, "id", spans, "id_")
    joined = changed.join(spans, (F.col("id") == F.col("id_")) & (F.col("tag") == F.col("tag_")), "left")
    names = [id_col, *columns, text_col, "n_words", "n_removed"]
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{id_col}` long", *[f"`{c}` {kinds[c]}" for c in columns], f"`{text_col}` string, n_words long, n_removed long"])
    done = lambda rows, spans: rows.select("id", *[f"c{i}_" for i in range(len(columns))], "text", spans).mapInArrow(_finish(window, layout, names), schema)
    return done(joined, F.col("spans")).unionAll(done(whole, F.lit(None).cast("array<bigint>").alias("spans")))


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with base as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select r, doc_id, i, array_to_string(w[i : i + 49], ' ') as s
  from (select r, doc_id, w, unnest(range(1, len(w) - 48)) as i from base where len(w) >= 50)),
hit as (select r, i from (select *, min(doc_id) over (partition by s) as first from win) where first < doc_id),
gone as (select distinct r, i + k as p from hit, (select unnest(range(50)) as k)),
g as (select r, list(p) as ps from gone group by r),
k as (select doc_id, w, coalesce(len(ps), 0) as n, list_filter(range(1, len(w) + 1), lambda p: not coalesce(list_contains(ps, p), false)) as keep from base left join g using (r))
select doc_id, cast(len(w) as bigint) as n_words, cast(n as bigint) as n_removed,
       sha256(array_to_string(list_transform(keep, lambda p: w[p]), ' ')) as kept_sha256
from k
"""
