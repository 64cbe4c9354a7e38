"""Packing by optimal length buckets.

Texts are cut into pieces of at most max_len tokens. A dynamic programme over the global histogram of piece lengths
chooses the bucket boundaries that minimise padding; inside a bucket pieces fill batches up to a token budget.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import materialise, table
from leafmill.llm.tokens import tokens_of, vocabulary_path

MAX_LEN = 2048
BUCKETS = 16
BATCH_TOKENS = 32_768
#: Rows of a bucket are numbered in so many shards side by side; bounds the table of offsets.
SHARDS = 1024
WORD_RUN = re.compile(r"[^\x20\x09-\x0D]+")


def boundaries(lengths: np.ndarray, counts: np.ndarray, k: int) -> list[int]:
    """At most k lengths, the largest included, that minimise sum(count * (next boundary - length)).

    best[j] is the least cost of the first j lengths; a bucket that ends at j and begins after i costs
    length[j]*(N[j]-N[i]) - (S[j]-S[i]) with running sums N of counts and S of words."""
    if not len(lengths):
        return []
    length = np.asarray(lengths, dtype=np.float64)
    n = np.concatenate([[0.0], np.cumsum(counts, dtype=np.float64)])
    s = np.concatenate([[0.0], np.cumsum(length * counts)])
    m = len(length)
    best, cuts = np.full(m + 1, np.inf), []
    best[0] = 0.0
    for _ in range(min(k, m)):
        cost = best[:, None] + np.concatenate([[0.0], length])[None, :] * (n[None, :] - n[:, None]) - (s[None, :] - s[:, None])
        cost[np.tril_indices(m + 1)] = np.inf
        cut = cost.argmin(axis=0)
        new = cost[cut, np.arange(m + 1)]
        new[0] = 0.0
        cuts.append(np.where(new < best, cut, -1))
        best = np.minimum(new, best)
    found, j, level = [], m, len(cuts) - 1
    while j > 0:
        while cuts[level][j] < 0:
            level -= 1
        found.append(int(lengths[j - 1]))
        j, level = int(cuts[level][j]), level - 1
    return found[::-1]


def _cut(max_len: int, tokens):
    """(id, text) -> (id, tag, piece, first_char, n_chars, text, n_tokens)."""

    def words(text: str | None) -> Iterator[tuple[int, int, int]]:
        start = end = n = 0
        for m in WORD_RUN.finditer(text or ""):
            if n == max_len:
                yield start, end, n
                n = 0
            start, end, n = (start if n else m.start()), m.end(), n + 1
        if n:
            yield start, end, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokens:
            held = tokens()
            cut = lambda text: held.cut(text, max_len)
        else:
            cut = words
        for batch in batches:
            of, tag, piece, first, texts, sizes = [], [], [], [], [], []
            for i, x in enumerate(batch.column(1)):
                text = x.as_py()
                mark = xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 63)
                for k, (a, b, n) in enumerate(cut(text)):
                    of.append(i)
                    tag.append(mark)
                    piece.append(k)
                    first.append(a)
                    texts.append(text[a:b])
                    sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), pa.array(tag, pa.int64()), pa.array(piece, pa.int32()), pa.array(first, pa.int64()), pa.array(list(map(len, texts)), pa.int64()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32())],
                names=["id", "tag", "piece", "first_char", "n_chars", "text", "n_tokens"],
            )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, max_len: int = MAX_LEN, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """(id, piece, first_char, n_chars, text, n_tokens, boundary, padding, batch_id, slot): a row for each piece of each row of docs.

    Texts are cut at white space into pieces of at most max_len tokens of the vocabulary (words where there is none), the
    last one shorter; a piece's text stands at first_char of the row's. A piece is padded to its bucket's boundary; a
    batch holds batch_tokens // boundary pieces (one at least) of one bucket, so only a bucket's last batch can be short:
    the rows of a batch_id, by slot, are the batch. Null and empty texts have no piece; repeated rows are packed each on
    its own, in any order among themselves; other columns are dropped, whatever their names; an empty table gives no rows.
    Without the text column no text is shuffled. The histogram that reaches the driver has at most max_len rows, the table of offsets buckets * SHARDS."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(base.dtypes)['id']}, tag long, piece int, first_char long, n_chars long, text string, n_tokens int"
    rows = materialise(base.mapInArrow(_cut(max_len, tokens_of(vocabulary) if vocabulary else None), schema))
    hist = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    ends = boundaries(np.array([r[0] for r in hist], dtype=np.int64), np.array([r[1] for r in hist], dtype=np.int64), buckets)
    bucket = F.lit(None).cast("int")
    for end in reversed(ends):
        bucket = F.when(F.col("n_tokens") <= end, F.lit(end)).otherwise(bucket)
    # Equal rows are told apart by their place in the written file, or all of them would be in one shard.
    salt = F.pmod(F.col("_metadata.row_index"), F.lit(64))
    placed = rows.select("*", bucket.alias("boundary"), F.pmod(F.xxhash64("id", "tag", "piece", salt), F.lit(SHARDS)).cast("int").alias("shard"))
    counts = placed.groupBy("boundary", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("boundary").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(counts.select("boundary", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    own = Window.partitionBy("boundary", "shard").orderBy("id", "tag", "piece")
    numbered = placed.join(F.broadcast(offsets), ["boundary", "shard"]).withColumn("at", F.col("offset") + F.row_number().over(own) - 1)
    per = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("boundary"))).cast("long")
    return numbered.select(
        F.col("id").alias(id_col), "piece", "first_char", "n_chars", "text", "n_tokens", "boundary", (F.col("boundary") - F.col("n_tokens")).alias("padding"),
        F.concat_ws("-", F.col("boundary").cast("string"), F.floor(F.col("at") / per).cast("string")).alias("batch_id"), F.pmod("at", per).cast("int").alias("slot"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack(table(spark, sf_dir, "documents"), vocabulary=vocabulary_path(spark))
    return found.select("doc_id", "piece", "first_char", "n_chars", "n_tokens", "boundary", "padding", "batch_id", "slot")
