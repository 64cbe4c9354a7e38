"""The training-data pipeline: five stages over documents, each written and read again before the next.

A null or empty text, a repeated row and an id that comes twice have a defined way through every stage (see there); extra
columns of documents are dropped by the first; an empty table passes all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import langid, mixing, packing, simhash, substring, tokens
from leafmill.llm.common import forget, materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language has less than this of the fair share of evidence is rejected as no language.
LEAST_SCORE = 0.35


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a likely language; a null lang becomes the predicted one."""
    model = langid.train(docs)
    found = langid.predict(docs, model, list(COLUMNS)).filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near copies (five-word shingles, Jaccard similarity of 0.8 or
    more), once; rows of null id are kept."""
    found = materialise(simhash.near_copies(docs).filter("doc_id is not null"))
    keep = found.filter(F.col("doc_id") == F.col("component")).select("doc_id").distinct()
    known = docs.filter("doc_id is not null").join(keep, "doc_id", "left_semi").select(*COLUMNS)
    rest = docs.filter("doc_id is null").select(*COLUMNS)
    twice = materialise(found.groupBy("doc_id").agg(F.count("*").alias("rows_")).filter("rows_ > 1").select("doc_id"))
    if not twice.limit(1).count():
        return known.unionAll(rest)
    # Several rows of one id: one of them stays, the one of least hash; equal rows are one.
    many = known.join(twice, "doc_id", "left_semi").withColumn("mark_", F.xxhash64("text", "lang", "source", "n_chars"))
    least = many.groupBy("doc_id").agg(F.min("mark_").alias("mark_"))
    return known.join(twice, "doc_id", "left_anti").unionAll(many.join(least, ["doc_id", "mark_"], "left_semi").select(*COLUMNS).distinct()).unionAll(rest)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 words and more that an earlier document has; a document of which nothing is left goes."""
    found = substring.deduplicate(docs, columns=("lang", "source", "n_chars"), layout="original")
    changed = F.col("n_removed") > 0
    left = found.filter(~changed | (F.col("n_removed") < F.col("n_words")))
    return left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it. Null texts and null sources are mixed like any other; of equal rows at the
    edge of a source's budget any are taken."""
    taken = mixing.mix(docs, columns=tuple(c for c in COLUMNS if c not in ("doc_id", "source"))).filter("epochs > 0")
    return taken.withColumn("again_", F.explode(F.sequence(F.lit(1), "epochs"))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of pieces with their texts: (doc_id, piece, first_char, n_chars, text, n_tokens, boundary, padding, batch_id, slot).
    A row that the mix takes twice is two rows here, in batches of their own; null and empty texts have no piece."""
    return packing.pack(docs, vocabulary=tokens.vocabulary_path(spark))


STAGES = [
    ("language identification", identify),
    ("near duplicates", one_of_each_group),
    ("repeated passages", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has no form of the language model and the optimal buckets; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, one after the other. What a stage has read is deleted after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
