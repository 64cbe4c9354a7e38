import zlib

from leafmill.llm import classifier
from pyspark.sql import functions as F


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_query_learns_from_every_label(spark, tmp_path):
    """Sites whose labels all fall on the held-out third have rates of their own."""
    texts = ["river stone walk", "light green house", "water under bridge"]
    third = [i for i in range(2000) if held(i)][:400]
    rest = [i for i in range(2000) if not held(i)][:400]
    rows = [(i, texts[k % 3], "en", "bad", 16) for k, i in enumerate(third)] + [(i, texts[k % 3], "en", "good", 16) for k, i in enumerate(rest)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(source == "good"), 0) for i, _, _, source, _ in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = classifier.op8_classifier(spark, str(tmp_path)).join(docs.select("doc_id", "source"), "doc_id")
    got = {r.source: r.p for r in found.groupBy("source").agg(F.avg("p_quality").alias("p")).collect()}
    assert got["bad"] < 0.2 and got["good"] > 0.8


def test_held_out_third(spark):
    """A fold passed to classify() measures it: most held-out labels of quality are found."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = classifier.classify(docs, labels.filter(~fold)).join(labels.filter(fold), "doc_id").filter("quality is not null")
    right = found.agg(F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int")).alias("r")).first().r
    assert right > 0.7
