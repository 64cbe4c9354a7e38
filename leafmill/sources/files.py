"""Files in and out: manifests, listings, ragged shards, versions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = T.StructType(
    [
        T.StructField("source_path", T.StringType()), T.StructField("page_index", T.IntegerType()), T.StructField("language", T.StringType()), T.StructField("category", T.StringType()),
        T.StructField("kind", T.StringType()), T.StructField("rotate90", T.IntegerType()), T.StructField("deskew_deg", T.DoubleType()), T.StructField("used_h", T.DoubleType()),
        T.StructField("used_w", T.DoubleType()), T.StructField("window", T.ArrayType(T.DoubleType())), T.StructField("body_pt", T.DoubleType()), T.StructField("reason", T.StringType()),
    ]
)
CORRUPT = "corrupt_line"


def read_manifest(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines) of a JSON-lines manifest under a fixed schema; a half-written last line is a broken one."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    raw = lines.select(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
    fine = F.col(CORRUPT).isNull()
    return raw.filter(fine).drop(CORRUPT), raw.filter(~fine).select(CORRUPT)


def write_manifest(rows: DataFrame, path: str, rejected: Column | None = None) -> None:
    """Usable rows and, beside them, rejected ones with their reason, as JSON lines."""
    if rejected is not None:
        rows.filter(rejected).write.mode("overwrite").json(f"{path}/rejected")
        rows = rows.filter(~rejected)
    rows.write.mode("overwrite").json(f"{path}/usable")


def read_table(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """A delimited file with a header under a fixed schema."""
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)


def listing(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """(path, size, modified, key) of every file below a folder; key is the start of the content's SHA-256. Files that
    `known` (path, size, modified) lists unchanged are not hashed again. Spark leaves out files of no length."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    plain = files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")
    if known is not None:
        plain = plain.join(known.select("path", "size", "modified"), ["path", "size", "modified"], "left_anti")
    return plain.select("path", "size", "modified", F.substring(F.sha2("content", 256), 1, 12).alias("key"))


def ragged_to_rows(shards: DataFrame) -> DataFrame:
    """(ids array<struct<doc,page>>, offsets array<long>, cls array<int>) -> a row for each id with its slice of cls."""
    start, end = lambda i: F.get("offsets", i), lambda i: F.get("offsets", i + 1)
    # Each id gets its own slice before they are rows: a row never carries the shard's arrays.
    own = lambda x, i: F.struct(x["doc"].alias("doc"), x["page"].alias("page"), F.slice("cls", (start(i) + 1).cast("int"), (end(i) - start(i)).cast("int")).alias("cls"))
    return shards.select(F.explode(F.transform("ids", own)).alias("r")).select("r.doc", "r.page", "r.cls")


def rows_to_ragged(rows: DataFrame, by: Sequence[str], doc: str = "doc", page: str = "page", cls: str = "cls") -> DataFrame:
    """The reverse: one shard for each group, ids sorted; a null list is an empty one. Groups are shards of bounded size
    (cut by shard_numbers). Offsets are a running sum over the group, linear in its size."""
    plain = rows.select(*by, F.col(doc).alias("doc"), F.col(page).alias("page"), F.coalesce(F.col(cls), F.array().cast(dict(rows.dtypes)[cls])).alias("c"))
    upto = F.sum(F.size("c").cast("long")).over(Window.partitionBy(*by).orderBy("doc", "page", "c").rowsBetween(Window.unboundedPreceding, 0))
    packed = plain.withColumn("upto", upto).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("doc", "page", "c", "upto"))).alias("r"))
    ids = F.transform("r", lambda x: F.struct(x["doc"].alias("doc"), x["page"].alias("page")))
    offsets = F.concat(F.array(F.lit(0).cast("long")), F.transform("r", lambda x: x["upto"]))
    return packed.select(*by, ids.alias("ids"), offsets.alias("offsets"), F.flatten(F.transform("r", lambda x: x["c"])).alias("cls"))


def class_counts(shards: DataFrame, value: int) -> DataFrame:
    """Boxes of one class and of all for each id of ragged shards."""
    return ragged_to_rows(shards).select("doc", "page", F.size(F.filter("cls", lambda c: c == value)).alias("hits"), F.size("cls").alias("n"))


def shard_numbers(df: DataFrame, by: Sequence[str], order: Sequence, weight: Column, most: int) -> DataFrame:
    """Shard of each row: consecutive rows until their running weight passes a multiple of `most`."""
    cum = F.sum(weight).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("shard", F.floor((cum - 1) / most))


def write_shards(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Partitioned Parquet; the committer makes a shard appear whole or not at all."""
    df.repartition(*by).sortWithinPartitions(*by).write.mode("overwrite").partitionBy(*by).parquet(path)


def sample_per_file(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n rows of each input file in a seeded hashed order."""
    named = df.withColumn("file_", F.input_file_name())
    w = Window.partitionBy("file_").orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key)
    return named.withColumn("r_", F.row_number().over(w)).filter(F.col("r_") <= n).drop("r_", "file_")


class Versions:
    """A table kept as version folders and a pointer to the current one; a swap is one small write, the last version
    stays as the backup. Paths go through Hadoop's file system, so any store that Spark reaches will do."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def current(self) -> str | None:
        pointers = self.fs.globStatus(self.path(f"{self.root}/pointer-*"))
        names = sorted(p.getPath().getName() for p in pointers) if pointers else []
        return names[-1].split("-", 2)[2] if names else None

    def read(self) -> DataFrame | None:
        name = self.current()
        return self.spark.read.parquet(f"{self.root}/{name}") if name else None

    def write(self, df: DataFrame) -> str:
        """Writes df whole, then makes it current; earlier versions but the last are removed."""
        pointers = sorted(p.getPath().getName() for p in self.fs.globStatus(self.path(f"{self.root}/pointer-*")) or [])
        name = f"v{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{name}")
        number = int(pointers[-1].split("-", 2)[1]) + 1 if pointers else 0
        self.fs.create(self.path(f"{self.root}/pointer-{number:09d}-{name}"), False).close()
        for old in pointers[:-1]:
            self.fs.delete(self.path(f"{self.root}/{old.split('-', 2)[2]}"), True)
            self.fs.delete(self.path(f"{self.root}/{old}"), False)
        return name


def guard_plan(spark: SparkSession, path: str, plan: dict) -> None:
    """Refuses to go on with a run whose recorded plan (preset, size, seed, input digest) is another."""
    now = json.dumps(plan, sort_keys=True)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(fs_path):
        before = spark.read.text(path).first().value
        if before != now:
            raise ValueError(f"the run was begun with {before}, not {now}")
    else:
        spark.createDataFrame([(now,)], "value string").coalesce(1).write.text(path)


def apply_payload(df: DataFrame, columns: Sequence[str], payload, key: str) -> DataFrame:
    """Runs payload(row dict) -> bytes for every row; (key, value, error). An error is data, it never stops the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, errors = [], []
            for row in batch.to_pylist():
                try:
                    values.append(payload(row))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  the contract is value or error
                    values.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)), pa.array(values, pa.binary()), pa.array(errors, pa.string())], names=[key, "value", "error"])

    return df.select(*dict.fromkeys([key, *columns])).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, value binary, error string")
