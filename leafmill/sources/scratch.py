"""Intermediate tables in the folder that driver and executors share, and broadcasts of checked size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting by which the shuffle files of a statement are deleted when it is done.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A table of at most so many rows may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 10_000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of our own: in the warehouse on a cluster, a temporary one in
    local mode, where there are no other machines."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.leafmill.shared.dir", None)
    if not found:
        local = re.fullmatch(r"local(\[.*)?", spark.sparkContext.master)
        found = "file://" + tempfile.mkdtemp(prefix="leafmill-") if local else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/leafmill-work"
        spark.conf.set("spark.leafmill.shared.dir", found)
    return found.rstrip("/")


def materialise(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    It cuts the lineage as checkpoint() does, survives the loss of executors, and computes df once
    where an eager checkpoint computes it twice. forget() deletes the files; those of the shuffles go at once, not when the
    driver happens to collect garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/leafmill/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def forget(*tables: DataFrame) -> None:
    """Deletes the files of materialised tables that nothing reads any more; other tables are left alone."""
    for df in tables:
        if found := getattr(df, "written_to", None):
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            path = jvm.org.apache.hadoop.fs.Path(found)
            path.getFileSystem(conf).delete(path, True)


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows, else unchanged. df should be cheap to read again."""
    return F.broadcast(df) if len(df.limit(most + 1).take(most + 1)) <= most else df
