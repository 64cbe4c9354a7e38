"""Append logs as streams: resumable ingestion, latest result wins, and (an extension) windows of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leafmill.sources.files import Versions


def append_log(spark: SparkSession, path: str, schema, per_trigger: int = 100) -> DataFrame:
    """A folder of JSON-lines files as a stream; the checkpoint remembers what was read, maxFilesPerTrigger bounds a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)


def upsert_into(versions: Versions, key: list[str], order: str):
    """foreachBatch function: the latest row of each key wins. A repeated batch gives the same table."""

    def run(batch: DataFrame, _: int) -> None:
        now = versions.read()
        rows = batch if now is None else now.unionByName(batch)
        latest = rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in key]), order).alias("r_"))
        versions.write(latest.select(*key, *[F.col(f"r_.{c}").alias(c) for c in rows.columns if c not in key]))

    return run


def keep_latest(log: DataFrame, versions: Versions, key: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Runs what is available and stops; call it again to go on where it stopped."""
    return log.writeStream.foreachBatch(upsert_into(versions, key, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, at: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Extension: counts and sums of events in tumbling windows; rows later than the watermark are left out."""
    timed = events.withColumn("at_", F.col(at).cast("timestamp")).withWatermark("at_", late)
    return timed.groupBy(F.window("at_", width), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
