"""Orders inside groups: places, turns, ranks, running totals, bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.sources.scratch import materialise


def place(by: Sequence[str], order: Sequence) -> Column:
    """0-based place inside the group, in an explicit order."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1


def head(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first n rows of each group. Spark keeps n rows of a group on each side of the shuffle (group limit)."""
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("r_") <= n).drop("r_")


def round_robin(df: DataFrame, turn: str, order: Sequence, n: int, within: Sequence[str] = ()) -> DataFrame:
    """Groups in turn: first rows of all, then second rows, until n rows of each `within` are taken."""
    dealt = df.withColumn("turn_", F.row_number().over(Window.partitionBy(*within, turn).orderBy(*order)))
    if not within:
        return running_over_all(dealt.filter(F.col("turn_") <= n), F.col("turn_"), ["turn_", turn], out="pick").filter(F.col("pick") <= n).drop("turn_")
    return dealt.filter(F.col("turn_") <= n).withColumn("pick", F.row_number().over(Window.partitionBy(*within).orderBy("turn_", turn))).filter(F.col("pick") <= n).drop("turn_")


def fair_blocks(df: DataFrame, host: str, key: str, block: int = 4, ties: Sequence[str] = ()) -> DataFrame:
    """Blocks of `block` rows of a host in turn, hosts and rows inside in hashed order, rows of one key in that of `ties`;
    `block` numbers the turn."""
    at = F.row_number().over(Window.partitionBy(host).orderBy(F.md5(key), key, *ties)) - 1
    return df.withColumn("block", F.floor(at / block).cast("int")).withColumn("host_hash", F.md5(host)).withColumn("key_hash", F.md5(key))


def value_bucket(df: DataFrame, column: str | Column, buckets: int = 1024) -> Column:
    """A number that grows with a numeric column and cuts the rows about evenly: places among approximate quantiles."""
    value = F.col(column) if isinstance(column, str) else column
    edges = df.agg(F.percentile_approx(value, [i / buckets for i in range(1, buckets)], 10_000).alias("e")).first().e
    edges = F.lit(sorted(set(edges or [])))
    return F.coalesce(F.size(F.filter(edges, lambda e: e < value)), F.lit(-1))


def hash_bucket(hexed: Column) -> Column:
    """The same for hex digests: their first three digits."""
    return F.substring(hexed, 1, 3)


def running_over_all(df: DataFrame, bucket: Column, order: Sequence, value: Column | None = None, out: str = "running") -> DataFrame:
    """Running sum of value (row number if none) over the whole table in an order that begins with the bucket.

    Rows are only sorted inside their bucket, in parallel; the sums of the buckets, a few thousand rows, give each
    bucket its start. No task sees the whole table."""
    rows = df.withColumn("bucket_", bucket).withColumn("value_", F.lit(1).cast("long") if value is None else value)
    sums = rows.groupBy("bucket_").agg(F.sum("value_").alias("sum_"))
    before = Window.orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("bucket_", F.coalesce(F.sum("sum_").over(before), F.lit(0)).alias("start_"))
    own = F.sum("value_").over(Window.partitionBy("bucket_").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.join(F.broadcast(starts), "bucket_").withColumn(out, F.col("start_") + own).drop("bucket_", "value_", "start_")


def in_order(df: DataFrame, order: Sequence, out: str = "place") -> DataFrame:
    """Row numbers from 1 over the whole table in an order of any type: rows are dealt into ranges and written, so that
    the ranges stay what they are, then numbered range by range."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = materialise(df.repartitionByRange(parts, *order).withColumn("range_", F.spark_partition_id()))
    return running_over_all(dealt, F.col("range_"), order, out=out).drop("range_")


def percentile_rank_over_all(df: DataFrame, column: str, out: str = "pct") -> DataFrame:
    """percentile_rank over a whole table: ranks come from counts of the different values, joined back."""
    counts = df.groupBy(column).agg(F.count("*").alias("n_"))
    ranked = running_over_all(counts, value_bucket(counts, column), [column], F.col("n_"), "upto_")
    total = df.agg(F.count("*").alias("t_"))
    places = ranked.crossJoin(F.broadcast(total)).select(F.col(column).alias("v_"), ((F.col("upto_") - F.col("n_") + 1 + (F.col("n_") - 1) / 2) / F.col("t_")).alias(out))
    return df.join(places, F.col(column).eqNullSafe(F.col("v_"))).drop("v_")


def percentile_rank(of: Column, by: Sequence[str] = ()) -> Column:
    """Average rank over the number of rows: ties share the mean of their places."""
    w = Window.partitionBy(*by)
    return (F.rank().over(w.orderBy(of)) + (F.count("*").over(Window.partitionBy(*by, of)) - 1) / 2) / F.count("*").over(w)


def running(value: Column, by: Sequence[str], order: Sequence) -> Column:
    return F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def edges_bin(value: Column, edges: Sequence[float], right: bool = False) -> Column:
    """Number of edges at or under the value (right: under it)."""
    return sum(((value > e) if right else (value >= e)).cast("int") for e in edges)


def quantile_bins(df: DataFrame, column: str, n: int, out: str = "bin") -> DataFrame:
    """Bins between exact quantiles, closed on the right, the lowest value included; equal values share a bin.

    The quantiles are one aggregated row, joined to all rows by broadcast."""
    cuts = df.agg(F.percentile(F.col(column), F.array(*[F.lit(i / n) for i in range(n + 1)])).alias("cuts_"))
    at = F.size(F.filter("cuts_", lambda e: e < F.col(column)))
    return df.crossJoin(F.broadcast(cuts)).withColumn(out, F.greatest(at - 1, F.lit(0))).drop("cuts_")


def gaps(df: DataFrame, by: Sequence[str], order: str, tolerance) -> DataFrame:
    """Number of the run a row is in: a new run begins where the step from the row before exceeds the tolerance."""
    w = Window.partitionBy(*by).orderBy(order)
    new = F.coalesce((F.col(order) - F.lag(order).over(w) > tolerance).cast("int"), F.lit(0))
    return df.withColumn("new_", new).withColumn("run", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("new_")


def spread_evenly(by: Sequence[str], order: Sequence, low: float, high: float, jitter: Column) -> Column:
    """A value for each row that spreads the group's ranks evenly over [low, high)."""
    w = Window.partitionBy(*by)
    return (F.row_number().over(w.orderBy(*order)) - 1 + jitter) / F.count("*").over(w) * (high - low) + low


def cycle(df: DataFrame, by: Sequence[str], order: Sequence, sources: DataFrame, key: Sequence[str]) -> DataFrame:
    """The i-th job of a group takes its source i mod n; `reused` from the second turn on. sources: `by` and key columns."""
    numbered = sources.withColumn("j_", F.row_number().over(Window.partitionBy(*by).orderBy(*key)) - 1).withColumn("n_", F.count("*").over(Window.partitionBy(*by)))
    sizes = numbered.groupBy(*by).agg(F.first("n_").alias("size_"))
    jobs = df.withColumn("i_", place(by, order)).join(sizes, list(by)).withColumn("j_", F.pmod("i_", "size_"))
    return jobs.join(numbered.drop("n_"), [*by, "j_"]).withColumn("reused", F.col("i_") >= F.col("size_")).drop("i_", "j_", "size_")
