"""Seeded samples and splits by hashed order: they give the same rows on every engine and every rerun."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import hash_bucket, in_order, running_over_all, value_bucket
from leafmill.sources.scratch import materialise


def hashed(key: Column, seed: str = "") -> Column:
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def digit_sum(hexed: Column) -> Column:
    """Sum of hex digits; modulo 5 and 3 it is the number itself, as 16 is 1 there."""
    return F.aggregate(F.filter(F.split(hexed, ""), lambda c: c != ""), F.lit(0), lambda a, c: a + F.conv(c, 16, 10).cast("int"))


def hex_modulo(hexed: Column, m: int) -> Column:
    """A hex number of any length modulo m, digit by digit."""
    return F.aggregate(F.filter(F.split(hexed, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.pmod(a * 16 + F.conv(c, 16, 10).cast("int"), F.lit(m)))


def shuffle_order(key: str, seed: str) -> list[Column]:
    return [hashed(F.col(key), seed), F.col(key)]


def sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n rows without replacement; a top-n, not a sort of all."""
    return df.orderBy(hashed(F.col(key), seed), key).limit(n)


def systematic(df: DataFrame, mass: Column, order: str, u: float) -> DataFrame:
    """Systematic sampling with inclusion probability min(mass, 1): a row is taken where a point u, u+1, ... falls into
    its stretch of the running sum over the order of a numeric column."""
    rows = df.withColumn("mass_", F.least(mass, F.lit(1.0)))
    summed = running_over_all(rows, value_bucket(df, order), [order], F.col("mass_"), "cum_")
    cum = F.round(F.col("cum_") - u, 9)
    return summed.withColumn("taken", F.floor(cum) > F.floor(F.round(cum - F.col("mass_"), 9))).drop("mass_", "cum_")


def evenly_spaced(values: Column, k: int) -> Column:
    """Up to k different elements of an array at half-even rounded even steps, ends included."""
    n = F.size(values)
    m = F.least(n, F.lit(k))
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.bround(F.when(m > 1, i * (n - 1) / (m - 1)).otherwise(F.lit(0.0)), 0).cast("int")))
    return F.when(n > 0, F.transform(at, lambda i: F.get(values, i))).otherwise(values)


def budget(pages: Column, base: int = 10, least: int = 50, share: float = 0.1, short: int = 0) -> Column:
    """Pages to take of a document: base and a share of its length, at least `least`; documents under `short` whole."""
    n = F.coalesce(pages, F.lit(0))
    return F.when(n < short, n).otherwise(F.greatest(base + F.ceil(share * n), F.lit(least))).cast("long")


def fraction_split(df: DataFrame, key: str, test: float, val: float, seed: str) -> DataFrame:
    """round(n*test) rows of the hashed order are test, the next round(n*val) val, the others train."""
    at = running_over_all(df, hash_bucket(hashed(F.col(key), seed)), shuffle_order(key, seed), out="at_")
    rows = at.crossJoin(F.broadcast(df.agg(F.count("*").alias("n_"))))
    a, b = F.bround(F.col("n_") * test, 0), F.bround(F.col("n_") * val, 0)
    return rows.withColumn("part", F.when(F.col("at_") <= a, "test").when(F.col("at_") <= a + b, "val").otherwise("train")).drop("at_", "n_")


def group_split(df: DataFrame, group: str, val: float, test: float, seed: str) -> DataFrame:
    """Whole groups in hashed order go to val until it has its share (it may overshoot), then to test, the rest to train."""
    sizes = df.groupBy(F.col(group).alias("g_")).agg(F.count("*").alias("n_"))
    ranked = running_over_all(sizes, hash_bucket(hashed(F.col("g_"), seed)), shuffle_order("g_", seed), F.col("n_"), "upto_")
    rows = ranked.withColumn("before_", F.col("upto_") - F.col("n_")).crossJoin(F.broadcast(sizes.agg(F.sum("n_").alias("total_"))))
    rows = materialise(rows.withColumn("val_", F.col("before_") < F.col("total_") * val))
    ends = rows.agg(F.coalesce(F.sum(F.when(F.col("val_"), F.col("n_"))), F.lit(0)).alias("ends_"))
    part = F.when(F.col("val_"), "val").when(F.col("before_") - F.col("ends_") < F.col("total_") * test, "test").otherwise("train")
    marked = rows.crossJoin(F.broadcast(ends)).select("g_", part.alias("part"))
    return df.join(marked, F.col(group) == F.col("g_")).drop("g_")


def every_kth(df: DataFrame, group: str, n_eval: int) -> DataFrame:
    """Every k-th of the sorted groups is held out, k = max(n div n_eval, 1), the first n_eval of them."""
    groups = df.select(F.col(group).alias("g_")).distinct()
    placed = in_order(groups, ["g_"], "at_").crossJoin(F.broadcast(groups.agg(F.count("*").alias("n_"))))
    k, at = F.greatest(F.floor(F.col("n_") / n_eval), F.lit(1)), F.col("at_") - 1
    held = placed.select("g_", ((F.pmod(at, k) == 0) & (at / k < n_eval)).alias("held_out"))
    return df.join(held, F.col(group) == F.col("g_")).drop("g_")


def oversampled(df: DataFrame, strata: Sequence[str], key: str, need: Column, factor: int, seed: str = "") -> DataFrame:
    """need*factor rows of each stratum in an order hashed with the stratum's name."""
    mark = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(s).cast("string") for s in strata], F.col(key).cast("string")))
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*strata).orderBy(mark, key))).filter(F.col("r_") <= need * factor).drop("r_")


def least_confident(df: DataFrame, confidence: str, key: str, share: float) -> DataFrame:
    """Marks floor(share*n) rows of least (confidence, key)."""
    at = running_over_all(df, value_bucket(df, confidence), [confidence, key], out="at_").crossJoin(F.broadcast(df.agg(F.count("*").alias("n_"))))
    return at.withColumn("review", F.col("at_") <= F.floor(share * F.col("n_"))).drop("at_", "n_")
