"""Joins beyond equality: nearest, k nearest, containment, overlap, greedy one-to-one. Vectors are arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.cells import k_nearest
from leafmill.sources.scratch import materialise

#: Rows of a side that are compared as one product, and how near a mean may come to a bound before pairs decide.
ROWS, CLOSE = 4096, 1e-6


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def nearest(queries: DataFrame, refs: DataFrame, id_col: str, vector: str, drop_self: bool = True) -> DataFrame:
    return k_nearest(queries, refs, id_col, vector, 1, drop_self).select("src", "dst", "similarity")


def _units(column: pa.Array) -> np.ndarray:
    """The vectors of a column at length one, in double precision; those that are null, hold null or are zero are left out."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.drop_null()
    flat = column.flatten()
    if not len(flat):
        return np.empty((0, 0))
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    if flat.null_count:
        x = x[flat.is_valid().to_numpy(zero_copy_only=False).reshape(x.shape).all(axis=1)]
    size = np.sqrt((x * x).sum(axis=1))
    return x[size != 0] / size[size != 0][:, None]


def pair_cosines(df: DataFrame, label: str, vector: str, block: str, over: float, bounds: Sequence[float] = ()) -> DataFrame:
    """(a, b, n, mean, least): for labels a < b the number of pairs of their rows in the same block, and of the pairs'
    cosines (9 digits) the mean and the least. Vectors that are null, hold null or are zero count but have no cosine.

    The mean of all cosines is a product of sums of unit vectors, so no pair is made for it. The least is not over the
    mean: labels whose mean is not over `over` have the mean as a bound in its place. Only where the mean is over it, or
    too near one of `bounds` for sums to be sure of the side, pairs are made, as products of blocks of rows."""
    rows = df.select(F.col(label).alias("l"), F.col(block).cast("long").alias("k"), F.col(vector).alias("v")).filter("l is not null and k is not null")
    kind = dict(rows.dtypes)["l"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places: dict = {}
            for i, place in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                places.setdefault(place, []).append(i)
            units = [_units(batch.column(2).take(pa.array(at))) for at in places.values()]
            whole = [x.sum(axis=0).tolist() for x in units]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in places], batch.schema.field(0).type), pa.array([p[1] for p in places], pa.int64()), pa.array([len(at) for at in places.values()], pa.int64()), pa.array([len(x) for x in units], pa.int64()), pa.array(whole, pa.list_(pa.float64()))], names=["l", "k", "n", "good", "s"])

    parts = materialise(rows.mapInArrow(sums, f"l {kind}, k long, n long, good long, s array<double>"))
    total = parts.select("l", "k", F.posexplode("s").alias("at", "x")).groupBy("l", "k", "at").agg(F.sum("x").alias("x")).groupBy("l", "k").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s"))
    total = total.select("l", "k", F.transform("s", lambda p: p["x"]).alias("s"))
    stats = materialise(parts.groupBy("l", "k").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).join(total, ["l", "k"], "left"))
    a, b = (stats.select(F.col("l").alias(x), "k", *[F.col(c).alias(f"{c}{x}") for c in ("n", "good", "s")]) for x in "ab")
    dot = F.aggregate(F.zip_with("sa", "sb", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    means = a.join(b, "k").filter("a < b").groupBy("a", "b").agg(F.sum(F.col("na") * F.col("nb")).alias("n"), F.try_divide(F.sum(dot), F.sum(F.col("gooda") * F.col("goodb"))).alias("mean"))
    means = materialise(means)
    near = F.col("mean") > over - CLOSE
    for x in bounds:
        near = near | (F.abs(F.col("mean") - x) < CLOSE)
    open_ = means.filter(near).select("a", "b")
    if not open_.limit(1).count():
        return means.withColumn("least", F.col("mean"))

    def products(x: pa.Table, y: pa.Table) -> pa.Table:
        u, v, total, least, n = _units(x.column("v")), _units(y.column("w")), 0.0, None, 0
        if len(u) and len(v):
            c = np.round(u @ v.T, 9)
            total, n, least = float(c.sum()), c.size, float(np.nan if np.isnan(c).all() else np.nanmin(c))
        return pa.table({"a": x.column("a").slice(0, 1) if len(x) else y.column("a_").slice(0, 1), "b": x.column("b").slice(0, 1) if len(x) else y.column("b_").slice(0, 1), "n_": pa.array([n], pa.int64()), "total": pa.array([total]), "least": pa.array([least], pa.float64())})

    cuts = stats.select("l", "k", F.ceil(F.col("n") / ROWS).cast("int").alias("cuts"))
    dealt = rows.join(cuts, ["l", "k"]).withColumn("cut", F.pmod(F.monotonically_increasing_id(), F.col("cuts")).cast("int")).drop("cuts")
    met = open_.join(cuts.select(F.col("l").alias("a"), "k", F.col("cuts").alias("ca")), "a").join(cuts.select(F.col("l").alias("b"), "k", F.col("cuts").alias("cb")), ["b", "k"])
    jobs = materialise(met.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ca") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("cb") - 1))).select("a", "b", "k", "i", "j"))
    key = ["a", "b", "k", "i", "j"]
    left = jobs.join(dealt.select(F.col("l").alias("a"), "k", F.col("cut").alias("i"), "v"), ["a", "k", "i"]).select(*key, "v")
    right = jobs.join(dealt.select(F.col("l").alias("b"), "k", F.col("cut").alias("j"), "v"), ["b", "k", "j"]).select(*[F.col(c).alias(f"{c}_") for c in key], F.col("v").alias("w"))
    made = left.groupBy(*key).cogroup(right.groupBy(*[f"{c}_" for c in key])).applyInArrow(products, f"a {kind}, b {kind}, n_ long, total double, least double")
    exact = made.groupBy("a", "b").agg((F.sum("total") / F.sum("n_")).alias("mean_"), F.min("least").alias("least_"))
    return means.join(exact, ["a", "b"], "left").select("a", "b", "n", F.coalesce("mean_", "mean").alias("mean"), F.coalesce("least_", "mean").alias("least"))


def contained(small: DataFrame, large: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs in which the first array's elements are all in the second. They meet by the element of the first that the
    fewest of the second have, so a common element is nobody's key unless there is no other; then they are tested."""
    right = large.withColumn("k_", F.explode(F.array_distinct(F.col(b))))
    many = right.groupBy(F.col("k_").alias("e_")).agg(F.count("*").alias("n_"))
    known = small.withColumn("row_", F.struct(*[F.col(c) for c in small.columns])).select("row_", F.explode(F.array_distinct(F.col(a))).alias("e_"))
    rarest = known.join(many, "e_", "left").groupBy("row_").agg(F.min(F.struct(F.coalesce("n_", F.lit(0)).alias("n"), F.col("e_").alias("e")))["e"].alias("k_"))
    return rarest.select("row_.*", "k_").join(right, "k_").filter(F.size(F.array_except(a, b)) == 0).drop("k_")


def overlap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Share of the first box that the second covers."""
    w = F.greatest(F.least(ax1, bx1) - F.greatest(ax0, bx0), F.lit(0))
    h = F.greatest(F.least(ay1, by1) - F.greatest(ay0, by0), F.lit(0))
    return F.try_divide(w * h, (ax1 - ax0) * (ay1 - ay0))


def greedy_one_to_one(pairs: DataFrame, group: str, left: str, right: str, order: str, cap: int | None = None) -> DataFrame:
    """Inside each group, pairs in order are taken while both ends are free and the cap is not reached.

    The choice is sequential, so a group is one task's work; give connected components or regions as groups."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        used_l, used_r, rows = set(), set(), []
        for r in pdf.sort_values([order, left, right], kind="stable").itertuples(index=False):
            a, b = getattr(r, left), getattr(r, right)
            if a not in used_l and b not in used_r and (cap is None or len(rows) < cap):
                used_l.add(a)
                used_r.add(b)
                rows.append((getattr(r, group), a, b))
        return pd.DataFrame(rows, columns=[group, left, right])

    kind = dict(pairs.dtypes)
    return pairs.select(group, left, right, order).groupBy(group).applyInPandas(run, f"`{group}` {kind[group]}, `{left}` {kind[left]}, `{right}` {kind[right]}")


def best_in_window(df: DataFrame, candidates: DataFrame, key: list[str], guess: str, page: str, score: str, reach: int = 4) -> DataFrame:
    """The candidate page with the best score within the guess +- reach or among pages 0-2; ties take the later page."""
    met = df.join(candidates, key).filter(F.col(page).between(F.col(guess) - reach, F.col(guess) + reach) | F.col(page).isin(0, 1, 2))
    return met.groupBy(*key).agg(F.max_by(page, F.struct(score, page)).alias("page"), F.max(score).alias("score"))
