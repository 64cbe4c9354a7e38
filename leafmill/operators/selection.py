"""Choosing rows in vector space: density, farthest points, medoids, balanced and stratified samples, coverage.

Steps that are sequential over the whole set run as a short loop of distributed rounds whose state is one vector or
one batch of vectors; steps that are sequential inside a cluster run in one task for each cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.cells import counts_within, k_nearest, units
from leafmill.operators.joins import nearest
from leafmill.sources.scratch import forget, materialise, maybe_broadcast


def density(df: DataFrame, refs: DataFrame, id_col: str, vector: str, r: float = 0.2) -> DataFrame:
    """(id, density): share of the references nearer than cosine distance r."""
    whole = refs.agg(F.greatest(F.count("*"), F.lit(1)).alias("n_"))
    return counts_within(df, refs, id_col, vector, r).crossJoin(F.broadcast(whole)).select(id_col, (F.col("near") / F.col("n_")).alias("density"))


def farthest_points(df: DataFrame, id_col: str, vector: str, k: int, start: int | None = None, batch: int = 1, chosen: DataFrame | None = None) -> DataFrame:
    """(id, pick, distance): k rows, each the farthest from those picked before (cosine distance; ties the least id).

    A round is one distributed pass that keeps each row's distance to the set; with batch > 1 a round picks the `batch`
    farthest rows at once. With `chosen`, a bounded table of vectors, these are the set to begin with, and all k rows
    are far from them too. Picked rows are never picked again and k is bounded by the rows. The distances are written to
    the shared folder now and then, so a lost executor repeats few rounds."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"))
    first = rows.orderBy("id") if start is None else rows.filter(F.col("id") == start)
    given = [] if chosen is None else chosen.select(F.lit(None).cast("long").alias("id"), F.col(vector).alias("v")).collect()
    new = given or first.limit(1).collect()
    picks = [] if given else [(r.id, 0, 2.0) for r in new]
    state, written, since = rows.withColumn("d", F.lit(2.0)), None, 0
    while new and len(picks) < k:
        held = units(pa.array([list(map(float, r.v)) for r in new], pa.list_(pa.float64())))
        gone = [r.id for r in new if r.id is not None]

        def closer(batches: Iterator[pa.RecordBatch], held=held, gone=gone) -> Iterator[pa.RecordBatch]:
            for b in batches:
                d = np.minimum(b.column(2).to_numpy(zero_copy_only=False), np.round(1 - (units(b.column(1)) @ held.T).max(axis=1, initial=-1.0), 12)) if b.num_rows else np.zeros(0)
                d[np.isin(b.column(0).to_numpy(zero_copy_only=False), gone)] = -1.0
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(d)], names=["id", "v", "d"])

        state = state.mapInArrow(closer, state.schema)
        since += 1
        if since == 8:
            before, written, since = written, materialise(state), 0
            state = written
            if before is not None:
                forget(before)
        new = state.filter("d >= 0").orderBy(F.desc("d"), "id").limit(min(batch, k - len(picks))).collect()
        picks += [(r.id, len(picks) + i, float(r.d)) for i, r in enumerate(new)]
    return spark.createDataFrame(picks, "id long, pick int, distance double").withColumnRenamed("id", id_col)


def per_cluster(df: DataFrame, cluster: Sequence[str], id_col: str, vector: str, choose, columns: Sequence[str] = ()) -> DataFrame:
    """Applies choose(ids, unit vectors, frame) -> (ids, values) inside every cluster, one task each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(id_col, kind="stable").reset_index(drop=True)
        x = np.array(pdf[vector].tolist(), dtype=np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        ids, values = choose(pdf[id_col].to_numpy(), x, pdf)
        return pd.DataFrame({id_col: ids, "value": np.asarray(values, dtype=np.float64)})

    return df.select(*dict.fromkeys([*cluster, id_col, vector, *columns])).groupBy(*cluster).applyInPandas(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, value double")


def insertion_radii(ids, x, _):
    """k-center order from the row nearest the mean: distance of each row when it is inserted."""
    first = int(np.argmax(np.round(x @ x.mean(axis=0), 12)))
    near = np.full(len(x), np.inf)
    radii, at = np.zeros(len(x)), first
    for step in range(len(x)):
        radii[at] = near[at] if step else 2.0
        near = np.minimum(near, np.round(1 - x @ x[at], 12))
        near[at] = -1.0
        at = int(np.argmax(near))
    return ids, radii


def thin_to(q: int):
    """Removes the row with the closest neighbour (ties the later row) until q are left. Only each row's nearest
    neighbour is held; it is looked for again when that one goes, so memory is in proportion to the rows."""

    def choose(ids, x, _):
        alive = np.ones(len(x), dtype=bool)
        near, to = np.full(len(x), np.inf), np.full(len(x), -1)

        def look(rows: np.ndarray) -> None:
            for s in range(0, len(rows), 256):
                part = rows[s : s + 256]
                d = np.round(1 - x[part] @ x.T, 12)
                d[:, ~alive] = np.inf
                d[np.arange(len(part)), part] = np.inf
                to[part] = d.argmin(axis=1)
                near[part] = d[np.arange(len(part)), to[part]]

        look(np.arange(len(x)))
        for _ in range(len(x) - q):
            out = int(np.nonzero(near == near[alive].min())[0].max())
            alive[out] = False
            near[out] = np.inf
            look(np.nonzero(alive & (to == out))[0])
        return ids[alive], np.zeros(int(alive.sum()))

    return choose


def cluster(df: DataFrame, vector: str, k: int, seed: int = 0, weight: str | None = None):
    """Spherical k-means of MLlib: (rows with `cluster`, model)."""
    rows = df.withColumn("features_", array_to_vector(F.col(vector).cast("array<double>")))
    means = KMeans(k=k, seed=seed, featuresCol="features_", predictionCol="cluster", distanceMeasure="cosine", weightCol=weight) if weight else KMeans(k=k, seed=seed, featuresCol="features_", predictionCol="cluster", distanceMeasure="cosine")
    model = means.fit(rows)
    return model.transform(rows).drop("features_"), model


def medoids(df: DataFrame, id_col: str, vector: str, k: int, seed: int = 0, weight: str | None = None) -> DataFrame:
    """(id, cluster): the row nearest each centre of spherical k-means, each row once. Centres are k vectors."""
    rows, model = cluster(df, vector, k, seed, weight)
    centres = df.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    from leafmill.operators.joins import cosine

    met = rows.join(F.broadcast(centres), "cluster").withColumn("s_", F.round(cosine(F.col(vector), F.col("centre")), 12))
    return met.groupBy("cluster").agg(F.max_by(id_col, F.struct("s_", -F.col(id_col))).alias(id_col)).select(id_col, "cluster")


def hybrid(df: DataFrame, id_col: str, vector: str, k: int, boundary: float = 0.15, gamma: float = 0.5, trim: float = 0.25, r: float = 0.2, seed: int = 0, dense: DataFrame | None = None) -> DataFrame:
    """(id, kind): (1-boundary)k medoids weighted against density, and boundary*k points farthest from the medoids
    and from each other among the rows above the trimmed part of the densities. dense: (id, density), if known."""
    dense = density(df, df, id_col, vector, r) if dense is None else dense
    rows = df.join(dense, id_col).withColumn("w_", F.pow(F.greatest("density", F.lit(1e-6)), F.lit(-gamma)))
    inner = materialise(medoids(rows, id_col, vector, max(1, round(k * (1 - boundary))), seed, "w_").select(id_col, F.lit("medoid").alias("kind")))
    floor = rows.agg(F.percentile("density", F.lit(trim)).alias("f")).first().f
    outer = farthest_points(rows.filter(F.col("density") >= floor).join(inner, id_col, "left_anti"), id_col, vector, k - inner.count(), batch=8, chosen=rows.join(inner, id_col))
    return inner.unionAll(outer.select(id_col, F.lit("boundary").alias("kind")))


def select_by_group(df: DataFrame, id_col: str, vector: str, group: str, k: int, alpha: float = 0.5, few: int = 4, trim: float = 0.25, r: float = 0.2, seed: int = 0) -> DataFrame:
    """(id, kind): k rows, each group's quota by its size to the power of alpha, one at least. A group under its quota
    comes whole, of a quota under `few` the densest rows, of others the hybrid selection; what rounding leaves open is
    topped up with the rows farthest from all that are chosen. Groups are few (languages): each is a job of its own."""
    from leafmill.operators.allocators import water_fill

    dense = materialise(density(df, df, id_col, vector, r))
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    filled = water_fill(sizes, "n", F.lit(k), F.pow("n", F.lit(alpha)), key=[group])
    plan = materialise(filled.select(group, "n", F.greatest(F.lit(1), F.bround("quota", 0)).cast("int").alias("quota")))
    rows = materialise(df.join(dense, id_col).join(maybe_broadcast(plan.withColumnRenamed(group, "g_")), F.col(group).eqNullSafe(F.col("g_"))).drop("g_"))
    whole = rows.filter("quota >= n").select(id_col, F.lit("whole").alias("kind"))
    w = Window.partitionBy(group).orderBy(F.desc("density"), id_col)
    top = rows.filter((F.col("quota") < F.col("n")) & (F.col("quota") < few)).withColumn("r_", F.row_number().over(w)).filter("r_ <= quota").select(id_col, F.lit("dense").alias("kind"))
    out = whole.unionAll(top)
    for g in plan.filter((F.col("quota") < F.col("n")) & (F.col("quota") >= few)).orderBy(group).collect():
        mine = rows.filter(F.col(group).eqNullSafe(F.lit(g[group]))).drop("n", "quota")
        out = out.unionAll(hybrid(mine.drop("density"), id_col, vector, g.quota, trim=trim, seed=seed, dense=mine.select(id_col, "density")))
    out = materialise(out)
    missing = k - out.count()
    if missing <= 0:
        return out
    floor = dense.agg(F.percentile("density", F.lit(trim)).alias("f")).first().f
    free = rows.filter(F.col("density") >= floor).join(out, id_col, "left_anti")
    more = farthest_points(free, id_col, vector, missing, chosen=rows.join(out.select(id_col), id_col, "left_semi"))
    return out.unionAll(more.select(id_col, F.lit("top-up").alias("kind")))


def stratified_farthest(df: DataFrame, strata: Sequence[str], id_col: str, vector: str, quotas: DataFrame) -> DataFrame:
    """Farthest points inside each stratum up to its quota (strata, quota)."""

    def choose(ids, x, pdf):
        n = min(int(pdf["quota"].iloc[0]), len(x))
        near, order, at = np.full(len(x), 2.0), [], 0
        for _ in range(n):
            order.append(at)
            near = np.minimum(near, np.round(1 - x @ x[at], 12))
            near[order] = -1.0
            at = int(np.argmax(near))
        return ids[order], np.arange(n)

    return per_cluster(df.join(maybe_broadcast(quotas), list(strata)), strata, id_col, vector, choose, ["quota"]).withColumnRenamed("value", "pick")


def coverage(df: DataFrame, selected: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Distances of all rows to the nearest selected one (themselves left out), and the spacing among the selected."""
    d = lambda q: nearest(q, selected, id_col, vector).select((1 - F.col("similarity")).alias("d"))
    stats = [F.avg("d").alias("mean"), F.percentile("d", F.lit(0.5)).alias("p50"), F.percentile("d", F.lit(0.99)).alias("p99"), F.max("d").alias("max")]
    return d(df).agg(*stats).withColumn("of", F.lit("all")).unionByName(d(selected).agg(*stats).withColumn("of", F.lit("selected")))


def inverse_density_mass(df: DataFrame, id_col: str, vector: str, k: int, total: float) -> DataFrame:
    """(id, mass): masses that grow with the volume a row has to itself (its k-th neighbour's distance to the power of
    the intrinsic dimension by Levina and Bickel), summing to `total`."""
    near = k_nearest(df, df, id_col, vector, k).withColumn("d", F.sqrt(F.greatest(2 - 2 * F.col("similarity"), F.lit(1e-12))))
    of = near.groupBy("src").agg(F.max("d").alias("far"), F.avg(F.ln("d")).alias("mean_ln"))
    dimension = of.agg((1 / F.avg(F.ln("far") - F.col("mean_ln"))).alias("dim"))
    mass = of.crossJoin(F.broadcast(dimension)).withColumn("m", F.pow("far", "dim"))
    whole = mass.agg(F.sum("m").alias("s"))
    return mass.crossJoin(F.broadcast(whole)).select(F.col("src").alias(id_col), (F.col("m") / F.col("s") * total).alias("mass"))


def midpoints(df: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """Virtual rows: the normalised midpoint of each row and each of its k nearest, once for each pair;
    length is that of the sum before it is normalised."""
    pairs = k_nearest(df, df, id_col, vector, k).select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()
    va, vb = df.select(F.col(id_col).alias("a"), F.col(vector).alias("va")), df.select(F.col(id_col).alias("b"), F.col(vector).alias("vb"))
    met = pairs.join(va, "a").join(vb, "b").withColumn("s", F.zip_with("va", "vb", lambda x, y: x.cast("double") + y))
    norm = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, x: t + x * x))
    return met.withColumn("n", norm).filter("n > 0").select("a", "b", F.col("n").alias("length"), F.transform("s", lambda x: x / F.col("n")).alias("midpoint"))


def drift(old: DataFrame, new: DataFrame, id_col: str, vector: str, limits: Sequence[float] = (0.99, 0.97, 0.95, 0.9)) -> DataFrame:
    """Cosines of old and new vectors of the same key: quantiles and counts under each limit."""
    from leafmill.operators.joins import cosine

    both = old.select(id_col, F.col(vector).alias("o")).join(new.select(id_col, F.col(vector).alias("n")), id_col).select(F.round(cosine(F.col("o"), F.col("n")), 9).alias("c"))
    return both.agg(F.percentile("c", F.array(*[F.lit(q) for q in (0.0, 0.001, 0.01, 0.05, 0.5)])).alias("quantiles"), F.array(*[F.count_if(F.col("c") < x) for x in limits]).alias("under"), F.count("*").alias("n"))


def gap_cells(df: DataFrame, centres: DataFrame, id_col: str, vector: str, thin: int) -> DataFrame:
    """Centres with at most `thin` rows nearest to them."""
    hits = nearest(df, centres, id_col, vector, drop_self=False).groupBy(F.col("dst").alias(id_col)).agg(F.count("*").alias("n"))
    return centres.select(F.col(id_col).cast("long").alias(id_col)).join(hits, id_col, "left").select(id_col, F.coalesce("n", F.lit(0)).alias("n")).filter(F.col("n") <= thin)


def class_border(df: DataFrame, id_col: str, vector: str, label: str, k: int = 10) -> DataFrame:
    """(id, border): share of the k nearest that carry another label."""
    labels = df.select(F.col(id_col).cast("long").alias("i"), F.col(label).alias("l"))
    near = k_nearest(df, df, id_col, vector, k).join(labels.withColumnsRenamed({"i": "dst", "l": "ld"}), "dst").join(labels.withColumnsRenamed({"i": "src", "l": "ls"}), "src")
    return near.groupBy(F.col("src").alias(id_col)).agg(F.avg((F.col("ld") != F.col("ls")).cast("double")).alias("border"))


def one_per_document(df: DataFrame, document: str, order: Sequence, cls: Sequence[str], n: int) -> DataFrame:
    """The best row of each document, then the first n of each class."""
    w = Window.partitionBy(document).orderBy(*order)
    best = df.withColumn("r_", F.row_number().over(w)).filter("r_ = 1")
    return best.withColumn("r_", F.row_number().over(Window.partitionBy(*cls).orderBy(*order))).filter(F.col("r_") <= n).drop("r_")


def fused(df: DataFrame, parts: Sequence[tuple[str, float]], out: str = "fused") -> DataFrame:
    """Several vectors of a row as one: each centred on its mean over all rows, weighted, one after the other."""
    from leafmill.operators.evidence import mean_vector

    centred = lambda weight: lambda x, m: (x.cast("double") - m) * weight
    for i, (c, weight) in enumerate(parts):
        mean = mean_vector(df.withColumn("all_", F.lit(0)), ["all_"], c).select(F.col("mean").alias(f"m{i}_"))
        df = df.crossJoin(F.broadcast(mean)).withColumn(f"f{i}_", F.zip_with(F.col(c), F.col(f"m{i}_"), centred(weight))).drop(f"m{i}_")
    names = [f"f{i}_" for i in range(len(parts))]
    return df.withColumn(out, F.concat(*names)).drop(*names)


def text_scores(df: DataFrame, id_col: str, vector: str, texts: DataFrame, name: str, text_vector: str) -> DataFrame:
    """(id, name, score): cosine of the first half of each row's vector with each text vector. texts is a short list."""
    from leafmill.operators.joins import cosine

    half = F.slice(F.col(vector), F.lit(1), (F.size(vector) / 2).cast("int"))
    return df.select(id_col, half.alias("h_")).crossJoin(maybe_broadcast(texts.select(name, F.col(text_vector).alias("t_")))).select(id_col, name, cosine(F.col("h_"), F.col("t_")).alias("score"))


def neighbour_agreement(a: DataFrame, b: DataFrame, id_col: str, vector: str, k: int = 10) -> DataFrame:
    """Mean share of each row's k neighbours in one space that are neighbours in the other."""
    lists = lambda d, c: k_nearest(d, d, id_col, vector, k).groupBy("src").agg(F.collect_set("dst").alias(c))
    return lists(a, "x").join(lists(b, "y"), "src").agg(F.avg(F.size(F.array_intersect("x", "y")) / k).alias("agreement"))


def border_by_direction(df: DataFrame, id_col: str, vector: str, directions: int, low: float = 0.005) -> DataFrame:
    """(direction, side, id): for each principal direction the rows nearest its low and high projection quantiles."""
    from leafmill.operators.learned import apply_matrix, principal_axes

    mean, axes = principal_axes(df, vector, directions)
    long = apply_matrix(df.select(id_col, vector), vector, axes, mean, "p_").select(id_col, F.posexplode("p_").alias("direction", "x"))
    cuts = long.groupBy("direction").agg(F.percentile("x", F.lit(low)).alias("low"), F.percentile("x", F.lit(1 - low)).alias("high"))
    met = long.join(F.broadcast(cuts), "direction")
    pick = lambda side: F.min_by(id_col, F.struct(F.abs(F.col("x") - F.col(side)), id_col)).alias(side)
    return met.groupBy("direction").agg(pick("low"), pick("high")).select("direction", F.explode(F.create_map(F.lit("low"), "low", F.lit("high"), "high")).alias("side", id_col))


def prune_by_density(df: DataFrame, id_col: str, vector: str, n: int, k: int, temperature: float = 0.1, seed: int = 0) -> DataFrame:
    """Rows kept of k clusters: quota by softmax of (distance between centres x spread inside) under each cluster's size,
    the farthest from the centre first."""
    from leafmill.operators.allocators import softmax_quota
    from leafmill.operators.joins import cosine

    rows, model = cluster(df, vector, k, seed)
    centres = np.array([c for c in model.clusterCenters()])
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    inter = np.sort(1 - unit @ unit.T, axis=1)[:, 1:2].mean(axis=1) if k > 1 else np.ones(k)
    table = df.sparkSession.createDataFrame([(i, [float(v) for v in c], float(x)) for i, (c, x) in enumerate(zip(centres, inter, strict=True))], "cluster int, centre array<double>, inter double")
    far = rows.join(F.broadcast(table), "cluster").withColumn("d_", F.round(1 - cosine(F.col(vector), F.col("centre")), 12))
    groups = far.groupBy("cluster").agg((F.first("inter") * F.avg("d_") / temperature).alias("score"), F.count("*").alias("size"))
    quota = softmax_quota(groups, "score", "size", n, ["cluster"]).select("cluster", "quota")
    placed = far.join(maybe_broadcast(quota), "cluster").withColumn("r_", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("d_"), id_col)))
    return placed.filter(F.col("r_") <= F.col("quota")).select(id_col, "cluster")


def hierarchical_sample(df: DataFrame, id_col: str, vector: str, n: int, fine: int, coarse: int, seed: int = 0) -> DataFrame:
    """n rows spread evenly over coarse clusters of fine clusters: water levels from the top down, hashed order inside."""
    from leafmill.operators.allocators import water_level

    rows, model = cluster(df, vector, fine, seed)
    tops = df.sparkSession.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())], "leaf int, centre array<double>")
    above, _ = cluster(tops, "centre", min(coarse, fine), seed)
    placed = rows.withColumnRenamed("cluster", "leaf").join(F.broadcast(above.select("leaf", F.col("cluster").alias("top"))), "leaf")
    leaves = placed.groupBy("top", "leaf").agg(F.count("*").alias("n"))
    top = water_level(leaves.groupBy("top").agg(F.sum("n").alias("s")), "s", F.lit(n), ["top"], out="tq").select("top", "tq")
    quota = water_level(leaves.join(top, "top"), "n", F.col("tq"), ["leaf"], by=["top"]).select("leaf", "quota")
    at = F.row_number().over(Window.partitionBy("leaf").orderBy(F.md5(F.col(id_col).cast("string")), id_col))
    return placed.join(maybe_broadcast(quota), "leaf").withColumn("r_", at).filter(F.col("r_") <= F.col("quota")).select(id_col, "top", "leaf")


def landings(new: DataFrame, points: DataFrame, id_col: str, vector: str, radius: float) -> DataFrame:
    """(src, dst, distance): each new row on its nearest open point within the radius, one row for each point."""
    near = nearest(new, points, id_col, vector, drop_self=False).withColumn("distance", F.round(1 - F.col("similarity"), 12)).filter(F.col("distance") <= radius)
    return near.withColumn("r_", F.row_number().over(Window.partitionBy("dst").orderBy("distance", "src"))).filter("r_ = 1").select("src", "dst", "distance")


def elimination(weight: float = 1.0, kept: int = 1):
    """Weighted sample elimination: of rows as crowded as their close neighbours make them, the most crowded goes until
    `kept` are left (ties the later row). The reach shrinks with the number of rows that stay."""

    def choose(ids, x, _):
        n, left = len(x), min(kept, len(x))
        d = lambda rows: np.sqrt(np.maximum(2 - 2 * np.round(x[rows] @ x.T, 12), 0.0))
        sample = np.linspace(0, n - 1, min(n, 256)).astype(int)
        reach = 2 * np.quantile(d(sample), min(1.0, 1 / max(1, left)))
        crowd = np.zeros(n)
        for s in range(0, n, 256):
            rows = np.arange(s, min(n, s + 256))
            near = d(rows)
            near[np.arange(len(rows)), rows] = reach
            crowd[rows] = (np.maximum(0.0, 1 - np.minimum(near, reach) / max(reach, 1e-300)) ** (8 * weight)).sum(axis=1)
        alive = np.ones(n, dtype=bool)
        for _step in range(n - left):
            at = np.nonzero(alive)[0]
            out = int(at[np.nonzero(np.round(crowd[at], 9) == np.round(crowd[at], 9).max())[0].max()])
            alive[out] = False
            near = d(np.array([out]))[0]
            crowd -= np.where(np.arange(n) == out, 0.0, np.maximum(0.0, 1 - np.minimum(near, reach) / max(reach, 1e-300)) ** (8 * weight))
        return ids[alive], crowd[alive]

    return choose


def herding(k: int, width: float = 0.5):
    """Kernel herding: each pick is where the rows' mean kernel most exceeds that of the picks before it (ties the earlier
    row); the value is the pick's place."""

    def choose(ids, x, _):
        kernel = lambda rows: np.exp(-(2 - 2 * np.round(x[rows] @ x.T, 12)) / (2 * width**2))
        mean = np.concatenate([kernel(np.arange(s, min(len(x), s + 256))).mean(axis=1) for s in range(0, len(x), 256)]) if len(x) else np.zeros(0)
        taken, sums = [], np.zeros(len(x))
        for step in range(min(k, len(x))):
            score = np.round(mean - sums / (step + 1), 12)
            score[taken] = -np.inf
            at = int(score.argmax())
            taken.append(at)
            sums += kernel(np.array([at]))[0]
        return ids[taken], np.arange(len(taken))

    return choose


def seed_rounds(candidates: DataFrame, targets: DataFrame, id_col: str, vector: str, shift: tuple[np.ndarray, np.ndarray, np.ndarray], by: str, per_round: int, rounds: int, radius: float) -> DataFrame:
    """(id, by, target, round): candidates whose predicted vectors (shift: mean, matrix, mean of a ridge) come nearest to
    targets that no earlier pick has covered. A round takes the best per_round of each `by`, one for each target; targets
    within the radius of a pick are covered. Stops when no target is left; targets and picks of a round are small tables."""
    from leafmill.operators.learned import apply_matrix

    mean, matrix, offset = shift
    moved = apply_matrix(candidates.select(id_col, by, F.col(vector).cast("array<double>").alias(vector)), vector, matrix, mean, "moved_")
    rows = materialise(moved.select(F.col(id_col).cast("long").alias(id_col), by, F.zip_with("moved_", F.array(*[F.lit(float(v)) for v in offset]), lambda a, b: a + b).alias(vector)))
    left, out = materialise(targets.select(F.col(id_col).cast("long").alias(id_col), F.col(vector).cast("array<double>").alias(vector))), None
    for turn in range(rounds):
        if not left.limit(1).count():
            break
        free = rows if out is None else rows.join(out.select(id_col), id_col, "left_anti")
        near = nearest(free, left, id_col, vector, drop_self=False).join(free.select(F.col(id_col).alias("src"), by), "src")
        one = near.withColumn("r_", F.row_number().over(Window.partitionBy("dst").orderBy(F.desc("similarity"), "src"))).filter("r_ = 1")
        best = one.withColumn("r_", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("similarity"), "src"))).filter(F.col("r_") <= per_round)
        new = materialise(best.select(F.col("src").alias(id_col), by, F.col("dst").alias("target"), F.lit(turn).alias("round")))
        if not new.limit(1).count():
            break
        out = new if out is None else out.unionAll(new)
        picked = rows.join(new.select(id_col), id_col, "left_semi")
        covered = nearest(left, picked, id_col, vector, drop_self=False).filter(F.round(1 - F.col("similarity"), 12) <= radius).select(F.col("src").alias(id_col))
        hit = covered.unionAll(new.select(F.col("target").alias(id_col))).distinct()
        left = materialise(left.join(hit, id_col, "left_anti"))
    return out if out is not None else rows.limit(0).select(id_col, by, F.lit(None).cast("long").alias("target"), F.lit(0).alias("round"))


def identical_groups(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, group): rows of equal vectors share the least id among them; rows of null vectors are groups of their own."""
    least = df.filter(F.col(vector).isNotNull()).groupBy(F.col(vector).alias("v_")).agg(F.min(id_col).alias("g_"))
    return df.select(id_col, vector).join(least, F.col(vector) == F.col("v_"), "left").select(id_col, F.coalesce("g_", F.col(id_col)).alias("group"))
