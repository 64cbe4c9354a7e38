"""Models fitted on Spark: projections, whitening, ridge, logistic scores, out-of-fold predictions, importance.

Sums of outer products are d*d numbers whatever the rows are; they are added on the executors and solved on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _moments(df: DataFrame, vector: str, group: str | None = None, target: str | None = None) -> dict:
    """Sums of rows, of their outer products and of their products with a target vector, by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = {}
        for batch in batches:
            pdf = batch.to_pandas()
            for g, part in pdf.groupby("g", dropna=False):
                x = np.array(part["v"].tolist(), dtype=np.float64)
                y = np.array(part["t"].tolist(), dtype=np.float64) if "t" in part else np.zeros((len(x), 0))
                new = [float(len(x)), x.sum(axis=0), x.T @ x, x.T @ y, y.sum(axis=0)]
                found[g] = [a + b for a, b in zip(found[g], new, strict=True)] if g in found else new
        if found:
            yield pa.RecordBatch.from_pydict({"g": [str(g) for g in found], "s": [np.concatenate([np.ravel(a) for a in v]).tolist() for v in found.values()]})

    columns = [F.coalesce(F.col(group).cast("string"), F.lit("")).alias("g") if group else F.lit("").alias("g"), F.col(vector).alias("v")]
    parts = df.select(*columns, *([F.col(target).alias("t")] if target else [])).mapInArrow(run, "g string, s array<double>")
    summed = parts.select("g", F.posexplode("s")).groupBy("g", "pos").agg(F.sum("col").alias("x")).groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias("s"))
    out = {}
    first = df.select(F.size(vector).alias("d"), *([F.size(target).alias("m")] if target else [])).first()
    if first is None:
        return out
    d, m = first.d, first.m if target else 0
    for r in summed.collect():
        s = np.array(r.s)
        cuts = np.cumsum([1, d, d * d, d * m])
        n, a, b, c, e = np.split(s, cuts)
        out[r.g] = (n[0], a, b.reshape(d, d), c.reshape(d, m), e)
    return out


def apply_matrix(df: DataFrame, vector: str, matrix: np.ndarray, shift: np.ndarray, out: str) -> DataFrame:
    """out = (vector - shift) @ matrix for every row."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(vector)
            x = np.array(batch.column(at).to_pylist(), dtype=np.float64).reshape(batch.num_rows, -1)
            y = (x - shift) @ matrix if batch.num_rows else np.zeros((0, matrix.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(y), pa.list_(pa.float64()))], names=[*names, out])

    return df.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{out}` array<double>"]))


def principal_axes(df: DataFrame, vector: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, d x k axes) by the covariance; each axis points to its largest entry. Reuse both for rows added later."""
    n, a, b, _, _ = _moments(df, vector)[""]
    mean = a / n
    values, axes = np.linalg.eigh(b / n - np.outer(mean, mean))
    axes = axes[:, np.argsort(-values, kind="stable")[:k]]
    return mean, axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])


def whitening(df: DataFrame, vector: str, label: str, shrink: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(mean, d x d matrix) that makes the shrunk within-class covariance the identity."""
    parts = _moments(df, vector, label).values()
    n = sum(p[0] for p in parts)
    within = sum(p[2] - np.outer(p[1], p[1]) / p[0] for p in parts) / n
    d = len(within)
    within = (1 - shrink) * within + shrink * np.trace(within) / d * np.eye(d)
    values, axes = np.linalg.eigh(within)
    return sum(p[1] for p in parts) / n, axes @ np.diag(values**-0.5) @ axes.T


def ridge(df: DataFrame, vector: str, target: str, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean of inputs, d x m matrix, mean of targets) of a ridge regression by its normal equations."""
    n, a, b, c, e = _moments(df, vector, target=target)[""]
    mx, my = a / n, e / n
    return mx, np.linalg.solve(b - n * np.outer(mx, mx) + penalty * np.eye(len(a)), c - n * np.outer(mx, my)), my


def balanced_weight(label: Column, df: DataFrame) -> Column:
    """Weight n / (classes * n of the class)."""
    counts = df.groupBy(label.alias("l_")).agg(F.count("*").alias("n_")).collect()
    total = sum(r.n_ for r in counts)
    out = F.lit(0.0)
    for r in counts:
        out = F.when(label.eqNullSafe(F.lit(r.l_)), F.lit(total / (len(counts) * r.n_))).otherwise(out)
    return out


def logistic_scores(train: DataFrame, rows: DataFrame, vector: str, label: str, balanced: bool = True, strength: float = 0.01) -> DataFrame:
    """rows with p, the probability of label 1, by MLlib's logistic regression fitted on train."""
    feats = lambda d: d.withColumn("features_", array_to_vector(F.col(vector).cast("array<double>")))
    weighted = feats(train).withColumn("w_", balanced_weight(F.col(label), train) if balanced else F.lit(1.0))
    model: Model = LogisticRegression(featuresCol="features_", labelCol=label, weightCol="w_", regParam=strength, probabilityCol="p_", rawPredictionCol="r_", predictionCol="yhat_").fit(weighted)
    return model.transform(feats(rows)).withColumn("p", F.get(vector_to_array("p_"), F.lit(1))).drop("features_", "p_", "r_", "yhat_")


def accepted_or_confident(rows: DataFrame, status: str, vector: str, least: float) -> DataFrame:
    """Fits accepted against rejected rows; keeps the accepted and, of the unreviewed, those of probability >= least."""
    known = rows.filter(F.col(status).isin("accepted", "rejected")).withColumn("y_", (F.col(status) == "accepted").cast("double"))
    return logistic_scores(known, rows, vector, "y_").filter((F.col(status) == "accepted") | ((F.col("p") >= least) & ~F.col(status).eqNullSafe(F.lit("rejected"))))


def out_of_fold(df: DataFrame, vector: str, label: str, group: str, folds: int = 5, boosted: bool = False) -> DataFrame:
    """df with p fitted without the row's fold; folds hold whole groups (by hash). A fold whose training rows lack a
    class gives it probability 0 (or 1 to the only one)."""
    rows = df.withColumn("fold_", F.pmod(F.xxhash64(group), F.lit(folds)))
    out = None
    for k in range(folds):
        train, test = rows.filter(F.col("fold_") != k), rows.filter(F.col("fold_") == k)
        classes = [r[0] for r in train.select(label).distinct().collect()]
        if len(classes) < 2:
            part = test.withColumn("p", F.lit(float(classes[0]) if classes else 0.0))
        elif boosted:
            feats = lambda d: d.withColumn("features_", array_to_vector(F.col(vector).cast("array<double>")))
            model = GBTClassifier(featuresCol="features_", labelCol=label, maxIter=20, maxDepth=3, seed=1).fit(feats(train))
            part = model.transform(feats(test)).withColumn("p", F.get(vector_to_array("probability"), F.lit(1))).select(*test.columns, "p")
        else:
            part = logistic_scores(train, test, vector, label).select(*test.columns, "p")
        out = part if out is None else out.unionByName(part)
    return out.drop("fold_")


def permutation_importance(df: DataFrame, score: Callable[[DataFrame], float], columns: Sequence[str], seed: str = "") -> dict[str, float]:
    """Drop of a score when one column's values are dealt anew among the rows in hashed order."""
    base = score(df)
    out = {}
    from leafmill.operators.ranking import hash_bucket, running_over_all

    key = "row_"
    numbered = running_over_all(df, hash_bucket(F.md5(F.to_json(F.struct(*df.columns)))), [F.to_json(F.struct(*df.columns))], out=key)
    for c in columns:
        mark = F.md5(F.concat(F.lit(seed + c), F.col(key).cast("string")))
        dealt = running_over_all(numbered.select(F.col(key), F.col(c).alias("new_")), hash_bucket(mark), [mark], out="to_").select(F.col("to_").alias(key), "new_")
        out[c] = base - score(numbered.join(dealt, key).withColumn(c, F.col("new_")).drop("new_", key))
    return out


def forward_search(groups: dict[str, Sequence[str]], error: Callable[[Sequence[str]], float], least_gain: float = 0.0) -> list[str]:
    """Adds the feature group that lowers the held-out error most until none does."""
    chosen, best = [], float("inf")
    while len(chosen) < len(groups):
        trials = {g: error([c for name in (*chosen, g) for c in groups[name]]) for g in groups if g not in chosen}
        g = min(trials, key=lambda k: (trials[k], k))
        if best - trials[g] <= least_gain:
            break
        chosen.append(g)
        best = trials[g]
    return chosen
