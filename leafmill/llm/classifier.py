"""Quality classifier with hierarchical empirical Bayes.

A linear model judges each text by itself. Labelled rows are counted by site and by path within the site; a path's rate
is drawn towards its site's and a site's towards the global rate, the more the sparser it is, with strengths that
the spread of the rates themselves tells. The path's posterior then replaces the global prior of the text's odds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import materialise, maybe_broadcast, table

#: The linear models are fitted on about so many labelled rows at most, chosen by a hash of the id.
LABELLED = 6000
FEATURES = 1 << 18
ROUNDS = 300
RIDGE = 0.3
LEAST_SCORE = 4.0
LEAST_ROWS = 5
#: Prior strengths are kept within these bounds.
WEAKEST, STRONGEST = 5.0, 1e6
WORD = re.compile(r"[^\W\d_]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")


def _bin(share: float) -> int:
    """Coarse steps of a share, finer near nought."""
    return int(min(9, math.floor(math.sqrt(max(0.0, share)) * 10)))


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a whole text: lower-case words, and steps of its shape."""
    if not text:
        return np.array([xxhash.xxh32_intdigest("empty") % FEATURES], dtype=np.int64)
    words = text.split()
    letters = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    upper = sum(w.isupper() and len(w) > 1 for w in letters)
    shape = (
        f" length {int(math.log2(n))}", f" symbols {_bin(len(SYMBOLS.findall(text)) / max(1, len(text)))}", f" upper {_bin(upper / max(1, len(letters)))}",
        f" distinct {_bin(1 - len(set(words)) / n)} {min(4, int(math.log2(n)) // 3)}", f" lines {_bin(1 - len(set(lines)) / max(1, len(lines)))}", f" chars {min(12, len(text) // n)}",
    )
    found = {w.lower() for w in letters}
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(f) % FEATURES for f in (*found, *shape)), dtype=np.int64))


@dataclass
class LinearModel:
    weights: np.ndarray
    bias: float

    def logit(self, at: np.ndarray) -> float:
        return self.bias + float(self.weights[at].sum())


def fit_linear(rows: list[np.ndarray], y: np.ndarray) -> LinearModel:
    """Ridge logistic regression over binary features by full-batch Adam with a fixed start. Only features that part
    the classes beyond chance (a score of LEAST_SCORE standard errors, LEAST_ROWS rows) get a weight: with many
    thousand words the others would only learn single rows by heart."""
    if not len(rows) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return LinearModel(np.zeros(FEATURES, dtype=np.float32), math.log(rate / (1 - rate)))
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    every = np.concatenate(rows)
    ones = y.sum()
    a, n = np.bincount(every, weights=y[row], minlength=FEATURES), np.bincount(every, minlength=FEATURES)
    share = n / len(y)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / ones + 1 / (len(y) - ones)))
    score = np.abs(a / ones - (n - a) / (len(y) - ones)) / error
    columns = np.nonzero((score >= LEAST_SCORE) & (n >= LEAST_ROWS))[0]
    number = np.full(FEATURES, -1)
    number[columns] = np.arange(len(columns))
    kept = number[every] >= 0
    row, place = row[kept], number[every[kept]]
    w, bias = np.zeros(len(columns)), math.log(ones / (len(y) - ones))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        z = bias + np.bincount(row, weights=w[place], minlength=len(y))
        wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(place, weights=wrong[row], minlength=len(columns)) + RIDGE * w / len(y)
        gb = wrong.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= 0.1 * fix * m / (np.sqrt(v) + 1e-8)
        bias -= 0.05 * fix * mb / (math.sqrt(vb) + 1e-8)
    full = np.zeros(FEATURES, dtype=np.float32)
    full[columns] = w
    return LinearModel(full, bias)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names[:-1], "features"])


def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def shrink(cells: DataFrame, prior: Column, strength: float) -> Column:
    """Posterior rate of a cell with k of n, drawn to `prior` with `strength` pseudo-rows."""
    return (F.coalesce("k", F.lit(0)) + strength * prior) / (F.coalesce("n", F.lit(0)) + strength)


def strength_of(cells: DataFrame, prior: Column) -> float:
    """Moments: rates of cells spread by p(1-p)/n from chance and p(1-p)/(strength+1) from true differences."""
    p = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    chance = p * (1 - p)
    got = cells.filter("n > 0").agg(F.sum((F.col("k") - F.col("n") * p) ** 2 - F.col("n") * chance).alias("excess"), F.sum(chance * F.col("n") * (F.col("n") - 1)).alias("room")).first()
    if not got.room or got.excess is None or got.excess <= 0:
        return STRONGEST
    return float(min(STRONGEST, max(WEAKEST, got.room / got.excess - 1)))


def site_posteriors(labelled: DataFrame, target: str) -> tuple[DataFrame, float]:
    """labelled (site, path, target 0/1) -> (site, path, posterior rate of the path), and the global rate."""
    paths = materialise(labelled.groupBy("site", "path").agg(F.sum(target).cast("double").alias("k"), F.count(target).cast("double").alias("n")))
    whole = paths.agg(F.sum("k").alias("k"), F.sum("n").alias("n")).first()
    rate = ((whole.k or 0.0) + 0.5) / ((whole.n or 0.0) + 1.0)
    sites = paths.groupBy("site").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    of_site = strength_of(sites, F.lit(rate))
    drawn = materialise(sites.select(F.col("site").alias("site_"), shrink(sites, F.lit(rate), of_site).alias("site_rate")))
    joined = paths.join(drawn, F.col("site").eqNullSafe(F.col("site_"))).drop("site_")
    of_path = strength_of(joined, F.col("site_rate"))
    return materialise(joined.select("site", "path", shrink(joined, F.col("site_rate"), of_path).alias("rate"), "site_rate")), rate


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site: Column | None = None, path: Column | None = None, targets: tuple[str, ...] = ("quality", "toxic"), sample: int = LABELLED) -> DataFrame:
    """One row per row of docs: id and p_<target> for each target.

    labels has the id and 0/1 columns named by targets; null labels and ids are not learned from, and of several labels
    of one id and target the largest counts. All labelled rows enter the site and path rates; about `sample` of them fit
    the linear models. A site or path without labels has its parent's rate; null site or path is a value of its own.
    A null or empty text is judged by that and its site; a long text is read whole. Repeated rows are judged alike and
    each counts; without labels every probability is a half. Rates are compared to nothing, so there are no ties; a caller
    who cuts at a probability says on which side equality falls. Other columns of docs and labels are ignored, whatever
    their names. An empty table gives no rows. The site table is broadcast only while small."""
    site = F.col("source") if site is None else site
    path = F.col("lang") if path is None else path
    base = docs.select(F.col(id_col).alias("id"), site.cast("string").alias("site"), path.cast("string").alias("path"), F.col(text_col).alias("text"))
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(*[F.max(t).cast("int").alias(t) for t in targets])
    known = base.select("id", "site", "path").join(marks, "id")
    size = marks.count()
    some = marks.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(min(1.0, sample / max(1, size)) * 1_000_000))
    fitted = base.select("id", "text").join(maybe_broadcast(some, 2 * sample), "id").select(*targets, "text")
    kinds = ", ".join(f"`{t}` int" for t in targets)
    rows = fitted.mapInArrow(_features_of, f"{kinds}, features array<long>").toArrow()
    found = rows.column("features").to_pylist()
    models, out_site = [], None
    known = materialise(known)
    for t in targets:
        y = rows.column(t).to_pylist()
        use = [i for i, v in enumerate(y) if v is not None]
        models.append(fit_linear([np.array(found[i], dtype=np.int64) for i in use], np.array([y[i] for i in use], dtype=np.float64)))
        rates, rate = site_posteriors(known.filter(F.col(t).isNotNull()), t)
        shift = rates.select(F.col("site").alias("s_"), F.col("path").alias("p_"), (_logit(F.col("rate")) - _logit(F.lit(rate))).alias(f"shift_{t}"), (_logit(F.col("site_rate")) - _logit(F.lit(rate))).alias(f"of_site_{t}"))
        by_site = shift.groupBy(F.col("s_").alias("ss_")).agg(F.first(f"of_site_{t}").alias(f"of_site_{t}"))
        base = base.join(maybe_broadcast(shift.drop(f"of_site_{t}")), F.col("site").eqNullSafe(F.col("s_")) & F.col("path").eqNullSafe(F.col("p_")), "left").drop("s_", "p_")
        base = base.join(maybe_broadcast(materialise(by_site)), F.col("site").eqNullSafe(F.col("ss_")), "left").drop("ss_")
        base = base.withColumn(f"shift_{t}", F.coalesce(f"shift_{t}", f"of_site_{t}", F.lit(0.0))).drop(f"of_site_{t}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [features(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            own = [pa.array([m.logit(a) for a in at], pa.float64()) for m in models]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own], names=[*batch.schema.names[:-1], *[f"own_{t}" for t in targets]])

    chosen = base.select("id", *[f"shift_{t}" for t in targets], "text")
    kind = dict(chosen.dtypes)["id"]
    judged = chosen.mapInArrow(run, ", ".join([f"id {kind}", *[f"shift_{t} double" for t in targets], *[f"own_{t} double" for t in targets]]))
    return judged.select(F.col("id").alias(id_col), *[(1 / (1 + F.exp(-(F.col(f"own_{t}") + F.col(f"shift_{t}"))))).alias(f"p_{t}") for t in targets])


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from all labelled documents; held_out marks the third that tests leave out to measure it."""
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "p_quality", "p_toxic", ((F.col("p_quality") >= 0.5) & (F.col("p_toxic") <= 0.5)).alias("kept"))
