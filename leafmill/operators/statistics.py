"""Reports: votes, shares, associations, errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import running_over_all, value_bucket
from leafmill.sources.scratch import maybe_broadcast


def top_shares(df: DataFrame, by: Sequence[str], value: str, n: int) -> DataFrame:
    """"value share%" of the n most frequent values of each group, as one text."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n_"))
    ranked = counts.withColumn("r_", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n_"), value))).withColumn("t_", F.sum("n_").over(Window.partitionBy(*by)))
    text = F.concat(F.col(value).cast("string"), F.lit(" "), F.round(100.0 * F.col("n_") / F.col("t_"), 0).cast("long").cast("string"), F.lit("%"))
    parts = ranked.filter(F.col("r_") <= n).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("r_", text.alias("x_")))).alias("p_"))
    return parts.select(*by, F.array_join(F.transform("p_", lambda p: p["x_"]), ", ").alias("shares"))


def majority(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Most frequent value of each group (ties: the least) and its share."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n_"))
    w = Window.partitionBy(*by)
    ranked = counts.withColumn("t_", F.sum("n_").over(w)).withColumn("r_", F.row_number().over(w.orderBy(F.desc("n_"), value)))
    return ranked.filter("r_ = 1").select(*by, value, (F.col("n_") / F.col("t_")).alias("share"))


def weighted_vote(df: DataFrame, by: Sequence[str], label: str, weight: Column, least: float = 0.5, unknown="unknown") -> DataFrame:
    """Label of the greatest summed weight and its share of the total; `unknown` under the least share."""
    votes = df.groupBy(*by, label).agg(F.sum(F.greatest(weight, F.lit(0.0))).alias("v_"))
    w = Window.partitionBy(*by)
    ranked = votes.withColumn("t_", F.sum("v_").over(w)).withColumn("r_", F.row_number().over(w.orderBy(F.desc("v_"), label)))
    share = F.coalesce(F.try_divide("v_", "t_"), F.lit(0.0))
    return ranked.filter("r_ = 1").select(*by, F.when(share >= least, F.col(label).cast("string")).otherwise(F.lit(unknown)).alias("label"), share.alias("share"))


def value_shares(df: DataFrame, group: str, value: str, groups: Sequence) -> DataFrame:
    """Share of each value in each set, sets side by side, nought where missing."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n_")).withColumn("s_", F.col("n_") / F.sum("n_").over(Window.partitionBy(group)))
    return counts.groupBy(value).pivot(group, list(groups)).agg(F.first("s_")).na.fill(0.0)


def cramers_v(df: DataFrame, a: str, b: str) -> DataFrame:
    """Bias-corrected association of two columns: one contingency table, its margins as windows over it."""
    n = df.groupBy(a, b).agg(F.count("*").cast("double").alias("n_"))
    wa, wb, w = Window.partitionBy(a), Window.partitionBy(b), Window.partitionBy()
    e = n.withColumn("ra_", F.sum("n_").over(wa)).withColumn("cb_", F.sum("n_").over(wb)).withColumn("t_", F.sum("n_").over(w))
    # Cells without rows add their expected count: in all t minus the expected counts of the cells that have rows.
    x = F.col("ra_") * F.col("cb_") / F.col("t_")
    s = e.agg(F.sum((F.col("n_") - x) ** 2 / x).alias("chi"), F.sum(x).alias("seen"), F.max("t_").alias("t"), F.countDistinct(a).alias("r"), F.countDistinct(b).alias("c"))
    chi = F.col("chi") + F.col("t") - F.col("seen")
    phi = F.greatest(chi / F.col("t") - (F.col("r") - 1) * (F.col("c") - 1) / (F.col("t") - 1), F.lit(0.0))
    rr, cc = (F.col(k) - (F.col(k) - 1) ** 2 / (F.col("t") - 1) for k in ("r", "c"))
    return s.select(F.lit(a).alias("a"), F.lit(b).alias("b"), F.sqrt(F.coalesce(F.try_divide(phi, F.least(rr, cc) - 1), F.lit(0.0))).alias("v"))


def entropy(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Natural-log entropy of a column in each group, and its share of the greatest possible."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n_"))
    p = F.col("n_") / F.sum("n_").over(Window.partitionBy(*by))
    h = counts.withColumn("p_", p).groupBy(*by).agg((-F.sum(F.col("p_") * F.ln("p_"))).alias("entropy"), F.count("*").alias("k_"))
    return h.select(*by, "entropy", F.when(F.col("k_") > 1, F.col("entropy") / F.ln("k_")).otherwise(0.0).alias("normalised"))


def error_summary(df: DataFrame, by: Sequence[str], error: Column, near: float) -> DataFrame:
    e = F.abs(error)
    return df.groupBy(*by).agg(F.avg(e).alias("mean_abs"), F.percentile(e, F.lit(0.5)).alias("median_abs"), F.percentile(e, F.lit(0.9)).alias("p90_abs"), F.avg((e <= near).cast("double")).alias("within"), F.avg(error).alias("bias"))


def classification_report(df: DataFrame, truth: str, found: str) -> DataFrame:
    """Precision, recall, F1 and support of each class that occurs on either side."""
    cells = df.groupBy(truth, found).agg(F.count("*").alias("n_"))
    t = cells.groupBy(F.col(truth).alias("class")).agg(F.sum("n_").alias("support"), F.sum(F.when(F.col(truth) == F.col(found), F.col("n_")).otherwise(0)).alias("hit"))
    p = cells.groupBy(F.col(found).alias("class")).agg(F.sum("n_").alias("called"))
    both = t.join(p, "class", "full_outer").na.fill(0, ["support", "hit", "called"])
    precision, recall = F.coalesce(F.try_divide("hit", "called"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return both.select("class", precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"), "support")


def mass_set(df: DataFrame, value: str, share: float) -> DataFrame:
    """The most frequent values until their running share reaches `share` (the one that reaches it included)."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"))
    ranked = running_over_all(counts, value_bucket(counts, (-F.col("n")).cast("double")), [F.desc("n"), value], F.col("n"), "upto_")
    total = counts.agg(F.sum("n").alias("t_"))
    return ranked.crossJoin(F.broadcast(total)).filter(F.col("upto_") - F.col("n") < share * F.col("t_")).select(value, "n")


def short_cells(df: DataFrame, a: str, b: str, least: int) -> DataFrame:
    """Full grid of two columns' values with counts and what is missing to `least`, short cells only."""
    grid = df.select(a).distinct().crossJoin(maybe_broadcast(df.select(b).distinct()))
    counts = df.groupBy(a, b).agg(F.count("*").alias("n"))
    out = grid.join(counts, [a, b], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("need", F.greatest(F.lit(least) - F.col("n"), F.lit(0))).filter("need > 0")


def post_weights(df: DataFrame, cls: str, stratum: str, corpus: DataFrame) -> DataFrame:
    """Weight of a row: corpus share of its stratum over the stratum's share inside the class (unseen strata one of
    all), class totals restored, classes balanced, mean one. corpus: (stratum, share)."""
    cells = df.groupBy(F.col(cls).alias("c_"), F.col(stratum).alias("s_")).agg(F.count("*").alias("n_"))
    cells = cells.join(maybe_broadcast(corpus.select(F.col(stratum).alias("t_"), "share")), F.col("s_") == F.col("t_"), "left")
    classes = cells.groupBy(F.col("c_").alias("k_")).agg(F.sum("n_").alias("of_class"))
    whole = classes.agg(F.sum("of_class").alias("all_"), F.count("*").alias("classes_"))
    raw = F.coalesce("share", 1 / F.col("all_")) / (F.col("n_") / F.col("of_class"))
    cells = cells.join(classes, F.col("c_").eqNullSafe(F.col("k_"))).crossJoin(F.broadcast(whole)).withColumn("raw_", raw)
    # The weights of a class come to one before they are scaled to a mean of one.
    sums = cells.groupBy(F.col("c_").alias("g_")).agg(F.sum(F.col("raw_") * F.col("n_")).alias("sum_"))
    cells = cells.join(sums, F.col("c_").eqNullSafe(F.col("g_"))).select("c_", "s_", (F.col("raw_") / F.col("sum_") * F.col("all_") / F.col("classes_")).alias("weight"))
    return df.join(cells, F.col(cls).eqNullSafe(F.col("c_")) & F.col(stratum).eqNullSafe(F.col("s_"))).drop("c_", "s_")


def z_scores(df: DataFrame, columns: Sequence[str], clip: float = 5.0) -> DataFrame:
    """Columns standardised over the rows that have them, clipped, nought where missing, with a flag column each."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(stats))
    for c in columns:
        z = F.try_divide(F.col(c) - F.col(f"m_{c}"), F.col(f"s_{c}"))
        out = out.withColumn(f"z_{c}", F.coalesce(F.least(F.greatest(z, F.lit(-clip)), F.lit(clip)), F.lit(0.0))).withColumn(f"has_{c}", F.col(c).isNotNull().cast("int"))
    return out.drop(*[f"{k}_{c}" for c in columns for k in "ms"])


def weighted_summary(df: DataFrame, by: Sequence[str], value: str, weight: str) -> DataFrame:
    """(by, n, mass, mean, median) of a weighted pool: null values and weights are left out; the median is the least value
    at which half of the mass is reached."""
    rows = df.filter(F.col(value).isNotNull() & F.col(weight).isNotNull())
    cells = rows.groupBy(*by, value).agg(F.count("*").alias("n_"), F.sum(weight).alias("w_"))
    w = Window.partitionBy(*by)
    placed = cells.withColumn("upto_", F.sum("w_").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("all_", F.sum("w_").over(w))
    half = F.min(F.when(F.col("upto_") >= F.col("all_") / 2, F.col(value)))
    return placed.groupBy(*by).agg(F.sum("n_").alias("n"), F.sum("w_").alias("mass"), (F.sum(F.col(value) * F.col("w_")) / F.sum("w_")).alias("mean"), half.alias("median"))
