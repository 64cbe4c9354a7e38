"""Verdicts from several sources of evidence: cascades, votes, scopes, boxes, retrieval by deficit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_reason(*rules: tuple[Column, str]) -> Column:
    """Name of the first rule that holds, null if none does."""
    return F.coalesce(*[F.when(c, F.lit(name)) for c, name in rules])


def carried_scope(now: DataFrame, last: DataFrame, key: str, rules: Column, reviewed_out: DataFrame, live: DataFrame, n_last: int) -> DataFrame:
    """Scope of each row: rows since the last run by the rules alone, older ones by rules and their last scope; rejected
    reviews leave, and only live keys stay. last: (key, scope)."""
    out = now.join(last.select(key, F.col("scope").alias("prev_")), key, "left").join(reviewed_out.select(key, F.lit(True).alias("no_")).distinct(), key, "left")
    scope = F.when(F.col(key) >= n_last, rules).otherwise(rules & F.coalesce("prev_", F.lit(False)))
    return out.join(live.select(key).distinct(), key, "left_semi").withColumn("scope", scope & F.col("no_").isNull()).drop("prev_", "no_")


def checked_at_three_grains(rows: DataFrame, pages: DataFrame, documents: DataFrame, page_key: Sequence[str], doc_key: str, path: Column, folders: Sequence[str]) -> DataFrame:
    """checked: the page has a verdict, or its document has, or its first folder is listed."""
    p = pages.select(*page_key, F.lit(True).alias("p_")).distinct()
    d = documents.select(doc_key, F.lit(True).alias("d_")).distinct()
    out = rows.join(p, list(page_key), "left").join(d, doc_key, "left")
    return out.withColumn("checked", F.coalesce("p_", F.lit(False)) | F.coalesce("d_", F.lit(False)) | F.get(F.split(path, "/"), F.lit(0)).isin(*folders)).drop("p_", "d_")


def resolve(rows: DataFrame, steps: Sequence[tuple[DataFrame, str, str]], out: str) -> DataFrame:
    """First answer of a cascade of lookups (table, key column in rows, value column); keys are unique in each table."""
    answers = []
    for i, (lookup, key, value) in enumerate(steps):
        rows = rows.join(lookup.select(F.col(key), F.col(value).alias(f"a{i}_")).dropDuplicates([key]), key, "left")
        answers.append(f"a{i}_")
    return rows.withColumn(out, F.coalesce(*answers)).drop(*answers)


def box_match(true: DataFrame, found: DataFrame, page: str, share: float = 0.5) -> DataFrame:
    """Per source: true boxes and those hit (overlapped by more than `share`), found boxes and those that hit none.
    Boxes have id, x0, y0, x1, y1; found ones a source.

    Only which boxes meet matters, so equal boxes of a page are compared once. They meet in a grid whose cells are as large
    as the page's largest box, four cells a box at most; a box with a corner that is null or not finite meets its whole page."""
    corners = ["x0", "y0", "x1", "y1"]
    t = true.select(F.col(page).alias("p_"), *corners).distinct()
    f = found.select(F.col(page).alias("p_"), *[F.col(c).alias(f"f{c}") for c in corners], "source").distinct()
    plain = lambda names: F.greatest(*[F.coalesce(F.abs(F.col(c).cast("double")) >= float("inf"), F.lit(True)) for c in names]) == F.lit(False)
    fc = [f"f{c}" for c in corners]
    sizes = t.filter(plain(corners)).select("p_", *corners).unionAll(f.filter(plain(fc)).select("p_", *fc))
    grid = sizes.groupBy("p_").agg(F.min("x0").alias("gx"), F.min("y0").alias("gy"), F.max(F.col("x1") - F.col("x0")).alias("gw"), F.max(F.col("y1") - F.col("y0")).alias("gh"))

    def cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
        x0, y0, x1, y1 = names
        cell = lambda c, low, size: F.when(F.col(size) > 0, F.floor(F.least((F.col(c) - F.col(low)) / F.when(F.col(size) > 0, F.col(size)), F.lit(1e15)))).otherwise(F.lit(0).cast("long"))
        met = rows.join(grid, "p_").filter((F.col(x1) > F.col(x0)) & (F.col(y1) > F.col(y0)))
        met = met.withColumn("cx", F.explode(F.sequence(cell(x0, "gx", "gw"), cell(x1, "gx", "gw")))).withColumn("cy", F.explode(F.sequence(cell(y0, "gy", "gh"), cell(y1, "gy", "gh"))))
        return met.drop("gx", "gy", "gw", "gh")

    near = cells(t.filter(plain(corners)), corners).join(cells(f.filter(plain(fc)), fc), ["p_", "cx", "cy"]).drop("cx", "cy")
    odd = t.filter(~plain(corners)).join(f, "p_").unionByName(t.filter(plain(corners)).join(f.filter(~plain(fc)), "p_"))
    w = F.greatest(F.least("x1", "fx1") - F.greatest("x0", "fx0"), F.lit(0))
    h = F.greatest(F.least("y1", "fy1") - F.greatest("y0", "fy0"), F.lit(0))
    met = near.unionByName(odd).withColumn("s_", F.try_divide(w * h, (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))).filter("s_ > 0")
    hits = met.filter(F.col("s_") > share).select("source", "p_", *corners).distinct()
    same = lambda names, other: [F.col(page) == F.col("p_"), *[F.col(c).eqNullSafe(F.col(o)) for c, o in zip(names, other, strict=True)]]
    marks = hits.select("source", "p_", *[F.col(c).alias(f"h{c}") for c in corners])
    hit = true.join(marks, same(corners, [f"h{c}" for c in corners])).select("source", page, "id").distinct().groupBy("source").agg(F.count("*").alias("hit"))
    touched = met.select(F.col("source").alias("s2_"), "p_", *fc).distinct()
    on = found.join(touched, [*same(corners, fc), F.col("source").eqNullSafe(F.col("s2_"))]).select("source", page, "id").distinct().groupBy("source").agg(F.count("*").alias("on"))
    total = found.groupBy("source").agg(F.count("*").alias("found"))
    n = true.agg(F.count("*").alias("boxes"))
    out = total.join(hit, "source", "left").join(on, "source", "left").crossJoin(F.broadcast(n))
    return out.select("source", "boxes", F.coalesce("hit", F.lit(0)).alias("hit"), "found", (F.col("found") - F.coalesce("on", F.lit(0))).alias("off_target"))


def consensus(votes: DataFrame, key: Sequence[str], answer: str, least: int = 3, share: float = 0.6) -> DataFrame:
    """The answer of each key with enough votes and share; ties have none over one half."""
    counts = votes.groupBy(*key, answer).agg(F.count("*").alias("n_"))
    w = Window.partitionBy(*key)
    return counts.withColumn("t_", F.sum("n_").over(w)).filter((F.col("n_") >= least) & (F.col("n_") >= share * F.col("t_"))).select(*key, answer, F.col("n_").alias("votes"))


def agreement(a: DataFrame, b: DataFrame, key: Sequence[str], value: str, by: Sequence[str]) -> DataFrame:
    """Share of shared keys with equal values; groups without a shared key have no row."""
    both = a.select(*key, *[c for c in by if c not in key], F.col(value).alias("x_")).join(b.select(*key, F.col(value).alias("y_")), list(key))
    return both.groupBy(*by).agg(F.avg((F.col("x_") == F.col("y_")).cast("double")).alias("share"), F.count("*").alias("n"))


def first_acceptable(candidates: DataFrame, key: str, rank: str, text: str, fine: Column) -> DataFrame:
    """The first candidate of each key, by rank, that is acceptable."""
    w = Window.partitionBy(key).orderBy(rank, text)
    return candidates.filter(fine).withColumn("r_", F.row_number().over(w)).filter("r_ = 1").drop("r_")


def weighted_accuracy(df: DataFrame, truth: str, found: str, weight: Column, by: str) -> DataFrame:
    """Accuracy, weighted accuracy and number of rows of each group."""
    ok = (F.col(truth) == F.col(found)).cast("double")
    return df.groupBy(by).agg(F.avg(ok).alias("accuracy"), (F.sum(weight * ok) / F.sum(weight)).alias("weighted"), F.count("*").alias("n"))


def median_threshold(df: DataFrame, by: str, length: Column, factor: float) -> DataFrame:
    """factor times the median length of each group."""
    return df.groupBy(by).agg((F.percentile(length, F.lit(0.5)) * factor).alias("least"))


def capped_retrieval(df: DataFrame, cls: Sequence[str], document: str, score: str, need: str, least: float, factor: int) -> DataFrame:
    """For each class its best rows over a least score, one for each document over all classes (the best class of the
    document gets it), at most need*factor."""
    best = df.filter(F.col(score) >= least).withColumn("r_", F.row_number().over(Window.partitionBy(document).orderBy(F.desc(score), *cls))).filter("r_ = 1")
    place = F.row_number().over(Window.partitionBy(*cls).orderBy(F.desc(score), document))
    return best.withColumn("r_", place).filter(F.col("r_") <= F.col(need) * factor).drop("r_")


def descending_floors(groups: DataFrame, group: str, counts: Sequence[str], n: int) -> DataFrame:
    """Quota n//groups, one more for the groups with most strong candidates; then each floor in turn fills what is
    missing, the group with the fewest picks first (a whole-number water level over what the floor offers)."""
    w = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.desc(counts[0]), group))
    out = groups.withColumn("quota", F.floor(n / F.count("*").over(w)) + (rank <= n % F.count("*").over(w)).cast("int"))
    out = out.withColumn("picked", F.least("quota", counts[0]))
    for c in counts[1:]:
        # Filling the emptiest first up to n in all is a level over max(picked, min(offer, level)).
        out = out.withColumn("offers_", F.collect_list(F.struct(F.col("picked").cast("long").alias("p"), F.greatest(F.col(c), "picked").cast("long").alias("o"))).over(w))
        filled = lambda level: F.aggregate("offers_", F.lit(0).cast("long"), lambda a, x: a + F.greatest(x["p"], F.least(x["o"], level)))
        level = F.array_max(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(n).cast("long")), lambda x: filled(x) <= F.lit(n)))
        out = out.withColumn("level_", F.coalesce(level, F.lit(0).cast("long"))).withColumn("picked", F.greatest(F.col("picked").cast("long"), F.least(F.greatest(F.col(c), "picked").cast("long"), F.col("level_")))).drop("offers_", "level_")
    return out


def sourcing_plan(need: DataFrame, paragraphs: DataFrame, target: str, source: str, key: str, size: str, margin: float = 1.2) -> DataFrame:
    """Paragraphs of each target's sources in turn, each once for a target, until the running sum of their sizes covers
    need*margin. need: (target, source, missing)."""
    dealt = paragraphs.withColumn("t_", F.row_number().over(Window.partitionBy(source).orderBy(key)))
    met = need.join(dealt, source)
    w = Window.partitionBy(target).orderBy("t_", source).rowsBetween(Window.unboundedPreceding, -1)
    return met.withColumn("before_", F.coalesce(F.sum(size).over(w), F.lit(0))).filter(F.col("before_") < F.col("missing") * margin).drop("t_", "before_")


def weight_batches(df: DataFrame, order: Sequence, by: Sequence[str], weight: Column | int, most: int) -> DataFrame:
    """Batch number of consecutive rows: a row belongs to the batch in which the weight of the rows before it falls, so a
    batch is full once it holds `most`. weight: a column of estimates, or one number for all rows."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if isinstance(weight, int):
        return df.withColumn("batch", F.floor(F.count("*").over(w) / F.ceil(F.lit(most) / weight)).cast("long"))
    return df.withColumn("batch", F.floor(F.coalesce(F.sum(weight).over(w), F.lit(0)) / most).cast("long"))


def mean_vector(df: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """Element-wise mean of the vectors of each group, elements summed before they are sent."""
    long = df.select(*by, F.posexplode(vector).alias("i_", "x_")).groupBy(*by, "i_").agg(F.avg(F.col("x_").cast("double")).alias("m_"))
    return long.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i_", "m_"))), lambda s: s["m_"]).alias("mean"))


def label_rules(kind: Column, cls: Column) -> Column:
    """Corrections in order: filled without writing is blank, blank with writing is filled, and what is mostly writing is
    handwritten unless filled or music; the third rule sees the results of the first two."""
    first = F.when((kind == "filled") & (cls == 0), "blank").otherwise(kind)
    second = F.when((first == "blank") & (cls >= 1), "filled").otherwise(first)
    return F.when((cls == 2) & ~second.isin("filled", "music"), "handwritten").otherwise(second)


def passages(blocks: DataFrame, document: str, order: str, size: str, text: str, cut: int) -> DataFrame:
    """Consecutive blocks joined until their running size passes a multiple of `cut`."""
    before = F.coalesce(F.sum(size).over(Window.partitionBy(document).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cutted = blocks.withColumn("passage", F.floor(before / cut).cast("long"))
    grouped = cutted.groupBy(document, "passage").agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("b_"), F.sum(size).alias("size"))
    return grouped.select(document, "passage", "size", F.array_join(F.transform("b_", lambda x: x[text]), "\n").alias("text"))
