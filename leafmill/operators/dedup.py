"""Exact and near duplicates, kept copies, and groups of linked rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.cells import similar_pairs
from leafmill.sources.scratch import forget, materialise


def content_key(content: Column) -> Column:
    """SHA-256, by which equal contents are known."""
    return F.sha2(content, 256)


def short_name(key: Column, digits: int = 12) -> Column:
    """The first hex digits of a key: a name for people, never what decides identity."""
    return F.substring(key, 1, digits)


def keep_first(df: DataFrame, by: Sequence, order: Sequence) -> DataFrame:
    """One row of each key, the first in an explicit order."""
    return df.withColumn("r_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("r_") == 1).drop("r_")


def duplicate_status(df: DataFrame, key: Column, order: Sequence, known: DataFrame | None = None) -> DataFrame:
    """ok for the first of its content, dup for later ones, known where the content is in `known` (key)."""
    out = df.withColumn("key", key)
    at = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    status = F.when(at == 1, "ok").otherwise("dup")
    if known is None:
        return out.withColumn("status", status)
    seen = known.select(F.col("key"), F.lit(True).alias("seen_")).distinct()
    return out.join(seen, "key", "left").withColumn("status", F.when(F.col("seen_"), "known").otherwise(status)).drop("seen_")


def normal_key(text: Column) -> Column:
    """Lower case, everything that is neither letter nor digit one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def repeated_line_rule(text: Column, least: int = 12, repeats: float = 0.05, digits: float = 0.3) -> Column:
    """Why a text is rejected: lines over `least` characters repeat, or digits are too many of its letters and digits."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > least)
    again = F.try_divide(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines))
    share = F.try_divide(F.regexp_count(text, F.lit(r"\p{Nd}")), F.regexp_count(text, F.lit(r"[\p{L}\p{Nd}]")))
    return F.coalesce(F.when(again > repeats, "repeats"), F.when(share > digits, "digits"), F.lit("ok"))


def window_keys(text: Column, width: int = 60, offsets: Sequence[int] = (0, 200, 500), prefix: int = 4096) -> Column:
    """Fixed-width windows of the white-space-normalised text that fit into it. Only as much of the text is normalised as
    the windows need; the whole only where its first `prefix` characters are mostly white space."""
    normal = lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))
    head, need = normal(F.substring(text, 1, prefix)), max(offsets) + width
    clean = F.when((F.length(text) <= prefix) | (F.length(head) > need), head).otherwise(normal(text))
    return F.filter(F.array(*[F.when(F.length(clean) >= o + width, F.substring(clean, o + 1, width)) for o in offsets]), lambda w: w.isNotNull())


def later_overlaps(df: DataFrame, id_col: str, text_col: str, width: int = 60, offsets: Sequence[int] = (0, 200, 500)) -> DataFrame:
    """(id, first_owner, shared): in order of the id, a row goes if it shares a window with an earlier row that stays; the
    least such row and the number of windows shared with rows that stay. Ids are unique.

    Rounds decide: a row that has all its windows first among the undecided stays, and whoever shares one with it goes. A
    window's first row is one aggregate; rows are never paired."""
    windows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), F.explode(F.array_distinct(window_keys(F.col(text_col), width, offsets))).alias("w"))
    left, stay = materialise(windows), None
    every = left
    while left.limit(1).count():
        first = left.groupBy("w").agg(F.min("i").alias("first"))
        own = left.join(first, "w").groupBy("i").agg(F.min((F.col("first") == F.col("i")).cast("int")).alias("all_")).filter("all_ = 1").select("i")
        kept = materialise(left.join(own, "i", "left_semi"))
        stay = kept if stay is None else stay.unionAll(kept)
        rest = left.join(kept.select("i").distinct(), "i", "left_anti")
        out = rest.join(kept.select("w").distinct(), "w", "left_semi").select("i").distinct()
        before, left = left, materialise(rest.join(out, "i", "left_anti"))
        if before is not every:
            forget(before)
    owners = (every.limit(0) if stay is None else stay).groupBy("w").agg(F.min("i").alias("owner"))
    hits = every.join(owners, "w").filter(F.col("owner") < F.col("i"))
    return hits.groupBy(F.col("i").alias(id_col)).agg(F.min("owner").alias("first_owner"), F.count("*").alias("shared"))


def subset_pairs(members: DataFrame, doc: str, item: str) -> DataFrame:
    """Pairs of documents in which all items of the smaller are in the larger: (small, large, shared).

    The larger one has the smaller one's rarest item, so they meet by that and no pair is made by a common item alone;
    then the items themselves are compared. Of equal sets the later document is the smaller."""
    m = members.select(F.col(doc).alias("d"), F.col(item).alias("i")).distinct()
    sets = m.groupBy("d").agg(F.collect_list("i").alias("items"))
    often = m.groupBy("i").agg(F.count("*").alias("n"))
    rarest = m.join(often, "i").groupBy("d").agg(F.min(F.struct("n", "i")).alias("r")).filter("r.n > 1").select("d", F.col("r.i").alias("i"))
    met = rarest.join(m.select(F.col("d").alias("e"), "i"), "i").filter("d != e").select("d", "e")
    met = met.join(sets, "d").join(sets.select(F.col("d").alias("e"), F.col("items").alias("others")), "e")
    n, k = F.size("items"), F.size("others")
    held = met.filter(((n < k) | ((n == k) & (F.col("d") > F.col("e")))) & (F.size(F.array_except("items", "others")) == 0))
    return held.select(F.col("d").alias("small"), F.col("e").alias("large"), n.cast("long").alias("shared"))


def greedy_near_duplicates(df: DataFrame, cluster: str, id_col: str, vector: str, prefer: Sequence[str], similarity: float = 0.95) -> DataFrame:
    """(id, kept): in order of `prefer` and id, a row goes if its cosine to an earlier kept row of its cluster exceeds the
    threshold. Rows of a null cluster are kept.

    The similar pairs are found cell by cell; then rounds over the pairs decide: a row with no earlier partner left is
    kept, its later partners go. No cluster is ever one task's."""
    keys = df.select(F.col(id_col).cast("long").alias("i"), F.struct(*prefer, F.col(id_col)).alias("o"))
    pairs = similar_pairs(df, id_col, vector, similarity, cluster).filter("a < b")
    met = pairs.join(keys.select(F.col("i").alias("a"), F.col("o").alias("oa")), "a").join(keys.select(F.col("i").alias("b"), F.col("o").alias("ob")), "b")
    early = F.col("oa") < F.col("ob")
    left = materialise(met.select(F.when(early, F.col("a")).otherwise(F.col("b")).alias("x"), F.when(early, F.col("b")).otherwise(F.col("a")).alias("y")))
    gone = None
    while left.limit(1).count():
        first = left.select("x").distinct().join(left.select(F.col("y").alias("x")).distinct(), "x", "left_anti")
        out = materialise(left.join(first, "x", "left_semi").select("y").distinct())
        gone = out if gone is None else gone.unionAll(out)
        dropped = out.select(F.col("y").alias("x"))
        before, left = left, materialise(left.join(first, "x", "left_anti").join(dropped, "x", "left_anti").join(out, "y", "left_anti"))
        forget(before)
    if gone is None:
        return df.select(id_col, F.lit(True).alias("kept"))
    marked = gone.select(F.col("y").alias("y_"), F.lit(False).alias("kept_"))
    return df.select(id_col).join(marked, F.col(id_col).cast("long") == F.col("y_"), "left").select(id_col, F.coalesce("kept_", F.lit(True)).alias("kept"))


def linked_groups(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, group): each node of the links and the least node it reaches, by alternating large and small stars until
    nothing changes; the number of rounds is logarithmic in the longest path. A node linked only to itself is a group.

    Each round is written to the shared folder, which cuts its lineage."""
    given = materialise(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null"))
    nodes = given.select("u").unionAll(given.select("v")).distinct().withColumnRenamed("u", "node")
    now = materialise(given.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).filter("a < b").distinct())
    while True:
        # Large star: every larger neighbour goes to the least of a node and its neighbours.
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(least, "b").select("m", F.col("a").alias("v")).unionAll(least.select("m", F.col("b").alias("v")))
        after = materialise(moved.filter("m < v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())
        same = not after.exceptAll(now).limit(1).count() and not now.exceptAll(after).limit(1).count()
        forget(now)
        now = after
        if same:
            break
    groups = now.groupBy("b").agg(F.min("a").alias("group"))
    return nodes.join(groups, F.col("node") == F.col("b"), "left").select("node", F.coalesce("group", "node").alias("group"))


def one_id_per_file(df: DataFrame, path: str, page: str, id_col: str) -> DataFrame:
    """The least id of each file stands for it; of equal (file, page) rows the first stays; reason says what happened."""
    w = Window.partitionBy(path)
    out = df.withColumn("keep_id", F.min(id_col).over(w))
    at = F.row_number().over(Window.partitionBy(path, page).orderBy(id_col))
    return out.withColumn("reason", F.when(at > 1, "second row of a page").when(F.col(id_col) != F.col("keep_id"), "moved to the first id").otherwise("kept"))


def candidate_verdict(pairs: DataFrame, common: str = "n", mean: str = "mean", least: str = "least", ok: float = 0.95) -> DataFrame:
    """Verdict on candidate pairs from the similarities of their common pages."""
    verdict = F.when((F.col(common) > 1) & (F.col(least) > ok), "confirmed").when(F.col(mean) > ok, "first pages only").when(F.col(mean) > 0.5, "template only").otherwise("no")
    return pairs.withColumn("verdict", verdict)


