"""State of a corpus kept in tables: merges, deletes, ids, reconciliation. Every function returns the next version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import in_order


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], replace: bool = True) -> DataFrame:
    """Insert-or-replace (new rows win) or insert-or-ignore (old rows win) by key."""
    if replace:
        return old.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)
    return old.unionByName(new.join(old.select(*key), list(key), "left_anti"), allowMissingColumns=True)


def delete(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*key).distinct(), list(key), "left_anti")


def assign_ids(known: DataFrame, new: DataFrame, key: str, id_col: str) -> DataFrame:
    """Ids above the greatest known one, in key order, for keys that have none; known ids never change."""
    top = known.agg(F.coalesce(F.max(id_col), F.lit(-1)).alias("top_"))
    fresh = new.select(key).distinct().join(known.select(key), key, "left_anti")
    numbered = in_order(fresh, [key], "r_")
    return numbered.crossJoin(F.broadcast(top)).select(key, (F.col("top_") + F.col("r_")).cast("long").alias(id_col))


def merge_pages(old: DataFrame, new: DataFrame, drop: DataFrame, key: Sequence[str]) -> DataFrame:
    """Old rows without the dropped keys, and the new rows whose keys are not among them, one row for each key."""
    left = delete(old, drop, key)
    added = new.dropDuplicates(list(key)).join(left.select(*key), list(key), "left_anti")
    return left.unionByName(added)


def replace_documents(old: DataFrame, new: DataFrame, doc: str, page: str, redo: DataFrame, order: Sequence) -> DataFrame:
    """All rows of a redo document and rows with a new key go; of new rows the first of each key comes in."""
    first = new.withColumn("r_", F.row_number().over(Window.partitionBy(doc, page).orderBy(*order))).filter("r_ = 1").drop("r_")
    return delete(delete(old, redo, [doc]), first, [doc, page]).unionByName(first)


def conflicts(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose value differs between the versions."""
    return old.select(key, F.col(value).alias("old")).join(new.select(key, F.col(value).alias("new")), key).filter(~F.col("old").eqNullSafe(F.col("new")))


def layered(layers: Sequence[DataFrame], key: Sequence[str], value: str) -> DataFrame:
    """Later layers override earlier ones; nulls in the winning layer become 0."""
    stacked = None
    for i, layer in enumerate(layers):
        part = layer.select(*key, value, F.lit(i).alias("layer"))
        stacked = part if stacked is None else stacked.unionByName(part)
    best = stacked.groupBy(*key).agg(F.max_by(F.struct(value), "layer").alias("v_"), F.max("layer").alias("layer"))
    return best.select(*key, F.coalesce(F.col("v_")[value], F.lit(0)).alias(value), "layer")


def reconcile(listed: DataFrame, found: DataFrame, content: str, path: str) -> DataFrame:
    """State of each listed file against what is found: same, moved, ambiguous (several places), gone."""
    places = found.groupBy(content).agg(F.count("*").alias("n_"), F.min(path).alias("there_"))
    here = found.select(content, path, F.lit(True).alias("same_")).distinct()
    out = listed.join(here, [content, path], "left").join(places, content, "left")
    state = F.when(F.col("same_"), "same").when(F.col("n_").isNull(), "gone").when(F.col("n_") > 1, "ambiguous").otherwise("moved")
    return out.withColumn("state", state).withColumn("now_at", F.when(state.isin("same"), F.col(path)).when(state == "moved", F.col("there_"))).drop("same_", "n_", "there_")


def state_machine(state: Column, readable: Column, embedded: Column, placed: Column) -> Column:
    """new -> picked or unreadable -> embedded -> placed, one step at a time."""
    return F.when((state == "new") & ~readable, "unreadable").when(state == "new", "picked").when((state == "picked") & embedded, "embedded").when((state == "embedded") & placed, "placed").otherwise(state)


def audit(old: DataFrame, new: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Every difference of two versions as a row (table, key, old, new, action)."""
    both = old.select(key, F.col(value).cast("string").alias("old"), F.lit(True).alias("in_old")).join(new.select(key, F.col(value).cast("string").alias("new"), F.lit(True).alias("in_new")), key, "full_outer")
    action = F.when(F.col("in_old").isNull(), "added").when(F.col("in_new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.select(F.lit(name).alias("table"), key, "old", "new", action.alias("action")).filter("action is not null")


def best_result(results: DataFrame, key: Sequence[str], value: str, rank: str, never: Column) -> DataFrame:
    """Best result of each key: not null before null, then the highest rank; rows marked `never` cannot win."""
    w = Window.partitionBy(*key).orderBy(F.col(value).isNull(), F.desc(rank))
    return results.filter(~never).withColumn("r_", F.row_number().over(w)).filter("r_ = 1").drop("r_")


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """Number of offending rows of each named check."""
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")
        out = one if out is None else out.unionAll(one)
    return out


def pending(expected: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """What a restarted run still has to do."""
    return expected.join(done.select(*key).distinct(), list(key), "left_anti")


def claimable(queries: DataFrame, done: DataFrame, claims: DataFrame, key: str, at: Column, lease: int = 120) -> DataFrame:
    """Rows neither done nor claimed within the lease (seconds before `at`)."""
    live = claims.filter(F.col("claimed_at") > at - F.make_interval(secs=F.lit(lease)))
    return pending(pending(queries, done, [key]), live, [key])


def serve(queue: DataFrame, done: DataFrame, claims: DataFrame, key: str, order: Sequence[str], workers: Sequence[str], each: int, at: Column, lease: int = 120) -> DataFrame:
    """(key, worker, claimed_at): the next claims of a queue: rows neither done nor claimed within the lease, in order,
    dealt to the workers in turn, `each` to one at most."""
    free = claimable(queue.select(key, *[o for o in order if o != key]), done, claims, key, at, lease)
    placed = in_order(free, [*order, key], "place_").filter(F.col("place_") <= each * len(workers))
    names = F.array(*[F.lit(w) for w in workers])
    return placed.select(key, F.element_at(names, (F.pmod(F.col("place_") - 1, F.lit(len(workers))) + 1).cast("int")).alias("worker"), at.alias("claimed_at"))


def poisoned(attempts: DataFrame, key: str, failed: str, most: int = 3) -> DataFrame:
    """(key, tries, state): of a log of attempts in any order: done once one succeeded, poison after `most` failures, retry
    before that."""
    tries = attempts.groupBy(key).agg(F.count("*").alias("tries"), F.bool_or(~F.col(failed)).alias("fine_"))
    state = F.when(F.col("fine_"), "done").when(F.col("tries") >= most, "poison").otherwise("retry")
    return tries.select(key, "tries", state.alias("state"))
