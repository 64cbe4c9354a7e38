"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 60-bit hash of its id and text. Words are summed by source and leading hash bits; running sums over
that histogram give the bucket in which a source's budget ends; only that bucket is read again, by its next
bits, until the threshold is exact. The rows below the threshold are taken by a filter: nothing is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.llm.common import materialise, maybe_broadcast, n_words, table

#: Relative weights of the sources in code-point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST_EPOCHS = 3
HASH_BITS = 60
LEVEL_BITS = 12


def row_hash(id_col: Column, text_col: Column) -> Column:
    """60 bits of MD5 over id and text, which other engines can compute too. Nulls hash as empty strings."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text_col, F.lit("")))), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) -> (source, source_size, source_rank, target).

    The targets share the sum of all sizes by weight; a target stops at `most` times its source's size and the
    excess goes to the others by weight until none is above. In order of most*size/weight the sources that stop
    are a prefix, so one running sum finds the level: it rises along that prefix, and behind it, where sources that do
    not stop are counted as if they did, it falls. The windows hold one row for each source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    sized = sizes.withColumn("source_rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    by_ratio = Window.orderBy((F.col("limit_") / F.col("w_")), "source_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        sized.withColumn("w_", weight.cast("double"))
        .withColumn("limit_", F.col("source_size") * F.lit(most).cast("double"))
        .withColumn("total_", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weights_", F.sum("w_").over(everything))
        .withColumn("limits_before_", F.coalesce(F.sum("limit_").over(before), F.lit(0.0)))
        .withColumn("weights_before_", F.coalesce(F.sum("w_").over(before), F.lit(0.0)))
        .withColumn("level_", (F.col("total_") - F.col("limits_before_")) / (F.col("weights_") - F.col("weights_before_")))
        .withColumn("free_", F.col("level_") * F.col("w_") <= F.col("limit_"))
        .withColumn("water_", F.max(F.when(F.col("free_"), F.col("level_"))).over(everything))
    )
    target = F.when(F.col("free_") & F.col("water_").isNotNull(), F.col("water_") * F.col("w_")).otherwise(F.col("limit_"))
    return levels.select("source", "source_size", "source_rank", target.alias("target"))


def _below(hist: DataFrame, budgets: DataFrame) -> DataFrame:
    """The bucket of each source in which its budget ends, and what of the budget is left there."""
    run = Window.partitionBy("source_rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cut = hist.join(maybe_broadcast(budgets), "source_rank").withColumn("cum_", F.sum("words").over(run))
    inside = cut.filter((F.col("cum_") - F.col("words") < F.col("budget")) & (F.col("cum_") >= F.col("budget")))
    return inside.select("source_rank", F.col("bucket").alias("edge"), (F.col("budget") - (F.col("cum_") - F.col("words"))).alias("budget"), "words", "n")


def _refined(rows: DataFrame, column: str, budgets: DataFrame) -> tuple[DataFrame, int]:
    """For each source the bucket of the column's leading bits in which its budget ends, refined until one row at most is
    in each, and the number of bits that are left out."""
    level, read, at = HASH_BITS - LEVEL_BITS, rows, budgets
    while True:
        hist = read.groupBy("source_rank", F.shiftright(column, level).alias("bucket")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        edges = materialise(_below(hist, at))
        if not level or not edges.filter("n > 1").limit(1).count():
            return edges, level
        read = rows.join(maybe_broadcast(edges.select("source_rank", "edge")), "source_rank").filter(F.shiftright(column, level) == F.col("edge")).drop("edge")
        at, level = edges.select("source_rank", "budget"), level - LEVEL_BITS


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, most: float = MOST_EPOCHS, columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, source, size, source_size, target, epochs (how often the row is taken), taken, and
    `columns` of docs (those that have one of these names are not carried).

    A source whose target is T and size S takes every row floor(T/S) times, and once more the rows whose hash is
    under the threshold at which their words come to T - floor(T/S)*S; the row at the edge is taken if that comes
    nearer. The hash is of id and text; rows that are equal in both, ties among them, are told apart by a number they get
    when they are first written, so a source of equal rows meets its target too, and reruns agree but for which of
    equal rows are taken. Null texts have size 0 and are taken like any other; a null source is a source, a null id is an
    id. A long text is one row. An empty table gives no rows. The windows hold one row for each source."""
    carried = [c for c in columns if c not in (id_col, "source", "size", "source_size", "target", "epochs", "taken")]
    text = F.col(text_col)
    base = materialise(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"), row_hash(F.col(id_col), text).alias("h"),
            F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS).alias("h2"), *[F.col(c).alias(f"c{i}_") for i, c in enumerate(carried)],
        )
    )
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = (
        source_targets(sizes, weights, most)
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("budget", F.greatest(F.col("target") - F.col("rounds") * F.col("source_size"), F.lit(0.0)))
    )
    plan = materialise(plan)
    rows = base.join(maybe_broadcast(plan.select(F.col("source").alias("source_"), "source_rank")), F.col("source").eqNullSafe(F.col("source_"))).select("source_rank", "size", "h", "h2")
    taken_if = F.when(2 * F.col("budget") >= F.col("words"), 1).otherwise(0)
    edges, level = _refined(rows, "h", plan.filter("budget > 0").select("source_rank", "budget"))
    upto, second = edges.select("source_rank", (F.col("edge") + taken_if).alias("edge")), F.lit(False)
    if edges.filter("n > 1").limit(1).count():
        # Equal rows at an edge: the budget ends among them.
        equal = rows.join(maybe_broadcast(edges.select("source_rank", "edge")), "source_rank").filter(F.col("h") == F.col("edge")).drop("edge")
        finer, low = _refined(equal, "h2", edges.select("source_rank", "budget"))
        upto = edges.select("source_rank", "edge").join(finer.select("source_rank", (F.col("edge") + taken_if).alias("edge2")), "source_rank", "left")
        second = (F.col("h") == F.col("edge")) & (F.shiftright("h2", low) < F.col("edge2"))
    final = materialise(plan.join(upto, "source_rank", "left"))
    once_more = F.coalesce(((F.shiftright("h", level) < F.col("edge")) | second).cast("int"), F.lit(0))
    out = base.join(maybe_broadcast(final.withColumnRenamed("source", "source_")), F.col("source").eqNullSafe(F.col("source_")))
    epochs = F.col("rounds") + once_more
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", epochs.alias("epochs"), (F.col("size") * epochs).alias("taken"), *[F.col(f"c{i}_").alias(c) for i, c in enumerate(carried)])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix by sorting: a row is under the threshold if the words up to it in hash order fit its budget.
OP6_SQL = r"""
with base as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')), 1, 15)) as bigint) as h,
         row_number() over () as n
  from documents),
src as (
  select source, sum(size) as source_size, row_number() over (order by source is null, source) - 1 as r from base group by source),
w as (
  select *, cast([5, 2, 1][r % 3 + 1] as double) as w, source_size * 3.0::double as lim, sum(source_size) over () as total from src),
l as (
  select *, (cast(total as double) - coalesce(sum(lim) over b, 0)) / (sum(w) over () - coalesce(sum(w) over b, 0)) as level
  from w window b as (order by lim / w, r rows between unbounded preceding and 1 preceding)),
f as (select *, level * w <= lim as free from l),
t as (
  select source, cast(source_size as bigint) as source_size,
         case when free and (max(level) filter (free) over ()) is not null then (max(level) filter (free) over ()) * w else lim end as target
  from f),
p as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as rounds from t),
q as (select *, greatest(target - rounds * source_size, 0) as budget from p),
d as (
  select base.*, q.source_size, q.target, q.rounds, q.budget, sum(size) over (partition by base.source order by h, n) as cum, size as own
  from base join q on base.source is not distinct from q.source)
select doc_id, size, source_size, target,
       cast(size * (rounds + case when budget > 0 and cum - own < budget and (cum <= budget or 2 * (budget - (cum - own)) >= own) then 1 else 0 end) as bigint) as taken
from d
"""
