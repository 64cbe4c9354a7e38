"""Dealing a budget over groups: water filling, largest remainder, floors, cascades.

Tables of groups are small beside the tables they come from (one row for each language, type or cluster), so the
windows without a partition below hold group rows only, never the corpus. Everything stays a DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import hash_bucket, running_over_all


def _window(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by)


def water_fill(groups: DataFrame, supply: str, budget: Column, weight: Column | None = None, by: Sequence[str] = (), key: Sequence[str] = (), out: str = "quota") -> DataFrame:
    """Continuous water filling: budget shared by weight, no group beyond its supply; the sum is min(budget, supplies).

    Groups sorted by supply/weight fill up first, so the level is found by running sums. `by` deals separately inside
    each parent; `key` breaks ties. Groups without supply or weight get nothing."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    active = (F.coalesce(F.col(supply), F.lit(0)) > 0) & (F.coalesce(w, F.lit(0.0)) > 0)
    rows = groups.withColumn("s_", F.when(active, F.col(supply).cast("double")).otherwise(0.0)).withColumn("w_", F.when(active, w).otherwise(0.0)).withColumn("b_", budget.cast("double"))
    order = _window(by).orderBy(F.when(F.col("w_") > 0, F.col("s_") / F.nullif(F.col("w_"), F.lit(0.0))).asc_nulls_last(), *key)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("w_").over(_window(by)) - F.coalesce(F.sum("w_").over(before), F.lit(0.0))
    level = F.try_divide(F.col("b_") - F.coalesce(F.sum("s_").over(before), F.lit(0.0)), rest)
    rows = rows.withColumn("l_", F.when(F.col("w_") > 0, level))
    # Along the groups that fill up the level rises, behind them it falls: its maximum over the others is the level.
    rows = rows.withColumn("level_", F.max(F.when(F.col("l_") * F.col("w_") <= F.col("s_"), F.col("l_"))).over(_window(by)))
    share = F.when(F.col("level_").isNull(), F.col("s_")).otherwise(F.least(F.col("s_"), F.greatest(F.col("level_"), F.lit(0.0)) * F.col("w_")))
    return rows.withColumn(out, share).drop("s_", "w_", "b_", "l_", "level_")


def water_level(groups: DataFrame, supply: str, total: Column, order: Sequence[str], by: Sequence[str] = (), out: str = "quota") -> DataFrame:
    """Whole-number water level: every group gets min(supply, cap) with the largest cap that fits, and the first groups
    in `order` that have room one more until the total is dealt."""
    rows = groups.withColumn("s_", F.col(supply).cast("long")).withColumn("t_", total.cast("long"))
    asc = _window(by).orderBy("s_", *order)
    left = F.col("t_") - F.coalesce(F.sum("s_").over(asc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cap = F.floor(left / (F.count("*").over(_window(by)) - F.row_number().over(asc) + 1))
    rows = rows.withColumn("c_", cap).withColumn("cap_", F.max(F.when(F.col("c_") <= F.col("s_"), F.col("c_"))).over(_window(by)))
    rows = rows.withColumn("q_", F.when(F.col("cap_").isNull(), F.col("s_")).otherwise(F.least(F.col("s_"), F.greatest(F.col("cap_"), F.lit(0)))))
    rows = rows.withColumn("over_", F.col("t_") - F.sum("q_").over(_window(by))).withColumn("room_", (F.col("s_") > F.col("q_")).cast("int"))
    turn = F.sum("room_").over(_window(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    one = ((F.col("room_") == 1) & (turn <= F.col("over_"))).cast("int")
    return rows.withColumn(out, F.col("q_") + one).drop("s_", "t_", "c_", "cap_", "q_", "over_", "room_")


def largest_remainder(groups: DataFrame, weight: Column, n: Column, order: Sequence[str], by: Sequence[str] = (), out: str = "quota") -> DataFrame:
    """floor(n * share), and one more for the largest fractions until n is dealt; ties go by `order`."""
    rows = groups.withColumn("x_", n * weight.cast("double") / F.sum(weight.cast("double")).over(_window(by))).withColumn("f_", F.floor("x_")).withColumn("n_", n)
    rank = F.row_number().over(_window(by).orderBy((F.col("x_") - F.col("f_")).desc(), *order))
    rows = rows.withColumn("more_", (rank <= F.col("n_") - F.sum("f_").over(_window(by))).cast("int"))
    return rows.withColumn(out, (F.col("f_") + F.col("more_")).cast("long")).drop("x_", "f_", "n_", "more_")


def two_level(groups: DataFrame, parent: str, child: str, supply: str, budget: float, alpha: float = 0.5) -> DataFrame:
    """Water filling over parents by supply**alpha, then inside each parent over its children the same way, rounded half
    to even; demand is what the child would get without its cap."""
    tops = groups.groupBy(parent).agg(F.sum(supply).alias("top_supply"))
    tops = water_fill(tops, "top_supply", F.lit(budget), F.pow("top_supply", F.lit(alpha)), key=[parent], out="top_quota")
    inside = groups.join(tops.select(parent, "top_quota"), parent)
    weight = F.pow(F.col(supply).cast("double"), F.lit(alpha))
    filled = water_fill(inside, supply, F.col("top_quota"), weight, by=[parent], key=[child], out="raw_")
    demand = F.col("top_quota") * weight / F.sum(weight).over(_window([parent]))
    return filled.withColumn("demand", F.bround(demand, 0).cast("long")).withColumn("quota", F.bround("raw_", 0).cast("long")).drop("raw_")


def ascending_equal_share(groups: DataFrame, size: str, total: Column, order: Sequence[str], by: Sequence[str] = (), out: str = "quota") -> DataFrame:
    """Groups in ascending size each take min(size, what is left // groups left).

    Small groups are taken whole while they are under the share; from the first that is not, the rest share what is
    left evenly, and the remainder of the division moves to the end one by one."""
    rows = groups.withColumn("s_", F.col(size).cast("long")).withColumn("t_", total.cast("long"))
    asc = _window(by).orderBy("s_", *order)
    rows = rows.withColumn("left_", F.col("t_") - F.coalesce(F.sum("s_").over(asc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("n_", F.count("*").over(_window(by)) - F.row_number().over(asc) + 1)
    rows = rows.withColumn("big_", (F.floor(F.col("left_") / F.col("n_")) < F.col("s_")).cast("int"))
    rows = rows.withColumn("from_", F.max(F.when(F.col("big_") == 1, F.col("n_"))).over(_window(by))).withColumn("rest_", F.max(F.when(F.col("big_") == 1, F.struct("n_", "left_"))).over(_window(by))["left_"])
    even, odd = F.floor(F.col("rest_") / F.col("from_")), F.pmod(F.col("rest_"), F.col("from_"))
    share = F.when(F.col("from_").isNull() | (F.col("n_") > F.col("from_")), F.col("s_")).otherwise(F.least(F.col("s_"), even + (F.col("n_") <= odd).cast("int")))
    return rows.withColumn(out, share.cast("long")).drop("s_", "t_", "left_", "n_", "big_", "from_", "rest_")


def fixed_share_targets(groups: DataFrame, name: str, have: str, n: int, fixed: str, share: float) -> DataFrame:
    """One group has a fixed share of n, the others equal shares of the rest (one at least); keep and deficit follow."""
    others = F.sum((F.col(name) != fixed).cast("int")).over(_window([]))
    first = F.bround(F.lit(n * share), 0).cast("long")
    rest = F.greatest(F.lit(1), F.floor((n - first) / F.greatest(others, F.lit(1)))).cast("long")
    rows = groups.withColumn("target", F.when(F.col(name) == fixed, first).otherwise(rest))
    return rows.withColumn("keep", F.least(F.col(have), F.col("target"))).withColumn("deficit", F.greatest(F.col("target") - F.col(have), F.lit(0)))


def script_group_quota(groups: DataFrame, name: str, script: str, supply: str, n: int, fixed: str, share: float, shares: dict[str, float]) -> DataFrame:
    """The fixed language gets `share` of n, script groups their shares of the rest, split evenly inside a group under
    each language's supply. What a group cannot spend is not passed on, so the sum can stay under n."""
    first = int(n * share)
    part = F.lit(0.0)
    for k, v in shares.items():
        part = F.when(F.col(script) == k, F.lit(float(v))).otherwise(part)
    mine = groups.filter(F.col(name) != fixed).withColumn("budget_", F.floor((n - first) * part).cast("long"))
    dealt = water_level(mine, supply, F.col("budget_"), [name], by=[script]).drop("budget_")
    head = groups.filter(F.col(name) == fixed).withColumn("quota", F.least(F.col(supply).cast("long"), F.lit(first).cast("long")))
    return dealt.unionByName(head)


def cascade(rows: DataFrame, need: str, steps: Sequence[str]) -> DataFrame:
    """What each source in turn covers of a need: from_<step> = min(supply of the step, what is still missing)."""
    left = F.col(need)
    for step in steps:
        rows = rows.withColumn(f"from_{step}", F.greatest(F.least(F.col(step), left), F.lit(0)))
        left = left - F.col(f"from_{step}")
    return rows.withColumn("missing", F.greatest(left, F.lit(0)))


def floors(rows: DataFrame, expected: Column, floor: Column, share: float = 0.5) -> DataFrame:
    """How far the expected number stays under the floor, and its split into two ways of getting more."""
    short = F.greatest(floor - F.floor(expected), F.lit(0))
    rows = rows.withColumn("shortfall", short.cast("long"))
    return rows.withColumn("download", F.ceil(F.col("shortfall") * share).cast("long")).withColumn("write_by_hand", F.col("shortfall") - F.ceil(F.col("shortfall") * share).cast("long"))


def keep_rate(scan: Column, right: Column, plain: Column, dup: float = 0.9, fallback: float = 0.3) -> Column:
    """Share of found documents that stay: digital, rightly labelled, not duplicate; a fallback where nothing is known."""
    return F.coalesce((1 - F.avg(scan.cast("double"))) * F.avg(right.cast("double")) * dup, plain, F.lit(fallback))


def inflate(need: Column, keep: Column, least: float = 0.15) -> Column:
    """How many to fetch so that `need` are kept."""
    return F.ceil(need / F.greatest(keep, F.lit(least))).cast("long")


def rare_cap(groups: DataFrame, size: str, total: int, cap: int, limit: int, order: Sequence[str]) -> DataFrame:
    """Rare groups (size up to limit) get `cap` each, the others share the rest evenly, the first ones one more."""
    rare = F.col(size) <= limit
    n_rare = F.sum(rare.cast("int")).over(_window([]))
    n_rest = F.count("*").over(_window([])) - n_rare
    left = F.greatest(total - n_rare * cap, F.lit(0))
    at = F.row_number().over(_window([]).orderBy(rare, *order))
    share = F.floor(F.try_divide(left, n_rest)) + (at <= F.pmod(left, F.greatest(n_rest, F.lit(1)))).cast("int")
    return groups.withColumn("quota", F.when(rare, F.lit(cap)).otherwise(share).cast("long"))


def softmax_quota(groups: DataFrame, score: str, size: str, n: int, order: Sequence[str], temperature: float = 1.0, rounds: int = 60) -> DataFrame:
    """sum of clip(n*softmax(score/temperature) + shift, 1, size) = n, the shift by bisection, then largest remainder.

    Each of the rounds is an aggregate over an array of the groups' values, inside one row: no loop on the driver."""
    peak = F.max(F.col(score) / temperature).over(_window([]))
    p = F.exp(F.col(score) / temperature - peak)
    rows = groups.withColumn("p_", n * p / F.sum(p).over(_window([]))).withColumn("all_", F.collect_list(F.struct(F.col("p_"), F.col(size).cast("double").alias("s"))).over(_window([])))
    total = lambda shift: F.aggregate("all_", F.lit(0.0), lambda a, x: a + F.least(F.greatest(x["p_"] + shift, F.lit(1.0)), x["s"]))
    start = F.struct(F.lit(-float(n) - 1e6).alias("lo"), F.lit(float(n) + 1e6).alias("hi"))
    step = lambda a, _: F.when(total((a["lo"] + a["hi"]) / 2) < n, F.struct(((a["lo"] + a["hi"]) / 2).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), ((a["lo"] + a["hi"]) / 2).alias("hi")))
    rows = rows.withColumn("shift_", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda a: (a["lo"] + a["hi"]) / 2))
    rows = rows.withColumn("x_", F.least(F.greatest(F.col("p_") + F.col("shift_"), F.lit(1.0)), F.col(size).cast("double"))).withColumn("f_", F.floor(F.round("x_", 9)))
    rank = F.row_number().over(_window([]).orderBy(F.round(F.col("x_") - F.col("f_"), 9).desc(), *order))
    more = ((rank <= F.least(F.lit(n), F.sum(F.col(size)).over(_window([]))) - F.sum("f_").over(_window([]))) & (F.col("f_") < F.col(size))).cast("int")
    return rows.withColumn("quota", (F.col("f_") + more).cast("long")).drop("p_", "all_", "shift_", "x_", "f_")


def cells(factors: Sequence[DataFrame], probability: str = "p") -> DataFrame:
    """All combinations of factor levels with the product of their probabilities. Factors are level tables."""
    out = None
    for i, f in enumerate(factors):
        f = f.withColumnRenamed(probability, f"p{i}_")
        out = f if out is None else out.crossJoin(F.broadcast(f))
    product = F.lit(1.0)
    for i in range(len(factors)):
        product = product * F.col(f"p{i}_")
    return out.withColumn(probability, product).drop(*[f"p{i}_" for i in range(len(factors))])


def main_effects(df: DataFrame, key: str, factors: dict[str, int]) -> DataFrame:
    """A level column for each factor, every level equally often: place in an order salted by the factor's name modulo
    its number of levels. Orders are hashed, so places are counted bucket by bucket, not in one task."""
    for name, levels in factors.items():
        mark = F.md5(F.concat(F.lit(name), F.col(key).cast("string")))
        df = running_over_all(df, hash_bucket(mark), [mark, F.col(key)], out="at_").withColumn(name, F.pmod(F.col("at_") - 1, F.lit(levels)).cast("int")).drop("at_")
    return df
