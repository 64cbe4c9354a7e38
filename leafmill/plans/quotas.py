"""Allocator queries over documents, customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators import allocators as a
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}


def query(name, sql):
    def put(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return put


def by_lang(spark, d):
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("supply"))


def by_source(spark, d):
    """Uneven supplies: documents of at least 2000 characters by source."""
    return read(spark, d, "documents").groupBy("source").agg(F.sum((F.col("n_chars") >= 2000).cast("long")).alias("supply"), F.count("*").alias("n"))


LANG = "select lang, count(*) as supply from documents group by lang"
SOURCE = "select source, sum(case when n_chars >= 2000 then 1 else 0 end) as supply, count(*) as n from documents group by source"


@query("water_quota_lang", f"""
with g as ({LANG}), t as (select floor(sum(supply) * 0.6)::bigint as total from g),
c as (select max(c) as cap from (select unnest(range(0, (select max(supply) from g)::bigint + 1)) as c) r where (select sum(least(supply, r.c)) from g) <= (select total from t)),
q as (select lang, supply, least(supply, cap) as q from g, c),
o as (select *, (select total from t) - sum(q) over () as over_, sum(case when supply > q then 1 else 0 end) over (order by lang) as turn from q)
select lang, cast(supply as bigint) as supply, cast(q + case when supply > q and turn <= over_ then 1 else 0 end as bigint) as quota from o""")
def water_quota_lang(spark, d):
    g = by_lang(spark, d).withColumn("total", F.floor(F.sum("supply").over(a._window([])) * 0.6))
    return a.water_level(g, "supply", F.col("total"), ["lang"]).select("lang", "supply", "quota")


@query("water_quota_source", f"""
with g as ({SOURCE}), c as (select max(c) as cap from (select unnest(range(0, (select max(supply) from g)::bigint + 1)) as c) r where (select sum(least(supply, r.c)) from g) <= 77),
q as (select source, supply, least(supply, cap) as q from g, c),
o as (select *, 77 - sum(q) over () as over_, sum(case when supply > q then 1 else 0 end) over (order by source) as turn from q)
select source, cast(q + case when supply > q and turn <= over_ then 1 else 0 end as bigint) as quota from o""")
def water_quota_source(spark, d):
    return a.water_level(by_source(spark, d), "supply", F.lit(77), ["source"]).select("source", "quota")


@query("weighted_water_quota", f"""
with recursive g as (select source, supply::double as s, sqrt(n)::double as w from ({SOURCE})),
lv as (select 0 as i, 0.0::double as lo, 1e6::double as hi union all
  select i + 1, case when (select sum(least(s, (lo + hi) / 2 * w)) from g) < 100 then (lo + hi) / 2 else lo end,
         case when (select sum(least(s, (lo + hi) / 2 * w)) from g) < 100 then hi else (lo + hi) / 2 end from lv where i < 80)
select source, round(least(s, (select max(hi) from lv where i = 80) * w), 6) as quota from g""")
def weighted_water_quota(spark, d):
    return a.water_fill(by_source(spark, d), "supply", F.lit(100.0), F.sqrt("n"), key=["source"]).select("source", F.round("quota", 6).alias("quota"))


@query("two_level_quota", """
with recursive g as (select n_regionkey as r, c_nationkey as n, count(*)::double as s from customer join nation on c_nationkey = n_nationkey group by 1, 2),
t as (select r, sum(s) as s, sqrt(sum(s)) as w from g group by r),
lt as (select 0 as i, 0.0::double as lo, 1e6::double as hi union all
  select i + 1, case when (select sum(least(s, (lo + hi) / 2 * w)) from t) < 500 then (lo + hi) / 2 else lo end,
         case when (select sum(least(s, (lo + hi) / 2 * w)) from t) < 500 then hi else (lo + hi) / 2 end from lt where i < 80),
tq as (select r, least(s, (select max(hi) from lt where i = 80) * w) as tq from t),
lg as (select 0 as i, r, 0.0::double as lo, 1e6::double as hi, tq from tq union all
  select i + 1, lg.r, case when f < tq then (lo + hi) / 2 else lo end, case when f < tq then hi else (lo + hi) / 2 end, tq
  from (select lg.*, (select sum(least(g.s, (lo + hi) / 2 * sqrt(g.s))) from g where g.r = lg.r) as f from lg where i < 60) lg)
select g.r as region, g.n as nation, cast(round_even(least(g.s, lg.hi * sqrt(g.s)), 0) as bigint) as quota,
       cast(round_even(lg.tq * sqrt(g.s) / sum(sqrt(g.s)) over (partition by g.r), 0) as bigint) as demand
from g join lg on lg.r = g.r and lg.i = 60""")
def two_level_quota(spark, d):
    c = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    g = c.groupBy(F.col("n_regionkey").alias("region"), F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("supply"))
    return a.two_level(g, "region", "nation", "supply", 500.0).select("region", "nation", "quota", "demand")


@query("largest_remainder_plan", f"""
with g as ({LANG}), x as (select lang, 37 * supply::double / sum(supply) over () as x from g),
f as (select lang, x, floor(x) as f, row_number() over (order by x - floor(x) desc, lang) as r from x)
select lang, cast(f + case when r <= 37 - sum(f) over () then 1 else 0 end as bigint) as quota from f""")
def largest_remainder_plan(spark, d):
    return a.largest_remainder(by_lang(spark, d), F.col("supply"), F.lit(37), ["lang"]).select("lang", "quota")


@query("ascending_equal_share", f"""
with recursive g as (select source, supply, row_number() over (order by supply, source) as i, count(*) over () as n from ({SOURCE})),
r as (select 0::bigint as i, ''::varchar as source, 0::bigint as quota, 103::bigint as left_ union all
  select g.i, g.source, least(g.supply, r.left_ // (g.n - g.i + 1))::bigint, (r.left_ - least(g.supply, r.left_ // (g.n - g.i + 1)))::bigint from r join g on g.i = r.i + 1)
select source, quota from r where i > 0""")
def ascending_equal_share(spark, d):
    return a.ascending_equal_share(by_source(spark, d), "supply", F.lit(103), ["source"]).select("source", "quota")


@query("fixed_share_language_targets", f"""
with g as ({LANG}), t as (select lang, supply, case when lang = 'en' then cast(round_even(500 * 0.25, 0) as bigint)
  else greatest(1, (500 - cast(round_even(500 * 0.25, 0) as bigint)) // greatest((select count(*) from g where lang <> 'en'), 1)) end as target from g)
select lang, target, least(supply, target) as keep, greatest(target - supply, 0) as deficit from t""")
def fixed_share_language_targets(spark, d):
    return a.fixed_share_targets(by_lang(spark, d), "lang", "supply", 500, "en", 0.25).select("lang", "target", "keep", "deficit")


@query("script_group_quota", f"""
with g as (select lang, supply, case when lang in ('fr', 'es') then 'romance' else 'germanic' end as script from ({LANG})),
b as (select *, floor((300 - 120) * case script when 'romance' then 0.6::double else 0.4::double end)::bigint as b from g where lang <> 'en'),
c as (select script, max(cap) as cap from (select distinct script, b, unnest(range(0, 2000)) as cap from b) r where (select sum(least(supply, r.cap)) from b where b.script = r.script) <= r.b group by script),
q as (select b.*, least(supply, cap) as q from b join c using (script)),
o as (select *, b - sum(q) over (partition by script) as over_, sum(case when supply > q then 1 else 0 end) over (partition by script order by lang) as turn from q)
select lang, cast(q + case when supply > q and turn <= over_ then 1 else 0 end as bigint) as quota from o
union all select lang, least(supply, 120) from g where lang = 'en'""")
def script_group_quota(spark, d):
    g = by_lang(spark, d).withColumn("script", F.when(F.col("lang").isin("fr", "es"), "romance").otherwise("germanic"))
    return a.script_group_quota(g, "lang", "script", "supply", 300, "en", 0.4, {"romance": 0.6, "germanic": 0.4}).select("lang", "quota")


@query("forms_cascade", """
with g as (select c_mktsegment as seg, count(*) as need, count(*) filter (c_acctbal < 0) as real_, count(*) filter (c_acctbal between 0 and 1000) as fill,
  count(*) filter (c_acctbal between 1000.000001 and 4000) as digital, count(*) filter (c_acctbal > 9000) as scans from customer group by 1),
a as (select *, greatest(least(real_, need), 0) as from_real from g), b as (select *, greatest(least(fill, need - from_real), 0) as from_fill from a),
c as (select *, greatest(least(digital, need - from_real - from_fill), 0) as from_digital from b),
e as (select *, greatest(least(scans, need - from_real - from_fill - from_digital), 0) as from_scans from c)
select seg, need, from_real, from_fill, from_digital, from_scans, greatest(need - from_real - from_fill - from_digital - from_scans, 0) as missing from e""")
def forms_cascade(spark, d):
    bal = F.col("c_acctbal")
    g = read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("seg")).agg(
        F.count("*").alias("need"), F.count_if(bal < 0).alias("real"), F.count_if(bal.between(0, 1000)).alias("fill"), F.count_if(bal.between(1000.000001, 4000)).alias("digital"), F.count_if(bal > 9000).alias("scans")
    )
    return a.cascade(g, "need", ["real", "fill", "digital", "scans"]).select("seg", "need", "from_real", "from_fill", "from_digital", "from_scans", "missing")


@query("type_language_floor", """
with g as (select lang, source, count(*) as n from documents group by 1, 2),
e as (select *, n * 0.35::double as x, case when lang = 'en' then 12 else 4 end as floor_ from g),
s as (select *, cast(greatest(floor_ - floor(x), 0) as bigint) as shortfall from e)
select lang, source, shortfall, cast(ceil(shortfall * 0.5) as bigint) as download, cast(shortfall - ceil(shortfall * 0.5) as bigint) as write_by_hand from s""")
def type_language_floor(spark, d):
    g = read(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return a.floors(g, F.col("n") * F.lit(0.35), F.when(F.col("lang") == "en", 12).otherwise(4)).select("lang", "source", "shortfall", "download", "write_by_hand")


@query("keep_rates_inflation", """
with g as (select source, (1 - avg(case when n_chars < 500 then 1.0::double else 0.0 end)) * avg(case when lang = 'en' then 1.0::double else 0.0 end) * 0.9::double as keep from documents group by source)
select source, round(keep, 9) as keep, cast(ceil(100 / greatest(keep, 0.15::double)) as bigint) as fetch from g""")
def keep_rates_inflation(spark, d):
    g = read(spark, d, "documents").groupBy("source").agg(a.keep_rate(F.col("n_chars") < 500, F.col("lang") == "en", F.lit(None).cast("double")).alias("keep"))
    return g.select("source", F.round("keep", 9).alias("keep"), a.inflate(F.lit(100), F.col("keep")).alias("fetch"))


@query("scans_needed", """
with g as (select l_returnflag as f, l_linestatus as s, sum(case when l_discount > 0.05 then 1 else 0 end) as digital, count(*) as n from lineitem group by 1, 2)
select f, s, cast(greatest(n // 2 - digital - 0, 0) as bigint) as scans from g""")
def scans_needed(spark, d):
    g = read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("s")).agg(F.sum((F.col("l_discount") > 0.05).cast("long")).alias("digital"), F.count("*").alias("n"))
    return g.select("f", "s", F.greatest(F.floor(F.col("n") / 2) - F.col("digital") - F.lit(0), F.lit(0)).cast("long").alias("scans"))


@query("rare_cap_allocation", f"""
with g as (select source, supply, supply <= 12 as rare from ({SOURCE})),
x as (select *, sum(case when rare then 1 else 0 end) over () as nr, count(*) over () as n, row_number() over (order by rare, source) as pos from g),
y as (select *, greatest(200 - nr * 5, 0) as left_, n - nr as rest from x)
select source, cast(case when rare then 5 else left_ // rest + case when pos <= left_ % rest then 1 else 0 end end as bigint) as quota from y""")
def rare_cap_allocation(spark, d):
    return a.rare_cap(by_source(spark, d), "supply", 200, 5, 12, ["source"]).select("source", "quota")


@query("softmax_quota", f"""
with recursive g as (select source, n as size, supply::double / n * 4 as score from ({SOURCE})),
p as (select source, size, 150 * exp(score - max(score) over ()) / sum(exp(score - (select max(score) from g))) over () as p from g),
b as (select 0 as i, -1000150.0::double as lo, 1000150.0::double as hi union all
  select i + 1, case when (select sum(least(greatest(p + (lo + hi) / 2, 1.0), size)) from p) < 150 then (lo + hi) / 2 else lo end,
         case when (select sum(least(greatest(p + (lo + hi) / 2, 1.0), size)) from p) < 150 then hi else (lo + hi) / 2 end from b where i < 60),
x as (select source, size, least(greatest(p + (select max((lo + hi) / 2) from b where i = 60), 1.0), size) as x from p),
f as (select *, floor(round(x, 9)) as f, row_number() over (order by round(x - floor(round(x, 9)), 9) desc, source) as r from x)
select source, cast(f + case when r <= least(150, sum(size) over ()) - sum(f) over () and f < size then 1 else 0 end as bigint) as quota from f""")
def softmax_quota(spark, d):
    g = by_source(spark, d).select("source", F.col("n").alias("size"), (F.col("supply").cast("double") / F.col("n") * 4).alias("score"))
    return a.softmax_quota(g, "score", "size", 150, ["source"]).select("source", "quota")


@query("like_for_like_topup", f"""
with g as (select lang, supply, supply // 10 as lost from ({LANG})), a as (select *, least(lost, supply) as first_ from g),
c as (select max(c) as cap from (select unnest(range(0, 2000)) as c) r where (select sum(least(supply - first_, r.c)) from a) <= 90),
q as (select a.*, least(supply - first_, cap) as q from a, c),
o as (select *, 90 - sum(q) over () as over_, sum(case when supply - first_ > q then 1 else 0 end) over (order by lang) as turn from q)
select lang, cast(first_ as bigint) as like_for_like, cast(q + case when supply - first_ > q and turn <= over_ then 1 else 0 end as bigint) as rest from o""")
def like_for_like_topup(spark, d):
    g = by_lang(spark, d).withColumn("like_for_like", F.least(F.floor(F.col("supply") / 10), F.col("supply")).cast("long")).withColumn("room", F.col("supply") - F.col("like_for_like"))
    return a.water_level(g, "room", F.lit(90), ["lang"], out="rest").select("lang", "like_for_like", "rest")


@query("tree_quota", """
with g as (select n_regionkey as r, c_nationkey as n, count(*) as s from customer join nation on c_nationkey = n_nationkey group by 1, 2),
t as (select r, sum(s)::bigint as s from g group by r),
tc as (select max(c) as cap from (select unnest(range(0, 20000)) as c) x where (select sum(least(s, x.c)) from t) <= 203),
tq as (select r, s, least(s, cap) as q from t, tc),
t2 as (select r, q + case when s > q and sum(case when s > q then 1 else 0 end) over (order by r) <= 203 - sum(q) over () then 1 else 0 end as tq from tq),
gc as (select r, max(c) as cap from (select r, tq, unnest(range(0, 2000)) as c from t2) x where (select sum(least(s, x.c)) from g where g.r = x.r) <= x.tq group by r),
gq as (select g.r, g.n, g.s, least(g.s, cap) as q, tq from g join gc using (r) join t2 using (r))
select r as region, n as nation, cast(q + case when s > q and sum(case when s > q then 1 else 0 end) over (partition by r order by n) <= tq - sum(q) over (partition by r) then 1 else 0 end as bigint) as quota from gq""")
def tree_quota(spark, d):
    c = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    g = c.groupBy(F.col("n_regionkey").alias("region"), F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("s"))
    top = a.water_level(g.groupBy("region").agg(F.sum("s").alias("t")), "t", F.lit(203), ["region"], out="tq").select("region", "tq")
    return a.water_level(g.join(top, "region"), "s", F.col("tq"), ["nation"], by=["region"]).select("region", "nation", "quota")


@query("factor_cells", """
select o_orderstatus as status, o_orderpriority as priority, round(a.p * b.p, 9) as p
from (select o_orderstatus, count(*)::double / (select count(*) from orders) as p from orders group by 1) a,
     (select o_orderpriority, count(*)::double / (select count(*) from orders) as p from orders group by 1) b""")
def factor_cells(spark, d):
    o = read(spark, d, "orders")
    n = F.sum(F.count("*")).over(a._window([]))
    level = lambda c, name: o.groupBy(F.col(c).alias(name)).agg((F.count("*").cast("double") / n).alias("p"))
    return a.cells([level("o_orderstatus", "status"), level("o_orderpriority", "priority")]).select("status", "priority", F.round("p", 9).alias("p"))


@query("stratified_plan_marginals", """
with p as (select doc_id, (row_number() over (order by md5('paper' || doc_id::varchar), doc_id) - 1) % 4 as paper, (row_number() over (order by md5('light' || doc_id::varchar), doc_id) - 1) % 3 as light from documents)
select cast(paper as integer) as paper, cast(light as integer) as light, count(*) as n from p group by 1, 2""")
def stratified_plan_marginals(spark, d):
    plan = a.main_effects(read(spark, d, "documents").select("doc_id"), "doc_id", {"paper": 4, "light": 3})
    return plan.groupBy("paper", "light").agg(F.count("*").alias("n"))
