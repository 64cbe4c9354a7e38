"""Ranking, sampling and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators import ranking as r
from leafmill.operators import sampling as s
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}


def query(name, sql):
    def put(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return put


@query("cumcount_in_group", "select doc_id, source, row_number() over (partition by source order by n_chars desc, doc_id) - 1 as place from documents")
def cumcount_in_group(spark, d):
    return read(spark, d, "documents").select("doc_id", "source", r.place(["source"], [F.desc("n_chars"), "doc_id"]).cast("long").alias("place"))


@query("round_robin_balance", """
with a as (select doc_id, lang, source, row_number() over (partition by source, lang order by doc_id) as t from documents),
b as (select *, row_number() over (partition by source order by t, lang) as pick from a where t <= 12)
select doc_id, lang, source, pick from b where pick <= 12""")
def round_robin_balance(spark, d):
    out = r.round_robin(read(spark, d, "documents").select("doc_id", "lang", "source"), "lang", ["doc_id"], 12, ["source"])
    return out.select("doc_id", "lang", "source", F.col("pick").cast("long").alias("pick"))


@query("host_fair_order", r"""
with h as (select page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') as host from pages)
select page_id, host, cast((row_number() over (partition by host order by md5(url), url) - 1) // 4 as integer) as block, md5(host) as host_hash, md5(url) as key_hash from h""")
def host_fair_order(spark, d):
    from leafmill.functions.urls import host

    p = read(spark, d, "pages").select("page_id", "url", host(F.col("url")).alias("host"))
    return r.fair_blocks(p, "host", "url", ties=["page_id"]).select("page_id", "host", "block", "host_hash", "key_hash")


@query("best_n_per_group", "select c_custkey, c_nationkey, c_acctbal from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as r from customer) where r <= 3")
def best_n_per_group(spark, d):
    return r.head(read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 3)


@query("pct_rank_avg", "select p_partkey, (rank() over (order by p_size) + (count(*) over (partition by p_size) - 1) / 2.0::double) / count(*) over () as pct from part")
def pct_rank_avg(spark, d):
    return r.percentile_rank_over_all(read(spark, d, "part").select("p_partkey", "p_size"), "p_size").select("p_partkey", "pct")


@query("rank_desc_first", "select s_suppkey, row_number() over (partition by s_nationkey order by s_acctbal desc, s_suppkey) as place from supplier")
def rank_desc_first(spark, d):
    return read(spark, d, "supplier").select("s_suppkey", (r.place(["s_nationkey"], [F.desc("s_acctbal"), "s_suppkey"]) + 1).cast("long").alias("place"))


@query("group_totals_on_rows", "select o_orderkey, count(*) over (partition by o_custkey) as n, min(o_orderkey) over (partition by o_custkey) as first_key, round(sum(o_totalprice) over (partition by o_custkey), 2) as total from orders")
def group_totals_on_rows(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey")
    return read(spark, d, "orders").select("o_orderkey", F.count("*").over(w).alias("n"), F.min("o_orderkey").over(w).alias("first_key"), F.round(F.sum("o_totalprice").over(w), 2).alias("total"))


@query("shard_cut", """
with c as (select doc_id, source, sum(n_chars) over (partition by source order by doc_id) as cum from documents)
select source, cast((cum - 1) // 20000 as bigint) as shard, count(*) as docs, cast(max(cum) as bigint) as upto from c group by 1, 2""")
def shard_cut(spark, d):
    c = read(spark, d, "documents").select("source", r.running(F.col("n_chars"), ["source"], ["doc_id"]).alias("cum"))
    return c.groupBy("source", F.floor((F.col("cum") - 1) / 20000).alias("shard")).agg(F.count("*").alias("docs"), F.max("cum").alias("upto"))


@query("decile_shares", """
with e as (select quantile_cont(n_chars, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as e from documents),
b as (select lang, greatest(len(list_filter(e.e, lambda x: round(x, 6) < n_chars)) - 1, 0) as bin from documents, e)
select bin, lang, count(*) as n, round(count(*)::double / sum(count(*)) over (partition by bin), 9) as share from b group by bin, lang""")
def decile_shares(spark, d):
    from pyspark.sql import Window

    b = r.quantile_bins(read(spark, d, "documents").select("lang", F.col("n_chars").cast("double")), "n_chars", 10)
    n = F.sum(F.count("*")).over(Window.partitionBy("bin"))
    return b.groupBy("bin", "lang").agg(F.count("*").alias("n"), F.round(F.count("*").cast("double") / n, 9).alias("share"))


@query("threshold_bands", "select cast((n_chars >= 200)::int + (n_chars >= 1000)::int + (n_chars >= 5000)::int as integer) as band, cast((n_chars > 200)::int + (n_chars > 1000)::int + (n_chars > 5000)::int as integer) as right_band, count(*) as n from documents group by 1, 2")
def threshold_bands(spark, d):
    e = [200, 1000, 5000]
    return read(spark, d, "documents").groupBy(r.edges_bin(F.col("n_chars"), e).alias("band"), r.edges_bin(F.col("n_chars"), e, True).alias("right_band")).agg(F.count("*").alias("n"))


@query("rank_matched_spread", "select doc_id, round((row_number() over (partition by lang order by n_chars, doc_id) - 1 + (doc_id % 10) / 10.0::double) / count(*) over (partition by lang) * 6 + 8, 9) as pt from documents")
def rank_matched_spread(spark, d):
    return read(spark, d, "documents").select("doc_id", F.round(r.spread_evenly(["lang"], ["n_chars", "doc_id"], 8.0, 14.0, (F.col("doc_id") % 10) / F.lit(10.0)), 9).alias("pt"))


@query("event_sessions", """
with g as (select user_id, event_id, epoch_us(ts) // 1000000 as t from events),
n as (select *, coalesce((t - lag(t) over (partition by user_id order by t, event_id) > 3600)::int, 0) as new from g)
select user_id, cast(run as bigint) as run, count(*) as n from (select *, sum(new) over (partition by user_id order by t, event_id rows unbounded preceding) as run from n) group by 1, 2""")
def event_sessions(spark, d):
    e = read(spark, d, "events").select("user_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    return r.gaps(e, ["user_id"], "t", 3600).groupBy("user_id", "run").agg(F.count("*").alias("n"))


@query("source_cycling", """
with j as (select o_orderkey, o_custkey % 7 as g, row_number() over (partition by o_custkey % 7 order by o_orderkey) - 1 as i from orders),
s as (select s_suppkey, s_suppkey % 7 as g, row_number() over (partition by s_suppkey % 7 order by s_suppkey) - 1 as j, count(*) over (partition by s_suppkey % 7) as n from supplier)
select o_orderkey, s_suppkey, i >= n as reused from j join s on j.g = s.g and i % n = s.j""")
def source_cycling(spark, d):
    jobs = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("g"))
    sources = read(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") % 7).alias("g"))
    return r.cycle(jobs, ["g"], ["o_orderkey"], sources, ["s_suppkey"]).select("o_orderkey", "s_suppkey", "reused")


# Sampling and splits


@query("quota_pick_md5", "select doc_id, lang from (select *, row_number() over (partition by lang order by md5('7' || doc_id::varchar), doc_id) as r from documents) where r <= 25")
def quota_pick_md5(spark, d):
    return r.head(read(spark, d, "documents").select("doc_id", "lang"), ["lang"], s.shuffle_order("doc_id", "7"), 25)


@query("sample_without_replacement", "select doc_id from documents order by md5('x' || doc_id::varchar), doc_id limit 50")
def sample_without_replacement(spark, d):
    return s.sample(read(spark, d, "documents").select("doc_id"), "doc_id", 50, "x")


@query("shuffle_keep_together", "select conv_id, turn, cast(dense_rank() over (order by md5('s' || conv_id::varchar), conv_id) as bigint) as place from conversations")
def shuffle_keep_together(spark, d):
    c = read(spark, d, "conversations")
    keys = c.select("conv_id").distinct()
    order = r.running_over_all(keys, r.hash_bucket(s.hashed(F.col("conv_id"), "s")), s.shuffle_order("conv_id", "s"), out="place")
    return c.join(order, "conv_id").select("conv_id", "turn", "place")


@query("pps_systematic", """
with c as (select doc_id, sum(least(n_chars / 20000.0::double, 1.0)) over (order by doc_id rows unbounded preceding) as c, least(n_chars / 20000.0::double, 1.0) as m from documents)
select doc_id, floor(round(c - 0.37, 9)) > floor(round(round(c - 0.37, 9) - m, 9)) as taken from c""")
def pps_systematic(spark, d):
    return s.systematic(read(spark, d, "documents"), F.col("n_chars") / F.lit(20000.0), "doc_id", 0.37).select("doc_id", "taken")


@query("evenly_spaced_pick", """
with g as (select source, list(doc_id order by doc_id) as ids from documents group by source),
k as (select source, ids, list_distinct(list_transform(range(0, least(len(ids), 7)), lambda i: cast(round_even(i * (len(ids) - 1)::double / 6, 0) as bigint))) as pos from g)
select source, list_sort(list_transform(pos, lambda i: ids[i + 1])) as picked from k""")
def evenly_spaced_pick(spark, d):
    g = read(spark, d, "documents").groupBy("source").agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
    return g.select("source", s.evenly_spaced(F.col("ids"), 7).alias("picked"))


@query("hash_split_train_val", """
select doc_id, case when list_sum([('0x' || c)::int for c in string_split(sha1(text), '')]) % 5 = 0 then 'val' else 'train' end as part,
       list_reduce(list_transform(string_split(md5(text), ''), lambda c: ('0x' || c)::int), lambda a, c: (a * 16 + c) % 10, 0) = 0 as md5_val from documents""")
def hash_split_train_val(spark, d):
    return read(spark, d, "documents").select("doc_id", F.when(s.digit_sum(F.sha1("text")) % 5 == 0, "val").otherwise("train").alias("part"), (s.hex_modulo(F.md5("text"), 10) == 0).alias("md5_val"))


@query("host_crc_fold", r"""
with h as (select page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') as h from pages)
select page_id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(h))::bigint), lambda i: ('0x' || hex(encode(h))[2 * i + 1 : 2 * i + 2])::bigint)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 10 = 0 as held_out from h""")
def host_crc_fold(spark, d):
    from leafmill.functions.urls import host

    return read(spark, d, "pages").select("page_id", (F.crc32(host(F.col("url"))) % 10 == 0).alias("held_out"))


@query("fraction_split", """
with r as (select doc_id, row_number() over (order by md5('f' || doc_id::varchar), doc_id) as r, count(*) over () as n from documents)
select doc_id, case when r <= round_even(n * 0.1, 0) then 'test' when r <= round_even(n * 0.1, 0) + round_even(n * 0.15, 0) then 'val' else 'train' end as part from r""")
def fraction_split(spark, d):
    return s.fraction_split(read(spark, d, "documents").select("doc_id"), "doc_id", 0.1, 0.15, "f").select("doc_id", "part")


@query("group_split", """
with g as (select source, count(*) as n from documents group by source),
b as (select *, coalesce(sum(n) over (order by md5('g' || source), source rows between unbounded preceding and 1 preceding), 0) as before, sum(n) over () as total from g),
v as (select *, before < total * 0.2 as val, sum(case when before < total * 0.2 then n else 0 end) over () as ends from b)
select doc_id, source, case when val then 'val' when before - ends < total * 0.1 then 'test' else 'train' end as part from documents join v using (source)""")
def group_split(spark, d):
    return s.group_split(read(spark, d, "documents").select("doc_id", "source"), "source", 0.2, 0.1, "g").select("doc_id", "source", "part")


@query("every_kth_group", """
with g as (select source, row_number() over (order by source) - 1 as i, greatest(count(*) over () // 6, 1) as k from (select distinct source from documents))
select doc_id, i % k = 0 and i / k < 6 as held_out from documents join g using (source)""")
def every_kth_group(spark, d):
    return s.every_kth(read(spark, d, "documents").select("doc_id", "source"), "source", 6).select("doc_id", "held_out")


@query("document_budget", "select doc_id, cast(greatest(10 + ceil(0.1::double * n_chars), 50) as bigint) as budget, cast(case when n_chars < 5 then n_chars else greatest(5 + ceil(0.1::double * n_chars), 30) end as bigint) as more from documents")
def document_budget(spark, d):
    return read(spark, d, "documents").select("doc_id", s.budget(F.col("n_chars")).alias("budget"), s.budget(F.col("n_chars"), 5, 30, short=5).alias("more"))


@query("oversampled_strata", "select doc_id, lang, source from (select *, row_number() over (partition by lang, source order by md5('o|' || lang || '|' || source || '|' || doc_id::varchar), doc_id) as r from documents) where r <= 6")
def oversampled_strata(spark, d):
    return s.oversampled(read(spark, d, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", F.lit(2), 3, "o")


@query("least_confident_share", "select event_id, row_number() over (order by value, event_id) <= floor(0.1::double * count(*) over ()) as review from events")
def least_confident_share(spark, d):
    return s.least_confident(read(spark, d, "events").select("event_id", "value"), "value", "event_id", 0.1).select("event_id", "review")


@query("largest_in_reading_order", """
with t as (select *, row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey, l_suppkey, l_linenumber) as r from lineitem)
select l_orderkey, l_partkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos from t where r <= 2""")
def largest_in_reading_order(spark, d):
    from pyspark.sql import Window

    top = r.head(read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"), ["l_orderkey"], [F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber"], 2)
    return top.select("l_orderkey", "l_partkey", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).cast("long").alias("pos"))


@query("best_of_sampled_middle", """
with p as (select conv_id, turn, length(text) as score, count(*) over (partition by conv_id) as n, row_number() over (partition by conv_id order by turn) - 1 as i from conversations),
m as (select *, row_number() over (partition by conv_id order by md5(conv_id::varchar || '-' || turn::varchar), turn) as r from p where i >= floor(0.1::double * n) and i <= floor(0.9::double * n))
select conv_id, max(score) as best from m where r <= 3 group by conv_id""")
def best_of_sampled_middle(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id")
    p = read(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("score"), F.count("*").over(w).alias("n"), (F.row_number().over(w.orderBy("turn")) - 1).alias("i"))
    middle = p.filter((F.col("i") >= F.floor(F.lit(0.1) * F.col("n"))) & (F.col("i") <= F.floor(F.lit(0.9) * F.col("n"))))
    some = r.head(middle, ["conv_id"], [F.md5(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))), "turn"], 3)
    return some.groupBy("conv_id").agg(F.max("score").alias("best"))
