"""Dedup, lifecycle, join, report and text queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill.functions import language, text, urls
from leafmill.operators import dedup, joins, lifecycle, ranking
from leafmill.operators import statistics as st
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}


def query(name, sql):
    def put(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return put


def docs(spark, d):
    return read(spark, d, "documents")


# Deduplication


@query("exact_dup_groups", "select substr(sha256(text), 1, 12) as key, count(*) as n, min(doc_id) as first_doc from documents group by sha256(text) having count(*) > 1")
def exact_dup_groups(spark, d):
    groups = docs(spark, d).groupBy(dedup.content_key(F.col("text")).alias("full")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).filter("n > 1")
    return groups.select(dedup.short_name(F.col("full")).alias("key"), "n", "first_doc")


@query("keep_best_copy", "select doc_id, source from (select *, row_number() over (partition by sha256(text) order by source <> 'src3', length(source), source, doc_id) as r from documents) where r = 1")
def keep_best_copy(spark, d):
    rows = docs(spark, d).select("doc_id", "source", dedup.content_key(F.col("text")).alias("k"))
    return dedup.keep_first(rows, ["k"], [F.col("source") != "src3", F.length("source"), "source", "doc_id"]).select("doc_id", "source")


@query("ingest_status", """
with k as (select sha256(text) as key from documents where doc_id < 200)
select doc_id, case when sha256(text) in (select key from k) then 'known' when row_number() over (partition by sha256(text) order by doc_id) = 1 then 'ok' else 'dup' end as status from documents where doc_id >= 200""")
def ingest_status(spark, d):
    key = dedup.content_key(F.col("text"))
    known = docs(spark, d).filter("doc_id < 200").select(key.alias("key"))
    return dedup.duplicate_status(docs(spark, d).filter("doc_id >= 200"), key, ["doc_id"], known).select("doc_id", "status")


@query("repeated_line_docs", r"""
with l as (select doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: length(x) > 12) as ls from documents)
select doc_id, case when (len(ls) - len(list_distinct(ls)))::double / nullif(len(ls), 0) > 0.05 then 'repeats'
  when len(regexp_extract_all(text, '\p{Nd}'))::double / nullif(len(regexp_extract_all(text, '[\p{L}\p{Nd}]')), 0) > 0.3 then 'digits' else 'ok' end as verdict from l""")
def repeated_line_docs(spark, d):
    return docs(spark, d).select("doc_id", dedup.repeated_line_rule(F.col("text")).alias("verdict"))


@query("boilerplate_windows", r"""
with recursive c as (select doc_id, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'), ' ') as t from documents),
w as (select distinct doc_id, md5(substr(t, o + 1, 60)) as w from c, (select unnest([0, 200, 500]) as o) where length(t) >= o + 60), o as (select doc_id, list(w) as ws, row_number() over (order by doc_id) as r from w group by doc_id),
g as (select 0::bigint as r, []::varchar[] as kept, []::bigint[] as ids union all select o.r, case when list_has_any(kept, ws) then kept else list_concat(kept, ws) end, case when list_has_any(kept, ws) then ids else list_append(ids, doc_id) end from g join o on o.r = g.r + 1),
k as (select unnest(ids) as doc_id from (select ids from g order by r desc limit 1)), f as (select w, min(doc_id) as owner from w join k using (doc_id) group by w)
select doc_id, min(owner) as first_owner, count(*) as shared from w join f using (w) where owner < doc_id group by doc_id""")
def boilerplate_windows(spark, d):
    return dedup.later_overlaps(docs(spark, d), "doc_id", "text")


@query("subset_documents", """
with m as (select distinct l_orderkey as d, l_partkey as i from lineitem), s as (select d, count(*) as n from m group by d),
p as (select a.d, b.d as e, count(*) as shared from m a join m b on a.i = b.i and a.d <> b.d group by 1, 2)
select p.d as small, p.e as large, shared from p join s x on x.d = p.d join s y on y.d = p.e where shared = x.n and (x.n < y.n or (x.n = y.n and p.d > p.e))""")
def subset_documents(spark, d):
    return dedup.subset_pairs(read(spark, d, "lineitem"), "l_orderkey", "l_partkey")


@query("line_dups", r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as line from documents),
k as (select doc_id, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') as key from l)
select key, count(*) as n, count(distinct doc_id) as docs, min(doc_id) as first_doc from k where key <> '' group by key having count(*) > 1""")
def line_dups(spark, d):
    lines = docs(spark, d).select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", dedup.normal_key(F.col("line")).alias("key")).filter("key <> ''")
    return lines.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc")).filter("n > 1")


@query("one_id_per_file", "select doc_id, min(doc_id) over (partition by source || '/' || md5(text)) as keep_id, case when row_number() over (partition by source || '/' || md5(text), n_chars order by doc_id) > 1 then 'second row of a page' when doc_id <> min(doc_id) over (partition by source || '/' || md5(text)) then 'moved to the first id' else 'kept' end as reason from documents")
def one_id_per_file(spark, d):
    rows = docs(spark, d).select("doc_id", "n_chars", F.concat("source", F.lit("/"), F.md5("text")).alias("path"))
    return dedup.one_id_per_file(rows, "path", "n_chars", "doc_id").select("doc_id", "keep_id", "reason")


@query("near_dup_greedy", """
with recursive v as (select vec_id, label, row_number() over (partition by label order by vec_id) as r from embeddings),
n as (select b.vec_id, list(a.vec_id) as l from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id
  where list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]) * list_dot_product(b.embedding::double[], b.embedding::double[])) > 0.35 group by b.vec_id),
x as (select v.*, coalesce(l, []::bigint[]) as l from v left join n using (vec_id)),
g as (select distinct label, 0::bigint as r, []::bigint[] as kept from v union all select g.label, x.r, case when list_has_any(kept, l) then kept else list_append(kept, vec_id) end from g join x on x.label = g.label and x.r = g.r + 1),
e as (select label, max_by(kept, r) as kept from g group by label)
select vec_id, list_contains(kept, vec_id) as kept from v join e using (label)""")
def near_dup_greedy(spark, d):
    return dedup.greedy_near_duplicates(read(spark, d, "embeddings"), "label", "vec_id", "embedding", ["vec_id"], 0.35)


# Lifecycle


@query("registry_ids", "select text_key, 200 + row_number() over (order by text_key) - 1 as id from (select distinct sha256(text) as text_key from documents where sha256(text) not in (select sha256(text) from documents where doc_id < 200))")
def registry_ids(spark, d):
    key = F.sha2("text", 256).alias("text_key")
    known = docs(spark, d).filter("doc_id < 200").select(key, F.col("doc_id").alias("id"))
    return lifecycle.assign_ids(known, docs(spark, d).select(key), "text_key", "id")


@query("merge_pages_versions", """
with old as (select o_orderkey, o_totalprice from orders), new as (select case when o_orderstatus = 'F' then o_orderkey + 1000000000 else o_orderkey end as o_orderkey, o_totalprice + 1 as o_totalprice from orders where o_orderstatus <> 'O'), gone as (select o_orderkey from orders where o_totalprice < 20000),
l as (select * from old where o_orderkey not in (select o_orderkey from gone))
select o_orderkey, round(o_totalprice, 2) as price from (select * from l union all select * from new where o_orderkey not in (select o_orderkey from l))""")
def merge_pages_versions(spark, d):
    """All orders as the old version; of the new one orders in process are known and finished ones have new keys."""
    o = read(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    key = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") + 1_000_000_000).otherwise(F.col("o_orderkey"))
    new = o.filter("o_orderstatus <> 'O'").select(key.alias("o_orderkey"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    out = lifecycle.merge_pages(o.drop("o_orderstatus"), new, o.filter("o_totalprice < 20000"), ["o_orderkey"])
    return out.select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@query("upsert_versions", """
with old as (select s_suppkey as k, s_name as v from supplier), new as (select case when s_acctbal > 5000 then s_suppkey + 100000 else s_suppkey end as k, lower(s_name) as v from supplier where s_acctbal < 0 or s_acctbal > 5000)
select k, v, 'replace' as mode from (select * from old where k not in (select k from new) union all select * from new)
union all select k, v, 'ignore' from (select * from old union all select * from new where k not in (select k from old))""")
def upsert_versions(spark, d):
    """All suppliers as the old version; those in debt come again, rich ones under new keys."""
    s = read(spark, d, "supplier")
    key = F.when(F.col("s_acctbal") > 5000, F.col("s_suppkey") + 100_000).otherwise(F.col("s_suppkey"))
    old, new = s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v")), s.filter("s_acctbal < 0 or s_acctbal > 5000").select(key.alias("k"), F.lower("s_name").alias("v"))
    return lifecycle.upsert(old, new, ["k"]).withColumn("mode", F.lit("replace")).unionByName(lifecycle.upsert(old, new, ["k"], replace=False).withColumn("mode", F.lit("ignore")))


@query("drop_pages", "select count(*) as left_, (select count(*) from lineitem where l_orderkey % 5 = 0) as gone from lineitem where l_orderkey % 5 <> 0")
def drop_pages(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey")
    keys = li.filter("l_orderkey % 5 = 0")
    left = lifecycle.delete(li, keys, ["l_orderkey"]).agg(F.count("*").alias("left_"))
    return left.crossJoin(keys.agg(F.count("*").alias("gone")))


@query("reconcile_states", """
with listed as (select doc_id, sha256(text) as c, source as p from documents), found as (select sha256(text) as c, case when n_chars < 400 then 'moved' else source end as p from documents where n_chars < 3000),
n as (select c, count(*) as n, min(p) as there from found group by c), h as (select distinct c, p from found)
select doc_id, case when h.c is not null then 'same' when n.n is null then 'gone' when n.n > 1 then 'ambiguous' else 'moved' end as state,
       case when h.c is not null then l.p when n.n = 1 then there end as now_at
from listed l left join h on h.c = l.c and h.p = l.p left join n on n.c = l.c""")
def reconcile_states(spark, d):
    """All documents are listed; short ones are found elsewhere, long ones not at all."""
    c = F.sha2("text", 256).alias("c")
    listed = docs(spark, d).select("doc_id", c, F.col("source").alias("p"))
    found = docs(spark, d).filter("n_chars < 3000").select(c, F.when(F.col("n_chars") < 400, "moved").otherwise(F.col("source")).alias("p"))
    return lifecycle.reconcile(listed, found, "c", "p").select("doc_id", "state", "now_at")


@query("replace_by_document", """
with new as (select case when l_returnflag = 'A' then l_orderkey + 1000000000 else l_orderkey end as d, l_partkey as p, max(l_extendedprice) as v from lineitem where l_returnflag <> 'N' group by 1, 2), redo as (select distinct l_orderkey as d from lineitem where l_discount >= 0.09),
old as (select l_orderkey as d, l_partkey as p, min(l_extendedprice) as v from lineitem group by 1, 2)
select d, p, v from old where d not in (select d from redo) and (d, p) not in (select d, p from new) union all select * from new""")
def replace_by_document(spark, d):
    """All lines as the old version; returned ones come again, accepted ones as new documents; discounted orders are redone."""
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("d"), F.col("l_partkey").alias("p"), F.col("l_extendedprice").alias("v"), "l_returnflag", "l_discount")
    key = F.when(F.col("l_returnflag") == "A", F.col("d") + 1_000_000_000).otherwise(F.col("d"))
    new = li.filter("l_returnflag <> 'N'").select(key.alias("d"), "p", "v")
    old = li.groupBy("d", "p").agg(F.min("v").alias("v"))
    return lifecycle.replace_documents(old, new, "d", "p", li.filter("l_discount >= 0.09").select("d"), [F.desc("v")])


@query("layered_labels", """
with l as (select doc_id, quality as v, 0 as layer from labels union all select doc_id, case when doc_id % 14 = 0 then null else 1 - quality end, 1 from labels where doc_id % 7 = 0 union all select doc_id, toxic, 2 from labels where doc_id % 11 = 0)
select doc_id, cast(coalesce(v, 0) as integer) as v, layer from (select *, row_number() over (partition by doc_id order by layer desc) as r from l) where r = 1""")
def layered_labels(spark, d):
    lb = read(spark, d, "labels")
    second = lb.filter("doc_id % 7 = 0").select("doc_id", F.when(F.col("doc_id") % 14 != 0, 1 - F.col("quality")).alias("v"))
    return lifecycle.layered([lb.select("doc_id", F.col("quality").alias("v")), second, lb.filter("doc_id % 11 = 0").select("doc_id", F.col("toxic").alias("v"))], ["doc_id"], "v").withColumn("v", F.col("v").cast("int"))


@query("integrity_violations", """
select 'order without customer' as "check", count(*) as n from orders where o_custkey not in (select c_custkey from customer) union all
select 'repeated line key', count(*) from (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1) union all
select 'label without document', count(*) from labels where doc_id not in (select doc_id from documents) union all
select 'empty text', count(*) from documents where text is null or length(text) = 0""")
def integrity_violations(spark, d):
    r = lambda t: read(spark, d, t)
    return lifecycle.violations(
        {
            "order without customer": r("orders").join(r("customer"), F.col("o_custkey") == F.col("c_custkey"), "left_anti"),
            "repeated line key": r("lineitem").groupBy("l_orderkey", "l_linenumber").count().filter("count > 1"),
            "label without document": r("labels").join(r("documents"), "doc_id", "left_anti"),
            "empty text": r("documents").filter("text is null or length(text) = 0"),
        }
    )


@query("best_result_wins", "select l_orderkey, l_suppkey from (select *, row_number() over (partition by l_orderkey order by l_suppkey is null, l_partkey desc, l_suppkey desc, l_linenumber) as r from (select l_orderkey, l_partkey, l_linenumber, case when l_quantity > 5 then l_suppkey end as l_suppkey from lineitem where l_returnflag <> 'R')) where r = 1")
def best_result_wins(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", F.when(F.col("l_quantity") > 5, F.col("l_suppkey")).alias("l_suppkey"), F.struct("l_partkey", F.when(F.col("l_quantity") > 5, F.col("l_suppkey"))).alias("rank"))
    return lifecycle.best_result(li, ["l_orderkey"], "l_suppkey", "rank", F.col("l_returnflag") == "R").select("l_orderkey", "l_suppkey")


@query("audit_trail", """
with o as (select c_custkey as k, c_mktsegment as v from customer where c_custkey % 10 <> 1), n as (select c_custkey as k, case when c_custkey % 7 = 0 then 'X' else c_mktsegment end as v from customer where c_custkey % 10 <> 2)
select 'customer' as "table", k, o.v as old, n.v as new, case when o.k is null then 'added' when n.k is null then 'removed' else 'changed' end as action from o full join n using (k) where o.k is null or n.k is null or o.v <> n.v""")
def audit_trail(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"))
    return lifecycle.audit(c.filter("k % 10 <> 1"), c.filter("k % 10 <> 2").withColumn("v", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("v"))), "k", "v", "customer")


@query("pending_work", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def pending_work(spark, d):
    return lifecycle.pending(docs(spark, d).select("doc_id"), read(spark, d, "labels"), ["doc_id"])


# Joins and votes


@query("pool_filtered", "select d.doc_id, l.quality, coalesce(l.toxic, 0) as toxic from documents d left join labels l using (doc_id) where d.source not in ('src1', 'src2') and d.n_chars > 300 and coalesce(l.quality, 1) = 1")
def pool_filtered(spark, d):
    out = docs(spark, d).filter(~F.col("source").isin("src1", "src2") & (F.col("n_chars") > 300)).join(read(spark, d, "labels"), "doc_id", "left")
    return out.filter(F.coalesce("quality", F.lit(1)) == 1).select("doc_id", "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"))


COS = "list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]) * list_dot_product(b.embedding::double[], b.embedding::double[]))"
KNN = f"select a.vec_id as src, b.vec_id as dst, round({COS}, 12) as sim, row_number() over (partition by a.vec_id order by round({COS}, 12) desc, b.vec_id) as rank, a.label as la, b.label as lb from embeddings a join embeddings b on a.vec_id <> b.vec_id"


@query("knn_table", f"select src, cast(rank as integer) as rank, dst, round(sim, 9) as similarity from ({KNN}) where rank <= 5")
def knn_table(spark, d):
    e = read(spark, d, "embeddings")
    return joins.k_nearest(e, e, "vec_id", "embedding", 5).withColumn("similarity", F.round("similarity", 9))


@query("border_rank", f"select src, round(sqrt(greatest(2 - 2 * sim, 0)), 6) as d10, row_number() over (order by sim, src) as place from ({KNN}) where rank = 10")
def border_rank(spark, d):
    e = read(spark, d, "embeddings")
    k = joins.k_nearest(e, e, "vec_id", "embedding", 10).filter("rank = 10")
    placed = ranking.running_over_all(k, ranking.value_bucket(k, "similarity"), ["similarity", "src"], out="place")
    return placed.select("src", F.round(F.sqrt(F.greatest(2 - 2 * F.col("similarity"), F.lit(0.0))), 6).alias("d10"), "place")


@query("nearest_selected", f"select src, dst, round(sim, 9) as similarity from (select *, row_number() over (partition by src order by sim desc, dst) as r from ({KNN}) where dst in (select min(vec_id) from embeddings group by label)) where r = 1")
def nearest_selected(spark, d):
    e = read(spark, d, "embeddings")
    return joins.nearest(e, dedup.keep_first(e, ["label"], ["vec_id"]), "vec_id", "embedding").withColumn("similarity", F.round("similarity", 9))


@query("knn_label_vote", f"""
with v as (select src, lb, sum(greatest(sim, 0)) as v from ({KNN}) where rank <= 15 group by 1, 2),
r as (select *, v / sum(v) over (partition by src) as share, row_number() over (partition by src order by v desc, lb) as r from v)
select src, case when share >= 0.3 then cast(lb as varchar) else 'unknown' end as label, round(share, 6) as share from r where r = 1""")
def knn_label_vote(spark, d):
    e = read(spark, d, "embeddings")
    k = joins.k_nearest(e, e, "vec_id", "embedding", 15).join(e.select(F.col("vec_id").alias("dst"), "label"), "dst")
    return st.weighted_vote(k, ["src"], "label", F.col("similarity"), 0.3).withColumn("share", F.round("share", 6))


@query("knn_label_accuracy", f"""
with v as (select src, la, lb, count(*) as n from ({KNN}) where rank <= 5 group by 1, 2, 3), w as (select *, row_number() over (partition by src order by n desc, lb) as r from v)
select round(avg((la = lb)::int), 9) as accuracy from w where r = 1""")
def knn_label_accuracy(spark, d):
    e = read(spark, d, "embeddings")
    k = joins.k_nearest(e, e, "vec_id", "embedding", 5).join(e.select(F.col("vec_id").alias("dst"), F.col("label").alias("lb")), "dst")
    won = st.majority(k, ["src"], "lb").join(e.select(F.col("vec_id").alias("src"), "label"), "src")
    return won.agg(F.round(F.avg((F.col("label") == F.col("lb")).cast("int")), 9).alias("accuracy"))


@query("dup_components", f"""
with recursive e as (select src as a, dst as b from ({KNN}) where rank = 1), s as (select a, b from e union select b, a from e),
r as (select a as node, a as x from s union select r.node, s.b from r join s on r.x = s.a)
select node, min(x) as "group" from r group by node""")
def dup_components(spark, d):
    """Groups of vectors that nearest-neighbour links connect."""
    e = read(spark, d, "embeddings")
    return dedup.linked_groups(joins.nearest(e, e, "vec_id", "embedding"), "src", "dst")


@query("contained_sets", """
with s as (select c_nationkey * 100 + floor(c_acctbal / 500)::bigint as n, list(distinct c_mktsegment) as a from customer group by 1), l as (select s_nationkey as m, ['BUILDING', 'MACHINERY', 'AUTOMOBILE', 'HOUSEHOLD'] as b from supplier group by 1)
select n, m from s, l where len(list_filter(a, lambda x: not list_contains(b, x))) = 0""")
def contained_sets(spark, d):
    """The segments of each nation's customers of like means, and whose offer has them all."""
    s = read(spark, d, "customer").groupBy((F.col("c_nationkey") * 100 + F.floor(F.col("c_acctbal") / 500)).alias("n")).agg(F.collect_set("c_mktsegment").alias("a"))
    big = read(spark, d, "supplier").select(F.col("s_nationkey").alias("m")).distinct().withColumn("b", F.array(*[F.lit(x) for x in ("BUILDING", "MACHINERY", "AUTOMOBILE", "HOUSEHOLD")]))
    return joins.contained(s, big, "a", "b").select("n", "m")


@query("greedy_assignment", """
with recursive r as (select l_suppkey % 20 as g, l_orderkey, l_partkey, row_number() over (partition by l_suppkey % 20 order by l_extendedprice, l_orderkey, l_partkey) as i from lineitem),
w as (select distinct g, 0::bigint as i, []::bigint[] as o, []::bigint[] as p from r
  union all select g, i, case when free then list_append(o, l_orderkey) else o end, case when free then list_append(p, l_partkey) else p end
  from (select w.g, r.i, o, p, l_orderkey, l_partkey, not list_contains(o, l_orderkey) and not list_contains(p, l_partkey) as free from w join r on r.g = w.g and r.i = w.i + 1 where len(o) < 40)),
e as (select g, max_by(o, i) as o, max_by(p, i) as p from w group by g)
select g, unnest(o) as l_orderkey, unnest(p) as l_partkey from e""")
def greedy_assignment(spark, d):
    li = read(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("g"), "l_orderkey", "l_partkey", "l_extendedprice")
    return joins.greedy_one_to_one(li, "g", "l_orderkey", "l_partkey", "l_extendedprice", 40)


@query("top_value_shares", """
with c as (select source, lang, count(*) as n from documents group by 1, 2), r as (select *, row_number() over (partition by source order by n desc, lang) as r, sum(n) over (partition by source) as t from c)
select source, string_agg(lang || ' ' || cast(round(100.0 * n / t, 0) as bigint) || '%', ', ' order by r) as shares from r where r <= 3 group by source""")
def top_value_shares(spark, d):
    return st.top_shares(docs(spark, d), ["source"], "lang", 3)


@query("majority_with_share", "select source, lang, n::double / t as share from (select source, lang, count(*) as n, sum(count(*)) over (partition by source) as t, row_number() over (partition by source order by count(*) desc, lang) as r from documents group by 1, 2) where r = 1")
def majority_with_share(spark, d):
    return st.majority(docs(spark, d), ["source"], "lang")


@query("value_shares_by_set", """
with c as (select l_shipdate < timestamp '1995-01-01' as early, l_returnflag as v, count(*) as n from lineitem group by 1, 2), s as (select *, n::double / sum(n) over (partition by early) as s from c)
select v, coalesce(max(s) filter (early), 0) as before, coalesce(max(s) filter (not early), 0) as after from s group by v""")
def value_shares_by_set(spark, d):
    li = read(spark, d, "lineitem").select(F.when(F.col("l_shipdate") < F.lit("1995-01-01").cast("timestamp_ntz"), "before").otherwise("after").alias("part"), F.col("l_returnflag").alias("v"))
    return st.value_shares(li, "part", "v", ["before", "after"])


@query("cramers_v_pairs", """
with n as (select o_orderstatus as a, o_orderpriority as b, count(*)::double as n from orders group by 1, 2), a as (select a, sum(n) as ra from n group by a), b as (select b, sum(n) as cb from n group by b), t as (select sum(n) as t from n),
x as (select sum((coalesce(n.n, 0) - ra * cb / t) * (coalesce(n.n, 0) - ra * cb / t) / (ra * cb / t)) as chi, max(t) as t, count(distinct a.a) as r, count(distinct b.b) as c from a cross join b cross join t left join n on n.a = a.a and n.b = b.b)
select 'o_orderstatus' as a, 'o_orderpriority' as b, round(sqrt(greatest(chi / t - (r - 1) * (c - 1) / (t - 1), 0) / (least(r - (r - 1) * (r - 1) / (t - 1), c - (c - 1) * (c - 1) / (t - 1)) - 1)), 9) as v from x""")
def cramers_v_pairs(spark, d):
    return st.cramers_v(read(spark, d, "orders"), "o_orderstatus", "o_orderpriority").withColumn("v", F.round("v", 9))


@query("entropy_report", "with c as (select source, lang, count(*)::double as n from documents group by 1, 2), p as (select source, n / sum(n) over (partition by source) as p from c) select source, round(-sum(p * ln(p)), 9) as entropy, round(case when count(*) > 1 then -sum(p * ln(p)) / ln(count(*)) else 0 end, 9) as normalised from p group by source")
def entropy_report(spark, d):
    return st.entropy(docs(spark, d), ["source"], "lang").select("source", F.round("entropy", 9).alias("entropy"), F.round("normalised", 9).alias("normalised"))


@query("error_summary", "select l_returnflag, round(avg(abs(l_discount - l_tax)), 9) as mean_abs, round(quantile_cont(abs(l_discount - l_tax), 0.5), 9) as median_abs, round(quantile_cont(abs(l_discount - l_tax), 0.9), 9) as p90_abs, round(avg((abs(l_discount - l_tax) <= 0.05)::int), 9) as within, round(avg(l_discount - l_tax), 9) as bias from lineitem group by 1")
def error_summary(spark, d):
    out = st.error_summary(read(spark, d, "lineitem"), ["l_returnflag"], F.col("l_discount") - F.col("l_tax"), 0.05)
    return out.select("l_returnflag", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query("classification_report", """
with p as (select lang as t, case when doc_id % 9 = 0 then 'en' else lang end as f from documents), c as (select distinct t as class from p union select distinct f from p),
x as (select class, count(*) filter (t = class) as support, count(*) filter (f = class) as called, count(*) filter (t = class and f = class) as hit from c, p group by class)
select class, hit::double / called as precision, hit::double / support as recall, round(2 * (hit::double / called) * (hit::double / support) / (hit::double / called + hit::double / support), 9) as f1, support from x""")
def classification_report(spark, d):
    p = docs(spark, d).select(F.col("lang").alias("t"), F.when(F.col("doc_id") % 9 == 0, "en").otherwise(F.col("lang")).alias("f"))
    return st.classification_report(p, "t", "f").withColumn("f1", F.round("f1", 9))


@query("common_chars_mass", r"""
with c as (select ch, count(*) as n from (select unnest(regexp_extract_all(text, '(?s).')) as ch from documents) group by ch), r as (select *, coalesce(sum(n) over (order by n desc, ch rows between unbounded preceding and 1 preceding), 0) as b, sum(n) over () as t from c)
select ch, n from r where b < 0.995::double * t""")
def common_chars_mass(spark, d):
    chars = docs(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0))).alias("ch"))
    return st.mass_set(chars, "ch", 0.995)


@query("short_cells", "with l as (select distinct lang from documents), s as (select distinct source from documents), c as (select lang, source, count(*) as n from documents group by 1, 2) select lang, source, coalesce(n, 0) as n, 8 - coalesce(n, 0) as need from l cross join s left join c using (lang, source) where coalesce(n, 0) < 8")
def short_cells(spark, d):
    return st.short_cells(docs(spark, d), "lang", "source", 8)


@query("post_weights", """
with r as (select d.doc_id, quality as cls, lang from documents d join labels using (doc_id)), s as (select lang, count(*)::double / (select count(*) from documents) as share from documents group by lang),
w as (select doc_id, cls, share / (count(*) over (partition by cls, lang)::double / count(*) over (partition by cls)) as raw, count(*) over () as n from r join s using (lang)),
b as (select *, raw / sum(raw) over (partition by cls) as b from w) select doc_id, round(b * n / sum(b) over (), 9) as weight from b""")
def post_weights(spark, d):
    dd = docs(spark, d).select("doc_id", "lang")
    shares = dd.groupBy("lang").agg((F.count("*") / F.sum(F.count("*")).over(Window.partitionBy())).alias("share"))
    rows = dd.join(read(spark, d, "labels").select("doc_id", F.col("quality").alias("cls")), "doc_id")
    return st.post_weights(rows, "cls", "lang", shares).select("doc_id", F.round("weight", 9).alias("weight"))


@query("z_score_blocks", """
with p as (select p_partkey, p_size::double as a, case when p_size % 2 = 0 then p_retailprice end as b from part), s as (select avg(a) as ma, stddev_pop(a) as sa, avg(b) as mb, stddev_pop(b) as sb from p)
select p_partkey, round(least(greatest((a - ma) / sa, -5), 5), 9) as z_a, round(coalesce(least(greatest((b - mb) / sb, -5), 5), 0), 9) as z_b, (b is not null)::int as has_b from p, s""")
def z_score_blocks(spark, d):
    p = read(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice")).alias("b"))
    return st.z_scores(p, ["a", "b"]).select("p_partkey", F.round("z_a", 9).alias("z_a"), F.round("z_b", 9).alias("z_b"), "has_b")


@query("class_by_counts", "with c as (select l_orderkey, count(*) filter (l_quantity > 25) as hw, count(*) filter (l_quantity <= 25) as text from lineitem group by 1) select l_orderkey, case when hw > 4 and text < 2 then 2 when hw > 1 and text > 1 then 1 else 0 end as cls from c")
def class_by_counts(spark, d):
    q = F.col("l_quantity")
    c = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_if(q > 25).alias("hw"), F.count_if(q <= 25).alias("text"))
    return c.select("l_orderkey", F.when((F.col("hw") > 4) & (F.col("text") < 2), 2).when((F.col("hw") > 1) & (F.col("text") > 1), 1).otherwise(0).alias("cls"))


@query("doc_class_share", "with c as (select conv_id, count(*) filter (role = 'assistant')::double / greatest(count(*), 4) as a, count(*) filter (role = 'user')::double / greatest(count(*), 4) as u from conversations group by 1) select conv_id, case when a >= 0.5 then 'assistant' when u >= 0.5 then 'user' else 'none' end as cls from c")
def doc_class_share(spark, d):
    n = F.greatest(F.count("*"), F.lit(4))
    share = lambda r: F.count_if(F.col("role") == r) / n
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.when(share("assistant") >= 0.5, "assistant").when(share("user") >= 0.5, "user").otherwise("none").alias("cls"))


# Text, URLs, language


@query("url_canonical_dedup", r"select c as url, count(*) as n, min(page_id) as first_page from (select page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '^[a-z]+://', ''), '^www\.', ''), '/+$', '') as c from pages) group by c")
def url_canonical_dedup(spark, d):
    return read(spark, d, "pages").groupBy(urls.canonical(F.col("url")).alias("url")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


@query("url_depth_stats", r"select regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') as host, count(*) as n, avg(len(list_filter(string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+(/[^?#]*)?', 1), '/'), lambda x: x <> ''))) as depth from pages group by 1")
def url_depth_stats(spark, d):
    u = F.col("url")
    return read(spark, d, "pages").groupBy(urls.host(u).alias("host")).agg(F.count("*").alias("n"), F.avg(urls.depth(u)).alias("depth"))


@query("url_tokens", r"""
with u as (select page_id, regexp_replace(lower(url), '^(?s).*?://', '') as rest from pages),
s as (select page_id, regexp_replace(string_split(rest, '/')[1], '^www\.', '') as h, case when contains(rest, '/') then regexp_replace(rest, '^[^/]*/', '') else '' end as p from u),
t as (select *, string_split(h, '.') as l, list_filter(string_split(string_split(p, '?')[1], '/'), lambda x: x <> '') as dirs,
  list_transform(regexp_extract_all(p, '[a-z]+|[0-9]+'), lambda w: case when regexp_matches(w, '^[0-9]') then '#' || least(length(w), 6) else w end) as w from s),
v as (select *, list_concat(list_transform(dirs[1:3], lambda x, i: 'd' || (i - 1) || ':' || x), w) as tail from t)
select page_id, list_concat(['h:' || h, 'tld:' || l[-1], 'dom:' || array_to_string(l[-2:], '.'), 'n:' || least(len(dirs), 6)], tail, list_transform(range(1, greatest(len(tail), 1)), lambda i: 'b:' || tail[i] || '_' || tail[i + 1])) as tokens from v""")
def url_tokens(spark, d):
    return read(spark, d, "pages").select("page_id", urls.tokens(F.col("url")).alias("tokens"))


@query("url_hashed_bag", r"""
with tokens as (with u as (select page_id, regexp_replace(lower(url), '^(?s).*?://', '') as rest from pages),
s as (select page_id, regexp_replace(string_split(rest, '/')[1], '^www\.', '') as h, case when contains(rest, '/') then regexp_replace(rest, '^[^/]*/', '') else '' end as p from u),
t as (select *, string_split(h, '.') as l, list_filter(string_split(string_split(p, '?')[1], '/'), lambda x: x <> '') as dirs,
  list_transform(regexp_extract_all(p, '[a-z]+|[0-9]+'), lambda w: case when regexp_matches(w, '^[0-9]') then '#' || least(length(w), 6) else w end) as w from s),
v as (select *, list_concat(list_transform(dirs[1:3], lambda x, i: 'd' || (i - 1) || ':' || x), w) as tail from t)
select page_id, list_concat(['h:' || h, 'tld:' || l[-1], 'dom:' || array_to_string(l[-2:], '.'), 'n:' || least(len(dirs), 6)], tail, list_transform(range(1, greatest(len(tail), 1)), lambda i: 'b:' || tail[i] || '_' || tail[i + 1])) as tokens from v),
e as (select page_id, generate_subscripts(tokens, 1) as k, unnest(tokens) as t from tokens)
select page_id, list(xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(t))::bigint), lambda i: ('0x' || hex(encode(t))[2 * i + 1 : 2 * i + 2])::bigint)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 1048576 order by k) as buckets from e group by page_id""")
def url_hashed_bag(spark, d):
    return read(spark, d, "pages").select("page_id", urls.hashed_bag(urls.tokens(F.col("url"))).alias("buckets"))


@query("clean_and_cut", r"""
with c as (select doc_id, substr(trim(regexp_replace(regexp_replace(text, '[.…_\-–—=~*|]{3,}', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'), ' '), 1, 600) as t from documents)
select doc_id, md5(t) as cleaned, case when length(t) <= 80 then t when 80 - length(string_split(substr(t, 1, 80), ' ')[-1]) - 1 > 56 then substr(t, 1, 80 - length(string_split(substr(t, 1, 80), ' ')[-1]) - 1) else substr(t, 1, 80) end as cut from c""")
def clean_and_cut(spark, d):
    c = docs(spark, d).select("doc_id", text.clean(F.col("text")).alias("t"))
    return c.select("doc_id", F.md5("t").alias("cleaned"), text.cut_at_word(F.col("t"), 80).alias("cut"))


@query("char_class_shares", r"with s as (select doc_id, text, len(regexp_extract_all(text, '[^ \t\n\r\f\v]')) as n from documents) select doc_id, round(len(regexp_extract_all(text, '\p{L}'))::double / n, 9) as alpha, round(len(regexp_extract_all(text, '\p{Nd}'))::double / n, 9) as digit, round(len(regexp_extract_all(text, '\p{Lu}'))::double / n, 9) as upper from s")
def char_class_shares(spark, d):
    s = docs(spark, d).select("doc_id", text.char_shares(F.col("text")).alias("s"))
    return s.select("doc_id", *[F.round(f"s.{k}", 9).alias(k) for k in ("alpha", "digit", "upper")])


@query("language_signature_scores", r"""
with s as (select doc_id, text, lang, lower(text) as t from documents), c as (select *, len(regexp_extract_all(t, '\p{Latin}')) as n from s),
p as (select *, case when n > 0 then 1000.0::double / n else 0 end as k from c),
f as (select *, case when n <= 100 then null when k * len(regexp_extract_all(t, '[äöß]')) > 3 then 'de' when k * len(regexp_extract_all(t, '[èêçàœ]')) > 3 then 'fr' when k * len(regexp_extract_all(t, '[ñáíóú]')) > 3 then 'es' else 'none' end as found from p)
select doc_id, found, case when len(regexp_extract_all(text, '[^ \t\n\r\f\v]+')) < 20 and len(regexp_extract_all(text, '[^ \t\n\r\f\v]')) < 120 then 'short' when found = lang or (found = 'none' and lang = 'en') then 'ok' when found = 'none' then 'mismatch' when found is not null then 'other' end as status from f""")
def language_signature_scores(spark, d):
    found = language.signature(F.col("text"), language.LATIN, "Latin")
    out = docs(spark, d).withColumn("found", found)
    return out.select("doc_id", "found", language.status(F.col("text"), F.col("lang"), F.col("found"), language.LATIN_PLAIN).alias("status"))


@query("majority_script", r"""
with s as (select doc_id, text, [len(regexp_extract_all(text, '\p{Cyrillic}')), len(regexp_extract_all(text, '\p{Greek}')), len(regexp_extract_all(text, '\p{Arabic}')), len(regexp_extract_all(text, '\p{Hebrew}')), len(regexp_extract_all(text, '\p{Devanagari}')), len(regexp_extract_all(text, '\p{Bengali}')),
  len(regexp_extract_all(text, '\p{Han}')), len(regexp_extract_all(text, '\p{Hiragana}')), len(regexp_extract_all(text, '\p{Katakana}')), len(regexp_extract_all(text, '\p{Hangul}')), len(regexp_extract_all(text, '\p{Thai}'))] as o, len(regexp_extract_all(text, '\p{Latin}')) as l from documents),
t as (select *, list_sum(o) as r from s)
select doc_id, case when r + l = 0 then 'none' when l >= 0.97::double * (r + l) then 'Latin' when list_max(o) >= 0.8::double * greatest(r, 1) then ['Cyrillic', 'Greek', 'Arabic', 'Hebrew', 'Devanagari', 'Bengali', 'Han', 'Hiragana', 'Katakana', 'Hangul', 'Thai'][list_position(o, list_max(o))] else 'mixed' end as script, regexp_matches(text, '[\p{Co}\x{FFFD}]') as broken from t""")
def majority_script(spark, d):
    return docs(spark, d).select("doc_id", text.script(F.col("text")).alias("script"), text.is_broken(F.col("text")).alias("broken"))


@query("pass_vote_verdict", """
with a as (select event_id % 2000 as k, 'click' as label, event_type as a from events), v as (select k, label, a, count(*) as n from a group by 1, 2, 3),
h as (select k, label, bool_or(a = label) as hit from v group by 1, 2), b as (select k, a as new from (select *, row_number() over (partition by k order by n desc, a) as r from v where n >= 2 and a <> 'und') where r = 1)
select k, case when hit then label else new end as label, case when not hit and new is not null then label end as was, case when hit then 'kept' when new is not null then 'relabelled' else 'dropped' end as verdict from h left join b using (k)""")
def pass_vote_verdict(spark, d):
    a = read(spark, d, "events").select((F.col("event_id") % 2000).alias("k"), F.lit("click").alias("label"), F.col("event_type").alias("a"))
    return language.passes_verdict(a, "k", "label", "a")


@query("lexicon_share", r"""
with w as (select doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) as w from documents), l as (select distinct unnest(regexp_extract_all(lower(text), '\p{L}+')) as w from benchmark)
select doc_id, round(avg((l.w is not null)::int), 9) as share from w left join l using (w) group by doc_id""")
def lexicon_share(spark, d):
    lex = read(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    return language.lexicon_share(docs(spark, d), "doc_id", "text", lex, "w").withColumn("share", F.round("share", 9))


@query("char_trigram_lm", r"""
with c as (select lang, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g'), ' ') || ' ' as t from documents), g as (select lang, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) as gram from c where length(t) >= 3)
select lang, gram, count(*) as n from g group by 1, 2""")
def char_trigram_lm(spark, d):
    return language.ngram_counts(docs(spark, d), "text", 3, ["lang"])


@query("line_bank", r"""
with s as (select lang, unnest(string_split(regexp_replace(text, '([.!?…。！？।])[ \t\n\r\f\v]+', '\1' || chr(1), 'g'), chr(1))) as s from documents), c as (select lang, unnest(string_split(regexp_replace(s, '([,;:，；：])[ \t\n\r\f\v]+', '\1' || chr(1), 'g'), chr(1))) as c from s),
w as (select lang, regexp_extract_all(c, '[^ \t\n\r\f\v]+') as w from c), n as (select lang, w, ceil(len(w) / 10)::bigint as k from w where len(w) > 0),
p as (select lang, w, k, unnest(range(k)) as i from n), l as (select lang, array_to_string(w[floor(i * len(w) / k)::bigint + 1 : floor((i + 1) * len(w) / k)::bigint], ' ') as line from p),
y as (select lang, line, trim(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') as key from l)
select lang, min(line) as line, length(min(line)) as len, key, array_to_string(string_split(key, ' ')[1:2], ' ') as stem from y where key <> '' group by lang, key""")
def line_bank(spark, d):
    lines = docs(spark, d).select("lang", F.explode(text.phrases(F.col("text"))).alias("line")).withColumn("key", dedup.normal_key(F.col("line"))).filter("key <> ''")
    return dedup.keep_first(lines, ["lang", "key"], ["line"]).select("lang", "line", F.length("line").alias("len"), "key", text.stem(F.col("key")).alias("stem"))


@query("snippet_and_type", r"""
with w as (select doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from documents), k as (select *, least(greatest(len(w) // 10, 30), 100) as k from w)
select doc_id, case when len(w) >= 30 then md5(array_to_string(w[len(w) // 2 - k // 2 + 1 : len(w) // 2 - k // 2 + k], ' ')) end as snip,
       case when len(regexp_extract_all(text, '\p{L}+')) < 30 then null when len(regexp_extract_all(text, '_{4,}|\.{6,}')) >= 6 then 'forms' when len(string_split(text, chr(10))) >= 40 then 'tables' else 'text' end as kind from k""")
def snippet_and_type(spark, d):
    t = F.col("text")
    return docs(spark, d).select("doc_id", F.md5(text.snippet(t)).alias("snip"), text.page_type(t, F.lit(0), F.size(F.split(t, "\n"))).alias("kind"))
