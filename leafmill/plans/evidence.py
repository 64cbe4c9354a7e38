"""Evidence, review and planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import text
from leafmill.operators import evidence as e
from leafmill.operators import lifecycle
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}


def query(name, sql):
    def put(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return put


@query("first_failed_check", "select doc_id, case when n_chars < 100 then 'short' when lang not in ('en', 'de') then 'language' when source like 'src1%' then 'source' end as reason from documents")
def first_failed_check(spark, d):
    c = F.col
    return read(spark, d, "documents").select("doc_id", e.first_reason((c("n_chars") < 100, "short"), (~c("lang").isin("en", "de"), "language"), (c("source").like("src1%"), "source")).alias("reason"))


@query("carried_scope", """
select doc_id, (case when doc_id >= 500 then n_chars > 300 else n_chars > 300 and coalesce(l.quality = 1, false) end) and not coalesce(l.toxic = 1, false) as scope
from documents d left join labels l using (doc_id) where source in (select distinct source from documents where lang = 'de')""")
def carried_scope(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    live = docs.join(docs.filter("lang = 'de'").select("source").distinct(), "source", "left_semi")
    out = e.carried_scope(docs, labels.select("doc_id", (F.col("quality") == 1).alias("scope")), "doc_id", F.col("n_chars") > 300, labels.filter("toxic = 1"), live, 500)
    return out.select("doc_id", "scope")


@query("checked_three_grains", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey, l_linenumber) in (select o_orderkey, 1 from orders where o_orderstatus = 'F') or l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT') or l_returnflag in ('A') as checked from lineitem""")
def checked_three_grains(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderpriority")
    pages = o.filter("o_orderstatus = 'F'").select("l_orderkey", F.lit(1).alias("l_linenumber"))
    out = e.checked_at_three_grains(read(spark, d, "lineitem"), pages, o.filter("o_orderpriority = '1-URGENT'"), ["l_orderkey", "l_linenumber"], "l_orderkey", F.concat("l_returnflag", F.lit("/x")), ["A"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "checked")


@query("identity_cascade", """
with t as (select md5(text) as k, min(doc_id) as first from documents group by 1), s as (select source as k, min(doc_id) as first from documents where lang = 'fr' group by 1)
select d.doc_id, coalesce(case when d.lang = 'en' then t.first end, s.first) as target from documents d left join t on t.k = md5(d.text) left join s on s.k = d.source""")
def identity_cascade(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "lang", "source", F.md5("text").alias("k"))
    by_text = docs.groupBy("k").agg(F.min("doc_id").alias("first"))
    by_source = docs.filter("lang = 'fr'").groupBy("source").agg(F.min("doc_id").alias("first"))
    asked = docs.withColumn("k", F.when(F.col("lang") == "en", F.col("k")))
    return e.resolve(asked, [(by_text, "k", "first"), (by_source, "source", "first")], "target").select("doc_id", "target")


BOX = "select (p_partkey % 50)::bigint as page, p_partkey as id, (p_size * 3)::double as x0, p_size::double as y0, (p_size * 3 + 10)::double as x1, (p_size + 4)::double as y1, case when p_partkey % 2 = 0 then 'a' else 'b' end as source from part"


@query("box_recall", f"""
with t as ({BOX}), f as (select page, id, x0 + id % 7 as x0, y0, x1 + id % 7 as x1, y1, source from t),
m as (select t.page, t.id, f.id as fid, f.source, greatest(least(t.x1, f.x1) - greatest(t.x0, f.x0), 0) * greatest(least(t.y1, f.y1) - greatest(t.y0, f.y0), 0) / ((t.x1 - t.x0) * (t.y1 - t.y0)) as s from t join f using (page))
select source, (select count(*) from t) as boxes, (select count(distinct (page, id)) from m where m.source = f.source and s > 0.5) as hit, count(*) as found,
       count(*) - (select count(distinct (page, fid)) from m where m.source = f.source and s > 0) as off_target from f group by source""")
def box_recall(spark, d):
    p = read(spark, d, "part")
    num = lambda x: x.cast("double")
    size = F.col("p_size")
    t = p.select((F.col("p_partkey") % 50).alias("page"), F.col("p_partkey").alias("id"), num(size * 3).alias("x0"), num(size).alias("y0"), num(size * 3 + 10).alias("x1"), num(size + 4).alias("y1"), F.when(F.col("p_partkey") % 2 == 0, "a").otherwise("b").alias("source"))
    shift = F.col("id") % 7
    found = t.select("page", "id", (F.col("x0") + shift).alias("x0"), "y0", (F.col("x1") + shift).alias("x1"), "y1", "source")
    return e.box_match(t.drop("source"), found, "page")


@query("best_page_in_window", """
with g as (select distinct o_custkey as k, o_custkey % 20 as guess from orders), c as (select o_custkey as k, o_orderkey % 40 as page, max(o_totalprice) as score from orders group by 1, 2),
m as (select * from g join c using (k) where page between guess - 4 and guess + 4 or page in (0, 1, 2))
select k, page, score from (select *, row_number() over (partition by k order by score desc, page desc) as r from m) where r = 1""")
def best_page_in_window(spark, d):
    from leafmill.operators.joins import best_in_window

    o = read(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 40).alias("page"), F.col("o_totalprice").alias("score"))
    guess = o.select("k", (F.col("k") % 20).alias("guess")).distinct()
    return best_in_window(guess, o.groupBy("k", "page").agg(F.max("score").alias("score")), ["k"], "guess", "page", "score").select("k", "page", "score")


@query("vote_consensus", "with c as (select user_id, event_type, count(*) as n, sum(count(*)) over (partition by user_id) as t from events group by 1, 2) select user_id, event_type, n as votes from c where n >= 3 and n >= 0.25::double * t")
def vote_consensus(spark, d):
    return e.consensus(read(spark, d, "events"), ["user_id"], "event_type", 3, 0.25)


@query("hand_agreement", """
select l_returnflag as flag, avg((a.v = b.v)::int::double) as share, count(*) as n
from (select l_orderkey as k, min(l_returnflag) as l_returnflag, max(l_linenumber) as v from lineitem group by 1) a join (select o_orderkey as k, o_orderkey % 7 + 1 as v from orders where o_orderstatus <> 'P') b using (k) group by 1""")
def hand_agreement(spark, d):
    a = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_returnflag").alias("flag"), F.max("l_linenumber").cast("long").alias("v"))
    b = read(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 7 + 1).alias("v"))
    return e.agreement(a, b, ["k"], "v", ["flag"])


@query("first_acceptable_candidate", "select o_custkey, o_orderkey, o_orderpriority from (select *, row_number() over (partition by o_custkey order by o_orderpriority, o_orderkey) as r from orders where o_totalprice > 50000) where r = 1")
def first_acceptable_candidate(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice")
    return e.first_acceptable(o, "o_custkey", "o_orderpriority", "o_orderkey", F.col("o_totalprice") > 50000).drop("o_totalprice")


@query("weighted_accuracy", """
with p as (select source, lang as t, case when doc_id % 9 = 0 then 'en' else lang end as f, 1.0::double + n_chars % 5 as w from documents)
select source, avg((t = f)::int::double) as accuracy, round(sum(w * (t = f)::int) / sum(w), 9) as weighted, count(*) as n from p group by 1""")
def weighted_accuracy(spark, d):
    p = read(spark, d, "documents").withColumn("f", F.when(F.col("doc_id") % 9 == 0, "en").otherwise(F.col("lang")))
    return e.weighted_accuracy(p, "lang", "f", 1.0 + F.col("n_chars") % 5, "source").withColumn("weighted", F.round("weighted", 9))


@query("median_sentence_threshold", r"with s as (select lang, unnest(regexp_split_to_array(text, '[.!?]+')) as s from documents) select lang, quantile_cont(length(s), 0.5) * 3 as least from s where length(s) > 0 group by lang")
def median_sentence_threshold(spark, d):
    s = read(spark, d, "documents").select("lang", F.explode(F.split("text", r"[.!?]+")).alias("s")).filter(F.length("s") > 0)
    return e.median_threshold(s, "lang", F.length("s"), 3.0)


@query("deficit_retrieval", """
with c as (select distinct l_partkey % 5 as cls, l_orderkey as doc, l_extendedprice as score from lineitem where l_extendedprice >= 20000),
b as (select * from (select *, row_number() over (partition by doc order by score desc, cls) as r from c) where r = 1)
select cls, doc, score from (select *, row_number() over (partition by cls order by score desc, doc) as p from b) where p <= 3 * 20""")
def deficit_retrieval(spark, d):
    c = read(spark, d, "lineitem").select((F.col("l_partkey") % 5).alias("cls"), F.col("l_orderkey").alias("doc"), F.col("l_extendedprice").alias("score"), F.lit(20).alias("need"))
    return e.capped_retrieval(c, ["cls"], "doc", "score", "need", 20000.0, 3).drop("need")


@query("descending_threshold_quota", """
with recursive g as (select lang, count(*) filter (n_chars >= 4000) as hi, count(*) filter (n_chars >= 2000) as mid, count(*) as lo from documents group by 1),
q as (select *, 230 // count(*) over () + (row_number() over (order by hi desc, lang) <= 230 % count(*) over ())::int as quota from g),
p0 as (select *, least(quota, hi) as p from q),
l1 as (select max(l) as l from (select unnest(range(0, 231)) as l) x where (select sum(greatest(p, least(greatest(mid, p), x.l))) from p0) <= 230),
p1 as (select p0.* exclude (p), greatest(p, least(greatest(mid, p), coalesce(l, 0))) as p from p0, l1),
l2 as (select max(l) as l from (select unnest(range(0, 231)) as l) x where (select sum(greatest(p, least(greatest(lo, p), x.l))) from p1) <= 230)
select lang, cast(quota as bigint) as quota, cast(greatest(p, least(greatest(lo, p), coalesce(l, 0))) as bigint) as picked from p1, l2""")
def descending_threshold_quota(spark, d):
    n = F.col("n_chars")
    g = read(spark, d, "documents").groupBy("lang").agg(F.count_if(n >= 4000).alias("hi"), F.count_if(n >= 2000).alias("mid"), F.count("*").alias("lo"))
    return e.descending_floors(g, "lang", ["hi", "mid", "lo"], 230).select("lang", F.col("quota").cast("long").alias("quota"), "picked")


@query("sourcing_plan", """
with need as (select lang as target, source, 3000 as missing from (select distinct lang, source from documents)), p as (select source, doc_id, n_chars, row_number() over (partition by source order by doc_id) as t from documents),
m as (select target, n.source, doc_id, n_chars, missing, coalesce(sum(n_chars) over (partition by target order by t, n.source rows between unbounded preceding and 1 preceding), 0) as b from need n join p using (source))
select target, source, doc_id from m where b < missing * 1.2::double""")
def sourcing_plan(spark, d):
    docs = read(spark, d, "documents")
    need = docs.select(F.col("lang").alias("target"), "source").distinct().withColumn("missing", F.lit(3000))
    return e.sourcing_plan(need, docs.select("source", "doc_id", "n_chars"), "target", "source", "doc_id", "n_chars").select("target", "source", "doc_id")


@query("weight_batches", "select o_custkey, o_orderkey, cast((row_number() over (partition by o_custkey order by o_orderkey) - 1) // 4 as bigint) as batch from orders")
def weight_batches(spark, d):
    return e.weight_batches(read(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_orderkey"], ["o_custkey"], 50, 180)


@query("group_mean_vector", "with x as (select label, unnest(embedding)::double as v, unnest(range(64)) as i from embeddings), m as (select label, i, avg(v) as m from x group by 1, 2) select label, round(sum(m * m), 9) as squared_length, round(sum(m * (i + 1)), 9) as checksum from m group by label")
def group_mean_vector(spark, d):
    m = e.mean_vector(read(spark, d, "embeddings"), ["label"], "embedding")
    total = lambda f: F.round(F.aggregate(F.transform("mean", f), F.lit(0.0), lambda a, x: a + x), 9)
    return m.select("label", total(lambda x: x * x).alias("squared_length"), total(lambda x, i: x * (i + 1)).alias("checksum"))


@query("label_rules", """
with k as (select doc_id, quality + toxic as cls, case when doc_id % 3 = 0 then 'filled' when doc_id % 3 = 1 then 'blank' else 'music' end as kind from labels),
a as (select *, case when kind = 'filled' and cls = 0 then 'blank' else kind end as k1 from k), b as (select *, case when k1 = 'blank' and cls >= 1 then 'filled' else k1 end as k2 from a)
select doc_id, case when cls = 2 and k2 not in ('filled', 'music') then 'handwritten' else k2 end as kind from b""")
def label_rules(spark, d):
    kind = F.when(F.col("doc_id") % 3 == 0, "filled").when(F.col("doc_id") % 3 == 1, "blank").otherwise("music")
    return read(spark, d, "labels").select("doc_id", e.label_rules(kind, F.col("quality") + F.col("toxic")).alias("kind"))


@query("conversation_passages", """
with b as (select conv_id, turn, text, length(text) as n, coalesce(sum(length(text)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) // 600 as passage from conversations)
select conv_id, cast(passage as bigint) as passage, cast(sum(n) as bigint) as size, md5(string_agg(text, chr(10) order by turn)) as digest from b group by 1, 2""")
def conversation_passages(spark, d):
    c = read(spark, d, "conversations").select("conv_id", "turn", "text", F.length("text").cast("long").alias("n"))
    return e.passages(c, "conv_id", "turn", "n", "text", 600).select("conv_id", "passage", "size", F.md5("text").alias("digest"))


@query("field_kinds", r"""
select event_id, case when regexp_matches(x, '\b(date|birth|expir|issued)') then 'date' when regexp_matches(x, '\b(amount|price|total|fee|income|salary)') then 'money' when regexp_matches(x, '\bname\b') then 'name' else 'line' end as kind
from (select event_id, lower(['Date of birth', 'Total due', 'Family name', 'Remarks'][event_id % 4 + 1]) as x from events)""")
def field_kinds(spark, d):
    label = F.element_at(F.array(*[F.lit(x) for x in ("Date of birth", "Total due", "Family name", "Remarks")]), (F.col("event_id") % 4 + 1).cast("int"))
    return read(spark, d, "events").select("event_id", text.field_kind(label).alias("kind"))


@query("file_name_parts", r"""
with p as (select doc_id, source || '/' || case when doc_id % 4 = 0 then 'x' else 'doc_' || lang || '_' || substr(sha256(text), 1, 12) end || '.pdf' as path from documents)
select doc_id, split_part(path, '/', 1) as topic, case when doc_id % 4 = 0 then 'unknown' else regexp_extract(path, '_([a-z]{2})_', 1) end as language, case when doc_id % 4 = 0 then 'unknown' else regexp_extract(path, '_([0-9a-f]{12})\.pdf$', 1) end as hash from p""")
def file_name_parts(spark, d):
    name = F.when(F.col("doc_id") % 4 == 0, "x").otherwise(F.concat(F.lit("doc_"), "lang", F.lit("_"), F.substring(F.sha2("text", 256), 1, 12)))
    return read(spark, d, "documents").select("doc_id", text.name_parts(F.concat("source", F.lit("/"), name, F.lit(".pdf"))).alias("p")).select("doc_id", "p.topic", "p.language", "p.hash")


@query("tagged_recovery", r"""
with a as (select conv_id, turn, text, turn % 3 as lost from conversations)
select conv_id, turn, case when lost <= 1 then [case when lost = 1 then null else substr(upper(role), 1, 3) end, 'b'] end as texts from (select a.*, c.role from a join conversations c using (conv_id, turn))""")
def tagged_recovery(spark, d):
    c = read(spark, d, "conversations")
    lost = F.col("turn") % 3
    answer = F.concat(F.when(lost == 0, F.concat(F.lit("<p id=\"1\"> "), F.substring(F.upper("role"), 1, 3), F.lit(" </p>\n"))).otherwise(""), F.when(lost <= 1, "<P ID='2'>b<p id=\"9\">").otherwise("nothing"))
    return c.select("conv_id", "turn", text.recovered(answer, F.lit(2)).alias("texts"))


@query("claim_with_lease", "select event_id from events where user_id <> 1 and not (user_id % 2 = 0 and ts > timestamp '2024-01-30 23:57:12' - interval 120 seconds)")
def claim_with_lease(spark, d):
    ev = read(spark, d, "events").select("event_id", "user_id", F.col("ts").alias("claimed_at"))
    claims = ev.filter("user_id % 2 = 0")
    return lifecycle.claimable(ev.select("event_id"), ev.filter("user_id = 1"), claims, "event_id", F.lit("2024-01-30 23:57:12").cast("timestamp_ntz"))


@query("join_confusion", "with o as (select c_custkey, c_acctbal from customer), n as (select c_custkey, case when c_custkey % 9 = 0 then c_acctbal + 1 else c_acctbal + 0.001 end as c_acctbal from customer) select count(*) as n, avg((abs(o.c_acctbal - n.c_acctbal) <= 0.01)::int::double) as equal_share from o join n using (c_custkey)")
def join_confusion(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_acctbal")
    n = c.select("c_custkey", F.when(F.col("c_custkey") % 9 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal") + F.lit(0.001)).alias("b"))
    return c.join(n, "c_custkey").agg(F.count("*").alias("n"), F.avg((F.abs(F.col("c_acctbal") - F.col("b")) <= 0.01).cast("double")).alias("equal_share"))


@query("describe_quantiles", "select lang, count(*) as n, round(avg(n_chars), 6) as mean, round(stddev_samp(n_chars), 6) as std, round(quantile_cont(n_chars, 0.25), 6) as p25, round(quantile_cont(n_chars, 0.5), 6) as p50, round(quantile_cont(n_chars, 0.999), 6) as p999, count(distinct source) as sources from documents group by lang")
def describe_quantiles(spark, d):
    n = F.col("n_chars")
    q = lambda p: F.round(F.percentile(n, F.lit(p)), 6)
    return read(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(n), 6).alias("mean"), F.round(F.stddev_samp(n), 6).alias("std"), q(0.25).alias("p25"), q(0.5).alias("p50"), q(0.999).alias("p999"), F.countDistinct("source").alias("sources"))


@query("key_set_algebra", "select 'both' as part, doc_id from documents where doc_id in (select doc_id from labels) union all select 'unlabelled', doc_id from documents where doc_id not in (select doc_id from labels) union all select 'orphan', doc_id from labels where doc_id not in (select doc_id from documents)")
def key_set_algebra(spark, d):
    a, b = read(spark, d, "documents").select("doc_id"), read(spark, d, "labels").select("doc_id")
    return a.intersect(b).select(F.lit("both").alias("part"), "doc_id").unionAll(a.subtract(b).select(F.lit("unlabelled"), "doc_id")).unionAll(b.subtract(a).select(F.lit("orphan"), "doc_id"))
