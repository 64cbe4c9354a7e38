"""Text gates, character models, pools, plans and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.functions import language, text, urls
from leafmill.operators import dedup, records
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}
WORDS = r"'[^ \t\n\r\f\v]+'"
OTHER = r"[\p{Cyrillic}\p{Greek}\p{Arabic}\p{Hebrew}\p{Devanagari}\p{Bengali}\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Thai}]"
SCRIPT = rf"case when len(regexp_extract_all(line, '\p{{Latin}}')) + len(regexp_extract_all(line, '{OTHER}')) = 0 then 'none' when len(regexp_extract_all(line, '\p{{Latin}}')) >= 0.97::double * (len(regexp_extract_all(line, '\p{{Latin}}')) + len(regexp_extract_all(line, '{OTHER}'))) then 'Latin' else 'mixed' end"
LINES = f"select doc_id, lang, line, {SCRIPT} as script from (select doc_id, lang, trim(unnest(string_split(text, chr(10))), ' ') as line from documents) where length(line) between 20 and 120"


def query(name, sql):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def docs(spark, d):
    return read(spark, d, "documents")


def lines(spark, d):
    rows = docs(spark, d).select("doc_id", "lang", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line")).filter(F.length("line").between(20, 120))
    return rows.withColumn("script", text.script(F.col("line")))


@query("clean_text_gate", rf"""
with lex as (select distinct unnest(regexp_extract_all(lower(text), '\p{{L}}+')) as w from documents join labels using (doc_id) where quality = 1),
w as (select doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) as w from documents), k as (select doc_id, avg((lex.w is not null)::int) as share from w left join lex using (w) group by doc_id),
t as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {WORDS}) as ws, len(regexp_extract_all(coalesce(text, ''), '\p{{L}}')) as n from documents)
select doc_id, case when regexp_matches(t, 'Ã.|â€|Ð.Ð|Ø.Ù|Â[ -¿]') then 'mojibake' when regexp_matches(t, '[\x00-\x08\x0B-\x1F\x{{80}}-\x{{9F}}\x{{FFFD}}\x{{E000}}-\x{{F8FF}}]') then 'control'
  when len(list_filter(ws, lambda w: regexp_matches(w, '^\p{{M}}') or regexp_matches(w, '^[\x{{600}}-\x{{6FF}}\x{{900}}-\x{{DFF}}]$'))) > 0.04::double * len(ws) then 'split'
  when share < case when len(ws) >= 6 then 0.9::double else 0.5::double end then 'unknown' when n = 0 then 'empty' when (n - len(regexp_extract_all(t, '\p{{Latin}}')))::double / n > 0.1::double then 'foreign' end as reason
from t left join k using (doc_id)""")
def clean_text_gate(spark, d):
    good = docs(spark, d).join(read(spark, d, "labels").filter("quality = 1"), "doc_id")
    lex = good.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w"))
    return language.clean_gate(docs(spark, d), "doc_id", "text", lex, "w")


@query("trigram_mean_score", r"""
with l as (select doc_id, lang, '^^' || unnest(string_split(text, chr(10))) || '$' as l from documents), g as (select doc_id, lang, unnest(list_transform(range(1, length(l) - 1), lambda i: substr(l, i, 3))) as gram from l),
m as materialized (select doc_id, lang, gram, count(*) as n from g group by all), c3 as materialized (select lang, gram, sum(n) as n from m group by all), c2 as materialized (select lang, gram[2:3] as gram, sum(n) as n from c3 group by all), c1 as materialized (select lang, gram[3:3] as gram, sum(n) as n from c3 group by all),
h3 as materialized (select lang, gram[1:2] as h, sum(n) as a, count(*) as k from c3 group by all), h2 as materialized (select lang, gram[1:1] as h, sum(n) as a, count(*) as k from c2 group by all), h1 as materialized (select lang, sum(n) as a, count(*) as k from c1 group by all),
k as materialized (select lang, gram, n, gram[3:3] as c, gram[2:2] as b, gram[2:3] as bc, gram[1:2] as ab from c3),
x1 as materialized (select k.*, h1.a as a1, h1.k as k1 from k join h1 using (lang)), x2 as materialized (select x1.*, c1.n as n1 from x1 join c1 on c1.lang = x1.lang and c1.gram = x1.c),
x3 as materialized (select x2.*, c2.n as n2 from x2 join c2 on c2.lang = x2.lang and c2.gram = x2.bc), x4 as materialized (select x3.*, h2.a as a2, h2.k as k2 from x3 join h2 on h2.lang = x3.lang and h2.h = x3.b),
x5 as materialized (select x4.*, h3.a as a3, h3.k as k3 from x4 join h3 on h3.lang = x4.lang and h3.h = x4.ab),
p as materialized (select lang, gram, a1 / (a1 + k1)::double * n1 / a1 + k1 / (a1 + k1)::double / (k1 + 1) as p1, a2 / (a2 + k2)::double as l2, n2 / a2::double as q2, a3 / (a3 + k3)::double as l3, n / a3::double as q3 from x5)
select doc_id, round(sum(n * ln(l3 * q3 + (1 - l3) * (l2 * q2 + (1 - l2) * p1))) / sum(n), 6) as mean from m join p using (lang, gram) group by doc_id""")
def trigram_mean_score(spark, d):
    model = language.TrigramModel(docs(spark, d), "text", "lang")
    return model.score(docs(spark, d), "doc_id", "text", "lang").select("doc_id", F.round("mean", 6).alias("mean"))


@query("ill_formed_words", rf"""
with w as (select doc_id, regexp_extract_all(text, {WORDS}) as ws from documents)
select doc_id, round(len(list_filter(ws, lambda w: regexp_matches(w, '^\p{{M}}|[\p{{Cn}}\p{{Co}}\p{{Cs}}]') or (regexp_matches(w, '\p{{Latin}}')::int + regexp_matches(w, '\p{{Cyrillic}}')::int + regexp_matches(w, '\p{{Greek}}')::int + regexp_matches(w, '\p{{Arabic}}')::int + regexp_matches(w, '\p{{Hebrew}}')::int + regexp_matches(w, '\p{{Devanagari}}')::int + regexp_matches(w, '\p{{Bengali}}')::int + regexp_matches(w, '\p{{Hangul}}')::int + regexp_matches(w, '\p{{Thai}}')::int + regexp_matches(w, '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]')::int) > 1))::double / nullif(len(ws), 0), 9) as share from w""".replace(r"[\p{Cn}\p{Co}\p{Cs}]", r"\p{Co}"))
def ill_formed_words(spark, d):
    return docs(spark, d).select("doc_id", F.round(language.ill_formed_share(F.col("text")), 9).alias("share"))


@query("prose_lines", rf"""
with l as ({LINES}), f as (select * from l where not regexp_matches(line, '{language.CITATION}')),
r as (select *, row_number() over (partition by lang order by doc_id, line) as r from f), v as (select lang, script, count(*) as n from r where r <= 200 group by all), t as (select lang, first(script order by n desc, script) as script from v group by lang)
select lang, script, count(*) as n, min(line) as least from f join t using (lang, script) group by all""")
def prose_lines(spark, d):
    kept = language.prose_lines(lines(spark, d), "lang", "line", "script", "doc_id")
    return kept.groupBy("lang", "script").agg(F.count("*").alias("n"), F.min("line").alias("least"))


@query("line_pools", rf"""
with l as ({LINES}), f as (select * from l where not regexp_matches(line, '{language.CITATION}')),
r as (select *, row_number() over (partition by lang order by doc_id, line) as r from f), v as (select lang, script, count(*) as n from r where r <= 200 group by all), t as (select lang, first(script order by n desc, script) as script from v group by lang),
s as (select f.* from f join t using (lang, script) where len(regexp_extract_all(line, '\p{{L}}'))::double / nullif(len(regexp_extract_all(line, '[^ \t\n\r\f\v]')), 0) >= 0.7::double),
k as (select *, count(*) over (partition by lang) as n, row_number() over (partition by lang order by doc_id, line) as q from s), m as (select * from k where n >= 20 and q <= 300),
x as (select *, row_number() over (partition by script order by md5(lang || '|' || line), lang, line) as z from m)
select pool, lang, count(*) as n, max(md5(line)) as last from (select lang as pool, lang, line from m union all select 'script:' || script, lang, line from x where z <= 300) group by all""")
def line_pools(spark, d):
    found = language.pools(lines(spark, d), "lang", "line", "script", "doc_id", 20, 300)
    return found.groupBy("pool", "lang").agg(F.count("*").alias("n"), F.max(F.md5("line")).alias("last"))


@query("translation_garbled", r"""
with p as (select a.conv_id, a.turn, len(regexp_extract_all(a.text, '\p{L}+')) as n, case when b.text is not null then len(regexp_extract_all(b.text, '\p{L}+')) end as m from conversations a left join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1 and b.role = 'assistant' where a.role = 'user')
select conv_id, turn, case when coalesce(n, 0) = 0 then true when m is not null then not (m::double / n between 0.5::double and 2.0::double) end as garbled from p""")
def translation_garbled(spark, d):
    c = read(spark, d, "conversations")
    answers = c.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    met = c.filter("role = 'user'").join(answers, ["conv_id", "turn"], "left")
    return met.select("conv_id", "turn", language.garbled(F.col("text"), F.col("answer")).alias("garbled"))


@query("language_buckets", """
with a(lang, script, bucket) as (values ('en', 'Latin', 'germanic'), ('fr', 'mixed', 'other')), b(lang, bucket) as (values ('de', 'germanic'), ('fr', 'romance'))
select doc_id, coalesce(a.bucket, b.bucket, d.lang) as bucket from (select doc_id, lang, case when doc_id % 2 = 0 then 'Latin' else 'mixed' end as script from documents) d left join a on a.lang = d.lang and a.script = d.script left join b on b.lang = d.lang""")
def language_buckets(spark, d):
    a = spark.createDataFrame([("en", "Latin", "germanic"), ("fr", "mixed", "other")], "lang string, script string, bucket string")
    b = spark.createDataFrame([("de", "germanic"), ("fr", "romance")], "lang string, bucket string")
    rows = docs(spark, d).select("doc_id", "lang", F.when(F.col("doc_id") % 2 == 0, "Latin").otherwise("mixed").alias("script"))
    return language.bucket_of(rows, "lang", "script", a, b).select("doc_id", "bucket")


@query("usable_passages", r"""
with l as (select doc_id, text, lang, source, n_chars, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: length(x) > 12) as ls from documents),
k as (select l.*, case when source in ('src0', 'src1') then source when quality = 1 then 'prose' end as kind from l left join labels using (doc_id))
select doc_id, kind, kind is not null and n_chars >= 200 and lang is not null
  and not coalesce((len(ls) - len(list_distinct(ls)))::double / nullif(len(ls), 0) > 0.05::double, false)
  and not coalesce(len(regexp_extract_all(text, '\p{Nd}'))::double / nullif(len(regexp_extract_all(text, '[\p{L}\p{Nd}]')), 0) > 0.3::double, false) as usable from k""")
def usable_passages(spark, d):
    """Documents with a language, enough text and a kind (by folder, else by label) that repeat no lines and are no table of numbers."""
    rows = docs(spark, d).join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    kind = F.when(F.col("source").isin("src0", "src1"), F.col("source")).when(F.col("quality") == 1, "prose")
    fine = kind.isNotNull() & (F.col("n_chars") >= 200) & F.col("lang").isNotNull() & (dedup.repeated_line_rule(F.col("text")) == "ok")
    return rows.select("doc_id", kind.alias("kind"), fine.alias("usable"))


NAMES = (("Ana", "Bo", "Chi", "Dov", "Eli", "Fay", "Gus"), ("Abel", "Brook", "Cole", "Dunn", "Ewe"), ("example.com", "example.org", "example.net"))


@query("field_values", f"""
with m as (select c_custkey, md5(c_custkey::varchar) as h from customer), n as (select c_custkey, ('0x' || h[1:8])::bigint as a, ('0x' || h[9:16])::bigint as b, ('0x' || h[17:24])::bigint as c, ('0x' || h[25:32])::bigint as e from m),
p as (select *, {list(NAMES[0])}[a % 7 + 1] || ' ' || {list(NAMES[1])}[b % 5 + 1] as person from n)
select c_custkey, person, lower(replace(person, ' ', '.')) || '.' || c_custkey || '@' || {list(NAMES[2])}[c % 3 + 1] as e_mail, cast(date '2000-01-01' + cast(e % 9000 as integer) as date) as day from p""")
def field_values(spark, d):
    rows = read(spark, d, "customer").select("c_custkey")
    return records.field_values(rows, F.col("c_custkey"), *NAMES, 9000)


@query("line_pick", None)
def line_pick(spark, d):
    """Lines for made-up forms of four fields, one form for each customer, of all lines of the documents."""
    bank = lines(spark, d).select("lang", "line").distinct().withColumn("key", dedup.normal_key(F.col("line"))).withColumn("stem", text.stem(F.col("key")))
    short = dedup.keep_first(bank, ["lang", "key"], ["line"])
    forms = read(spark, d, "customer").select(F.col("c_custkey").alias("form"), F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit("fr"), F.lit("es")), (F.col("c_custkey") % 4 + 1).cast("int")).alias("lang"))
    fields = forms.withColumn("field", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn("cap", 40 + 25 * F.col("field"))
    return records.pick_lines(fields, short)


@query("wide_inventory", """
with f as (select lang, count(*) filter (source = 'src0') as src0_files, count(*) filter (source = 'src1') as src1_files, coalesce(sum(n_chars) filter (source = 'src0'), 0) as src0_pages, coalesce(sum(n_chars) filter (source = 'src1'), 0) as src1_pages from documents group by lang),
t as (select lang, count(*) filter (n_chars >= 2000) as long_texts, count(*) filter (n_chars < 2000) as short_texts from documents group by lang), q(lang, quota) as (values ('en', 40), ('de', 10), ('pt', 5)),
w as (select lang, coalesce(src0_files, 0) as src0_files, coalesce(src1_files, 0) as src1_files, coalesce(src0_pages, 0) as src0_pages, coalesce(src1_pages, 0) as src1_pages, coalesce(long_texts, 0) as long_texts, coalesce(short_texts, 0) as short_texts, coalesce(quota, 0) as quota from f full join t using (lang) full join q using (lang))
select *, least(long_texts, short_texts) as fields, array_to_string(list_filter([case when quota > 0 and src0_files = 0 then 'no src0' end, case when quota > 0 and src1_files = 0 then 'no src1' end, case when least(long_texts, short_texts) < 20 then 'few texts' end], lambda g: g is not null), ', ') as gaps from w""")
def wide_inventory(spark, d):
    quotas = spark.createDataFrame([("en", 40), ("de", 10), ("pt", 5)], "lang string, quota int")
    texts = docs(spark, d).groupBy("lang").agg(F.count_if(F.col("n_chars") >= 2000).alias("long_texts"), F.count_if(F.col("n_chars") < 2000).alias("short_texts"))
    return records.inventory(docs(spark, d), "lang", "source", ("src0", "src1"), "n_chars", texts, ("long_texts", "short_texts"), quotas, 20)


SHARES = {"text": 0.4, "table": 0.2, "form": 0.15, "handwritten": 0.15, "filled": 0.1}


@query("class_type_plan", """
with l as (select n_regionkey as class, n_name as lang, n_nationkey % 3 <> 0 as writable, greatest(15, 300 // count(*) over (partition by n_regionkey)) as per from nation),
s(type, share, hand) as (values ('text', 0.4::double, false), ('table', 0.2::double, false), ('form', 0.15::double, false), ('handwritten', 0.15::double, true), ('filled', 0.1::double, true)),
o as (select class, lang, type, case when writable then share when hand then 0 else share / (1 - (0.15::double + 0.1::double)) end as own, per from l cross join s),
q as (select class, lang, type, case when own > 0 then greatest(3, round_even(own * per, 0)::bigint) else 0 end as quota from o),
r as (select n_name as lang, case when p_size % 2 = 0 then 'text' else 'table' end as type, p_partkey as id, p_size % 5 = 0 as scan from part join nation on n_nationkey = p_partkey % 25 where p_partkey % 25 <> 7),
u as (select *, max((not scan)::int) over (partition by lang, type) as digital from r), k as (select lang, type, count(*) as n from u where (digital = 1 and not scan) or (digital = 0 and type = 'text') group by all),
f as (select q.*, least(coalesce(n, 0), floor(quota * 0.5::double))::bigint as real from q left join k using (lang, type)),
v as (select *, case when quota - real >= 5 then round_even(0.2::double * (quota - real), 0)::bigint when quota - real >= 3 then 1 else 0 end as val from f)
select lang, type, class, quota, real, val, quota - real - val as train from v""")
def class_type_plan(spark, d):
    n = read(spark, d, "nation")
    plan = records.class_type_plan(n.select(F.col("n_regionkey").alias("class"), F.col("n_name").alias("lang"), (F.col("n_nationkey") % 3 != 0).alias("writable")), SHARES, ("handwritten", "filled"))
    named = n.select((F.col("n_nationkey")).alias("k"), F.col("n_name").alias("lang"))
    real = read(spark, d, "part").filter("p_partkey % 25 != 7").join(named, F.col("p_partkey") % 25 == F.col("k"))
    real = real.select("lang", F.when(F.col("p_size") % 2 == 0, "text").otherwise("table").alias("type"), F.col("p_partkey").alias("id"), (F.col("p_size") % 5 == 0).alias("scan"))
    return records.filled_plan(plan, real, ("text",))


@query("search_until_met", """
with f as (select distinct l_suppkey as file, l_suppkey % 4 as rank from lineitem), p as (select *, (row_number() over (order by rank, file) - 1) // 10 as chunk from f), n(l_returnflag, need) as (values ('A', 30), ('R', 25)),
w as (select l_orderkey, l_linenumber, l_returnflag, file, rank, chunk, need from lineitem join p on file = l_suppkey join n using (l_returnflag)),
c as (select * from (select *, row_number() over (partition by file, l_returnflag order by l_orderkey, l_linenumber) as r from w) where r <= 2),
k as (select * from (select *, row_number() over (partition by l_returnflag order by chunk, rank, file, l_orderkey, l_linenumber) as k from c) where k <= need),
e as (select case when count(*) filter (x.chunk is null) = 0 then max(x.chunk) end as stop from n left join (select l_returnflag, chunk from k where k = need) x using (l_returnflag))
select l_orderkey, l_linenumber, l_returnflag, file, rank, chunk from k, e where stop is null or chunk <= stop""")
def search_until_met(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_suppkey").alias("file"), (F.col("l_suppkey") % 4).alias("rank"))
    needs = spark.createDataFrame([("A", 30), ("R", 25)], "l_returnflag string, need int")
    return records.search_until(rows, needs, "l_returnflag", "file", ["l_orderkey", "l_linenumber"], "rank").select("l_orderkey", "l_linenumber", "l_returnflag", "file", "rank", "chunk")


@query("edit_distance", "with r as (select p_partkey, p_name, lag(p_name) over (partition by p_brand order by p_partkey) as b from part) select p_partkey, levenshtein(p_name, b) as distance, round(1 - levenshtein(p_name, b)::double / greatest(length(p_name), length(b)), 9) as ratio from r where b is not null")
def edit_distance(spark, d):
    from pyspark.sql import Window

    r = read(spark, d, "part").select("p_partkey", "p_name", F.lag("p_name").over(Window.partitionBy("p_brand").orderBy("p_partkey")).alias("b")).filter("b is not null")
    far = F.levenshtein("p_name", "b")
    return r.select("p_partkey", far.alias("distance"), F.round(1 - far / F.greatest(F.length("p_name"), F.length("b")), 9).alias("ratio"))


@query("aligned_turns", None)
def aligned_turns(spark, d):
    """Lines of each answer against the lines of the whole conversation's first answer."""
    c = read(spark, d, "conversations").filter("role = 'assistant'")
    first = c.groupBy("conv_id").agg(F.min_by("text", "turn").alias("first"))
    rows = c.join(first, "conv_id").select(F.concat_ws("-", "conv_id", "turn").alias("key"), F.split("text", "\n").alias("a"), F.split("first", "\n").alias("b"))
    return records.align_lines(rows, "key", "a", "b")


@query("json_items", "select conv_id, array_to_string(list_concat(['conversation ' || conv_id], list(role || ': ' || text order by turn)), chr(10)) as texts from conversations group by conv_id")
def json_items(spark, d):
    """Conversations as nested JSON items, and their texts walked back out."""
    turn = F.struct(F.lit("p").alias("kind"), F.concat("role", F.lit(": "), "text").alias("text"))
    below = F.transform(F.array_sort(F.collect_list(F.struct("turn", turn.alias("item")))), lambda x: x["item"])
    nested = read(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.array(F.struct(F.lit("h").alias("kind"), F.concat(F.lit("conversation "), "conv_id").alias("text"), F.array(F.struct(F.lit("list").alias("kind"), below.alias("items"))).alias("items")))).alias("j"))
    return nested.select("conv_id", F.array_join(records.item_texts(F.col("j")), "\n").alias("texts"))


@query("url_keyword_filter", r"select page_id from pages where regexp_matches(lower(url), 'fr|page') and regexp_matches(string_split(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', ''), '.')[-1], '^(?:com|org)$')")
def url_keyword_filter(spark, d):
    return read(spark, d, "pages").filter(urls.keyword_filter(F.col("url"), ("fr", "page"), "com|org")).select("page_id")
