"""Pages, files, decoders, models and selections: the queries of what has no table of its own in the corpus."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from leafmill.functions import decoding, language, pages, text
from leafmill.operators import dedup, evidence, learned, lifecycle, planning, selection, statistics, structure
from leafmill.plans.vectors import DISTANCES, KNN, C, firsts, vectors
from leafmill.sources import files
from leafmill.sources.scratch import materialise, shared_dir
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}
SHEET = "(297::double / 210)"


def query(name, sql):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def folder(spark, name):
    import uuid

    return f"{shared_dir(spark)}/leafmill/{name}-{uuid.uuid4().hex}"


# Pages


@query("page_geometry", f"""
with p as (select p_partkey, 900 + p_size * 10::double as w, 900 + p_size * 10::double + p_retailprice % 500 as h, p_retailprice as native from part), r as (select *, h / w as r from p),
c as (select *, case when r < {SHEET} then h / {SHEET} else w end as cw, case when r > {SHEET} then w * {SHEET} else h end as ch, r between {SHEET} * 0.95::double and {SHEET} / 0.95::double as fits, abs(r / {SHEET} - 1) < 1e-3 as same from r)
select p_partkey, fits and native >= 1000 as ok, case when same then 'none' when fits then 'cut' else 'unfit' end as status, case when fits and not same then round(cw, 6) end as w, case when fits and not same then round(ch, 6) end as h from c""")
def page_geometry(spark, d):
    w = F.lit(900.0) + F.col("p_size") * 10
    p = read(spark, d, "part").select("p_partkey", w.alias("w"), (w + F.col("p_retailprice") % 500).alias("h"), F.col("p_retailprice").alias("native"))
    c = p.withColumn("c", pages.crop(F.col("w"), F.col("h")))
    return c.select("p_partkey", pages.page_ok(F.col("h") / F.col("w"), F.col("native")).alias("ok"), "c.status", F.round("c.w", 6).alias("w"), F.round("c.h", 6).alias("h"))


@query("page_flags", """
select l_orderkey, l_linenumber, not (l_returnflag = 'N') or l_linestatus = 'X' or l_linestatus like 'scan%' as scan, case when l_linenumber < 100000 then l_orderkey * 100000 + l_linenumber end as packed,
  round(l_discount * greatest(least(l_tax * 20, 1.0) - greatest(l_tax, 0.0), 0.0) * greatest(least(l_quantity / 40, 1.0) - greatest(0.1::double, 0.0), 0.0), 9) as fill,
  l_linenumber >= 0 and ((list_sort([l_linenumber - 1, 0]) <> range(l_linenumber)[1:2]) or (l_linenumber <> cast(l_quantity as integer) % 7 and cast(l_quantity as integer) % 7 < 500)) as stale from lineitem""")
def page_flags(spark, d):
    i = F.col("l_linenumber")
    before = F.bround("l_quantity").cast("int") % 7
    return read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", pages.scan_flag(F.col("l_returnflag") == "N", F.when(F.col("l_linestatus") != "X", F.col("l_linestatus"))).alias("scan"), pages.packed_key(F.col("l_orderkey"), i).alias("packed"),
        F.round(pages.window_fill(F.col("l_discount"), F.col("l_tax"), F.lit(0.1), F.col("l_tax") * 20, F.col("l_quantity") / 40), 9).alias("fill"), pages.stale(F.array(i - 1, F.lit(0)), i, before).alias("stale"),
    )


BOXES = "select l_orderkey as page, 'l' as kind, cast(l_partkey as varchar) as text, (l_linenumber - 1) % 3 * 100.0::double as x0, (l_linenumber - 1) // 3 * 20.0::double as y0, (l_linenumber - 1) % 3 * 100.0::double + 60 as x1, (l_linenumber - 1) // 3 * 20.0::double + 10 as y1, 10.0::double as size from lineitem"


def boxes(spark, d):
    li, i = read(spark, d, "lineitem"), F.col("l_linenumber") - 1
    x, y = (i % 3) * 100.0, F.floor(i / 3) * 20.0
    return li.select(F.col("l_orderkey").alias("page"), F.lit("l").alias("kind"), F.col("l_partkey").cast("string").alias("text"), x.alias("x0"), y.alias("y0"), (x + 60).alias("x1"), (y + 10).alias("y1"), F.lit(10.0).alias("size"))


@query("page_tables", None)
def page_tables(spark, d):
    """Tables of made-up pages whose items stand on a grid of three columns."""
    return structure.page_tables(boxes(spark, d), "page")


@query("page_trees", None)
def page_trees(spark, d):
    return structure.page_trees(boxes(spark, d), "page")


@query("layout_vectors", f"""
with b as (select page, x0 / 300 as x0, y0 / 60 as y0, x1 / 300 as x1, y1 / 60 as y1 from ({BOXES})), c as (select page, (x1 - x0) * (y1 - y0) as a, cast(least(floor((y0 + y1) / 2 * 8), 7) * 6 + least(floor((x0 + x1) / 2 * 6), 5) as integer) as c from b),
n as (select page, count(*) as n, sum(a) as area from c group by page), k as (select page, c, count(*) as k from c group by all), m as (select page, list(c) as cs, list(k) as ks from k group by page)
select page, n, round(area, 9) as area, list_transform(range(48), lambda i: round(coalesce(ks[list_position(cs, i)], 0)::double / n, 9)) as grid from n join m using (page)""")
def layout_vectors(spark, d):
    unit = boxes(spark, d).select("page", *[(F.col(c) / n).alias(c) for c, n in (("x0", 300), ("x1", 300), ("y0", 60), ("y1", 60))])
    return pages.layout_grid(unit, "page").select("page", "n", F.round("area", 9).alias("area"), F.transform("grid", lambda x: F.round(x, 9)).alias("grid"))


@query("tile_means", "select l_suppkey as page, least(floor(l_discount * 10 * 4), 3)::int as tx, least(floor(l_tax * 12 * 4), 3)::int as ty, round(avg(l_quantity), 9) as mean from lineitem group by all")
def tile_means(spark, d):
    px = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), (F.col("l_discount") * 10).alias("x"), (F.col("l_tax") * 12).alias("y"), F.col("l_quantity").alias("ink"))
    return pages.tile_means(px, "page", 4).withColumn("mean", F.round("mean", 9))


# Files


@query("manifest_rows", "select cast(p_partkey as integer) as page_index, p_name as source_path, p_brand as language from part")
def manifest_rows(spark, d):
    """Rows written as JSON lines beside a half-written last line, read back under the fixed schema."""
    at = folder(spark, "manifest")
    rows = read(spark, d, "part").select(F.col("p_name").alias("source_path"), F.col("p_partkey").cast("int").alias("page_index"), F.col("p_brand").alias("language"))
    broken = spark.createDataFrame([('{"source_path": "half',)], "value string")
    rows.select(F.to_json(F.struct("*")).alias("value")).unionAll(broken).write.text(at)
    return files.read_manifest(spark, at)[0].select("page_index", "source_path", "language")


@query("delimited_rows", "select s_suppkey, s_name, s_acctbal from supplier")
def delimited_rows(spark, d):
    at = folder(spark, "table")
    read(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).option("sep", "\t").csv(at)
    return files.read_table(spark, at, "s_suppkey long, s_name string, s_acctbal double")


@query("ragged_shards", "select l_orderkey as doc, l_linenumber as page, list_transform(range(l_linenumber % 4), lambda i: cast(l_suppkey + i as bigint)) as cls from lineitem")
def ragged_shards(spark, d):
    """Rows with lists packed into shards of ids, offsets and flat values, and read back."""
    li = read(spark, d, "lineitem")
    cls = F.when(F.col("l_linenumber") % 4 > 0, F.transform(F.sequence(F.lit(0), F.col("l_linenumber") % 4 - 1), lambda i: F.col("l_suppkey") + i)).otherwise(F.array().cast("array<long>"))
    rows = li.select((F.col("l_orderkey") % 50).alias("shard"), F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), cls.alias("cls"))
    return files.ragged_to_rows(files.rows_to_ragged(rows, ["shard"]))


@query("versions_current", "select n_nationkey, lower(n_name) as n_name from nation")
def versions_current(spark, d):
    """A table written twice as versions: the current one is the second."""
    table = files.Versions(spark, folder(spark, "versions"))
    n = read(spark, d, "nation").select("n_nationkey", "n_name")
    table.write(n)
    table.write(n.withColumn("n_name", F.lower("n_name")))
    return table.read()


@query("listed_files", "select count(*) as n, sum(octet_length(encode(s_name || chr(10)))) as bytes from supplier")
def listed_files(spark, d):
    at = folder(spark, "files")
    read(spark, d, "supplier").select("s_name").repartition(4).write.text(at)
    sizes = files.listing(spark, at).filter(F.col("path").contains("part-"))
    n = spark.read.text(at).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(sizes.agg(F.sum("size").alias("bytes"))))


@query("payload_errors", "select p_partkey, case when p_size % 10 <> 0 then p_name || '!' end as made, case when p_size % 10 = 0 then 'ValueError: no page' end as error from part")
def payload_errors(spark, d):
    """A payload that fails on some rows: an error is data."""

    def payload(row):
        if row["p_size"] % 10 == 0:
            raise ValueError("no page")
        return (row["p_name"] + "!").encode()

    return files.apply_payload(read(spark, d, "part"), ["p_name", "p_size"], payload, "p_partkey").select("p_partkey", F.col("value").cast("string").alias("made"), "error")


@query("estimated_batches", "select o_custkey, o_orderkey, cast(floor(coalesce(sum(o_totalprice) over (partition by o_custkey order by o_orderkey rows between unbounded preceding and 1 preceding), 0) / 500000) as bigint) as batch from orders")
def estimated_batches(spark, d):
    return evidence.weight_batches(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_orderkey"], ["o_custkey"], F.col("o_totalprice"), 500_000).drop("o_totalprice")


# State


@query("state_steps", "select o_orderkey, case when o_orderstatus = 'O' and o_totalprice % 2 >= 1.5::double then 'unreadable' when o_orderstatus = 'O' then 'picked' when o_orderstatus = 'P' and o_custkey % 2 = 0 then 'embedded' when o_orderstatus = 'F' and o_custkey % 3 = 0 then 'placed' when o_orderstatus = 'P' then 'picked' when o_orderstatus = 'F' then 'embedded' end as state from orders")
def state_steps(spark, d):
    o = read(spark, d, "orders")
    now = F.when(F.col("o_orderstatus") == "O", "new").when(F.col("o_orderstatus") == "P", "picked").when(F.col("o_orderstatus") == "F", "embedded")
    return o.select("o_orderkey", lifecycle.state_machine(now, F.col("o_totalprice") % 2 < 1.5, F.col("o_custkey") % 2 == 0, F.col("o_custkey") % 3 == 0).alias("state"))


@query("manifest_conflicts", "select c_custkey, c_mktsegment as old, case when c_acctbal < 0 then lower(c_mktsegment) else c_mktsegment end as new from customer where c_acctbal < 0")
def manifest_conflicts(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    new = read(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return lifecycle.conflicts(c, new, "c_custkey", "c_mktsegment")


@query("attempts_state", "select user_id, count(*) as tries, case when bool_or(event_type <> 'error') then 'done' when count(*) >= 3 then 'poison' else 'retry' end as state from events where event_type in ('error', 'purchase') group by user_id")
def attempts_state(spark, d):
    a = read(spark, d, "events").filter(F.col("event_type").isin("error", "purchase")).withColumn("failed", F.col("event_type") == "error")
    return lifecycle.poisoned(a, "user_id", "failed")


@query("served_claims", """
with done as (select distinct user_id % 997 as k from events where event_type = 'purchase'), live as (select distinct user_id % 997 as k from events where event_type = 'click' and ts > timestamp '2024-01-01 06:00:00' - interval 7200 second),
q as (select c_custkey as k, row_number() over (order by c_acctbal, c_custkey) as i from customer where c_custkey not in (select k from done) and c_custkey not in (select k from live))
select k, ['a', 'b', 'c'][(i - 1) % 3 + 1] as worker from q where i <= 30""")
def served_claims(spark, d):
    e = read(spark, d, "events").withColumn("k", F.col("user_id") % 997)
    queue = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    claims = e.filter("event_type = 'click'").select("k", F.col("ts").alias("claimed_at"))
    return lifecycle.serve(queue, e.filter("event_type = 'purchase'"), claims, "k", ["c_acctbal"], ["a", "b", "c"], 10, F.lit("2024-01-01 06:00:00").cast("timestamp"), 7200).select("k", "worker")


@query("weighted_pool", """
with c as (select l_returnflag, l_quantity as v, count(*) as n, sum(l_discount) as w from lineitem group by all), p as (select *, sum(w) over (partition by l_returnflag order by v rows unbounded preceding) as upto, sum(w) over (partition by l_returnflag) as total from c)
select l_returnflag, sum(n)::bigint as n, round(sum(w), 6) as mass, round(sum(v * w) / sum(w), 6) as mean, min(v) filter (upto >= total / 2) as median from p group by l_returnflag""")
def weighted_pool(spark, d):
    out = statistics.weighted_summary(read(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_discount")
    return out.select("l_returnflag", "n", F.round("mass", 6).alias("mass"), F.round("mean", 6).alias("mean"), "median")


@query("pair_verdicts", f"""
with p as (select a.label as a, b.label as b, round({C}, 9) as c from embeddings a join embeddings b on a.label < b.label and a.vec_id % 7 = b.vec_id % 7), g as (select a, b, count(*) as n, avg(c) as mean, min(c) as least from p group by all)
select a, b, n, case when n > 1 and least > 0.2 then 'confirmed' when mean > 0.2 then 'first pages only' when mean > 0.5 then 'template only' else 'no' end as verdict from g""")
def pair_verdicts(spark, d):
    from leafmill.operators.joins import pair_cosines

    g = pair_cosines(vectors(spark, d).withColumn("k", F.col("vec_id") % 7), "label", "embedding", "k", 0.2, [0.5])
    return dedup.candidate_verdict(g, ok=0.2).select("a", "b", "n", "verdict")


# Text repair and decoding


@query("repaired_text", "select doc_id, md5(text) as text from documents")
def repaired_text(spark, d):
    """Documents whose UTF-8 was read as Latin-1, read back."""
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return read(spark, d, "documents").select("doc_id", F.md5(decoding.repaired(broken)).alias("text"))


@query("localised_digits", "select c_custkey, translate(c_name, '0123456789', '٠١٢٣٤٥٦٧٨٩') as name from customer")
def localised_digits(spark, d):
    return read(spark, d, "customer").select("c_custkey", text.native_digits(F.col("c_name"), "٠١٢٣٤٥٦٧٨٩").alias("name"))


@query("html_tables", "select conv_id, md5('<table>' || string_agg('<tr><td>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td></tr>', '' order by turn) || '</table>') as html from conversations group by conv_id")
def html_tables(spark, d):
    t = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return read(spark, d, "conversations").groupBy("conv_id").agg(F.md5(text.html_rows(t)).alias("html"))


@query("target_names", "select doc_id, case when lang not in ('unknown', 'und') and substr(sha256(text), 1, 12) || '_' || lang || '.pdf' <> source then substr(sha256(text), 1, 12) || '_' || lang || '.pdf' end as name from documents")
def target_names(spark, d):
    key = dedup.short_name(dedup.content_key(F.col("text")))
    return read(spark, d, "documents").select("doc_id", text.target_name(key, F.col("lang"), F.lit("pdf"), F.concat(F.lit("x/"), "source")).alias("name"))


@query("font_routes", """
with f as (select p_partkey, regexp_replace(regexp_replace(lower(regexp_replace(font, '^[A-Z]{6}\\+', '')), '(regular|normal|bold|italic|oblique|mt)', '', 'g'), '[^a-z0-9]', '', 'g') as f from (select p_partkey, 'ABCDEF+' || p_brand || '-Bold' || p_size % 3 as font from part)),
r(family, kind, argument) as (values ('brand1', 'table', 'one'), ('brand11', 'table', 'eleven'), ('brand2', 'page', 'two')), m as (select f, arg_max(kind, length(family)) as kind, arg_max(argument, length(family)) as argument from (select distinct f from f) join r on starts_with(f, family) group by f)
select p_partkey, kind, argument from f left join m using (f)""")
def font_routes(spark, d):
    rows = read(spark, d, "part").select("p_partkey", F.concat(F.lit("ABCDEF+"), "p_brand", F.lit("-Bold"), (F.col("p_size") % 3).cast("string")).alias("font"))
    routes = spark.createDataFrame([("brand1", "table", "one"), ("brand11", "table", "eleven"), ("brand2", "page", "two")], "family string, kind string, argument string")
    return decoding.route(rows, "font", routes).select("p_partkey", "kind", "argument")


@query("decoded_chain", "select c_custkey, reverse(replace(translate(c_name, 'Cusr', 'Kuzr'), 'tome', 'TOM')) as name from customer where not regexp_matches(c_name, '[0-9]') union all select c_custkey, array_to_string(list_reverse(regexp_extract_all(replace(translate(c_name, 'Cusr', 'Kuzr'), 'tome', 'TOM'), '\\p{Nd}+(?:[.,:/]\\p{Nd}+)*|(?s).')), '') from customer where regexp_matches(c_name, '[0-9]')")
def decoded_chain(spark, d):
    steps = [("table", {"C": "K", "u": "u", "s": "z", "r": "r"}), ("table", {"tome": "TOM"}), ("reversed", None)]
    return read(spark, d, "customer").select("c_custkey", decoding.chained(F.col("c_name"), steps).alias("name"))


@query("table_agreement", """
with t as (select l_suppkey % 9 as font, l_linenumber as code, chr(96 + l_linenumber) as read from lineitem where l_suppkey % 9 <> 4 union all select 4, l_linenumber, '?' from lineitem where l_suppkey % 9 = 4),
b as (select 'a' as tab, unnest(range(1, 8)) as code union all select 'b', unnest(range(1, 4))), x as (select tab, code, chr(96 + code::int) as txt from b),
m as (select font, tab, avg((read = txt)::int) as share, count(distinct t.code) as codes from t join x on x.code = t.code group by all)
select font, arg_max(tab, (share, codes, tab)) as "table", max(share) as share from m where share >= 0.9 and codes >= 3 group by font""")
def table_agreement(spark, d):
    li = read(spark, d, "lineitem").select((F.col("l_suppkey") % 9).alias("font"), F.col("l_linenumber").alias("code"))
    traces = li.withColumn("read", F.when(F.col("font") == 4, "?").otherwise(F.chr(F.col("code") + 96)))
    rows = [("a", i, chr(96 + i)) for i in range(1, 8)] + [("b", i, chr(96 + i)) for i in range(1, 4)]
    tables = spark.createDataFrame(rows, "table string, code int, text string")
    return decoding.table_agreement(traces, tables, ["font"], codes=3)


@query("likeliest_tables", None)
def likeliest_tables(spark, d):
    """Lines of three languages under one of two letter swaps: the table that undoes it reads best."""
    lines = read(spark, d, "documents").filter("lang in ('en', 'de', 'fr')").select("lang", F.substring("text", 1, 200).alias("t"), "doc_id")
    model = language.TrigramModel(lines, "t", "lang")
    coded = lines.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(F.struct("doc_id", "t"))), 1, 20).alias("s")).select("lang", F.explode("s").alias("s")).select("lang", F.translate("s.t", "etn", "ntё").alias("coded"))
    tables = spark.createDataFrame([("swap", "n", "e"), ("swap", "t", "t"), ("swap", "ё", "n"), ("plain", "n", "n")], "table string, code string, text string")
    return decoding.likeliest_table(coded, tables, model, "lang", "coded", "lang").select("lang", "table")


@query("decoding_audit", r"select lang, count(text) as texts, sum(length(text))::bigint as characters, sum(len(regexp_extract_all(text, '[\p{Co}\x{FFFD}]')))::bigint as broken, sum(len(regexp_extract_all(text, '(?:^|[^\p{L}\p{M}])\p{M}')))::bigint as marks_first from documents group by lang")
def decoding_audit(spark, d):
    return decoding.decoding_audit(read(spark, d, "documents"), "lang", "text")


@query("glyph_coverage", r"""
with c as (select lang, ch, count(*) as n from (select lang, unnest(regexp_extract_all(text, '[^ \t\n\r\f\v]')) as ch from documents) group by all), g as (select distinct lang, ch from c where lang <> 'de' and n > 20),
m as (select c.*, g.ch is not null as has from c left join g using (lang, ch))
select lang, round(coalesce(sum(n) filter (has), 0)::double / sum(n), 9) as share, case when coalesce(sum(n) filter (has), 0)::double / sum(n) >= 1 then 'full' when coalesce(sum(n) filter (has), 0)::double / sum(n) >= 0.98::double then 'usable' else 'partial' end as class, count(*) filter (not has) as lacking from m group by lang""")
def glyph_coverage(spark, d):
    t = read(spark, d, "documents").select("lang", "text")
    chars = t.select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^ \t\n\r\f\x0B]"), F.lit(0))).alias("ch")).groupBy("lang", "ch").agg(F.count("*").alias("n"))
    glyphs = materialise(chars.filter("lang != 'de' and n > 20").select("lang", "ch"))
    out = decoding.coverage_class(t, "lang", "text", glyphs)
    return out.select("lang", F.round("share", 9).alias("share"), "class", F.length("missing").cast("long").alias("lacking"))


@query("nearest_shapes", """
with a as (select l_orderkey as k, list(distinct l_linenumber + l_suppkey % 3) as b from lineitem where l_orderkey % 2 = 0 group by l_orderkey), x as (select 'w' || l_suppkey as lab, list(distinct l_linenumber) as b from lineitem group by l_suppkey),
p as (select k, lab, len(list_intersect(a.b, x.b)) as i, len(a.b) as na, len(x.b) as nb from a, x), s as (select k, lab, i::double / (na + nb - i) as score from p where i > 0)
select k, arg_max(lab, (score, lab)) as label, round(max(score), 9) as score from s where score >= 0.5::double group by k""")
def nearest_shapes(spark, d):
    li = read(spark, d, "lineitem")
    a = li.filter("l_orderkey % 2 = 0").groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_set((F.col("l_linenumber") + F.col("l_suppkey") % 3).cast("int"))).alias("b"))
    x = li.groupBy(F.concat(F.lit("w"), "l_suppkey").alias("label")).agg(F.sort_array(F.collect_set("l_linenumber")).alias("b"))
    return decoding.nearest_shapes(a, x, "k", "b", "label", 0.5).withColumn("score", F.round("score", 9))


# Models and selections


@query("agreed_languages", "select doc_id, case when lang = l2 and least(p1, p2) >= 0.8::double and n_chars >= 200 then lang end as lang from (select doc_id, lang, n_chars, case when doc_id % 11 = 0 then 'xx' else lang end as l2, 0.5::double + (doc_id % 50) / 100.0::double as p1, 0.5::double + (doc_id % 30) / 60.0::double as p2 from documents)")
def agreed_languages(spark, d):
    i = F.col("doc_id")
    rows = read(spark, d, "documents").select("doc_id", "lang", "n_chars", F.when(i % 11 == 0, "xx").otherwise(F.col("lang")).alias("l2"), (F.lit(0.5) + (i % 50) / 100.0).alias("p1"), (F.lit(0.5) + (i % 30) / 60.0).alias("p2"))
    return rows.select("doc_id", language.agreed(F.col("lang"), F.col("p1"), F.col("l2"), F.col("p2"), F.col("n_chars")).alias("lang"))


@query("nearest_real", f"with n as (select src, dst, sim, la as l from ({KNN}) where rank = 1), b as (select *, row_number() over (partition by dst order by sim desc, src) as r from n), c as (select *, row_number() over (partition by l order by sim desc, src) as k from b where r = 1) select src, dst, l as label from c where k <= 3")
def nearest_real(spark, d):
    """The nearest real row of each query, one query for each row, the best three of a label."""
    from leafmill.operators.joins import nearest

    e = vectors(spark, d)
    n = nearest(e, e, "vec_id", "embedding").join(e.select(F.col("vec_id").alias("src"), "label"), "src")
    return selection.one_per_document(n, "dst", [F.desc("similarity"), "src"], ["label"], 3).select("src", "dst", "label")


@query("landing_rows", f"with f as (select min(vec_id) as vec_id from embeddings group by label), n as (select a.vec_id as src, b.vec_id as dst, round(1 - {C}, 12) as d, row_number() over (partition by a.vec_id order by {C} desc, b.vec_id) as r from embeddings a, embeddings b where a.vec_id not in (select vec_id from f) and b.vec_id in (select vec_id from f)), o as (select *, row_number() over (partition by dst order by d, src) as k from n where r = 1 and d <= 0.9) select src, dst, round(d, 9) as distance from o where k = 1")
def landing_rows(spark, d):
    e = vectors(spark, d)
    f = materialise(firsts(e))
    return selection.landings(e.join(f.select("vec_id"), "vec_id", "left_anti"), f, "vec_id", "embedding", 0.9).withColumn("distance", F.round("distance", 9))


@query("fused_vectors", """
with i as (select vec_id, embedding, generate_subscripts(embedding, 1) as k, unnest(embedding)::double as x from embeddings), m as (select k, avg(x) as m from i group by k), c as (select vec_id, sum((x - m) * (x - m)) as s from i join m using (k) group by vec_id)
select vec_id, round(sqrt(s * (0.25::double + 4)), 6) as length from c""")
def fused_vectors(spark, d):
    """Two views of a row, weighted one half and two: the length of the joined vector."""
    e = vectors(spark, d).withColumn("other", F.col("embedding"))
    f = selection.fused(e, [("embedding", 0.5), ("other", 2.0)])
    return f.select("vec_id", F.round(F.sqrt(F.aggregate("fused", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("length"))


@query("text_scores", "with h as (select vec_id, list_transform(embedding[1 : len(embedding) // 2], lambda x: x::double) as h from embeddings), t as (select 'a' as name, list_transform(range((select len(h) from h limit 1)), lambda i: 1.0::double) as t union all select 'b', list_transform(range((select len(h) from h limit 1)), lambda i: (i % 2)::double)) select vec_id, name, round(list_dot_product(h, t) / sqrt(list_dot_product(h, h) * list_dot_product(t, t)), 9) as score from h, t")
def text_scores(spark, d):
    e = vectors(spark, d)
    n = e.select(F.size("embedding").alias("n")).first()
    n = n.n // 2 if n else 1
    texts = spark.createDataFrame([("a", [1.0] * n), ("b", [float(i % 2) for i in range(n)])], "name string, t array<double>")
    return selection.text_scores(e, "vec_id", "embedding", texts, "name", "t").withColumn("score", F.round("score", 9))


@query("identical_vectors", "with e as (select vec_id, list_transform(embedding, lambda x: sign(x)::int)[1:5] as v from embeddings) select vec_id, min(vec_id) over (partition by v) as \"group\" from e")
def identical_vectors(spark, d):
    e = vectors(spark, d).select("vec_id", F.slice(F.transform("embedding", lambda x: F.signum(x).cast("int")), 1, 5).alias("v"))
    return selection.identical_groups(e, "vec_id", "v")


@query("herded_rows", None)
def herded_rows(spark, d):
    return selection.per_cluster(vectors(spark, d), ["label"], "vec_id", "embedding", selection.herding(5))


@query("eliminated_rows", None)
def eliminated_rows(spark, d):
    return selection.per_cluster(vectors(spark, d), ["label"], "vec_id", "embedding", selection.elimination(1.0, 8)).select("vec_id")


@query("seed_rounds", None)
def seed_rounds(spark, d):
    """Seeds whose vectors, moved by a ridge fitted on neighbours, land on the gaps."""
    from leafmill.operators.joins import nearest

    e = vectors(spark, d).withColumn("embedding", F.col("embedding").cast("array<double>"))
    near = nearest(e, e, "vec_id", "embedding").join(e.select(F.col("vec_id").alias("src"), F.col("embedding").alias("x")), "src").join(e.select(F.col("vec_id").alias("dst"), F.col("embedding").alias("y")), "dst")
    shift = learned.ridge(near, "x", "y", 1.0)
    return selection.seed_rounds(e, firsts(e), "vec_id", "embedding", shift, "label", 1, 4, 0.3)


@query("balanced_sample", None)
def balanced_sample(spark, d):
    return selection.hierarchical_sample(vectors(spark, d), "vec_id", "embedding", 40, 12, 4)


@query("pruned_rows", None)
def pruned_rows(spark, d):
    return selection.prune_by_density(vectors(spark, d), "vec_id", "embedding", 60, 6)


@query("border_rows", None)
def border_rows(spark, d):
    return selection.border_by_direction(vectors(spark, d), "vec_id", "embedding", 3)


def labelled(spark, d):
    return vectors(spark, d).select("vec_id", F.col("embedding").cast("array<double>").alias("x"), (F.col("label") % 2).cast("double").alias("y"), (F.col("vec_id") % 13).alias("g"))


@query("projection_variance", """
with i as (select vec_id, generate_subscripts(embedding, 1) as k, unnest(embedding)::double as x from embeddings), m as (select k, avg(x) as m from i group by k)
select round(sum((x - m) * (x - m)) / (select count(*) from embeddings), 6) as total from i join m using (k)""")
def projection_variance(spark, d):
    """All principal axes keep the whole variance."""
    e = labelled(spark, d)
    n = e.select(F.size("x").alias("n")).first().n
    mean, axes = learned.principal_axes(e, "x", n)
    p = learned.apply_matrix(e.select("vec_id", "x"), "x", axes, mean, "p")
    return p.agg(F.round(F.avg(F.aggregate("p", F.lit(0.0), lambda a, v: a + v * v)), 6).alias("total"))


@query("whitened_spread", None)
def whitened_spread(spark, d):
    e = vectors(spark, d).select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    mean, m = learned.whitening(e, "x", "label")
    return learned.apply_matrix(e.select("vec_id", "x", "label"), "x", m, mean, "w").groupBy("label").agg(F.count("*").alias("n"), F.avg(F.aggregate("w", F.lit(0.0), lambda a, v: a + v * v)).alias("spread"))


@query("logistic_scores", None)
def logistic_scores(spark, d):
    e = labelled(spark, d)
    return learned.logistic_scores(e.filter("g != 1"), e, "x", "y").select("vec_id", F.round("p", 6).alias("p"))


@query("out_of_fold_boosted", None)
def out_of_fold_boosted(spark, d):
    """Boosted trees out of fold, and a logistic model over both kinds of scores, out of fold as well."""
    e = labelled(spark, d)
    linear = learned.out_of_fold(e, "x", "y", "g", 3).select("vec_id", F.col("p").alias("p1"))
    boosted = learned.out_of_fold(e, "x", "y", "g", 3, boosted=True).select("vec_id", F.col("p").alias("p2"))
    both = materialise(e.select("vec_id", "y", "g").join(linear, "vec_id").join(boosted, "vec_id").withColumn("s", F.array("p1", "p2")))
    return learned.out_of_fold(both, "s", "y", "g", 3).select("vec_id", F.round("p1", 6).alias("p1"), F.round("p2", 6).alias("p2"), F.round("p", 6).alias("p"))


@query("confident_rows", None)
def confident_rows(spark, d):
    e = labelled(spark, d).withColumn("status", F.when(F.col("g") < 4, F.when(F.col("y") == 1, "accepted").otherwise("rejected")))
    return learned.accepted_or_confident(e, "status", "x", 0.6).select("vec_id")


@query("passages_to_pages", None)
def passages_to_pages(spark, d):
    """Documents put on pages of known room, the roomiest page first."""
    docs = read(spark, d, "documents").select("lang", F.col("doc_id").alias("text"), F.col("n_chars").alias("size"), F.col("source").alias("document"))
    first = docs.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("text"))).filter("r <= 100").select("lang", F.col("text").alias("page"), (F.col("size") * 2).alias("room"))
    return planning.assign_passages(first, docs, "lang", "page", "room", "text", "size", "document")


@query("evidence_scores", "with x as (select conv_id, count(*) as turns, sum(length(text)) as n from conversations group by conv_id) select conv_id, case when turns < 3 then 'short' when n > 5000 then 'long' end as reason from x")
def evidence_scores(spark, d):
    x = read(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("n"))
    return x.select("conv_id", evidence.first_reason((F.col("turns") < 3, "short"), (F.col("n") > 5000, "long")).alias("reason"))
