"""Vector selection queries over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafmill.operators import allocators
from leafmill.operators import selection as s
from leafmill.sources.tables import read

QUERIES, SQL = {}, {}
C = "round(list_dot_product(a.embedding::double[], b.embedding::double[]) / sqrt(list_dot_product(a.embedding::double[], a.embedding::double[]) * list_dot_product(b.embedding::double[], b.embedding::double[])), 12)"
KNN = f"select a.vec_id as src, b.vec_id as dst, {C} as sim, row_number() over (partition by a.vec_id order by {C} desc, b.vec_id) as rank, a.label as la, b.label as lb from embeddings a join embeddings b on a.vec_id <> b.vec_id"
#: Members of a label in order of their ids, and of each the distances to all of them.
DISTANCES = f"m as (select vec_id, label, row_number() over (partition by label order by vec_id) as r from embeddings), d as (select x.label, x.r, x.vec_id, list(round(1 - {C}, 12) order by y.r) as d from m x join m y using (label) join embeddings a on a.vec_id = x.vec_id join embeddings b on b.vec_id = y.vec_id group by all)"
FIRST = "select min(vec_id) from embeddings group by label"


def query(name, sql):
    def put(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return put


def vectors(spark, d):
    return read(spark, d, "embeddings")


def firsts(e):
    from leafmill.operators.dedup import keep_first

    return keep_first(e, ["label"], ["vec_id"])


@query("local_density", f"select a.vec_id, count(*) filter ({C} > 0.8)::double / count(*) as density from embeddings a, embeddings b group by a.vec_id")
def local_density(spark, d):
    return s.density(vectors(spark, d), vectors(spark, d), "vec_id", "embedding", 0.2)


@query("class_border_share", f"select src as vec_id, round(avg((la <> lb)::int), 9) as border from ({KNN}) where rank <= 10 group by src")
def class_border_share(spark, d):
    return s.class_border(vectors(spark, d), "vec_id", "embedding", "label").withColumn("border", F.round("border", 9))


@query("coverage_of_selection", f"""
with q as (select src, max(sim) as sim from ({KNN}) where dst in ({FIRST}) group by src), d as (select src, 1 - sim as d from q), s as (select * from d where src in ({FIRST}))
select 'all' as of, round(avg(d), 9) as mean, round(quantile_cont(d, 0.5), 9) as p50, round(quantile_cont(d, 0.99), 9) as p99, round(max(d), 9) as max from d
union all select 'selected', round(avg(d), 9), round(quantile_cont(d, 0.5), 9), round(quantile_cont(d, 0.99), 9), round(max(d), 9) from s""")
def coverage_of_selection(spark, d):
    e = vectors(spark, d)
    out = s.coverage(e, firsts(e), "vec_id", "embedding")
    return out.select("of", *[F.round(c, 9).alias(c) for c in ("mean", "p50", "p99", "max")])


@query("gap_cells", f"with n as (select dst, count(*) as n from (select a.vec_id as src, b.vec_id as dst, row_number() over (partition by a.vec_id order by {C} desc, b.vec_id) as r from embeddings a, embeddings b where b.vec_id in ({FIRST})) where r = 1 group by dst) select vec_id, coalesce(n, 0) as n from embeddings left join n on dst = vec_id where vec_id in ({FIRST}) and coalesce(n, 0) <= (select count(*) // 10 from embeddings)")
def gap_cells(spark, d):
    e = vectors(spark, d)
    return s.gap_cells(e, firsts(e), "vec_id", "embedding", e.count() // 10)


@query("neighbour_midpoints", f"""
with p as (select distinct least(src, dst) as a, greatest(src, dst) as b from ({KNN}) where rank <= 2)
select p.a, p.b, round(sqrt(list_dot_product(x.s, x.s)), 6) as length from p join (select a.vec_id as a, b.vec_id as b, list_transform(list_zip(a.embedding, b.embedding), lambda z: z[1]::double + z[2]) as s from embeddings a, embeddings b) x on x.a = p.a and x.b = p.b""")
def neighbour_midpoints(spark, d):
    return s.midpoints(vectors(spark, d), "vec_id", "embedding", 2).select("a", "b", F.round("length", 6).alias("length"))


@query("vector_drift", f"""
with n as (select vec_id, lead(embedding) over (order by vec_id) as e from embeddings), x as (select a.embedding as a, list_transform(list_zip(a.embedding, n.e), lambda z: z[1]::double + 0.1 * z[2]) as b from embeddings a join n using (vec_id) where n.e is not null),
c as (select round(list_dot_product(a::double[], b) / sqrt(list_dot_product(a::double[], a::double[]) * list_dot_product(b, b)), 9) as c from x)
select round(min(c), 6) as least, round(quantile_cont(c, 0.5), 6) as median, count(*) filter (c < 0.99) as under_99, count(*) as n from c""")
def vector_drift(spark, d):
    """Drift of vectors that are each moved a tenth towards the next one."""
    e = vectors(spark, d)
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    moved = e.join(after, "vec_id").select("vec_id", F.zip_with("embedding", "next", lambda x, y: x.cast("double") + 0.1 * y.cast("double")).alias("embedding"))
    found = s.drift(e, moved, "vec_id", "embedding")
    return found.select(F.round(F.get("quantiles", F.lit(0)), 6).alias("least"), F.round(F.get("quantiles", F.lit(4)), 6).alias("median"), F.get("under", F.lit(0)).alias("under_99"), "n")


@query("fps_order", f"""
with recursive m as (select vec_id, row_number() over (order by vec_id) as r from embeddings), d as (select x.r, list(round(1 - {C}, 12) order by y.r) as d from m x cross join m y join embeddings a on a.vec_id = x.vec_id join embeddings b on b.vec_id = y.vec_id group by all),
g as (select 0 as step, 1 as n, [1]::bigint[] as new, [2.0]::double[] as far, list_transform(range((select count(*) from m)), lambda i: 2.0::double) as near, []::bigint[] as gone
  union all select step + 1, n + least(4, 24 - n), list_transform(top, lambda t: t.i), list_transform(top, lambda t: -t.d), near, gone
  from (select step, n, near, gone, list_sort(list_filter(list_transform(near, lambda x, i: {{'d': -x, 'i': i}}), lambda t: t.d <= 0))[1 : least(4, 24 - n)] as top
        from (select g.step, g.n, list_concat(g.gone, g.new) as gone, list_transform(g.near, lambda x, i: case when list_contains(g.new, i) or x < 0 then -1 else least(x, list_min(list_transform(k.ds, lambda q: q[i]))) end) as near
              from (select * from g where n < 24) g join (select g2.step, list(d.d) as ds from (select step, unnest(new) as r from g where n < 24) g2 join d using (r) group by g2.step) k using (step)))),
o as (select step, n - len(new) as before, unnest(new) as r, unnest(far) as distance, generate_subscripts(new, 1) as k from g)
select vec_id, cast(before + k - 1 as integer) as pick, distance from o join m using (r)""")
def fps_order(spark, d):
    return s.farthest_points(vectors(spark, d), "vec_id", "embedding", 24, batch=4)


@query("kcenter_radii", f"""
with recursive {DISTANCES},
f as (select label, arg_min(r, (-s, r)) as at from (select label, r, round(1 - list_avg(d), 12) as s from d) group by label),
g as (select f.label, f.at, 2.0::double as value, list_transform(d.d, lambda x, i: case when i = f.at then -1.0 else x end) as near from f join d on d.label = f.label and d.r = f.at
  union all select g.label, d.r, list_max(g.near), list_transform(list_zip(g.near, d.d), lambda z, i: case when i = d.r then -1.0 else least(z[1], z[2]) end) from g join d on d.label = g.label and d.r = list_position(g.near, list_max(g.near)) where list_max(g.near) > -1)
select vec_id, value from g join d on d.label = g.label and d.r = g.at""")
def kcenter_radii(spark, d):
    return s.per_cluster(vectors(spark, d), ["label"], "vec_id", "embedding", s.insertion_radii)


@query("thin_cluster", f"""
with recursive m as (select vec_id, label, count(*) over (partition by label) as n from embeddings),
q as (select a.label, a.vec_id as x, b.vec_id as y, row_number() over (partition by a.label order by round(1 - {C}, 12), b.vec_id desc, a.vec_id desc) as i from embeddings a join embeddings b on a.label = b.label and a.vec_id < b.vec_id),
g as (select distinct label, 0::bigint as i, n, []::bigint[] as gone from m
  union all select g.label, q.i, case when out then n - 1 else n end, case when out then list_append(gone, q.y) else gone end from (select g.label, g.n, g.gone, q.i, q.y, not list_contains(g.gone, q.x) and not list_contains(g.gone, q.y) as out from g join q on q.label = g.label and q.i = g.i + 1 where g.n > 20) g join q on q.label = g.label and q.i = g.i),
e as (select label, max_by(gone, i) as gone from g group by label)
select vec_id, 0.0::double as value from m join e using (label) where not list_contains(gone, vec_id)""")
def thin_cluster(spark, d):
    return s.per_cluster(vectors(spark, d), ["label"], "vec_id", "embedding", s.thin_to(20))


@query("kmeans_medoids", None)
def kmeans_medoids(spark, d):
    return s.medoids(vectors(spark, d), "vec_id", "embedding", 12)


@query("hybrid_select", None)
def hybrid_select(spark, d):
    return s.hybrid(vectors(spark, d), "vec_id", "embedding", 30)


@query("group_select", None)
def group_select(spark, d):
    return s.select_by_group(vectors(spark, d), "vec_id", "embedding", "label", 40)


@query("stratified_fps", f"""
with recursive {DISTANCES},
s as (select label, count(*) as n from embeddings group by label), c as (select max(c) as cap from (select unnest(range(0, 61)) as c) r where (select sum(least(n, r.c)) from s) <= 60),
u as (select label, n, least(n, cap) as q from s, c), v as (select *, 60 - sum(q) over () as over_, sum((n > q)::int) over (order by label) as turn from u), w as (select label, q + case when n > q and turn <= over_ then 1 else 0 end as quota from v),
g as (select d.label, d.r as at, 0 as pick, quota, list_transform(d.d, lambda x, i: case when i = 1 then -1.0 else least(2.0, x) end) as near from d join w using (label) where d.r = 1 and quota > 0
  union all select g.label, d.r, g.pick + 1, quota, list_transform(list_zip(g.near, d.d), lambda z, i: case when i = d.r or z[1] < 0 then -1.0 else least(z[1], z[2]) end) from g join d on d.label = g.label and d.r = list_position(g.near, list_max(g.near)) where g.pick + 1 < g.quota)
select vec_id, pick::double as pick from g join d on d.label = g.label and d.r = g.at""")
def stratified_fps(spark, d):
    e = vectors(spark, d)
    quotas = allocators.water_level(e.groupBy("label").agg(F.count("*").alias("n")), "n", F.lit(60), ["label"]).select("label", "quota")
    return s.stratified_farthest(e, ["label"], "vec_id", "embedding", quotas)


@query("inverse_density_mass", f"""
with k as (select src, sqrt(greatest(2 - 2 * sim, 1e-12)) as d from ({KNN}) where rank <= 10), o as (select src, max(d) as far, avg(ln(d)) as l from k group by src), x as (select 1 / avg(ln(far) - l) as dim from o), m as (select src, pow(far, dim) as m from o, x)
select src as vec_id, round(m / (select sum(m) from m) * 100.0, 9) as mass from m""")
def inverse_density_mass(spark, d):
    return s.inverse_density_mass(vectors(spark, d), "vec_id", "embedding", 10, 100.0).withColumn("mass", F.round("mass", 9))
