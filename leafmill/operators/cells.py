"""Exact vector searches by cells: k nearest, neighbours within a radius, pairs over a similarity.

Unit vectors of the reference side live in the cell of their nearest centre (centres are fitted on a bounded sample; they
decide the work, never the result). A cell has a radius, so the triangle inequality tells which cells a query can leave
out. Whoever looks into a cell is compared with it chunk by chunk: a chunk's vectors are held by one task, the queries
stream past it, and both sides are dealt out by one shuffle. Nothing but the centres and one row a cell reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.sources.scratch import forget, materialise

#: Vectors of a chunk; there are as many cells as chunks, up to MOST_CELLS.
CHUNK, MOST_CELLS = 4096, 1024
SAMPLE, ROUNDS = 8192, 8
#: Queries of one cell that go to one task.
SLICE = 65_536
#: Slack of distances against rounding.
EPS = 1e-6


def units(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :], 0.0))


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    rows = np.unique(x, axis=0)
    centres = rows[np.linspace(0, len(rows) - 1, min(k, len(rows))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = _distances(x, centres).argmin(axis=1)
        for c in range(len(centres)):
            if (mine := x[near == c]).size:
                centres[c] = mine.mean(axis=0)
    return centres


class Cells:
    """The reference side: id, v and by placed in cells. by: equal on both sides of a pair ("" where all may meet)."""

    def __init__(self, refs: DataFrame):
        self.spark = refs.sparkSession
        self.kind = dict(refs.dtypes)["v"]
        rows = materialise(refs.select("id", "v", "by"))
        self.n = n = rows.count()
        share = F.lit(min(1.0, SAMPLE / max(1, n)) * 1_000_000)
        sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share).select("v").limit(2 * SAMPLE).toArrow().column("v").combine_chunks() if n else []
        x = units(sample if len(sample) else rows.select("v").limit(1).toArrow().column("v").combine_chunks()) if n else np.zeros((1, 1))
        self.centres = _centres(x, int(np.clip(-(-n // CHUNK), 1, MOST_CELLS)))
        self.rows = materialise(self._mapped(rows, self._home))
        forget(rows)
        got = {r.cell: r for r in self.rows.groupBy("cell").agg(F.max("d").alias("radius"), F.count("*").alias("n")).collect()}
        self.radius = np.array([got[c].radius if c in got else -np.inf for c in range(len(self.centres))])
        self.chunks = [-(-got[c].n // CHUNK) if c in got else 0 for c in range(len(self.centres))]

    def _mapped(self, df: DataFrame, visits) -> DataFrame:
        """A row for each cell of each row of df (id, v, by, ...): visits(rows, distances, limit) -> row and cell numbers."""
        if not self.n:
            return self.spark.createDataFrame([], f"id long, v {self.kind}, by string, cell int, d double")
        centres = self.spark.sparkContext.broadcast(self.centres)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 2048):
                    batch = whole.slice(at, 2048)
                    d = _distances(units(batch.column(1)), centres.value)
                    limit = batch.column(3).to_numpy(zero_copy_only=False) if batch.num_columns > 3 else None
                    row, cell = visits(d, limit)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([batch.column(c).take(take) for c in range(3)] + [pa.array(cell.astype(np.int32)), pa.array(d[row, cell])], names=["id", "v", "by", "cell", "d"])

        return df.mapInArrow(run, f"id long, v {self.kind}, by string, cell int, d double")

    @staticmethod
    def _home(d: np.ndarray, _) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(d)), d.argmin(axis=1)

    def nearest_cell(self, queries: DataFrame) -> DataFrame:
        """Each query in the nearest cell that has references."""
        empty = np.array(self.chunks) == 0

        def visits(d, _):
            return np.arange(len(d)), np.where(empty[None, :], np.inf, d).argmin(axis=1)

        return self._mapped(queries.select("id", "v", "by"), visits)

    def within(self, queries: DataFrame, done: bool) -> DataFrame:
        """Each query (id, v, by, limit) in every cell that can hold something within its limit; done: but the nearest."""
        empty, radius = np.array(self.chunks) == 0, self.radius

        def visits(d, limit):
            ok = (d - radius[None, :] <= limit[:, None] + EPS) & ~empty[None, :]
            if done:
                ok[np.arange(len(d)), np.where(empty[None, :], np.inf, d).argmin(axis=1)] = False
            return np.nonzero(ok)

        return self._mapped(queries.select("id", "v", "by", "limit"), visits)

    def met(self, looking: DataFrame, compare, schema: str) -> DataFrame:
        """compare(query ids, query units, reference ids, reference units) -> batch, for every query in a cell and every
        chunk of it with the same `by`."""
        looking = materialise(looking)
        sizes = looking.groupBy(F.col("cell").alias("cell_"), F.col("by").alias("by_")).agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
        chunks = F.array(*[F.lit(max(1, c)) for c in self.chunks])
        per = F.element_at(chunks, F.col("cell") + 1)
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        group = F.xxhash64("by", "cell", "chunk", "slice").alias("group")
        asked = looking.join(sizes, (F.col("cell") == F.col("cell_")) & F.col("by").eqNullSafe(F.col("by_")))
        asked = asked.withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int")).withColumn("chunk", every(per)).select(group, F.lit(1).alias("asks"), "id", "v")
        held = self.rows.join(sizes, (F.col("cell") == F.col("cell_")) & F.col("by").eqNullSafe(F.col("by_")))
        held = held.withColumn("chunk", F.pmod(F.xxhash64("id"), per).cast("int")).withColumn("slice", every(F.col("slices"))).select(group, F.lit(0).alias("asks"), "id", "v")
        parts = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, ids, x, parts_ = None, None, None, []
            for batch in batches:
                keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)], axis=1)
                cuts = np.concatenate([[0], np.nonzero((np.diff(keys, axis=0) != 0).any(axis=1))[0] + 1, [len(keys)]]) if len(keys) else [0]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if keys[a, 0] != here:
                        here, ids, x, parts_ = keys[a, 0], None, None, []
                    part = batch.slice(a, b - a)
                    if not keys[a, 1]:
                        parts_.append(part)
                        continue
                    if parts_:
                        whole = pa.Table.from_batches(parts_)
                        ids, x, parts_ = whole.column("id").to_numpy(), units(whole.column("v").combine_chunks()), []
                        order = np.argsort(ids, kind="stable")
                        ids, x = ids[order], x[order]
                    if ids is None:
                        continue
                    for at in range(0, part.num_rows, 512):
                        some = part.slice(at, 512)
                        yield compare(some.column(2).to_numpy(), units(some.column(3)), ids, x)

        return asked.unionAll(held).repartition(parts, "group").sortWithinPartitions("group", "asks").mapInArrow(run, schema)


def _rows(df: DataFrame, id_col: str, vector: str, by: str | None = None, kind: str = "array<double>") -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast(kind).alias("v"), (F.lit("") if by is None else F.col(by).cast("string")).alias("by"))


def _kind(*tables: tuple[DataFrame, str]) -> str:
    """Vectors of equal type keep it on the way; others meet as doubles."""
    kinds = {dict(df.dtypes)[v] for df, v in tables}
    return kinds.pop() if len(kinds) == 1 else "array<double>"


def k_nearest(queries: DataFrame, refs: DataFrame, id_col: str, vector: str, k: int, drop_self: bool = True) -> DataFrame:
    """(src, rank, dst, similarity): the k most similar references of each query by cosine, ties by reference id.

    Two rounds: the k best of the query's own cell bound how far the others can be, then every cell that can hold one as
    near is searched. Exact whatever the cells; the nearer the neighbours, the fewer cells are searched."""
    kind = _kind((queries, vector), (refs, vector))
    cells, asks = Cells(_rows(refs, id_col, vector, kind=kind)), _rows(queries, id_col, vector, kind=kind)

    def best(src: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        sims = np.round(q @ x.T, 12)
        if drop_self:
            sims[src[:, None] == ids[None, :]] = -np.inf
        m = min(k, sims.shape[1])
        top = np.argsort(-sims, axis=1, kind="stable")[:, :m]
        found = np.take_along_axis(sims, top, axis=1)
        fine = np.isfinite(found)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(src, m)[fine.ravel()]), pa.array(ids[top][fine]), pa.array(found[fine])], names=["src", "dst", "similarity"])

    schema = "src long, dst long, similarity double"
    w = Window.partitionBy("src").orderBy(F.desc("similarity"), "dst")
    merged = lambda found: found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    first = cells.met(cells.nearest_cell(asks), best, schema)
    if len(cells.centres) == 1:
        return merged(first).select("src", "rank", "dst", "similarity")
    first = materialise(merged(first))
    limit = first.filter(F.col("rank") == k).select(F.col("src").alias("src_"), F.sqrt(F.greatest(2 - 2 * F.col("similarity"), F.lit(0.0))).alias("limit"))
    more = asks.join(limit, F.col("id") == F.col("src_"), "left").withColumn("limit", F.coalesce("limit", F.lit(4.0)))
    second = cells.met(cells.within(more, True), best, schema)
    return merged(first.drop("rank").unionAll(second)).select("src", "rank", "dst", "similarity")


def counts_within(queries: DataFrame, refs: DataFrame, id_col: str, vector: str, r: float) -> DataFrame:
    """(id, near): number of references within cosine distance r of each query, the border left out."""
    kind = _kind((queries, vector), (refs, vector))
    cells, asks = Cells(_rows(refs, id_col, vector, kind=kind)), _rows(queries, id_col, vector, kind=kind)

    def count(src: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(src), pa.array((np.round(q @ x.T, 12) > 1 - r).sum(axis=1).astype(np.int64))], names=["src", "near"])

    looking = cells.within(asks.withColumn("limit", F.lit(float(np.sqrt(max(0.0, 2 * r))))), False)
    found = cells.met(looking, count, "src long, near long").groupBy("src").agg(F.sum("near").alias("near"))
    return queries.select(id_col).join(found, F.col(id_col) == F.col("src"), "left").select(id_col, F.coalesce("near", F.lit(0)).alias("near"))


def similar_pairs(df: DataFrame, id_col: str, vector: str, similarity: float, by: str | None = None) -> DataFrame:
    """(a, b): different rows of one `by` whose cosine exceeds `similarity`, in both orders. A null `by` meets nobody."""
    rows = _rows(df, id_col, vector, by, dict(df.dtypes)[vector]).filter("by is not null and v is not null")
    cells = Cells(rows)

    def over(src: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        i, j = np.nonzero(q @ x.T > similarity)
        a, b = src[i], ids[j]
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    looking = cells.within(rows.withColumn("limit", F.lit(float(np.sqrt(max(0.0, 2 - 2 * similarity))))), False)
    return cells.met(looking, over, "a long, b long")
