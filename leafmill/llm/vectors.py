"""Embedding near-duplicates by an inverted multi-index.

Each half of a unit vector has its own codebook; the pairs of codes form a grid of cells. A vector lives in one cell and
looks into the cells that the multi-sequence traversal (by the sum of both halves' distances) reaches first, as many as
a sample says are needed for the target recall. Whatever is met there is verified by its cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import materialise, maybe_broadcast, table
from leafmill.llm.components import components
from leafmill.llm.simhash import least_labels

THRESHOLD = 0.93
#: The codebooks and the number of visited cells are fitted on about so many vectors at most.
SAMPLE = 4096
#: Codes of each half: the root of the number of chunks that the vectors fill, within these bounds.
CODES = 12
MOST_CODES = 256
#: Share of the sample's pairs at the threshold that the traversal must meet, from either side.
TARGET_RECALL = 0.99
#: A cell is compared in chunks of about so many vectors.
CHUNK = 1024
ROUNDS = 12
#: Sums of distances that are held at a time.
SUMS = 2_000_000


def _halves(x: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of vectors cut or zero-filled to an even dim."""
    if x.shape[1] < dim:
        x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    return x[:, : dim // 2], x[:, dim // 2 : dim]


def _codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm from k distinct rows."""
    rows = np.unique(x, axis=0)
    centres = rows[rng.choice(len(rows), size=min(k, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _square_distances(x, centres).argmin(axis=1)
        for c in range(len(centres)):
            if (mine := x[near == c]).size:
                centres[c] = mine.mean(axis=0)
    return centres


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :]


def traverse(da: np.ndarray, db: np.ndarray, cells: int) -> np.ndarray:
    """(rows, cells) numbers of the cells (code of a * codes of b + code of b) that the multi-sequence traversal of each
    row's two distance lists reaches first, in order of da[i] + db[j].

    The traversal takes the pair of places (p, q) in the sorted lists only after all pairs at or before both, which
    are (p + 1) * (q + 1). So the first `cells` are among the pairs with (p + 1) * (q + 1) <= cells, some cells * ln(cells)
    of them whatever the size of the grid; those sums are formed and put in order."""
    k, m = da.shape[1], db.shape[1]
    cells = min(cells, k * m)
    oa, ob = (np.argsort(d, axis=1, kind="stable")[:, :cells] for d in (da, db))
    sa, sb = np.take_along_axis(da, oa, axis=1), np.take_along_axis(db, ob, axis=1)
    p = np.repeat(np.arange(sa.shape[1]), [min(sb.shape[1], cells // (i + 1)) for i in range(sa.shape[1])])
    q = np.arange(len(p)) - np.searchsorted(p, p)
    out = np.empty((len(da), cells), dtype=np.int64)
    step = max(1, SUMS // len(p))
    for at in range(0, len(da), step):
        here = slice(at, at + step)
        sums = sa[here][:, p] + sb[here][:, q]
        order = np.argsort(sums, axis=1, kind="stable")[:, :cells]
        out[here] = np.take_along_axis(oa[here], p[order], axis=1) * m + np.take_along_axis(ob[here], q[order], axis=1)
    return out


def reached_at(da: np.ndarray, db: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each row the place at which the traversal reaches its cell (i, j): pairs with a smaller sum, counted code by
    code, so no grid is formed. Of sums that are equal to rounding all count."""
    sb, sums = np.sort(db, axis=1), da[np.arange(len(da)), i] + db[np.arange(len(db)), j]
    return np.array([np.searchsorted(b, s - a + 1e-12 * abs(s), side="right").sum() for a, b, s in zip(da, sb, sums, strict=True)]) - 1


@dataclass
class MultiIndex:
    a: np.ndarray
    b: np.ndarray
    dim: int
    cells: int = 1

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ha, hb = _halves(x, self.dim)
        return _square_distances(ha, self.a), _square_distances(hb, self.b)

    def visited(self, x: np.ndarray) -> np.ndarray:
        """(rows, cells) cells by number in the order of the traversal, the nearest first."""
        return traverse(*self.distances(x), self.cells)


def fit(sample: np.ndarray, threshold: float = THRESHOLD, codes: int = CODES, target: float = TARGET_RECALL, seed: int = 7) -> MultiIndex:
    """sample: unit rows. The number of cells to visit is the least at which `target` of the made-up pairs exactly at
    the threshold (a sample row and the same row turned in a random direction) meet; closer pairs meet earlier."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] + sample.shape[1] % 2
    ha, hb = _halves(sample, dim)
    index = MultiIndex(_codebook(ha, codes, rng), _codebook(hb, codes, rng), dim)
    noise = rng.standard_normal(sample.shape)
    noise -= (noise * sample).sum(axis=1, keepdims=True) * sample
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    turned = threshold * sample + np.sqrt(max(0.0, 1 - threshold**2)) * noise
    (ma, mb), (ta, tb) = index.distances(sample), index.distances(turned)
    there = reached_at(ma, mb, ta.argmin(axis=1), tb.argmin(axis=1))
    back = reached_at(ta, tb, ma.argmin(axis=1), mb.argmin(axis=1))
    index.cells = min(len(index.a) * len(index.b), int(np.quantile(np.minimum(there, back), target, method="higher")) + 1)
    return index


def _unit(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows in double precision of equally long lists without nulls, and which of them are finite and not zero."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    fine = np.isfinite(x).all(axis=1)
    x = np.where(fine[:, None], x, 0.0)
    scale = np.abs(x).max(axis=1, initial=0.0)
    fine &= scale > 0
    x = x / np.where(fine, scale, 1.0)[:, None]
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1.0)[:, None], fine


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    lengths = np.fromiter((len(v) for v in batch.column(column)), dtype=np.int64, count=batch.num_rows)
    for n in np.unique(lengths):
        yield batch.take(pa.array(np.nonzero(lengths == n)[0]))


def _look(index: MultiIndex):
    """(rep, label, embedding) -> one row per visited cell; home is the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole, 2):
                x, fine = _unit(batch.column(2))
                rows = np.nonzero(fine)[0]
                if not len(rows):
                    continue
                cells = index.visited(x[rows]).astype(np.int32)
                n = cells.shape[1]
                at = np.repeat(rows, n)
                # The list of cells goes with the row at home only, so that it is sent once.
                sizes = np.zeros(cells.size, dtype=np.int32)
                sizes[::n] = n
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(cells.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1], dtype=np.int32)), pa.array(cells.reshape(-1)),
                     pa.array(np.repeat(cells[:, 0], n)), batch.column(2).take(pa.array(at)), lists, batch.column(3).take(pa.array(at))],
                    names=["rep", "label", "dim", "cell", "home", "v", "visits", "copies"],
                )

    return run


def _verify(threshold: float):
    """Rows sorted by group (label, length, cell, chunk): those at home there, each once, and those looking in."""

    def block(columns) -> Iterator[pa.RecordBatch]:
        rep, lives, home, copies = (columns[k].to_numpy(zero_copy_only=False) for k in ("rep", "lives", "home", "copies"))
        i, q = np.nonzero(lives)[0], np.nonzero(columns["looks"].to_numpy(zero_copy_only=False))[0]
        if not len(i) or not len(q):
            return
        x, _ = _unit(columns["v"].combine_chunks())
        seen = columns["visits"].combine_chunks().take(pa.array(i)).flatten().to_numpy(zero_copy_only=False).reshape(len(i), -1)
        ids, ends, sums = [], [], []
        for s in range(0, len(q), 1024):
            part = q[s : s + 1024]
            r, c = np.nonzero((x[part] @ x[i].T) >= threshold)
            other = rep[part[r]] != rep[i[c]]
            r, c = part[r[other]], c[other]
            if not len(r):
                continue
            # Both see each other unless the one at home here does not visit the other's home; then its link is counted here.
            step = max(1, SUMS // seen.shape[1])
            alone = np.concatenate([~(seen[c[k : k + step]] == home[r[k : k + step]][:, None]).any(axis=1) for k in range(0, len(c), step)])
            c = i[c]
            ids += [rep[r], rep[c[alone]]]
            sums += [copies[c], copies[r[alone]]]
            nodes, places = np.unique(np.concatenate([rep[r], rep[c]]), return_inverse=True)
            label = least_labels(len(nodes), places[: len(r)], places[len(r) :])
            moved = np.nonzero(label != np.arange(len(nodes)))[0]
            ends.append((nodes[label[moved]], nodes[moved]))
        if ids:
            who, place = np.unique(np.concatenate(ids), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate(sums)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.nulls(len(who), pa.int64()), pa.array(n)], names=["a", "b", "n"])
        for a, b in ends:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), dtype=np.int64))], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.nonzero(np.diff(groups))[0] + 1, [len(groups)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if groups[a] != last and held:
                    yield from block(pa.Table.from_batches(held))
                    held = []
                last = groups[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from block(pa.Table.from_batches(held))

    return run


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, index: MultiIndex | None = None) -> DataFrame:
    """One row per row of rows: id, n_links (other rows linked directly), component (least id reachable), kept.

    Rows link if their labels are equal and not null, their vectors equally long and their cosine reaches the threshold.
    Equal vectors of a label are one node with a number of copies, whose links are multiplied, so copies are never
    paired. Null vectors, zero vectors and those with null or non-finite components, and rows of null id or label,
    link with nothing. Repeated rows of one id count as copies of each other. An empty table gives no rows. A crowded
    cell is cut into chunks by a hash of the id, and whoever looks into the cell looks into every chunk."""
    spark = rows.sparkSession
    base = materialise(rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")))
    usable = base.filter("id is not null and label is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null)")
    nodes = materialise(usable.groupBy("label", "v").agg(F.min("id").alias("rep0"), F.count("*").alias("copies")))
    # An id that comes twice with different vectors or labels would name two nodes; the second gets a number below all ids.
    clash = nodes.groupBy("rep0").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count() > 0
    if clash:
        nodes = materialise(nodes.withColumn("rep", F.expr("case when row_number() over (partition by rep0 order by label, v) = 1 then rep0 else bigint(-9000000000000000000) + abs(xxhash64(label, v) % 4000000000000000000) end")))
    else:
        nodes = nodes.withColumn("rep", F.col("rep0"))
    if index is None:
        size = nodes.count()
        chosen = nodes.filter(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < F.lit(min(1.0, SAMPLE / max(1, size)) * 1_000_000)).select("v").limit(2 * SAMPLE).collect()
        longest = max((len(r.v) for r in chosen), default=0)
        sample, fine = _unit(pa.array([list(map(float, r.v)) + [0.0] * (longest - len(r.v)) for r in chosen], pa.list_(pa.float64()))) if chosen else (np.zeros((0, 2)), np.zeros(0, dtype=bool))
        sample = sample[fine]
        index = fit(sample if len(sample) else np.eye(2), threshold, int(np.clip((size / CHUNK) ** 0.5, CODES, MOST_CODES)))
    looks = materialise(nodes.select("rep", "label", "v", "copies").mapInArrow(_look(index), f"rep long, label {dict(base.dtypes)['label']}, dim int, cell int, home int, v {dict(base.dtypes)['v']}, visits array<int>, copies long"))
    crowd = looks.filter("cell = home").groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    cut = looks.join(maybe_broadcast(materialise(crowd)), ["label", "dim", "cell"])
    # A crowded cell is a grid: its residents in chunks, those looking in in as many slices, each pair of them one group.
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    at_home = (F.col("cell") == F.col("home")) & (F.col("chunk") == F.col("own"))
    placed = cut.withColumn("own", own).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    sliced = placed.withColumn("slice", F.explode(F.when(at_home, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array("own"))))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    group = F.xxhash64("label", "dim", "cell", "chunk", "slice").alias("group")
    met = sliced.select(group, "rep", at_home.alias("lives"), (F.col("slice") == F.col("own")).alias("looks"), "home", "copies", "v", F.when(at_home, F.col("visits")).alias("visits"))
    found = materialise(met.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_verify(threshold), "a long, b long, n long"))
    linked = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(found.filter("b is not null").select("a", "b"))
    whole = nodes.join(linked, "rep", "left").join(groups, nodes["rep"] == groups["node"], "left")
    # A component is named by the least real id in it.
    named = whole.withColumn("root", F.coalesce("component", "rep"))
    least = named.groupBy("root").agg(F.min("rep0").alias("component_id"))
    state = named.join(least, "root").select(F.col("label").alias("label_"), F.col("v").alias("v_"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "component_id")
    lone = base.join(state, (base["label"] == state["label_"]) & (base["v"] == state["v_"]), "left")
    fine = F.coalesce(F.col("n_links"), F.lit(0)).cast("long")
    bad = F.expr("not exists(v, x -> x is not null and x != 0) or exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    usable_row = F.col("component_id").isNotNull() & F.col("id").isNotNull() & ~F.coalesce(bad, F.lit(True))
    component = F.when(usable_row, F.col("component_id")).otherwise(F.col("id"))
    return lone.select(F.col("id").alias(id_col), F.when(usable_row, fine).otherwise(F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: All pairs of a label, and the least id reachable.
OP9_SQL = r"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings),
p as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.93),
r as (select vec_id as a, vec_id as b from v union select r.a, p.b from r join p on r.b = p.a),
c as (select a, min(b) as component_id from r group by a),
n as (select a, count(*) as n from p group by a)
select vec_id, cast(coalesce(n.n, 0) as bigint) as n_links, component_id, vec_id = component_id as kept
from v join c on c.a = v.vec_id left join n on n.a = v.vec_id
"""
