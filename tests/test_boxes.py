import random

import pytest
from leafmill.operators import evidence, ranking
from leafmill.operators.joins import overlap
from pyspark.sql import functions as F


def plainly(true, found):
    """Every pair of a page."""
    t = true.select("page", F.col("id").alias("tid"), "x0", "y0", "x1", "y1")
    f = found.select("page", "id", "source", *[F.col(c).alias(f"f{c}") for c in ("x0", "y0", "x1", "y1")])
    met = t.join(f, "page").withColumn("s", overlap(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "fx0", "fy0", "fx1", "fy1")]))
    out = {}
    for r in found.groupBy("source").count().collect():
        mine = met.filter(F.col("source") == r.source)
        out[r.source] = (true.count(), mine.filter("s > 0.5").select("page", "tid").distinct().count(), r["count"], r["count"] - mine.filter("s > 0").select("page", "id").distinct().count())
    return out


BOXES = "page long, id long, x0 double, y0 double, x1 double, y1 double, source string"


@pytest.mark.parametrize("odd", [False, True])
def test_boxes_in_a_grid_equal_all_pairs(spark, odd):
    rng = random.Random(11)

    def box(i):
        x, y = rng.uniform(-50, 50), rng.uniform(-50, 50)
        c = [x, y, x + rng.choice([0, 1, 3, 10, -2]), y + rng.choice([0.5, 2, 8])]
        if odd and rng.random() < 0.15:
            c[rng.randrange(4)] = rng.choice([None, float("inf"), float("-inf"), 1e300])
        return (rng.randrange(3), i, *c, rng.choice("ab"))

    true, found = (spark.createDataFrame([box(i) for i in range(250)], BOXES) for _ in range(2))
    got = {r.source: (r.boxes, r.hit, r.found, r.off_target) for r in evidence.box_match(true.drop("source"), found, "page").collect()}
    assert got == plainly(true.drop("source"), found)


def test_a_page_of_many_boxes(spark):
    """60,000 boxes on one page, equal and spread ones: 3.6 * 10**9 pairs if all met."""
    rows = spark.range(60_000).selectExpr("0L as page", "id", "if(id % 2 = 0, 5.0D, cast(id as double) * 4) as x0", "0.0D as y0", "'a' as source").selectExpr("page", "id", "x0", "y0", "x0 + 3 as x1", "y0 + 2 as y1", "source")
    r = evidence.box_match(rows.drop("source"), rows, "page").first()
    assert (r.boxes, r.hit, r.found, r.off_target) == (60_000, 60_000, 60_000, 0)


def test_blocks_of_equal_keys_do_not_hang_on_the_order_of_rows(spark):
    rows = [(i, "h", f"u{i % 5}") for i in range(40)]
    got = []
    for seed in range(6):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "page_id long, host string, url string").repartition(1 + seed % 4)
        got.append({r.page_id: r.block for r in ranking.fair_blocks(df, "host", "url", ties=["page_id"]).collect()})
    assert all(g == got[0] for g in got)
    for u in range(5):
        blocks = [got[0][i] for i in range(u, 40, 5)]
        assert blocks == sorted(blocks)
