"""Page predicates and layout numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Height over width of an A4 sheet.
SHEET = 297 / 210


def page_ok(ratio: Column, native: Column, cut: float = 0.05, least: float = 1000, sheet: float = SHEET) -> Column:
    """The page's ratio comes to the sheet's by cutting at most a share `cut` of one side, and it is sharp enough."""
    return ratio.between(sheet * (1 - cut), sheet / (1 - cut)) & (native >= least)


def crop(width: Column, height: Column, cut: float = 0.05, sheet: float = SHEET) -> Column:
    """struct(status, w, h): none where the page has the sheet's ratio, cut with the kept size, or unfit."""
    ratio = height / width
    w = F.when(ratio < sheet, height / sheet).otherwise(width)
    h = F.when(ratio > sheet, width * sheet).otherwise(height)
    fits = ratio.between(sheet * (1 - cut), sheet / (1 - cut))
    same = F.abs(ratio / sheet - 1) < 1e-3
    return F.struct(F.when(same, "none").when(fits, "cut").otherwise("unfit").alias("status"), F.when(fits & ~same, w).alias("w"), F.when(fits & ~same, h).alias("h"))


def writing_class(hw: Column, text: Column, many: int = 10, few: int = 5, some: int = 2) -> Column:
    """2 mostly handwritten, 1 filled in, 0 else; the first that holds."""
    return F.when((hw > many) & (text < few), 2).when((hw > some) & (text > many), 1).otherwise(0)


def document_class(rows: DataFrame, doc: str, cls: str, pages: str, share: float = 0.5) -> DataFrame:
    """Class of a document by the share of its pages (listed or known to exist): handwritten, filled, none."""
    n = F.greatest(F.max(pages), F.count("*"))
    of = lambda k: F.count_if(F.col(cls) == k) / n
    return rows.groupBy(doc).agg(F.when(of(2) >= share, "handwritten").when(of(1) >= share, "filled").otherwise("none").alias("class"))


def scan_flag(is_pdf: Column, kind: Column) -> Column:
    """True unless a PDF of a known class that is not scan-like."""
    return ~F.coalesce(is_pdf, F.lit(False)) | kind.isNull() | F.coalesce(kind.like("scan%"), F.lit(False))


def packed_key(doc: Column, page: Column) -> Column:
    """doc*100000+page; null where it would collide (page of 100000 and more). Joins use the pair itself."""
    return F.when(page < 100_000, doc.cast("long") * 100_000 + page)


def window_fill(fill: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Fill times the part of the window inside the unit page."""
    clip = lambda a, b: F.greatest(F.least(b, F.lit(1.0)) - F.greatest(a, F.lit(0.0)), F.lit(0.0))
    return fill * clip(x0, x1) * clip(y0, y1)


def stale(embedded: Column, pages_now: Column, pages_before: Column, most: int = 500) -> Column:
    """Redo: the embedded pages are not the first two of the file as it is, or its length changed and was short."""
    first = F.when(pages_now > 0, F.slice(F.sequence(F.lit(0), pages_now - 1), 1, 2)).otherwise(F.array().cast("array<int>"))
    return (pages_now >= 0) & ((F.sort_array(embedded) != first) | ((pages_now != pages_before) & (pages_before < most)))


def line_boxes(words: DataFrame, page: str, gap: float = 1.5) -> DataFrame:
    """Boxes of lines from word boxes (x0, y0, x1, y1): words in reading order by rows of equal middle, a new line where
    the step to the next word exceeds gap times the height."""
    height = F.col("y1") - F.col("y0")
    rows = words.withColumn("row_", F.floor((F.col("y0") + F.col("y1")) / 2 / F.greatest(F.percentile(height, F.lit(0.5)).over(Window.partitionBy(page)), F.lit(1e-9))))
    w = Window.partitionBy(page, "row_").orderBy("x0")
    new = F.coalesce((F.col("x0") - F.lag("x1").over(w) > gap * height).cast("int"), F.lit(0))
    run = rows.withColumn("new_", new).withColumn("run_", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(page, "row_", "run_").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("words")).drop("row_", "run_")


def layout_grid(blocks: DataFrame, page: str, columns: int = 6, rows: int = 8) -> DataFrame:
    """(page, n, area, grid): number and area of the blocks and a density grid of their middles; boxes in the unit page."""
    cell = (F.least(F.floor((F.col("y0") + F.col("y1")) / 2 * rows), F.lit(rows - 1)) * columns + F.least(F.floor((F.col("x0") + F.col("x1")) / 2 * columns), F.lit(columns - 1))).cast("int")
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    cells = blocks.withColumn("c_", cell).groupBy(page, "c_").agg(F.count("*").alias("k_"), F.sum(area).alias("a_"))
    g = cells.groupBy(page).agg(F.sum("k_").alias("n"), F.sum("a_").alias("area"), F.map_from_entries(F.collect_list(F.struct("c_", "k_"))).alias("m_"))
    return g.select(page, "n", "area", F.transform(F.sequence(F.lit(0), F.lit(rows * columns - 1)), lambda i: F.coalesce(F.try_element_at("m_", i), F.lit(0)) / F.col("n")).alias("grid"))


def tile_means(pixels: DataFrame, page: str, tiles: int, value: str = "ink") -> DataFrame:
    """Mean of a value in each of tiles x tiles squares of the unit page."""
    t = lambda c: F.least(F.floor(F.col(c) * tiles), F.lit(tiles - 1)).cast("int")
    return pixels.groupBy(page, t("x").alias("tx"), t("y").alias("ty")).agg(F.avg(value).alias("mean"))
