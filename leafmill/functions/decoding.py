"""Table-driven decoding of text in legacy encodings. Tables are inputs; none are kept here."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from leafmill.sources.scratch import materialise

#: Vowel signs written before their consonant but spoken after it, by block; text keeps them behind.
PREFIX_SIGNS = "िিেৈਿિେୈெேைെേൈ"
FORMS = regex.compile(r"[ﭐ-﷿ﹰ-ﻼ]")
#: Arabic lam and alef that extraction has put in the wrong order.
TURNED = regex.compile(r"(?<=\b)([اأإآ])(ل)(?=[اأإآ])")


def normal_font(name: Column) -> Column:
    """Font name without subset tag, style and marks, by which tables are routed."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.regexp_replace(name, r"^[A-Z]{6}\+", "")), r"(regular|normal|bold|italic|oblique|mt)", ""), r"[^a-z0-9]", "")


def route(rows: DataFrame, font: str, routes: DataFrame) -> DataFrame:
    """rows with kind and argument of their font; routes: (family, kind, argument). A font without its own route takes
    that of the longest family its name begins with."""
    named = rows.withColumn("f_", normal_font(F.col(font)))
    fonts = named.select("f_").distinct()
    met = fonts.join(F.broadcast(routes), F.col("f_").startswith(F.col("family"))).groupBy("f_").agg(F.max_by(F.struct("kind", "argument"), F.length("family")).alias("r_"))
    return named.join(met, "f_", "left").select(*rows.columns, "r_.kind", "r_.argument")


def decoder(table: dict[str, str]):
    """Longest-match replacement by a table, as a column function; characters outside the table stay."""
    single = all(len(k) == 1 and len(v) == 1 for k, v in table.items())
    if single:
        return lambda text: F.translate(text, "".join(table), "".join(table.values()))
    pattern = regex.compile("|".join(map(regex.escape, sorted(table, key=len, reverse=True))))

    @pandas_udf("string")
    def decode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda t: pattern.sub(lambda m: table[m.group()], t), na_action="ignore")

    return decode


def spoken_order(text: Column) -> Column:
    """Signs written before a consonant moved behind its cluster."""
    return F.regexp_replace(text, rf"([{PREFIX_SIGNS}])(\p{{Lo}}(?:[्্੍્୍்്]\p{{Lo}})*)", "$2$1")


def reversed_keeping_numbers(text: Column) -> Column:
    """A visual right-to-left run in logical order; numbers keep their own direction."""
    pieces = F.regexp_extract_all(text, F.lit(r"\p{Nd}+(?:[.,:/]\p{Nd}+)*|(?s)."), F.lit(0))
    return F.array_join(F.reverse(pieces), "")


def repaired(text: Column) -> Column:
    """UTF-8 read as Latin-1 or Windows-1252 read back, presentation forms composed, turned lam-alef put right."""

    def one(t: str) -> str:
        if not t.isascii():
            for code in ("cp1252", "latin-1"):
                try:
                    t = t.encode(code).decode("utf-8")
                    break
                except (UnicodeEncodeError, UnicodeDecodeError):
                    continue
        if FORMS.search(t):
            t = unicodedata.normalize("NFKC", t)
        return TURNED.sub(r"\2\1", t)

    @pandas_udf("string")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(one, na_action="ignore")

    return run(text)


def table_agreement(traces: DataFrame, tables: DataFrame, by: list[str], least: float = 0.9, codes: int = 8) -> DataFrame:
    """For each font the table that agrees best with its traces (code, read) on enough codes; tables: (table, code, text)."""
    met = traces.join(tables, "code").groupBy(*by, "table").agg(F.avg((F.col("read") == F.col("text")).cast("double")).alias("share"), F.countDistinct("code").alias("codes"))
    good = met.filter((F.col("share") >= least) & (F.col("codes") >= codes))
    return good.groupBy(*by).agg(F.max_by("table", F.struct("share", "codes", "table")).alias("table"), F.max("share").alias("share"))


def code_page(name: str) -> dict[str, str]:
    """The table of an 8-bit code page for text whose bytes were read as Latin-1; bytes without a character stay."""
    found = {chr(b): bytes([b]).decode(name, "ignore") for b in range(128, 256)}
    return {k: v for k, v in found.items() if v and v != k}


def chained(text: Column, steps) -> Column:
    """Several decoders one after the other: (kind, argument) with kind table (a dict), page (an 8-bit code page whose
    bytes were read as Latin-1), spoken or reversed."""
    for kind, argument in steps:
        if kind == "table":
            text = decoder(argument)(text)
        elif kind == "page":
            text = decoder(code_page(argument))(text)
        elif kind == "spoken":
            text = spoken_order(text)
        elif kind == "reversed":
            text = reversed_keeping_numbers(text)
        else:
            raise ValueError(f"no decoder {kind}")
    return text


def likeliest_table(samples: DataFrame, tables: DataFrame, model, by: str, text: str, lang: str) -> DataFrame:
    """(by, table, mean): of the candidate tables (table, code, text) that which makes the samples the likeliest text of
    their language by a character model; codes outside a table stay as they are."""
    keyed = samples.select(F.col(by).alias("b_"), F.col(lang).alias("l_"), F.col(text).alias("t_"), F.monotonically_increasing_id().alias("i_"))
    letters = keyed.select("*", F.posexplode(F.split("t_", "")).alias("at", "code")).filter("code <> ''")
    names = tables.select("table").distinct()
    met = letters.crossJoin(F.broadcast(names)).join(tables.withColumnRenamed("text", "to_"), ["table", "code"], "left")
    made = met.groupBy("b_", "l_", "i_", "table").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("to_", "code").alias("c")))), lambda x: x["c"]), "").alias("made"))
    rows = made.withColumn("k_", F.struct("b_", "i_", "table"))
    scored = model.score(rows, "k_", "made", "l_").groupBy("k_.b_", "k_.table").agg(F.avg("mean").alias("mean"))
    return scored.groupBy(F.col("b_").alias(by)).agg(F.max_by("table", F.struct("mean", "table")).alias("table"), F.max("mean").alias("mean"))


def decoding_audit(decoded: DataFrame, by: str, text: str) -> DataFrame:
    """(by, texts, characters, broken, marks_first): how much a font's texts hold that no decoder should leave."""
    n = lambda p: F.sum(F.regexp_count(F.col(text), F.lit(p)))
    return decoded.groupBy(by).agg(F.count(text).alias("texts"), F.sum(F.length(text)).alias("characters"), n(r"[\p{Co}\x{FFFD}]").alias("broken"), n(r"(?:^|[^\p{L}\p{M}])\p{M}").alias("marks_first"))


def coverage_class(texts: DataFrame, lang: str, text: str, glyphs: DataFrame, full: float = 1.0, usable: float = 0.98) -> DataFrame:
    """(lang, share, class, missing): share of a language's characters, by frequency, that a set of glyphs (lang, ch) has;
    full, usable or partial; and the characters that it lacks, the most frequent first."""
    chars = texts.select(F.col(lang).alias("l_"), F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?s)[^ \t\n\r\f\x0B]"), F.lit(0))).alias("ch")).groupBy("l_", "ch").agg(F.count("*").alias("n"))
    met = chars.join(glyphs.select(F.col(lang).alias("l_"), "ch", F.lit(True).alias("has")).distinct(), ["l_", "ch"], "left")
    out = met.groupBy("l_").agg((F.coalesce(F.sum(F.when(F.col("has"), F.col("n"))), F.lit(0)) / F.sum("n")).alias("share"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("has").isNull(), F.struct((-F.col("n")).alias("n"), "ch")))), lambda x: x["ch"]), "").alias("missing"))
    kind = F.when(F.col("share") >= full, "full").when(F.col("share") >= usable, "usable").otherwise("partial")
    return out.select(F.col("l_").alias(lang), "share", kind.alias("class"), "missing")


def nearest_shapes(glyphs: DataFrame, known: DataFrame, key: str, bitmap: str, label: str, least: float = 0.8) -> DataFrame:
    """(key, label, score): the known glyph whose shape agrees best: shared ink over all ink of two bitmaps of equal size,
    given as sorted arrays of the numbers of inked cells.

    Equal bitmaps are compared once, the known one under its last label. Two of score t share one of the n - ceil(t n) + 1
    rarest cells of the smaller's or larger's n, so shapes meet by those alone; then all cells are compared."""
    t = Fraction(str(least))
    a = glyphs.select(F.col(key).alias("k_"), F.col(bitmap).alias("a_"))
    b = known.filter(F.col(label).isNotNull()).groupBy(F.col(bitmap).alias("b_")).agg(F.max(label).alias("x_"))
    shapes = materialise(a.select(F.col("a_").alias("s_")).filter("s_ is not null").distinct())
    b = materialise(b.filter("b_ is not null"))
    often = b.select(F.explode("b_").alias("c_")).groupBy("c_").agg(F.count("*").alias("n_"))

    def firsts(rows: DataFrame, name: str) -> DataFrame:
        size = F.size(name)
        share = F.floor((size * t.numerator + (t.denominator - 1)) / F.lit(t.denominator))
        met = rows.select(name, F.explode(name).alias("c_")).join(often, "c_", "left").groupBy(name).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n_", F.lit(0)).alias("n"), "c_"))).alias("o_"))
        return met.select(name, F.explode(F.slice("o_", F.lit(1), F.greatest(size - share + 1, F.lit(0)).cast("int"))).alias("o_")).select(name, F.col("o_.c_").alias("c_"))

    pairs = firsts(shapes, "s_").join(firsts(b.select("b_"), "b_"), "c_").select("s_", "b_").distinct()
    both = F.size(F.filter(F.array_intersect("s_", "b_"), lambda c: c.isNotNull()))
    scored = pairs.withColumn("both", both).withColumn("score", F.col("both") / (F.size("s_") + F.size("b_") - F.col("both"))).filter((F.col("both") > 0) & (F.col("score") >= least))
    best = scored.join(b, "b_").groupBy("s_").agg(F.max_by("x_", F.struct("score", "x_")).alias(label), F.max("score").alias("score"))
    return a.join(best, F.col("a_") == F.col("s_")).select(F.col("k_").alias(key), label, "score")
