"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from functools import reduce

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import SPACE, WORD, table

#: Function words by language; prose holds some of them.
STOP_WORDS = {
    "en": "the of and to in a is that for it with as on be by this are".split(),
    "de": "der die und den von zu das mit sich des auf ist ein eine nicht in".split(),
    "fr": "le la les et de du un une que est pour qui dans en des au".split(),
    "es": "el la los de y en del se las por con no una para su al que un".split(),
}
WINDOW = 5
#: A shorter text may lack stop words.
STOP_FROM = 50
ELLIPSIS = r"(?:\.\.\.|…)[\x20\x09-\x0D]*\z"
BULLET = r"^[\x20\x09-\x0D]*[-*•●]"

#: What may not be kept whatever the method says: (feature, relation a kept text satisfies, threshold).
BASE_RULES = (("n_words", ">=", 10), ("repeat_percent", "<=", 20))
#: The method's own verdict.
RULES = (
    ("mean_word_chars", ">=", 2.0),
    ("mean_word_chars", "<=", 15.0),
    ("symbol_ratio", "<=", 0.1),
    ("upper_ratio", "<=", 0.6),
    ("dup_line_ratio", "<=", 0.5),
    ("bullet_line_ratio", "<=", 0.9),
    ("ellipsis_line_ratio", "<=", 0.5),
    ("stop_word_ratio", ">=", 0.002),
)
RELATIONS = {">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}


def compile_rules(rules) -> Column:
    """The table as one condition; a ratio without a denominator (null) breaks no rule."""
    tests = [F.coalesce(RELATIONS[relation](F.col(name), F.lit(threshold)), F.lit(True)) for name, relation, threshold in rules]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _counts(text: Column) -> dict[str, Column]:
    """Counts that a pattern or a replacement finds in one pass over the text, and the two arrays."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    bare = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), (" ", "\n", "\t", "\r", "\x0b", "\x0c"), text)
    return {
        "words_": F.array_remove(F.split(text, SPACE + "+"), ""),
        "lines_": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": count("[#*$%&|<>]"),
        "n_upper_": count(r"\p{Lu}"),
    }


def _of_arrays() -> dict[str, Column]:
    return {
        "n_words": F.size("words_").cast("long"),
        "n_lines_": F.size("lines_").cast("long"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
        "n_bullets_": F.size(F.filter("lines_", lambda x: x.rlike(BULLET))).cast("long"),
        "n_ellipses_": F.size(F.filter("lines_", lambda x: x.rlike(ELLIPSIS))).cast("long"),
        "hashes_": F.transform("words_", lambda x: F.xxhash64(x)),
    }


def every_word(stop_words=STOP_WORDS) -> list[str]:
    return sorted({w for words in stop_words.values() for w in words})


def stop_forms(words) -> list[str]:
    """A stop word as it stands in text: lower, capitalised or upper case, with one mark behind it or none."""
    cases = dict.fromkeys(f for w in words for f in (w, w.capitalize(), w.upper()))
    return [w + mark for w in cases for mark in ("", *".,;:!?")]


def _n_stop(stop_words: dict[str, list[str]]) -> Column:
    """Stop words of the text's language; of all languages where it is null; null if the language has no list."""

    def count(words) -> Column:
        known = [xxhash.xxh64_intdigest(w, seed=42) for w in stop_forms(words)]
        known = [h - (1 << 64) if h >> 63 else h for h in known]
        return F.size(F.filter("hashes_", lambda h: h.isin(known))).cast("long")

    found = F.when(F.col("lang_").isNull(), count(every_word(stop_words)))
    for lang, words in stop_words.items():
        found = found.when(F.col("lang_") == lang, count(words))
    return found


def _windows() -> Column:
    """A 64-bit hash for each window of words, in order; none for a text shorter than a window."""
    starts = F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW)
    hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes_", i + k) for k in range(WINDOW)]))
    return F.when(F.col("n_words") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))


def _placed(windows: str) -> Column:
    """The windows as (hash, place), sorted so that equal ones are neighbours; null if all differ."""
    placed = F.sort_array(F.transform(F.col(windows), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed)


def measure(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str | None = None, stop_words: dict[str, list[str]] = STOP_WORDS) -> DataFrame:
    """The features of every text, whole, beside its id (docs' other columns are dropped, whatever their names).

    Stop words are those of the language that lang_col names, without it or where it is null those of all languages; a
    language without a list has a null ratio, which breaks no rule.

    Nothing is shuffled: a text is split into words once and all counts come from that row. Windows are compared
    by 64-bit hashes inside one text, in time n log n of its words. A null text counts as empty: zeros and null ratios."""
    ratio = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    a = docs.select(F.col(id_col), lang.alias("lang_"), *[c.alias(k) for k, c in _counts(text).items()])
    b = a.select("*", *[c.alias(k) for k, c in _of_arrays().items()]).drop("words_", "lines_")
    c = b.withColumns({"windows_": _windows(), "n_stop_": _n_stop(stop_words)}).drop("hashes_")
    d = c.withColumn("placed_", _placed("windows_")).drop("windows_")
    same = lambda x, i: F.coalesce(x["h"] == F.get("placed_", i)["h"], F.lit(False))
    twin = F.filter("placed_", lambda x, i: same(x, i + 1) | ((i > 0) & same(x, i - 1)))
    e = d.withColumn("starts_", F.sort_array(F.transform(twin, lambda x: x["i"]))).drop("placed_")
    gains = F.transform("starts_", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts_", i + 1) - p, F.lit(WINDOW))))
    repeats = F.coalesce(F.aggregate(gains, F.lit(0), lambda x, y: x + y), F.lit(0)).cast("long")
    # The condition is always true; it keeps the optimiser from copying all of the above into a later filter. The price is
    # that a filter on the results runs after them; it needs all of them anyway.
    f = e.withColumn("n_repeat_words", F.when(F.monotonically_increasing_id() >= 0, repeats)).drop("starts_")
    return f.select(
        "*",
        F.try_divide(100.0 * F.col("n_repeat_words"), F.col("n_words").cast("double")).alias("repeat_percent"),
        ratio("word_chars", "n_words").alias("mean_word_chars"),
        ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_upper_", "word_chars").alias("upper_ratio"),
        ratio("n_dup_lines", "n_lines_").alias("dup_line_ratio"),
        ratio("n_bullets_", "n_lines_").alias("bullet_line_ratio"),
        ratio("n_ellipses_", "n_lines_").alias("ellipsis_line_ratio"),
        F.when(F.col("n_words") >= STOP_FROM, ratio("n_stop_", "n_words")).alias("stop_word_ratio"),
    )


def judge(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules=RULES, base_rules=BASE_RULES, lang_col: str | None = None, stop_words: dict[str, list[str]] = STOP_WORDS) -> DataFrame:
    """measure() with base_failed and kept. An empty or null text fails the base rules; repeated rows are judged alike; a
    ratio exactly at its threshold is kept. An empty table gives no rows."""
    found = measure(docs, text_col, id_col, lang_col, stop_words)
    return found.withColumn("base_failed", ~compile_rules(base_rules)).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), lang_col="lang")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_rules(rules) -> str:
    return " and ".join(f"coalesce({name} {relation} {threshold}, true)" for name, relation, threshold in rules)


def _sql_stops() -> str:
    found = [("lang is null", every_word()), *((f"lang = '{lang}'", words) for lang, words in STOP_WORDS.items())]
    return " ".join(f"when {when} then len(list_filter(words, lambda x: list_contains({stop_forms(words)}, x)))" for when, words in found)


OP3_SQL = rf"""
with base as (
  select row_number() over () as row_id, doc_id, lang, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
win as (
  select row_id, i, [words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]] as w
  from (select row_id, words, unnest(range(1, len(words) - 3)) as i from base where len(words) >= 5)),
twice as (select row_id, i from (select *, count(*) over (partition by row_id, w) as n from win) where n > 1),
rep as (select row_id, count(distinct i + k) as n from twice, (select unnest(range(5)) as k) group by row_id),
f as (
  select base.*, cast(len(words) as bigint) as n_words,
         cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(rep.n, 0) as bigint) as n_repeat_words,
         len(regexp_extract_all(text, '\p{{L}}')) as letters, len(regexp_extract_all(text, '\p{{Lu}}')) as uppers,
         case {_sql_stops()} end as stops,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•●]'))) as bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) as ellipses
  from base left join rep using (row_id)),
g as (
  select *, 100.0::double * n_repeat_words / nullif(n_words, 0) as repeat_percent,
         word_chars::double / nullif(n_words, 0) as mean_word_chars, n_symbols::double / nullif(word_chars, 0) as symbol_ratio,
         uppers::double / nullif(word_chars, 0) as upper_ratio, n_dup_lines::double / nullif(len(lines), 0) as dup_line_ratio,
         bullets::double / nullif(len(lines), 0) as bullet_line_ratio, ellipses::double / nullif(len(lines), 0) as ellipsis_line_ratio,
         case when n_words >= {STOP_FROM} then stops::double / n_words end as stop_word_ratio
  from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       not ({_sql_rules(BASE_RULES)}) as base_failed, ({_sql_rules(BASE_RULES)}) and ({_sql_rules(RULES)}) as kept
from g
"""
