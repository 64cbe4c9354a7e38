"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of leader characters in tables of contents and forms.
LEADERS = r"[.…_\-–—=~*|]{3,}"
#: Scripts told apart by share; Java names them as in Unicode.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Arabic", "Hebrew", "Devanagari", "Bengali", "Han", "Hiragana", "Katakana", "Hangul", "Thai")
#: What a code point of no use is: surrogate, private, unassigned, replacement.
BROKEN = r"[\p{Cs}\p{Co}\p{Cn}\x{FFFD}]"
#: Sentence marks, then clause marks.
SENTENCE_END, CLAUSE_END = r"(?<=[.!?…。！？।])\s+", r"(?<=[,;:，；：])\s+"
#: First matching rule names the kind of a form field.
FIELD_KINDS = (
    ("date", r"\b(date|birth|expir|issued)"), ("email", r"e-?mail"), ("phone", r"\b(phone|tel|mobile|fax)"), ("number", r"\b(no\.?|number|code|zip|id)\b"),
    ("money", r"\b(amount|price|total|fee|income|salary)"), ("address", r"\b(address|street|city|town|country|state)"), ("name", r"\bname\b"), ("sign", r"\b(signature|signed)"), ("check", r"\b(yes|no|tick|check)\b"),
)


def clean(text: Column, most: int = 600) -> Column:
    """White space collapsed, trimmed, cut to `most` characters; runs of leader characters become one blank."""
    flat = F.trim(F.regexp_replace(F.regexp_replace(text, LEADERS, " "), r"\s+", " "))
    return F.substring(flat, 1, most)


def cut_at_word(text: Column, n: int, back: float = 0.7) -> Column:
    """The first n characters, cut back to the last blank if that lies beyond back*n."""
    head = F.substring(text, 1, n)
    at = F.length(head) - F.length(F.substring_index(head, " ", -1)) - 1
    return F.when(F.length(text) <= n, text).when(at > n * back, F.substring(head, F.lit(1), at)).otherwise(head)


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.array_remove(F.split(text, r"\s+"), ""), 1, n), " ")


def first_graphemes(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"\X"), F.lit(0)), 1, n), "")


def phrases(text: Column, most: int = 10) -> Column:
    """Sentences, then clauses, then near-equal pieces of at most `most` words; nothing is dropped."""
    clauses = F.flatten(F.transform(F.split(text, SENTENCE_END), lambda s: F.split(s, CLAUSE_END)))
    worded = F.filter(F.transform(clauses, lambda c: F.array_remove(F.split(c, r"\s+"), "")), lambda w: F.size(w) > 0)

    def pieces(w: Column) -> Column:
        parts = F.ceil(F.size(w) / most).cast("int")
        bound = lambda i: F.floor(i * F.size(w) / parts).cast("int")
        return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.array_join(F.slice(w, bound(i) + 1, bound(i + 1) - bound(i)), " "))

    return F.flatten(F.transform(worded, pieces))


def stem(key: Column) -> Column:
    """Opening two words of a normalised line."""
    return F.array_join(F.slice(F.split(key, " "), 1, 2), " ")


def script_counts(text: Column, scripts=SCRIPTS) -> Column:
    return F.array(*[F.struct(F.regexp_count(text, F.lit(rf"\p{{Is{s}}}")).alias("n"), F.lit(s).alias("script")) for s in scripts])


def script(text: Column, latin: float = 0.97, other: float = 0.8) -> Column:
    """Majority script: Latin from a share of `latin`, another from `other` with Latin letters left out; else mixed."""
    counts = script_counts(text)
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x["n"])
    rest = F.filter(counts, lambda x: x["script"] != "Latin")
    best = F.array_max(rest)
    n_rest = F.aggregate(rest, F.lit(0), lambda a, x: a + x["n"])
    n_latin = total - n_rest
    return F.when(total == 0, "none").when(n_latin >= latin * total, "Latin").when(best["n"] >= other * F.greatest(n_rest, F.lit(1)), best["script"]).otherwise("mixed")


def is_broken(text: Column) -> Column:
    return text.rlike(BROKEN)


def char_shares(text: Column) -> Column:
    """Letters, digits and upper case as shares of the characters that are no white space."""
    solid = F.regexp_count(text, F.lit(r"\S"))
    share = lambda p: F.coalesce(F.try_divide(F.regexp_count(text, F.lit(p)), solid), F.lit(0.0))
    return F.struct(share(r"\p{L}").alias("alpha"), share(r"\p{Nd}").alias("digit"), share(r"\p{Lu}").alias("upper"))


def word_count(text: Column) -> Column:
    """Runs of letters; dictionary breaks of unspaced scripts are not known here."""
    return F.regexp_count(text, F.lit(r"\p{L}+"))


def field_kind(label: Column, rules=FIELD_KINDS) -> Column:
    out = F.lit("line")
    for name, pattern in reversed(rules):
        out = F.when(F.lower(label).rlike(pattern), name).otherwise(out)
    return out


def name_parts(path: Column) -> Column:
    """(topic, language, hash) of topic/..._lang_hash.ext, unknown where missing."""
    base = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    or_unknown = lambda c: F.when(c == "", "unknown").otherwise(c)
    return F.struct(
        or_unknown(F.regexp_extract(path, r"^([^/]+)/", 1)).alias("topic"),
        or_unknown(F.regexp_extract(base, r"_([a-z]{2,3})(?:_|$)", 1)).alias("language"),
        or_unknown(F.regexp_extract(base, r"(?<![0-9a-f])([0-9a-f]{12})(?![0-9a-f])", 1)).alias("hash"),
    )


def target_name(key: Column, lang: Column, ext: Column, path: Column, excluded=("unknown", "und")) -> Column:
    """New file name key_lang.ext; null for an odd key, an excluded language or an unchanged name."""
    name = F.concat(key, F.lit("_"), lang, F.lit("."), ext)
    fine = key.rlike("^[0-9a-f]{12}$") & ~lang.isin(*excluded)
    return F.when(fine, F.nullif(name, F.regexp_extract(path, r"([^/]*)$", 1)))


def keyed_blocks(answer: Column) -> Column:
    """Map of the <p id="k"> blocks of an answer; tolerant of case, quotes and missing end tags."""
    pattern = r"(?is)<p\s+id\s*=\s*[\"']?(\d+)[\"']?\s*>(.*?)(?=</p|<p\s|\z)"
    keys = F.transform(F.regexp_extract_all(answer, F.lit(pattern), F.lit(1)), lambda k: k.cast("int"))
    values = F.transform(F.regexp_extract_all(answer, F.lit(pattern), F.lit(2)), lambda v: F.trim(v))
    return F.map_from_entries(F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda e: e["k"].isNotNull()))


def recovered(answer: Column, n: Column, least: float = 0.5) -> Column:
    """Texts 1..n by key, null where lost; null altogether if more than half are lost."""
    got = F.transform(F.sequence(F.lit(1), n), lambda i: F.try_element_at(keyed_blocks(answer), i))
    lost = F.size(F.filter(got, lambda x: x.isNull()))
    return F.when(lost <= n * least, got)


def html_rows(texts: Column) -> Column:
    """Texts as escaped table rows."""
    safe = F.transform(texts, lambda t: F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")))
    return F.concat(F.lit("<table>"), F.array_join(F.transform(safe, lambda t: F.concat(F.lit("<tr><td>"), t, F.lit("</td></tr>"))), ""), F.lit("</table>"))


def native_digits(text: Column, digits: str) -> Column:
    return F.translate(text, "0123456789", digits)


def page_type(text: Column, widgets: Column, lines: Column) -> Column:
    """Type of a page by its evidence: null under 30 words, then forms, tables, text."""
    blanks = F.regexp_count(text, F.lit(r"_{4,}|\.{6,}"))
    return F.when(word_count(text) < 30, F.lit(None).cast("string")).when((widgets > 0) | (blanks >= 6), "forms").when(lines >= 40, "tables").otherwise("text")


def snippet(text: Column, least: int = 30, most: int = 100) -> Column:
    """A tenth of the words, clamped, from the middle; null for a short text."""
    words = F.array_remove(F.split(text, r"\s+"), "")
    n = F.size(words)
    k = F.least(F.greatest(F.floor(n / 10), F.lit(least)), F.lit(most)).cast("int")
    return F.when(n >= least, F.array_join(F.slice(words, (F.floor(n / 2) - F.floor(k / 2) + 1).cast("int"), k), " "))
