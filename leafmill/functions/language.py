"""Language and text-quality verdicts that need no detector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions.text import SCRIPTS
from leafmill.sources.scratch import maybe_broadcast

# Results depend on them as they stand.
#: Letters that one language of the Cyrillic script alone has, in the order in which they are looked for, and how many in
#: a thousand letters of the script must be seen.
CYRILLIC = {"kk": ("әғқңөұүһ", 8), "uk": ("їєґ", 2), "be": ("ў", 2), "ru": ("ыэё", 3)}
#: Cyrillic letters below which nothing is said, and the language of the script that has no letter of its own.
CYRILLIC_LEAST, CYRILLIC_PLAIN = 100, ("bg",)
#: A text of fewer words and fewer characters than these is too short to be judged.
SHORT_WORDS, SHORT_CHARS = 20, 120
#: What UTF-8 read as Latin-1 or cp1252 leaves behind.
MOJIBAKE = r"Ã.|â€|Ð.Ð|Ø.Ù|Â[ -¿]"
#: Largest shares of words cut apart and of letters of another script; least share of known words from LEXICON_WORDS
#: words on, and under that.
MOST_SPLIT, MOST_FOREIGN, LEXICON_WORDS, LEAST_KNOWN, LEAST_KNOWN_SHORT = 0.04, 0.10, 6, 0.9, 0.5
#: Bounds of the number of words of a translation over that of its source.
COMPARABLE = (0.5, 2.0)

#: Letters that German, French and Spanish have and the two others and English do not.
LATIN = {"de": ("äöß", 3), "fr": ("èêçàœ", 3), "es": ("ñáíóú", 3)}
LATIN_PLAIN = ("en",)


def per_mille(text: Column, letters: str, script: str) -> Column:
    """How many in a thousand letters of the script are among `letters`."""
    low = F.lower(text)
    return F.coalesce(F.try_divide(1000.0 * F.regexp_count(low, F.lit(f"[{letters}]")), F.regexp_count(low, F.lit(rf"\p{{Is{script}}}"))), F.lit(0.0))


def signature(text: Column, table: dict[str, tuple[str, float]] = CYRILLIC, script: str = "Cyrillic", least: int = CYRILLIC_LEAST) -> Column:
    """The first language of the table whose letters pass their share, none if there is none; null where the text has
    not more than `least` letters of the script."""
    out = F.lit("none")
    for lang, (letters, share) in reversed(table.items()):
        out = F.when(per_mille(text, letters, script) > share, lang).otherwise(out)
    return F.when(F.regexp_count(F.lower(text), F.lit(rf"\p{{Is{script}}}")) > least, out)


def status(text: Column, lang: Column, found: Column, plain: tuple[str, ...] = CYRILLIC_PLAIN) -> Column:
    """short; ok, if the language found is the one named or none is found and that one is `plain`; other, if another
    language is found; mismatch, if none is."""
    short = (F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]+")) < SHORT_WORDS) & (F.regexp_count(text, F.lit(r"[^ \t\n\r\f\x0B]")) < SHORT_CHARS)
    return F.when(short, "short").when((found == lang) | ((found == "none") & lang.isin(*plain)), "ok").when(found == "none", "mismatch").when(found.isNotNull(), "other")


def split_words(text: Column) -> Column:
    """Words cut apart by extraction: they begin with a combining mark or are one lone letter of a script that is joined."""
    return F.regexp_count(text, F.lit(r"(?<![^ \t\n\r\f])(?:\p{M}[^ \t\n\r\f]*|[\p{L}&&[؀-ۿऀ-෿]])(?![^ \t\n\r\f])"))


def clean_gate(docs: DataFrame, id_col: str, text: str, lexicon: DataFrame, word: str, own: tuple[str, ...] = ("Latin",)) -> DataFrame:
    """(id, reason): the first gate that a text fails, null for a clean one: mojibake, control (control, private-use or
    replacement characters), split (words cut apart), unknown (too few words of the lexicon), foreign (letters of other
    scripts), empty (no letter). A null text is empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_count(t, F.lit(r"[^ \t\n\r\f\x0B]+"))
    letters = F.regexp_count(t, F.lit(r"\p{L}"))
    mine = F.regexp_count(t, F.lit("[" + "".join(rf"\p{{Is{s}}}" for s in own) + r"&&\p{L}]"))
    known = lexicon_share(docs, id_col, text, lexicon, word).select(F.col(id_col).alias("id_"), "share")
    bad = t.rlike("[\\x00-\\x08\\x0B-\\x1F\\x80-\\x9F\\x{FFFD}\\x{E000}-\\x{F8FF}]")
    floor = F.when(words >= LEXICON_WORDS, F.lit(LEAST_KNOWN)).otherwise(F.lit(LEAST_KNOWN_SHORT))
    reason = (
        F.when(t.rlike(MOJIBAKE), "mojibake").when(bad, "control").when(split_words(t) > MOST_SPLIT * words, "split").when(F.col("share") < floor, "unknown")
        .when(letters == 0, "empty").when((letters - mine) / F.greatest(letters, F.lit(1)) > MOST_FOREIGN, "foreign")
    )
    return docs.join(known, F.col(id_col) == F.col("id_"), "left").select(id_col, reason.alias("reason"))


def garbled(text: Column, translation: Column) -> Column:
    """Whether a translation's word count is not comparable with its source's; null without a translation, true for a
    source without words. The translation is a column of the input: nothing is fetched here."""
    n, m = (F.regexp_count(c, F.lit(r"\p{L}+")) for c in (text, translation))
    return F.when(F.coalesce(n, F.lit(0)) == 0, True).when(translation.isNotNull(), ~F.try_divide(m.cast("double"), n).between(*COMPARABLE))


def bucket_of(df: DataFrame, lang: str, script: str, by_script: DataFrame, by_lang: DataFrame) -> DataFrame:
    """df with `bucket`: by (lang, script) if that pair has one, else by lang, else the language itself."""
    a = maybe_broadcast(by_script.select(F.col("lang").alias("l1_"), F.col("script").alias("s1_"), F.col("bucket").alias("b1_")))
    b = maybe_broadcast(by_lang.select(F.col("lang").alias("l2_"), F.col("bucket").alias("b2_")))
    met = df.join(a, (F.col(lang) == F.col("l1_")) & (F.col(script) == F.col("s1_")), "left").join(b, F.col(lang) == F.col("l2_"), "left")
    return met.withColumn("bucket", F.coalesce("b1_", "b2_", F.col(lang))).drop("l1_", "s1_", "b1_", "l2_", "b2_")


def misspelt(word: Column) -> Column:
    """A spelling no script allows: a word that begins with a mark, has a code point of no use, letters of two scripts, or
    an Indic vowel sign after the same sign or after an independent vowel."""
    scripts = sum(word.rlike(rf"\p{{Is{s}}}").cast("int") for s in SCRIPTS if s not in ("Han", "Hiragana", "Katakana"))
    east = word.rlike(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]").cast("int")
    signs, vowels = r"ा-ौা-ৌ", r"ऄ-औঅ-ঔ"
    return word.rlike(rf"^\p{{M}}|[\p{{Cn}}\p{{Co}}\p{{Cs}}]|([{signs}])\1|[{vowels}][{signs}]") | (scripts + east > 1)


def ill_formed_share(text: Column) -> Column:
    """Share of a text's words that no script allows; null for a text without words."""
    words = F.regexp_extract_all(text, F.lit(r"[^ \t\n\r\f\x0B]+"), F.lit(0))
    return F.try_divide(F.size(F.filter(words, misspelt)).cast("double"), F.size(words))


#: What gives a citation or a reference away: a year in brackets, numbered marks, et al., page and volume numbers, links.
CITATION = r"(?:^|[^\p{L}\p{N}])(?:et al\.|(?:pp?|vol|no|ed|eds)\. ?[0-9]|doi|ISBN|ibid)|\([^()]{0,40}(?:1[5-9]|20)[0-9]{2}[a-z]?\)|\[[0-9]{1,3}(?:[,–-] ?[0-9]{1,3})*\]|https?://"


def prose_lines(lines: DataFrame, lang: str, line: str, script: str, order: str, first: int = 200) -> DataFrame:
    """Lines that are no citation and have the script that most of the first `first` lines of their language have."""
    left = lines.filter(~F.col(line).rlike(CITATION))
    head = left.withColumn("r_", F.row_number().over(Window.partitionBy(lang).orderBy(order, line))).filter(F.col("r_") <= first)
    votes = head.groupBy(lang, script).agg(F.count("*").alias("n_"))
    top = votes.groupBy(F.col(lang).alias("l_")).agg(F.min(F.struct((-F.col("n_")).alias("n"), F.col(script).alias("s")))["s"].alias("s_"))
    return left.join(maybe_broadcast(top), (F.col(lang) == F.col("l_")) & (F.col(script) == F.col("s_"))).drop("l_", "s_")


def pools(lines: DataFrame, lang: str, line: str, script: str, order: str, least: int, most: int, alpha: float = 0.7) -> DataFrame:
    """(pool, lang, line): of languages with `least` lines of their main script or more, the first `most` of them; and for
    each script, in a pool of its own, up to `most` of those in hashed order."""
    body = F.regexp_count(F.col(line), F.lit(r"[^ \t\n\r\f\x0B]"))
    worded = F.coalesce(F.try_divide(F.regexp_count(F.col(line), F.lit(r"\p{L}")), body) >= alpha, F.lit(False))
    same = prose_lines(lines, lang, line, script, order).filter(worded)
    w = Window.partitionBy(lang)
    kept = same.withColumn("n_", F.count("*").over(w)).withColumn("r_", F.row_number().over(w.orderBy(order, line))).filter((F.col("n_") >= least) & (F.col("r_") <= most))
    mixed = kept.withColumn("r_", F.row_number().over(Window.partitionBy(script).orderBy(F.md5(F.concat(F.col(lang), F.lit("|"), F.col(line))), lang, line))).filter(F.col("r_") <= most)
    return kept.select(F.col(lang).alias("pool"), lang, line).unionAll(mixed.select(F.concat(F.lit("script:"), F.col(script)).alias("pool"), lang, line))


def agreed(l1: Column, p1: Column, l2: Column, p2: Column, n_chars: Column, least: float = 0.8, chars: int = 200) -> Column:
    """The language on which two models agree with confidence on a long enough text."""
    return F.when((l1 == l2) & (F.least(p1, p2) >= least) & (n_chars >= chars), l1)


def passes_verdict(answers: DataFrame, key: str, label: str, answer: str) -> DataFrame:
    """Kept if any pass names the label; relabelled if another code than und has two votes (ties: the least); else
    dropped. was holds the old label of a relabelled row."""
    votes = answers.groupBy(key, label, answer).agg(F.count("*").alias("n_"))
    best = votes.filter((F.col("n_") >= 2) & (F.col(answer) != "und")).groupBy(key, label).agg(F.min(F.struct((-F.col("n_")).alias("m"), F.col(answer).alias("a")))["a"].alias("new_"))
    hit = votes.groupBy(key, label).agg(F.bool_or(F.col(answer) == F.col(label)).alias("hit_"))
    out = hit.join(best, [key, label], "left")
    verdict = F.when(F.col("hit_"), "kept").when(F.col("new_").isNotNull(), "relabelled").otherwise("dropped")
    return out.select(key, F.when(F.col("hit_"), F.col(label)).otherwise(F.col("new_")).alias("label"), F.when(verdict == "relabelled", F.col(label)).alias("was"), verdict.alias("verdict"))


def lexicon_share(docs: DataFrame, id_col: str, text: str, lexicon: DataFrame, word: str) -> DataFrame:
    """Share of a text's words that a lexicon has: words are counted inside the document before they are joined."""
    words = docs.select(id_col, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0))).alias("w_")).groupBy(id_col, "w_").agg(F.count("*").alias("n_"))
    known = lexicon.select(F.col(word).alias("w_"), F.lit(True).alias("k_")).distinct()
    return words.join(known, "w_", "left").groupBy(id_col).agg((F.sum(F.when(F.col("k_"), F.col("n_")).otherwise(0)) / F.sum("n_")).alias("share"))


def ngram_counts(docs: DataFrame, text: str, n: int, by: list[str]) -> DataFrame:
    """Character n-grams of normalised text, counted by group: the table under a character language model."""
    clean = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}]+", " ")), F.lit(" "))
    grams = docs.select(*by, F.explode(F.regexp_extract_all(clean, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))).alias("gram"))
    return grams.groupBy(*by, "gram").agg(F.count("*").alias("n"))


class TrigramModel:
    """A character model of each group: trigrams interpolated with bigrams and single characters after Witten and Bell.

    The tables are counts of 1- to 3-grams of `^^text$` with the count and the number of different followers of each
    context, so a model of any size stays distributed; a text is scored by joins of its different trigrams."""

    def __init__(self, docs: DataFrame, text: str, by: str):
        self.by = by
        grams = self._grams(docs.select(F.col(by).alias("g_"), F.col(text).alias("t_")), ["g_"])
        each = [grams.select("g_", F.substring("gram", 4 - n, n).alias("gram"), "n").groupBy("g_", "gram").agg(F.sum("n").alias("n")) for n in (1, 2, 3)]
        self.counts = each
        context = lambda n: F.substring("gram", 1, n - 1)
        self.contexts = [c.groupBy("g_", context(n).alias("ctx")).agg(F.sum("n").alias("all"), F.count("*").alias("kinds")) for n, c in enumerate(each, 1)]

    @staticmethod
    def _grams(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Trigrams of each line of the text, with marks of beginning and end, counted by keys before they move."""
        lines = rows.select(*keys, F.explode(F.split("t_", "\n")).alias("l_")).select(*keys, F.concat(F.lit("^^"), "l_", F.lit("$")).alias("l_"))
        grams = lines.select(*keys, F.explode(F.regexp_extract_all("l_", F.lit(r"(?s)(?=(.{3}))"), F.lit(1))).alias("gram"))
        return grams.groupBy(*keys, "gram").agg(F.count("*").alias("n"))

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """(g_, gram) -> and p, the probability of the last character after the two before it."""
        size = self.counts[0].groupBy("g_").agg(F.count("*").alias("v_"))
        out = wanted.join(size, "g_").withColumn("p", 1 / (F.col("v_") + 1)).drop("v_")
        for n in (1, 2, 3):
            count = self.counts[n - 1].select("g_", F.col("gram").alias("x_"), F.col("n").alias("c_"))
            ctx = self.contexts[n - 1].select("g_", F.col("ctx").alias("h_"), "all", "kinds")
            out = out.withColumn("x_", F.substring("gram", 4 - n, n)).withColumn("h_", F.substring("gram", 4 - n, n - 1))
            out = out.join(count, ["g_", "x_"], "left").join(ctx, ["g_", "h_"], "left")
            own = F.col("all") / (F.col("all") + F.col("kinds"))
            out = out.withColumn("p", F.coalesce(own * F.coalesce("c_", F.lit(0)) / F.col("all") + (1 - own) * F.col("p"), F.col("p"))).drop("x_", "h_", "c_", "all", "kinds")
        return out

    def score(self, docs: DataFrame, id_col: str, text: str, by: str | None = None) -> DataFrame:
        """(id, group, mean): mean natural log probability of a text's characters (line ends included) in its group's model,
        or in every model where no group is named; null texts and groups without a model have no row."""
        rows = docs.select(F.col(id_col).alias("i_"), *([F.col(by).alias("g_")] if by else []), F.col(text).alias("t_"))
        if by is None:
            rows = rows.crossJoin(maybe_broadcast(self.counts[0].select("g_").distinct()))
        mine = self._grams(rows, ["i_", "g_"])
        p = self.probabilities(mine.select("g_", "gram").distinct())
        met = mine.join(p, ["g_", "gram"])
        return met.groupBy("i_", "g_").agg((F.sum(F.col("n") * F.ln("p")) / F.sum("n")).alias("mean")).select(F.col("i_").alias(id_col), F.col("g_").alias(self.by), "mean")
