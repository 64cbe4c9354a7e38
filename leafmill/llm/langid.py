"""Language identification by words first, then ever shorter character n-grams.

A known word scores by its log frequency in each language. An unseen word falls back to its known 5-grams, and where
it has none to 4-grams, and so on down to single characters; a word's grams count as one word's evidence.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import forget, materialise, maybe_broadcast, shared, table

UNKNOWN = "und"
#: The model is fitted on about so many documents of each language, chosen by a hash of the id.
DOCS_PER_LANGUAGE = 2000
#: A gram seen less often in that sample is not kept.
LEAST_COUNT = 2
LONGEST = 5
SMOOTHING = 0.5
#: The score speaks for so many words of a text's mean evidence at most, so that long texts don't all score 1.
EVIDENCE_WORDS = 8
CACHE = 400_000
ASCII_LETTERS = re.compile(r"[a-z]+")
#: A letter and what follows of letters and combining marks; numbers that look like letters are neither.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and their marks, lower case."""
    return (ASCII_LETTERS if text.isascii() else LETTERS).findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """languages, and by level (0 words, n for n-grams) the grams and their log frequency in each language."""

    languages: list[str]
    levels: list[tuple[pa.Array, np.ndarray]] = field(default_factory=list)

    @classmethod
    def of_counts(cls, counts: pa.Table) -> LanguageModel:
        """counts: columns lang, level, gram, n. Columns are read as arrays; no row becomes a Python object."""
        languages = sorted(pc.unique(counts.column("lang")).to_pylist())
        levels = []
        for level in range(LONGEST + 1):
            mine = counts.filter(pc.equal(counts.column("level"), level))
            coded = mine.column("gram").combine_chunks().dictionary_encode()
            table = np.full((len(coded.dictionary), len(languages)), SMOOTHING, dtype=np.float32)
            lang = pc.index_in(mine.column("lang"), pa.array(languages, pa.string())).to_numpy()
            table[coded.indices.to_numpy(), lang] += mine.column("n").to_numpy()
            if len(table):
                table = np.log(table / table.sum(axis=0, keepdims=True, dtype=np.float64)).astype(np.float32)
            levels.append((coded.dictionary, table))
        return cls(languages, levels)

    def scorer(self):
        """A function text -> (language, score), with a cache of words that stays bounded."""
        tables = [dict(zip(grams.to_pylist(), range(len(grams)), strict=True)) for grams, _ in self.levels]
        rows = [m for _, m in self.levels]
        flat = np.zeros(len(self.languages), dtype=np.float32)

        def backoff(word: str) -> np.ndarray:
            for n in range(LONGEST, 0, -1):
                known = [i for g in grams_of(word, n) if (i := tables[n].get(g)) is not None]
                if known:
                    return rows[n][known].mean(axis=0)
            return flat

        class Seen(dict):
            def __init__(self):
                super().__init__(tables[0])
                self.matrix = np.concatenate([rows[0], np.empty((4096, len(flat)), dtype=np.float32)])
                self.used = len(rows[0])

            def __missing__(self, word):
                if self.used == len(self.matrix):
                    self.matrix = np.concatenate([self.matrix, np.empty((len(self.matrix), len(flat)), dtype=np.float32)])
                self.matrix[self.used] = backoff(word)
                self[word] = self.used
                self.used += 1
                return self.used - 1

        seen = Seen() if self.languages else None

        def score(text: str | None) -> tuple[str, float]:
            nonlocal seen
            words = words_of(text)
            if not words or not self.languages:
                return UNKNOWN, 0.0
            if seen.used > CACHE + len(rows[0]):
                seen = Seen()
            at = np.fromiter(map(seen.__getitem__, words), dtype=np.int64, count=len(words))
            total = np.zeros(len(flat))
            for i in range(0, len(at), 65_536):
                total += seen.matrix[at[i : i + 65_536]].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            fair = np.exp((total - total[best]) * (min(len(words), EVIDENCE_WORDS) / len(words)))
            return self.languages[best], float(fair[best] / fair.sum())

        return score


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            words.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
    for lang, found in words.items():
        for level in range(LONGEST + 1):
            grams: Counter = found if not level else Counter()
            if level:
                for word, n in found.items():
                    for g in grams_of(word, level):
                        grams[g] += n
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array([level] * len(grams), pa.int32()), pa.array(list(grams)), pa.array(list(grams.values()), pa.int64())], names=["lang", "level", "gram", "n"]
                )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fits on a sample of docs bounded by docs_per_language (about; a hash of the id decides, so rows of one id are
    taken together). Rows without a text, a language or an id are not learned from; a row that comes twice counts twice;
    a long text is read whole. Other columns are ignored, whatever their names. No rows give a model without languages.
    The counts are summed on the executors; the model reaches the driver."""
    usable = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter("id is not null and lang is not null and text is not null")
    shares = materialise(usable.groupBy(F.col("lang").alias("lang_")).agg(F.least(F.lit(1.0), F.lit(docs_per_language) / F.count("*")).alias("share")))
    sample = usable.join(maybe_broadcast(shares), F.col("lang") == F.col("lang_")).filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    counts = sample.select("lang", "text").mapInArrow(_count, "lang string, level int, gram string, n long").groupBy("lang", "level", "gram").agg(F.sum("n").alias("n"))
    often = materialise(counts)
    model = LanguageModel.of_counts(often.filter(F.col("n") >= LEAST_COUNT).toArrow())
    forget(shares, often)
    return model


def predict(docs: DataFrame, model: LanguageModel, columns: list[str], text_col: str = "text") -> DataFrame:
    """columns of docs with lang_pred and score (0 to 1). A null text or one without a letter is `und` with score 0,
    as is every text if the model has no language. Of languages that score alike the first by code point is taken. A
    long text is scored whole, in slices. Repeated rows are judged alike. `columns` named lang_pred or score are
    replaced, all others are carried whatever their names. An empty table gives no rows. Nothing is shuffled."""
    columns = [c for c in columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = f"languages {uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared(key, lambda: sent.value.scorer())
        for batch in batches:
            found = [score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=[*columns, "lang_pred", "score"])

    chosen = docs.select(*columns, F.col(text_col).alias("text_to_judge_"))
    schema = ", ".join(f"`{c}` {t}" for c, t in chosen.dtypes[:-1])
    return chosen.mapInArrow(run, f"{schema}{', ' if schema else ''}lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """True for the third of the ids that is not learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    found = predict(docs, model, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
