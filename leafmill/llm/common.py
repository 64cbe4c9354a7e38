"""What the operators share: the word pattern, safe input columns, and tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sources.scratch import BROADCAST_ROWS, forget, materialise, maybe_broadcast, shared_dir

__all__ = ["BROADCAST_ROWS", "FILTER_BITS", "SPACE", "WORD", "forget", "materialise", "maybe_broadcast", "n_words", "shared", "shared_dir", "split_by", "table"]

#: A word is a run of characters outside these six; both patterns are read by Java and by RE2.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_SHARED: dict[str, object] = {}


def shared(key: str, make):
    """One object for each worker process: what make() gave the first time under this key. Few are held at a time."""
    if key not in _SHARED:
        if len(_SHARED) >= 4:
            _SHARED.clear()
        _SHARED[key] = make()
    return _SHARED[key]


#: Most bits of a filter of hashes, which bounds what is broadcast for it (half a million rows of 64 bits).
FILTER_BITS = 1 << 25


def split_by(rows: DataFrame, by: str, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """rows in two: those whose `by` may be among keys' `key`, and those whose `by` is certainly not (null is not).

    A bit for each hash of a key, 16 times as many bits as keys, in broadcast rows of 64 bits. Beyond FILTER_BITS the
    filter lets more through than it should, never less. It is worth it where the first part is shuffled by `by`."""
    n = keys.count()
    bits = min(FILTER_BITS, max(1 << 10, 1 << (16 * n).bit_length()))
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    words = keys.select(slot(key).alias("s")).groupBy(F.floor(F.col("s") / 64).cast("int").alias("w_")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("bits_"))
    met = rows.join(F.broadcast(words), F.floor(slot(by) / 64).cast("int") == F.col("w_"), "left")
    inside = F.coalesce(F.call_function("shiftright", F.col("bits_"), (slot(by) % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False)) & F.col(by).isNotNull()
    return met.filter(inside).drop("w_", "bits_"), met.filter(~inside).drop("w_", "bits_")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null, by replacements alone.

    All white space becomes the blank; each blank becomes tab and line feed, which are free by now; what stands
    between two blanks goes, so that a run is one tab. Words are the runs plus one, less one for each outer run."""
    for c in "\t\n\r\x0b\x0c":
        text = F.replace(text, F.lit(c), F.lit(" "))
    outer = F.startswith(text, F.lit(" ")).cast("int") + F.endswith(text, F.lit(" ")).cast("int")
    runs = F.replace(F.replace(text, F.lit(" "), F.lit("\t\n")), F.lit("\n\t"), F.lit(""))
    count = F.octet_length(runs) - F.octet_length(F.replace(runs, F.lit("\t"), F.lit("")))
    return F.greatest(F.coalesce(count + 1 - outer, F.lit(0)), F.lit(0)).cast("long") * (F.coalesce(F.octet_length(text), F.lit(0)) > 0).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
