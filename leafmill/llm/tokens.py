"""Token counts by a linear longest-match automaton.

The vocabulary is a trie. Each node knows where matching goes on when it cannot be extended (its failure link) and how
many tokens are closed on the way (precomputed), so a word is counted in one pass over its bytes and no piece is built.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import shared, table

#: Where the queries find a public vocabulary unless spark.leafmill.vocabulary names another.
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: What the vocabulary file itself says of its text: how words are cut, after NFC and lower case.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: The same words where all characters are ASCII, for which a simpler pattern does.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
#: White space of Unicode, which is what \s is in the pattern of words.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
RUN = re.compile(f"[^{BLANKS}]+")
WORD_END = 256
#: Words between the places where a text may be cut.
STEP = 32
CACHE = 500_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 stands for itself, the other
    bytes for code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_vocabulary(path: str, word_end: str = "</w>") -> list[tuple[int, ...]]:
    """Every piece of the file as symbols: bytes, then WORD_END if it closes a word."""
    with open(path, encoding="utf-8") as f:
        names = json.load(f)["model"]["vocab"]
    of, out = byte_alphabet(), []
    for name in names:
        ends = name.endswith(word_end) and name != word_end
        body = name[: -len(word_end)] if ends else name
        if body and all(c in of for c in body):
            out.append((*(of[c] for c in body), *([WORD_END] if ends else [])))
    return out


class Automaton:
    """next: node*512+symbol -> node; fail: where matching goes on; closed: tokens closed on the way there. -1: stuck."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]):
        self.next: dict[int, int] = {}
        is_piece, layers = [False], [[]]
        for piece in pieces:
            node = 0
            for depth, symbol in enumerate(piece):
                key = node << 9 | symbol
                child = self.next.get(key)
                if child is None:
                    child = self.next[key] = len(is_piece)
                    is_piece.append(False)
                    if depth == len(layers) - 1:
                        layers.append([])
                    layers[depth].append((node, symbol, child))
                node = child
            is_piece[node] = bool(node)
        self.fail, self.closed = [-1] * len(is_piece), [0] * len(is_piece)
        for layer in layers:
            for parent, symbol, node in layer:
                if is_piece[node]:
                    self.fail[node], self.closed[node] = 0, 1
                    continue
                at, closed = self.fail[parent], self.closed[parent]
                while at >= 0 and (at << 9 | symbol) not in self.next:
                    closed += self.closed[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.closed[node] = self.next[at << 9 | symbol], closed

    def count(self, symbols: Iterable[int]) -> int:
        """Pieces of the greedy longest-match cut; a word that cannot be cut whole is one unknown token."""
        following, node, found = self.next, 0, 0
        for symbol in symbols:
            while (child := following.get(node << 9 | symbol)) is None:
                if self.fail[node] < 0:
                    return 1
                found += self.closed[node]
                node = self.fail[node]
            node = child
        while node:
            if self.fail[node] < 0:
                return 1
            found += self.closed[node]
            node = self.fail[node]
        return found


class Tokens:
    """Counts a text's tokens, each different word once, and cuts texts into pieces of bounded count."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        automaton = Automaton(pieces)

        class Known(dict):
            def __missing__(self, word: str) -> int:
                if len(self) > CACHE:
                    self.clear()
                n = self[word] = automaton.count([*word.encode("utf-8", "surrogatepass"), WORD_END])
                return n

        self.known = Known()

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and tokens."""
        if not text:
            return 0, 0
        words = ASCII_WORDS.findall(text.lower()) if text.isascii() else WORDS.findall(unicodedata.normalize("NFC", text).lower())
        return len(words), sum(map(self.known.__getitem__, words))

    def cut(self, text: str | None, most: int) -> Iterator[tuple[int, int, int]]:
        """(start, end, tokens) of pieces of `most` tokens at most, cut at every STEP-th white space, so that they are full
        but for less than STEP words; where STEP words have too many tokens, at any white space, and inside a run of
        characters that has too many by itself, after characters that cannot have more (four bytes each).

        Words never reach across white space, so the counts of parts add up to that of the text."""
        if not text:
            return
        if len(text) <= 4 * most and (whole := self.count(text)[1]) <= most:
            if whole:
                yield 0, len(text), whole
            return
        starts = [m.start() for m in RUN.finditer(text)]
        bounds = [*starts[::STEP], len(text)]
        parts = [(a, b, self.count(text[a:b])[1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if len(parts) and sum(n for _, _, n in parts) <= most:
            yield 0, len(text), sum(n for _, _, n in parts)
            return
        if any(n > most for _, _, n in parts):
            step, finer = max(1, most // 4), []
            for a, b, n in parts:
                runs = [(a + m.start(), a + m.end()) for m in RUN.finditer(text[a:b])] if n > most else [(a, b)]
                for c, d in runs:
                    k = n if n <= most else self.count(text[c:d])[1]
                    finer += [(c, d, k)] if k <= most else [(i, min(i + step, d), self.count(text[i : min(i + step, d)])[1]) for i in range(c, d, step)]
            parts = finer
        start, end, held = parts[0][0], parts[0][0], 0
        for a, b, n in parts:
            if held + n > most:
                yield start, start + len(text[start:end].rstrip(BLANKS)), held
                start, held = a, 0
            end, held = b, held + n
        if held:
            yield start, start + len(text[start:end].rstrip(BLANKS)), held


def tokens_of(path: str):
    """A function for the workers that gives the Tokens of a vocabulary file; the driver reads the file, whose size
    bounds what is sent, and each worker process builds the automaton once."""
    pieces = load_vocabulary(path)
    key = xxhash.xxh3_64_hexdigest(repr(pieces))
    return lambda: shared(f"tokens {key}", lambda: Tokens(pieces))


def count_tokens(docs: DataFrame, columns: list[str], vocabulary: str, text_col: str = "text") -> DataFrame:
    """columns of docs with n_words and n_tokens of the whole text, however long. A null or empty text has none. Repeated
    rows are counted alike. Of several pieces that match the longest is taken, so there are no ties. `columns` named
    n_words or n_tokens are replaced by the counts, all others are carried whatever their names. An empty table gives no
    rows. Nothing is shuffled."""
    columns = [c for c in columns if c not in ("n_words", "n_tokens")]
    tokens = tokens_of(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokens().count
        for batch in batches:
            found = [count(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=[*columns, "n_words", "n_tokens"])

    chosen = docs.select(*columns, F.col(text_col).alias("text_to_count_"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in chosen.dtypes[:-1]), "n_words long", "n_tokens long"])
    return chosen.mapInArrow(run, schema)


def vocabulary_path(spark: SparkSession) -> str:
    return spark.conf.get("spark.leafmill.vocabulary", VOCABULARY)


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], vocabulary_path(spark))


#: The same counts by looking up, at each place of each different word, the longest piece that stands there. A byte's
#: stand-in is the character of byte_alphabet(); the end of a word is written as chr(1).
OP4_SQL = rf"""
with recursive names as (
  select unnest(json_keys(content::json, '$.model.vocab')) as name from read_text('{VOCABULARY}')),
pieces as (
  select distinct case when name like '%</w>' then name[: -5] || chr(1) else name end as piece from names where name <> '</w>'),
longest as (select cast(max(length(piece)) as bigint) as most from pieces),
alphabet as (
  select list(chr(c) order by b) as chars
  from (select b, case when b between 33 and 126 or b between 161 and 172 or b between 174 and 255 then cast(b as integer)
                       else cast(255 + row_number() over (partition by b between 33 and 126 or b between 161 and 172 or b between 174 and 255 order by b) as integer) end as c
        from (select cast(unnest(range(256)) as integer) as b))),
base as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(lower(nfc_normalize(coalesce(text, ''))), '''s|''t|''re|''ve|''m|''ll|''d|\p{{L}}+|\p{{N}}|[^\s\p{{L}}\p{{N}}]+') as words
  from documents),
each as (select r, unnest(words) as word from base),
known as (
  select word, list_aggregate(list_transform(range(cast(octet_length(encode(word)) as bigint)),
           lambda i: chars[cast('0x' || hex(encode(word))[2 * i + 1 : 2 * i + 2] as integer) + 1]), 'string_agg', '') || chr(1) as symbols
  from (select distinct word from each), alphabet),
walk as (
  select word, symbols as rest, cast(0 as bigint) as n from known
  union all
  select word, rest[step + 1 :], n + 1
  from (select w.word, w.rest, w.n, max(length(p.piece)) as step
        from (select *, unnest(range(1, least(length(rest), (select most from longest)) + 1)) as k from walk where rest <> '') w
        join pieces p on p.piece = w.rest[: w.k] group by w.word, w.rest, w.n)),
counts as (select word, coalesce(max(n) filter (rest = ''), 1) as n from walk group by word)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(t.n, 0) as bigint) as n_tokens
from base left join (select r, sum(n) as n from each join counts using (word) group by r) t using (r)
"""
