"""Deciphering by expectation and maximisation: what do the codes of a font most likely stand for, given lines of codes,
the texts each code may stand for, and a character model of the language.

Lines are read on the executors (forward and backward sums over the lattice of readings), expected counts are added by
Spark, and only the table of codes, which is as large as the font, is on the driver."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.language import TrigramModel

#: What is added to each expected count, so that no reading is lost for good.
FLOOR = 0.01


class Reader:
    """The model of one group as tables that a task holds: log probability of a text after two characters."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.after: dict[str, tuple[int, int]] = {}
        for gram, n in counts.items():
            total, kinds = self.after.get(f"{len(gram)}{gram[:-1]}", (0, 0))
            self.after[f"{len(gram)}{gram[:-1]}"] = total + n, kinds + 1
        self.size = sum(len(g) == 1 for g in counts)
        self.known: dict[tuple[str, str], float] = {}

    @classmethod
    def of(cls, model: TrigramModel, group) -> Reader:
        """Collects one group's counts, whose number the alphabet bounds."""
        rows = [r for table in model.counts for r in table.filter(F.col("g_").eqNullSafe(F.lit(group))).select("gram", "n").collect()]
        return cls({r.gram: r.n for r in rows})

    def _step(self, context: str, char: str) -> float:
        p = 1 / (self.size + 1)
        for n in (1, 2, 3):
            h = context[3 - n :]
            total, kinds = self.after.get(f"{n}{h}", (0, 0))
            if total:
                own = total / (total + kinds)
                p = own * self.counts.get(h + char, 0) / total + (1 - own) * p
        return p

    def log_p(self, context: str, text: str) -> float:
        found = self.known.get((context, text))
        if found is None:
            found, at = 0.0, context
            for c in text:
                found += math.log(self._step(at, c))
                at = (at + c)[-2:]
            self.known[context, text] = found
        return found


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


def readings(codes: list[str], options: dict[str, list[str]], prior: dict[str, dict[str, float]], reader: Reader) -> list[dict[str, float]]:
    """For each code of a line the probability of each of its texts. A code without options stands for itself."""
    choices = [options.get(c) or [c] for c in codes]
    own = [{o: math.log(prior.get(c, {}).get(o, 1.0)) for o in some} for c, some in zip(codes, choices, strict=True)]
    context = lambda text: ("^^" + text)[-2:]
    ahead: list[dict[str, float]] = []
    for k, some in enumerate(own):
        ahead.append({o: p + (_log_sum([v + reader.log_p(context(q), o) for q, v in ahead[-1].items()]) if k else reader.log_p("^^", o)) for o, p in some.items()})
    back = [{o: reader.log_p(context(o), "$") for o in own[-1]}] if own else []
    for k in range(len(own) - 2, -1, -1):
        back.append({o: _log_sum([reader.log_p(context(o), q) + own[k + 1][q] + v for q, v in back[-1].items()]) for o in own[k]})
    out = []
    for f, b in zip(ahead, back[::-1], strict=True):
        total = _log_sum([f[o] + b[o] for o in f])
        out.append({o: math.exp(f[o] + b[o] - total) for o in f})
    return out


def decipher(lines: DataFrame, codes: str, options: dict[str, list[str]], reader: Reader, rounds: int = 6) -> dict[str, dict[str, float]]:
    """The probability of each text of each code after some rounds. lines: a column of arrays of codes; null and empty
    lines say nothing. Codes that never occur keep their even start."""
    prior = {c: {o: 1 / len(some) for o in some} for c, some in options.items()}
    rows = lines.select(F.col(codes).alias("c")).filter("size(c) > 0")
    for _ in range(rounds):
        sent = lines.sparkSession.sparkContext.broadcast((options, prior, reader))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            options, prior, reader = sent.value
            sums: dict[tuple[str, str], float] = {}
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    for c, found in zip(line, readings(line, options, prior, reader), strict=True):
                        if c in options:
                            for o, p in found.items():
                                sums[c, o] = sums.get((c, o), 0.0) + p
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in sums], pa.string()), pa.array([o for _, o in sums], pa.string()), pa.array(list(sums.values()), pa.float64())], names=["c", "o", "n"])

        expected: dict[str, dict[str, float]] = {}
        for r in rows.mapInArrow(run, "c string, o string, n double").groupBy("c", "o").agg(F.sum("n").alias("n")).collect():
            expected.setdefault(r.c, {})[r.o] = r.n
        for c, found in expected.items():
            total = sum(found.values()) + FLOOR * len(options[c])
            prior[c] = {o: (found.get(o, 0.0) + FLOOR) / total for o in options[c]}
    return prior
