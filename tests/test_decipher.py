"""Deciphering against all readings of a line, and selection by group against its rules."""

import itertools
import math
import random

import numpy as np

from leafmill.functions import decipher
from leafmill.functions.language import TrigramModel
from leafmill.operators import selection

TEXT = "the cat and the dog sat on the mat and the cat ate the rat that the dog had seen on the mat at ten"


def model(spark):
    return TrigramModel(spark.createDataFrame([("en", TEXT)], "g string, t string"), "t", "g")


def test_readings_against_all_readings(spark):
    reader = decipher.Reader.of(model(spark), "en")
    options = {"1": ["t", "c"], "2": ["h", "a", "th"], "3": ["e"]}
    prior = {"1": {"t": 0.7, "c": 0.3}, "2": {"h": 0.2, "a": 0.5, "th": 0.3}}
    line = ["1", "2", "3", " ", "1"]
    every, sums = 0.0, [{} for _ in line]
    for way in itertools.product(*[options.get(c, [c]) for c in line]):
        context, log_p = "^^", 0.0
        for c, o in zip(line, way, strict=True):
            log_p += math.log(prior.get(c, {}).get(o, 1.0)) + reader.log_p(context, o)
            context = ("^^" + o)[-2:]
        p = math.exp(log_p + reader.log_p(context, "$"))
        every += p
        for k, o in enumerate(way):
            sums[k][o] = sums[k].get(o, 0.0) + p
    got = decipher.readings(line, options, prior, reader)
    assert all(abs(got[k][o] - sums[k][o] / every) < 1e-9 for k in range(len(line)) for o in sums[k])
    assert decipher.readings([], options, prior, reader) == []


def test_a_swap_of_letters_is_undone(spark):
    m = model(spark)
    reader = decipher.Reader.of(m, "en")
    coded = TEXT.translate(str.maketrans("tea", "XYZ"))
    rng = random.Random(1)
    words = coded.split()
    lines = [list(" ".join(rng.choices(words, k=6))) for _ in range(40)] + [[], None]
    df = spark.createDataFrame([(x,) for x in lines], "codes array<string>").repartition(3)
    found = decipher.decipher(df, "codes", {c: ["t", "e", "a"] for c in "XYZQ"}, reader)
    assert {c: max(p, key=p.get) for c, p in found.items() if c != "Q"} == {"X": "t", "Y": "e", "Z": "a"}
    assert all(abs(sum(p.values()) - 1) < 1e-9 for p in found.values()) and len(set(found["Q"].values())) == 1


def test_selection_by_group(spark):
    rng = np.random.default_rng(4)
    groups = ["a"] * 100 + ["b"] * 30 + ["c"] * 3 + ["d"]
    rows = spark.createDataFrame([(i, rng.standard_normal(5).tolist(), g) for i, g in enumerate(groups)], "id long, v array<double>, g string")
    got = {r.id: r.kind for r in selection.select_by_group(rows, "id", "v", "g", 30).collect()}
    assert len(got) == 30
    assert {got[i] for i in got if groups[i] == "d"} == {"whole"} and sum(groups[i] == "c" for i in got) >= 1
    n = {g: sum(groups[i] == g for i in got) for g in "ab"}
    assert n["a"] > n["b"] > 4 and {"medoid", "boundary"} <= set(got.values())
