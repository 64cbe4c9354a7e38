"""Plans and records made from tables: inventories, class and type plans, searches until enough, lines for fields,
generated values, nested items."""

from __future__ import annotations

import difflib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.sources.scratch import materialise, maybe_broadcast


#: Fields that are filled as one part.
FIELDS_A_PART = 8000


def inventory(files: DataFrame, lang: str, kind: str, kinds: Sequence[str], pages: str, texts: DataFrame, pools: Sequence[str], quotas: DataFrame, least_pool: int) -> DataFrame:
    """One row for each language of `files`, `texts` or `quotas`: <kind>_files and <kind>_pages for each kind, the sizes of
    its text pools, fields (the least of them), quota, and the gaps: what has a quota and no source, or too small a pool."""
    of = [F.count_if(F.col(kind) == k).alias(f"{k}_files") for k in kinds] + [F.coalesce(F.sum(F.when(F.col(kind) == k, F.col(pages))), F.lit(0)).alias(f"{k}_pages") for k in kinds]
    wide = files.groupBy(lang).agg(*of).join(texts, lang, "full_outer").join(quotas, lang, "full_outer")
    wide = wide.select(lang, *[F.coalesce(c, F.lit(0)).alias(c) for c in wide.columns if c != lang])
    fields = F.least(*pools) if len(pools) > 1 else F.col(pools[0])
    gaps = F.filter(F.array(*[F.when((F.col("quota") > 0) & (F.col(f"{k}_files") == 0), F.lit(f"no {k}")) for k in kinds], F.when(fields < least_pool, F.lit("few texts"))), lambda g: g.isNotNull())
    return wide.withColumn("fields", fields).withColumn("gaps", F.array_join(gaps, ", "))


def class_type_plan(languages: DataFrame, shares: dict[str, float], hand: Sequence[str], per_class: int = 300, least: int = 3) -> DataFrame:
    """(class, lang, type, quota) from (class, lang, writable): a class's rows are shared among its languages, a language's
    among the types by their shares, `least` of each at least. A language that cannot be written by hand has no handwritten
    types; their share goes to the others in proportion."""
    n = F.count("*").over(Window.partitionBy("class"))
    per = F.greatest(F.lit(len(shares) * least), F.floor(F.lit(per_class) / n))
    given = 1 - sum(shares[t] for t in hand)
    out = None
    for t, share in shares.items():
        own = F.when(F.col("writable"), F.lit(float(share))).otherwise(F.lit(0.0 if t in hand else share / given))
        quota = F.when(own > 0, F.greatest(F.lit(least), F.bround(own * F.col("per_"), 0).cast("int"))).otherwise(0)
        part = languages.withColumn("per_", per).select("class", "lang", F.lit(t).alias("type"), quota.cast("long").alias("quota"))
        out = part if out is None else out.unionAll(part)
    return out


def filled_plan(plan: DataFrame, real: DataFrame, scans_ok: Sequence[str], real_share: float = 0.5, seed: str = "") -> DataFrame:
    """plan with real (rows taken of `real`: lang, type, id, scan), and the synthetic rows still needed for train and val.

    At most real_share of a quota is real; digital rows go before scans, which are only taken for types in scans_ok and
    where there is no digital row. A fifth of what is needed is val, one of three or four, none of fewer."""
    w = Window.partitionBy("lang", "type")
    ranked = real.withColumn("digital_", F.max((~F.col("scan")).cast("int")).over(w)).filter(((F.col("digital_") == 1) & ~F.col("scan")) | ((F.col("digital_") == 0) & F.col("type").isin(*scans_ok)))
    stock = ranked.groupBy("lang", "type").agg(F.count("*").alias("n_"))
    out = plan.join(stock, ["lang", "type"], "left").withColumn("real", F.least(F.coalesce("n_", F.lit(0)), F.floor(F.col("quota") * real_share))).drop("n_")
    need = F.col("quota") - F.col("real")
    val = F.when(need >= 5, F.bround(0.2 * need, 0).cast("long")).when(need >= 3, 1).otherwise(0)
    return out.withColumn("val", val).withColumn("train", need - val)


def search_until(rows: DataFrame, needs: DataFrame, kind: str, file: str, order: Sequence, rank: str, chunk: int = 10, per_file: int = 2) -> DataFrame:
    """Rows that a search finds that reads files in order of rank, `chunk` files at a time, until every kind has what it
    needs: (kind, need). Of a file at most per_file rows of a kind count. Kinds are looked at in one pass: the chunk in
    which the last need is met ends it, all chunks if one never is."""
    files = rows.select(rank, file).distinct()
    placed = files.withColumn("chunk", F.floor((F.row_number().over(Window.orderBy(rank, file)) - 1) / chunk))
    wanted = rows.join(placed.drop(rank), file).join(maybe_broadcast(needs), kind)
    counted = wanted.withColumn("r_", F.row_number().over(Window.partitionBy(file, kind).orderBy(*order))).filter(F.col("r_") <= per_file)
    counted = counted.withColumn("k_", F.row_number().over(Window.partitionBy(kind).orderBy("chunk", rank, file, *order))).filter(F.col("k_") <= F.col("need"))
    met = needs.join(counted.filter(F.col("k_") == F.col("need")).select(kind, F.col("chunk").alias("end_")), kind, "left")
    ends = met.agg(F.when(F.count_if(F.col("end_").isNull()) == 0, F.max("end_")).alias("stop_"))
    return counted.crossJoin(F.broadcast(ends)).filter(F.col("stop_").isNull() | (F.col("chunk") <= F.col("stop_"))).drop("r_", "k_", "stop_", "need")


def _in_order(rows: DataFrame, lang: str) -> tuple[DataFrame, DataFrame]:
    """rows (lang, length_, line_, key_, stem_) with at_, the place in their language by these, and (lang, length_, n_,
    start_): what there is of a length and before it. Rows are sorted inside their length only."""
    counts = materialise(rows.groupBy(lang, "length_").agg(F.count("*").alias("n_")))
    starts = counts.withColumn("start_", F.coalesce(F.sum("n_").over(Window.partitionBy(lang).orderBy("length_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy(lang, "length_").orderBy("line_", "key_", "stem_"))
    return rows.withColumn("r_", own).join(maybe_broadcast(starts.drop("n_")), [lang, "length_"]).withColumn("at_", F.col("start_") + F.col("r_") - 1).drop("r_", "start_"), starts


def _last_lines(rows: DataFrame, lang: str, fields: int) -> DataFrame:
    """Of rows (lang, length_, line_, key_, stem_) those among which a form of at most `fields` fields has its shortest line
    of unused key and stem, whatever it has used: of a stem the shortest of so many keys (one of them is unused), of a key
    likewise, and of these as many as the keys and stems of the other fields can hold, and one."""
    order = ("length_", "line_", "key_", "stem_")
    for by in (("key_", "stem_"), ("stem_",), ("key_",)):
        place = F.row_number().over(Window.partitionBy(lang, *by).orderBy(*order))
        rows = rows.withColumn("r_", place).filter(F.col("r_") <= (1 if len(by) == 2 else fields)).drop("r_")
    return _in_order(materialise(rows), lang)[0].filter(F.col("at_") <= 2 * fields * (fields - 1))


def pick_lines(fields: DataFrame, bank: DataFrame, lang: str = "lang", form: str = "form", field: str = "field", cap: str = "cap", tries: int = 8, seed: str = "") -> DataFrame:
    """(lang, form, field, line): for each field a line of the language's bank (lang, line, key, stem) of at most `cap`
    characters, its length near a seeded share of the field, wider with each try; where no try finds one, the shortest that
    is left. No key and no stem comes twice in a form, and a field has no line only if every line that fits it has a key
    or stem that its form has by then.

    A form is filled field by field, so a form is the unit of work. Forms of a language and of about one size are dealt
    into parts of about FIELDS_A_PART fields. The places of the lines that the tries look at are drawn from the lengths
    alone; only these lines are fetched from the bank, which no task holds, and the few that are left for the rest."""
    kinds = dict(fields.dtypes)
    asked = fields.select(lang, form, field, cap).filter(F.col(lang).isNotNull())
    asked = materialise(asked.withColumn("size_", F.ceil(F.log2(F.count("*").over(Window.partitionBy(lang, form)))).cast("int")))
    sizes = materialise(asked.groupBy(lang, "size_").agg(F.ceil(F.count("*") / FIELDS_A_PART).cast("int").alias("parts_")))
    asked = asked.join(maybe_broadcast(sizes), [lang, "size_"]).withColumn("part_", F.pmod(F.xxhash64(form), F.col("parts_")).cast("int")).drop("parts_")
    longest = materialise(asked.groupBy(lang).agg(F.max(cap).alias("most_")))
    lines = bank.select(lang, F.length("line").alias("length_"), F.col("line").alias("line_"), F.col("key").alias("key_"), F.col("stem").alias("stem_"))
    lines = materialise(lines.join(maybe_broadcast(longest), lang).filter("length_ <= most_").drop("most_"))
    placed, lengths = _in_order(lines, lang)
    copies = lambda rows, on: rows.join(maybe_broadcast(sizes), on).withColumn("part_", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1))).drop("parts_")
    columns = {c: kinds[c] for c in (lang, form, field, cap)} | {"size_": "int", "part_": "int", "row_": "int", "try_": "int", "at_": "long"}
    listed = lambda of: ", ".join(f"`{c}` {k}" for c, k in of.items())

    def draw(of: pa.Table, counts: pa.Table) -> pa.Table:
        held = sorted(zip(*(counts.column(c).to_pylist() for c in ("length_", "n_")), strict=True))
        long, ends, forms, out = [n for n, _ in held], [0], {}, []
        for _, n in held:
            ends.append(ends[-1] + n)
        for r in of.to_pylist():
            forms.setdefault(r[form], []).append(r)
        for rows in forms.values():
            for row, r in enumerate(sorted(rows, key=lambda r: (r[field] is None, r[field], r[cap] is None, r[cap]))):
                rng = random.Random(f"{seed}|{r[form]}|{r[field]}")
                room = r[cap]
                fits = 0 if room is None else ends[bisect_right(long, room)]
                for t in range(tries if fits else 0):
                    want = room * rng.uniform(0.4, 0.95)
                    near = range(min(fits, ends[bisect_left(long, (0.8 - 0.1 * t) * want)]), min(fits, ends[bisect_right(long, (1.2 + 0.1 * t) * want)])) or range(max(0, fits - 20), fits)
                    out.append((*(r[c] for c in (lang, form, field, cap, "size_", "part_")), row, t, rng.choice(near)))
        kind = {c: of.schema.field(c).type for c in (lang, form, field, cap, "size_", "part_")} | {"row_": pa.int32(), "try_": pa.int32(), "at_": pa.int64()}
        return pa.table({c: pa.array([x[i] for x in out], k) for i, (c, k) in enumerate(kind.items())})

    def fill(of: pa.Table, last: pa.Table) -> pa.Table:
        left = sorted(zip(*(last.column(c).to_pylist() for c in ("at_", "length_", "line_", "key_", "stem_")), strict=True), key=lambda x: x[0])
        forms, out = {}, []
        for r in of.to_pylist():
            forms.setdefault(r[form], {}).setdefault(r["row_"], []).append(r)
        for rows in forms.values():
            used, stems, at = set(), set(), 0
            for _, drawn in sorted(rows.items()):
                free = [r for r in drawn if r["key_"] not in used and r["stem_"] not in stems]
                r, found = drawn[0], None
                if free:
                    best = min(free, key=lambda r: r["try_"])
                    found = best["line_"], best["key_"], best["stem_"]
                else:
                    # What is in use stays in use, so it is passed over for good.
                    while at < len(left) and (left[at][3] in used or left[at][4] in stems):
                        at += 1
                    if at < len(left) and left[at][1] <= r[cap]:
                        found = left[at][2:]
                if found:
                    used.add(found[1])
                    stems.add(found[2])
                    out.append((r[lang], r[form], r[field], found[0]))
        kind = {c: of.schema.field(c).type for c in (lang, form, field)} | {"line": pa.string()}
        return pa.table({c: pa.array([x[i] for x in out], k) for i, (c, k) in enumerate(kind.items())})

    by = [lang, "size_", "part_"]
    drawn = asked.groupBy(*by).cogroup(copies(lengths.drop("start_"), lang).groupBy(*by)).applyInArrow(draw, listed(columns))
    met = drawn.join(maybe_broadcast(materialise(placed.drop("length_"))), [lang, "at_"])
    last = None
    for size in sorted(r[0] for r in sizes.select("size_").distinct().collect()):
        few = _last_lines(lines.join(maybe_broadcast(sizes.filter(F.col("size_") == size).select(lang)), lang), lang, 1 << size).withColumn("size_", F.lit(size))
        last = few if last is None else last.unionAll(few)
    if last is None:
        last = placed.withColumn("size_", F.lit(0))
    return met.groupBy(*by).cogroup(copies(last, [lang, "size_"]).groupBy(*by)).applyInArrow(fill, listed({c: kinds[c] for c in (lang, form, field)}) + ", line string")


def field_values(rows: DataFrame, key: Column, first: Sequence[str], last: Sequence[str], domains: Sequence[str], days: int, since: str = "2000-01-01") -> DataFrame:
    """rows with person, e_mail and day, each drawn from the MD5 of the key: a row's values can be made alone and are the
    same on every run; the mail address holds the key, so no two rows share one."""
    mark = F.md5(key.cast("string"))
    draw = lambda at, n: F.pmod(F.conv(F.substring(mark, at, 8), 16, 10).cast("long"), F.lit(n)).cast("int")
    of = lambda names, at: F.element_at(F.array(*[F.lit(x) for x in names]), draw(at, len(names)) + 1)
    person = F.concat_ws(" ", of(first, 1), of(last, 9))
    mail = F.concat(F.lower(F.replace(person, F.lit(" "), F.lit("."))), F.lit("."), key.cast("string"), F.lit("@"), of(domains, 17))
    return rows.withColumn("person", person).withColumn("e_mail", mail).withColumn("day", F.date_add(F.to_date(F.lit(since)), draw(25, days)))


#: Nested items: a heading, paragraph or line has a text; a list, table or column has items.
ITEM = "struct<kind:string,text:string>"
for _ in range(3):
    ITEM = f"struct<kind:string,text:string,items:array<{ITEM}>>"


def item_texts(json: Column) -> Column:
    """The texts of a JSON array of items up to four levels deep, in reading order; null for text that is no JSON."""

    def walk(items: Column, depth: int) -> Column:
        own = lambda x: F.when(x["text"].isNotNull(), F.array(x["text"])).otherwise(F.array().cast("array<string>"))
        if depth == 1:
            return F.flatten(F.transform(items, own))
        below = lambda x: F.coalesce(walk(x["items"], depth - 1), F.array().cast("array<string>"))
        return F.flatten(F.transform(items, lambda x: F.concat(own(x), below(x))))

    return walk(F.from_json(json, f"array<{ITEM}>"), 4)


def aligned(typed: Sequence[str], original: Sequence[str], least: float = 0.6, sure: float = 0.97) -> list[int | None]:
    """For each typed line the number of the original line it comes nearest to, in order; None where none is near enough."""
    plain = lambda s: re.sub(r"[\W_]+", "", s.lower())
    out: list[int | None] = []
    start = 0
    for line in typed:
        best, at = 0.0, None
        for i in range(start, len(original)):
            a, b = plain(line), plain(original[i])
            ratio = difflib.SequenceMatcher(None, a, b).ratio() if a and b else float(line.strip() == original[i].strip())
            if ratio > best:
                best, at = ratio, i
            if ratio > sure:
                break
        out.append(at if best >= least else None)
        start = at + 1 if out[-1] is not None else start
    return out


def align_lines(rows: DataFrame, key: str, typed: str, original: str) -> DataFrame:
    """(key, line, of): for each line of the column `typed` (array of strings) the line of `original` it comes from."""

    def run(batches):
        for pdf in batches:
            out = [(k, i, None if at is None else at) for k, a, b in zip(pdf[key], pdf[typed], pdf[original], strict=True) for i, at in enumerate(aligned([] if a is None else list(a), [] if b is None else list(b)))]
            yield pd.DataFrame(out, columns=[key, "line", "of"]).astype({"of": "Int64"})

    return rows.select(key, typed, original).mapInPandas(run, f"`{key}` {dict(rows.dtypes)[key]}, line long, of long")
