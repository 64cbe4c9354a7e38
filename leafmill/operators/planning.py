"""Sequential plans: passages to pages, under-represented targets, the stratified factor plan."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafmill.operators.ranking import hash_bucket, running_over_all


def assign_passages(pages: DataFrame, texts: DataFrame, by: str, page: str, capacity: str, text: str, size: str, document: str, fill: float = 0.9) -> DataFrame:
    """(by, page, text): the page of most room first takes the shortest free passage of at least fill*room that fits, of
    an unused document if there is one, else the longest free one that fits. One task for each value of `by`."""
    kinds = dict(pages.dtypes) | dict(texts.dtypes)
    out = f"`{by}` {kinds[by]}, `{page}` {kinds[page]}, `{text}` {kinds[text]}"

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        free = list(right.sort_values([size, text], kind="stable")[[text, size, document]].itertuples(index=False, name=None))
        used, rows = set(), []
        for p, room in left.sort_values([capacity, page], ascending=[False, True], kind="stable")[[page, capacity]].itertuples(index=False, name=None):
            ladder = [t for t in free if fill * room <= t[1] <= room and t[2] not in used] or [t for t in free if fill * room <= t[1] <= room] or [t for t in reversed(free) if t[1] <= room]
            if ladder:
                free.remove(ladder[0])
                used.add(ladder[0][2])
                rows.append((key[0], p, ladder[0][0]))
        return pd.DataFrame(rows, columns=[by, page, text])

    return pages.select(by, page, capacity).groupBy(by).cogroup(texts.select(by, text, size, document).groupBy(by)).applyInPandas(run, out)


def under_represented(sources: Sequence[tuple[str, str]], families: dict[str, dict[str, Sequence[str]]]) -> list[tuple[str, str]]:
    """For each (id, family) a target language: of the other families the one least paired with this family, then least
    used, then by name; inside it the rarest script and the rarest language. Counts change row by row, so this is a
    loop over a plan's rows, not over the corpus."""
    pairs, total, scripts, languages, out = Counter(), Counter(), Counter(), Counter(), []
    for key, family in sources:
        others = [f for f in families if f != family]
        if not others:
            continue
        f = min(others, key=lambda x: (pairs[family, x], total[x], x))
        s = min(families[f], key=lambda x: (scripts[x], x))
        lang = min(families[f][s], key=lambda x: (languages[x], x))
        pairs[family, f] += 1
        total[f] += 1
        scripts[s] += 1
        languages[lang] += 1
        out.append((key, lang))
    return out


def factor_plan(rows: DataFrame, key: str, shares: dict[str, dict[str, float]], seed: str = "") -> DataFrame:
    """A level of every factor for every row with exact marginals: level counts by largest remainder, dealt in an order
    hashed anew for each factor, so factors are independent and any row can be made alone."""
    n = rows.count()
    for factor, levels in shares.items():
        total = sum(levels.values())
        exact = {k: n * v / total for k, v in levels.items()}
        counts = {k: int(x) for k, x in exact.items()}
        for k in sorted(levels, key=lambda k: (-(exact[k] - counts[k]), k))[: n - sum(counts.values())]:
            counts[k] += 1
        mark = F.md5(F.concat(F.lit(f"{seed}{factor}"), F.col(key).cast("string")))
        placed = running_over_all(rows, hash_bucket(mark), [mark, F.col(key)], out="at_")
        upto, level = 0, F.lit(None).cast("string")
        for k in levels:
            level = F.when((F.col("at_") > upto) & (F.col("at_") <= upto + counts[k]), k).otherwise(level)
            upto += counts[k]
        rows = placed.withColumn(factor, level).drop("at_")
    return rows


def without_reuse(plan: DataFrame, pages: DataFrame, by: Sequence[str], key: str, page: str, seed: str = "") -> DataFrame:
    """Each planned row takes a page of its group, none twice; rows beyond the group's pages are dropped."""
    order = lambda c: [F.md5(F.concat(F.lit(seed), F.col(c).cast("string"))), F.col(c)]
    jobs = plan.withColumn("i_", F.row_number().over(Window.partitionBy(*by).orderBy(*order(key))))
    stock = pages.select(*by, page).withColumn("i_", F.row_number().over(Window.partitionBy(*by).orderBy(*order(page))))
    return jobs.join(stock, [*by, "i_"]).drop("i_")
