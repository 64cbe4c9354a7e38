"""Main text of web pages: markup as evidence, and a suffix array over each host's pages.

A page is cut into blocks. The markup says of each whether it stands inside the article, in a part that is never content
(menus, headers, footers, sidebars, notices, adverts, forms, comments), or in the open. The blocks of a host's pages, all
but those that are plainly the article's, are laid end to end as one token stream, whose suffixes are ranked by
doubling. A run of RUN tokens, or a whole block, that stands on PAGES pages of different content is boilerplate: it goes
from blocks in the open and from doubtful parts of an article, whose unique runs stay. A substring of RUN tokens or more
is covered by its own windows of RUN tokens, so ranks by that many tokens find what longer common prefixes would.

A host's pages are dealt by their content into units of bounded bytes, of which each has its own array; what a unit
cannot settle alone is added up over the host's units, so the size of a unit never changes a result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import forget, materialise, maybe_broadcast, table

#: Tokens of a repeated run, block ends included, as a power of two.
RUN_LOG = 3
#: Pages of different content that a run must stand on.
PAGES = 3
#: Bytes of text of a unit of work.
UNIT = 8_000_000

NOISE_TAGS = frozenset("nav header footer aside button select textarea menu dialog fieldset iframe object embed map audio video canvas datalist".split())
NOISE_WORD = (
    r"(?:ads?|adv|advert\w*|adbox|banner\w*|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|comment\w*|disqus\w*|repl(?:y|ies)|sidebar\w*|menu\w*|nav\w*|footer\w*|header|masthead|breadcrumb\w*|share\w*|"
    r"social\w*|related\w*|recommend\w*|newsletter\w*|subscri\w*|signup|login|popup\w*|modal\w*|overlay|notice\w*|alert\w*|widget\w*|pager|pagination|toolbar|skiplink)"
)
#: A class or id is noise if one of its parts is; `side-bar`, `sign-up` and `skip-link` are written in two parts.
NOISE_NAME = re.compile(rf"(?:^|.*[-_])(?:{NOISE_WORD}|side-bar\w*|sign-up|skip-link)(?:$|[-_].*)", re.I)
#: Names that tell how a page is laid out around its content; what has such a name is only doubtful.
LAYOUT_NAME = re.compile(r"(?:has|with|without|no|is|left|right|one|two|both|sticky|fixed|layout|js)[-_].*|.*[-_](?:layout|enabled|visible|open|closed|left|right)", re.I)
#: An article is noise only if it is named so from the first part on (comment-17, promo).
NOISE_ARTICLE = re.compile(rf"{NOISE_WORD}(?:$|[-_].*)", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
MAIN_NAME = re.compile(r"article(?:-?(?:body|content|text))?|post(?:-?(?:body|content))|entry-?content|main-?content", re.I)
BLOCK_TAGS = frozenset(
    "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr thead tbody tfoot caption blockquote pre section article main header footer nav aside form fieldset figure figcaption hr address details summary body html title".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TABLE_TAGS = frozenset("table caption thead tbody tfoot tr td th".split())
CELLS = frozenset("table td th caption".split())
#: What the start of an element ends by itself, and how far up that is looked for.
ENDS = {"li": (frozenset(["li"]), frozenset("ul ol menu".split()) | CELLS), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | CELLS), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | CELLS),
        "tr": (frozenset("tr td th".split()), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])), "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
        "option": (frozenset(["option"]), frozenset(["select", "datalist"]))}
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|textarea|iframe|xmp|noembed|noframes)\b[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)|<svg\b[^>]*?(?:/>|>.*?(?:</svg\s*>|\Z))"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'"<>])*)>|<[!?][^>]*>|[^<]+|<""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Where a block stands. Of an article inside a part named as noise (a wrapper named after its sidebar) it is RESCUED.
OPEN, MAIN, DOUBTFUL, RESCUED, NOISE = range(5)
#: What an open element adds.
HARD, WRAP, WEAK, ARTICLE, SAVED, PLAIN = range(6)


def _kind(name: str, marks: dict[str, str], wrapped: bool) -> int:
    """What an element makes of the blocks inside it. wrapped: it stands inside a part that is noise by name only."""
    if name in NOISE_TAGS or "hidden" in marks or marks.get("aria-hidden", "").lower() == "true" or marks.get("role", "").lower() in NOISE_ROLES:
        return HARD
    names = f"{marks.get('class', '')} {marks.get('id', '')}".split() if name not in ("body", "html") else ()
    plain = [n for n in names if not LAYOUT_NAME.fullmatch(n)]
    if name == "article":
        if any(NOISE_ARTICLE.fullmatch(n) for n in plain):
            return HARD
        return SAVED if wrapped else ARTICLE
    if name == "main" or marks.get("role", "").lower() in ("main", "article") or any(MAIN_NAME.fullmatch(n) for n in names):
        return SAVED if wrapped else ARTICLE
    if name == "form" or any(NOISE_NAME.fullmatch(n) for n in plain):
        return WRAP
    return WEAK if len(plain) < len(names) and any(NOISE_NAME.fullmatch(n) for n in names) else PLAIN


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(place, text) of all blocks in page order. Character references are decoded, white space inside a block is one
    blank; noise inside a line of text is a block of its own and does not cut the line. Elements end as in HTML: a list
    item with the next one, a paragraph with the next block, and with any element also those left open inside it."""
    out: list[tuple[int, str]] = []
    parts: dict[int, list[str]] = {}
    stack: list[tuple[str, int]] = []
    here = [0] * 6
    is_open: dict[str, int] = {}

    def add(text: str):
        place = NOISE if here[HARD] else RESCUED if here[SAVED] else NOISE if here[WRAP] else (DOUBTFUL if here[WEAK] else MAIN) if here[ARTICLE] else OPEN
        parts.setdefault(place, []).append(text)

    def close():
        for place, found in parts.items():
            if text := " ".join("".join(found).split()):
                out.append((place, text))
        parts.clear()

    def pop(down_to: int):
        while len(stack) > down_to:
            name, kind = stack.pop()
            here[kind] -= 1
            is_open[name] -= 1

    def end(names, stop) -> None:
        """Closes the innermost open element of these names, unless one of `stop` is nearer."""
        if not any(is_open.get(n) for n in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return pop(i)
            if stack[i][0] in stop:
                return

    for m in TOKEN.finditer(page or ""):
        name = m.group(3)
        if name is None:
            piece = m.group()
            if piece[0] != "<" or piece == "<":
                add(entities.unescape(piece))
            continue
        name = name.lower()
        if name in BLOCK_TAGS:
            close()
        elif name in ("br", "td", "th", "img"):
            add(" ")
        if m.group(2):
            end((name,), frozenset(["table"]) if name in TABLE_TAGS - {"table"} else () if name == "table" else CELLS if name in BLOCK_TAGS else BLOCK_TAGS)
            continue
        if name in VOID_TAGS:
            continue
        if name in BLOCK_TAGS:
            end(("p",), CELLS)
        if name in ENDS:
            end(*ENDS[name])
        marks = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(m.group(4))} if m.group(4) else {}
        kind = _kind(name, marks, bool(here[WRAP]) and not here[SAVED])
        if kind == WRAP and here[SAVED]:
            kind = HARD
        stack.append((name, kind))
        here[kind] += 1
        is_open[name] = is_open.get(name, 0) + 1
    close()
    return out


def chosen(page: list[tuple[int, str]]) -> tuple[list[int], list[int]]:
    """Numbers of the blocks that are the page's content as far as the markup tells, and of those that are undecided.

    With an article, its blocks; else those of an article inside a part that is noise by name, if they outweigh the
    blocks in the open; else these, all of them undecided."""
    places = [p for p, _ in page]
    if MAIN in places or DOUBTFUL in places:
        return [i for i, p in enumerate(places) if p in (MAIN, DOUBTFUL)], [i for i, p in enumerate(places) if p == DOUBTFUL]
    weight = lambda place: sum(len(t) for p, t in page if p == place)
    if RESCUED in places and weight(RESCUED) >= weight(OPEN):
        return [i for i, p in enumerate(places) if p == RESCUED], []
    found = [i for i, p in enumerate(places) if p == OPEN]
    return found, found


def evidence(page: list[tuple[int, str]]) -> tuple[bytes, str]:
    """What a page gives to its host's array: a mark and the text of each block. Marks: 0 noise and the like, 1 content
    that is undecided, 2 content that stays (its text is given only beside undecided blocks)."""
    content, open_ = chosen(page)
    mark = {i: 2 for i in content} | {i: 1 for i in open_}
    marks = [mark.get(i, 0) for i in range(len(page))]
    return bytes(marks), "\n".join(t if k < 2 or open_ else "" for k, (_, t) in zip(marks, page, strict=True))


def identity(page: list[tuple[int, str]]) -> int:
    """Pages of equal content count as one."""
    content, _ = chosen(page)
    return xxhash.xxh3_64_intdigest("\n".join(page[i][1] for i in content).encode("utf-8", "surrogatepass")) - (1 << 63)


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


class Unit:
    """The suffix array of the pages of one unit: groups of equal windows of 2**run_log tokens and of equal blocks, with
    the number of different pages on which each stands."""

    def __init__(self, pages: list[tuple[bytes, list[str]]], owners: list[int], run_log: int = RUN_LOG):
        self.pages, self.run = pages, 1 << run_log
        numbers: dict[str, int] = {}
        _, owner = np.unique(np.array(owners, dtype=np.int64), return_inverse=True)
        self.n_owners = int(owner.max()) + 1 if len(owner) else 0
        codes, of_page, self.starts, names, block_owner = [], [], [], [], []
        at, stop = 0, -1
        known: dict[str, int] = {}
        for k, (marks, texts) in enumerate(pages):
            mine = []
            for mark, text in zip(marks, texts, strict=True):
                if mark == 2:  # the article's own text: nothing runs across it
                    mine.append(-1)
                    codes.append(np.array([stop], dtype=np.int64))
                    stop, at = stop - 1, at + 1
                    continue
                tokens = text.split(" ")
                mine.append(at)
                codes.append(np.array([*(numbers.setdefault(t, len(numbers)) for t in tokens), 0], dtype=np.int64))
                codes[-1][-1] = -(1 << 60)  # a block's end, equal to all others
                at += len(tokens) + 1
                names.append(known.setdefault(text, len(known)))
                block_owner.append(owner[k])
            codes.append(np.array([stop], dtype=np.int64))
            stop, at = stop - 1, at + 1
            of_page.append(at)
            self.starts.append(mine)
        self.tokens = list(numbers)
        self.code = np.concatenate(codes) if codes else np.empty(0, dtype=np.int64)
        self.owner = np.repeat(owner, np.diff(np.concatenate([[0], np.array(of_page, dtype=np.int64)]))) if len(pages) else np.empty(0, dtype=np.int64)
        self.texts, self.block = list(known), np.array(names, dtype=np.int64)
        self.block_pages = self._pages(self.block, np.array(block_owner, dtype=np.int64), len(self.texts))
        self._rank()

    def _pages(self, group: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        pairs = np.unique(group * np.int64(max(1, self.n_owners)) + owner)
        return np.bincount(pairs // max(1, self.n_owners), minlength=n)

    def _rank(self):
        n = len(self.code)
        inside = np.zeros(n, dtype=bool)
        barrier = np.nonzero((self.code < 0) & (self.code > -(1 << 60)))[0]
        if n >= self.run:
            # A window counts if no barrier is in it.
            ahead = np.searchsorted(barrier, np.arange(n))
            inside = np.where(ahead < len(barrier), barrier[np.minimum(ahead, max(0, len(barrier) - 1))] if len(barrier) else n, n) - np.arange(n) >= self.run
        _, rank = np.unique(self.code, return_inverse=True)
        step = 1
        while step < self.run and n:
            behind = np.full(n, -1, dtype=np.int64)
            behind[: max(0, n - step)] = rank[step:]
            _, rank = np.unique(rank * np.int64(n + 1) + behind + 1, return_inverse=True)
            step *= 2
        self.at = np.nonzero(inside)[0]
        self.lead, self.group = np.unique(rank[self.at], return_index=True, return_inverse=True)[1:] if len(self.at) else (np.empty(0, dtype=np.int64),) * 2
        self.run_pages = self._pages(self.group, self.owner[self.at], len(self.lead))

    def prints(self) -> tuple[np.ndarray, np.ndarray]:
        """64-bit fingerprints of the groups of windows and of blocks, equal in all units."""
        digest = xxhash.xxh3_64_intdigest
        word = np.array([*(digest(t.encode("utf-8", "surrogatepass")) for t in self.tokens), 0], dtype=np.uint64)
        found = np.full(len(self.lead), _MIX[1], dtype=np.uint64)
        for j in range(self.run):
            code = self.code[self.at[self.lead] + j] if len(self.lead) else self.code[:0]
            found = found * _MIX[0] + word[np.where(code < 0, len(word) - 1, code)]
            found ^= found >> np.uint64(29)
        return found, np.array([digest(t.encode("utf-8", "surrogatepass"), 1) for t in self.texts], dtype=np.uint64)

    def texts_of(self, pages: int = PAGES, elsewhere: np.ndarray | None = None) -> list[str | None]:
        """The main text of each page with undecided blocks; None for the others. elsewhere: sorted fingerprints that
        stand on enough pages of the host as a whole."""
        run, block = self.run_pages >= pages, self.block_pages >= pages
        if elsewhere is not None and len(elsewhere):
            mine, own = self.prints()
            run, block = run | np.isin(mine, elsewhere), block | np.isin(own, elsewhere)
        edge = np.zeros(len(self.code) + self.run + 1, dtype=np.int64)
        hit = self.at[run[self.group]] if len(self.at) else self.at
        np.add.at(edge, hit, 1)
        np.add.at(edge, hit + self.run, -1)
        covered = np.cumsum(edge)[: len(self.code)] > 0
        out, turn = [], 0
        for (marks, texts), starts in zip(self.pages, self.starts, strict=True):
            kept = []
            for mark, text, at in zip(marks, texts, starts, strict=True):
                if mark == 2:
                    kept.append(text)
                    continue
                repeated = block[self.block[turn]]
                turn += 1
                if mark == 1 and not repeated:
                    tokens = text.split(" ")
                    gone = covered[at : at + len(tokens)]
                    if not gone.all():
                        kept.append(" ".join(t for t, g in zip(tokens, gone, strict=True) if not g) if gone.any() else text)
            out.append("\n\n".join(kept) if 1 in marks else None)
        return out


def _evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, id, url, html) -> (host, id, url, ident, open, marks, texts)."""
    for batch in batches:
        parsed = [blocks(x.as_py()) for x in batch.column(3)]
        found = [evidence(p) for p in parsed]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([identity(p) for p in parsed], pa.int64()), pa.array([1 in m for m, _ in found], pa.bool_()), pa.array([m for m, _ in found], pa.binary()), pa.array([t for _, t in found], pa.string())],
            names=["host", "id", "url", "ident", "open", "marks", "texts"],
        )


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, url, html) -> (id, url, text) of the pages whose markup leaves nothing undecided."""
    for batch in batches:
        rows, texts = [], []
        for i, x in enumerate(batch.column(2)):
            page = blocks(x.as_py())
            content, undecided = chosen(page)
            if not undecided:
                rows.append(i)
                texts.append("\n\n".join(page[k][1] for k in content))
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(texts, pa.string())], names=["id", "url", "text"])


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, one table for each of its values."""
    held, last = [], None
    for batch in batches:
        groups = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.nonzero(np.diff(groups))[0] + 1, [len(groups)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            if held and groups[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = groups[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _unit(rows: pa.Table, run_log: int) -> Unit:
    pages = [(m, t.split("\n")) if m else (m, []) for m, t in zip(rows.column("marks").to_pylist(), rows.column("texts").to_pylist(), strict=True)]
    return Unit(pages, rows.column("ident").to_pylist(), run_log)


def _counted(run_log: int, pages: int):
    """(unit, host, shards, ident, marks, texts) -> (cell, unit, prints, counts): the unit's fingerprints and on how
    many pages each stands, in cells of the host by the fingerprint, of which there are as many as units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            unit = _unit(rows, run_log)
            number, host, shards = (rows.column(c)[0].as_py() for c in ("unit", "host", "shards"))
            prints = np.concatenate(unit.prints())
            counts = np.minimum(np.concatenate([unit.run_pages, unit.block_pages]), pages).astype(np.uint8)
            cell = (prints % np.uint64(shards)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            prints, counts, cell = prints[order], counts[order], cell[order]
            first = np.nonzero(np.diff(cell, prepend=-1))[0].tolist()
            ends = [*first[1:], len(cell)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_64_intdigest(f"{host} {cell[a]}") - (1 << 63) for a in first], pa.int64()), pa.array([number] * len(first), pa.int64()),
                 pa.array([prints[a:b].astype("<u8").tobytes() for a, b in zip(first, ends, strict=True)], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())],
                names=["cell", "unit", "prints", "counts"],
            )

    return run


def _summed(pages: int):
    """(cell, unit, prints, counts) sorted by cell -> (unit, prints): of each unit those that stand on enough pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            each = [np.frombuffer(x, dtype="<u8") for x in rows.column("prints").to_pylist()]
            found, place = np.unique(np.concatenate(each), return_inverse=True)
            enough = np.bincount(place, weights=np.frombuffer(b"".join(rows.column("counts").to_pylist()), dtype=np.uint8)) >= pages
            units, kept = [], []
            for number, mine, ok in zip(rows.column("unit").to_pylist(), each, np.split(enough[place], np.cumsum([len(x) for x in each])[:-1]), strict=True):
                if ok.any():
                    units.append(number)
                    kept.append(mine[ok].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.int64()), pa.array(kept, pa.binary())], names=["unit", "prints"])

    return run


def _decided(run_log: int, pages: int):
    """(unit, id, url, ident, marks, texts, prints) sorted by unit -> (id, url, text) of the undecided pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            here = np.array([x is not None for x in rows.column("marks").to_pylist()])
            sent = [x for x in rows.column("prints").to_pylist() if x]
            mine = rows.filter(pa.array(here))
            if not mine.num_rows:
                continue
            texts = _unit(mine, run_log).texts_of(pages, np.unique(np.frombuffer(b"".join(sent), dtype="<u8")) if sent else None)
            take = pa.array([i for i, t in enumerate(texts) if t is not None], pa.int64())
            yield pa.RecordBatch.from_arrays([mine.column(c).combine_chunks().take(take) for c in ("id", "url")] + [pa.array([t for t in texts if t is not None], pa.string())], names=["id", "url", "text"])

    return run


def host_of(url) -> Column:
    """Lower-case host without www.; the empty string for a null or odd URL."""
    return F.regexp_replace(F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit("")), r"^www\.", "")


def extract(rows: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", unit: int = UNIT, run_log: int = RUN_LOG, pages: int = PAGES) -> DataFrame:
    """One row per row of rows: id, url, text.

    A null or empty html gives the empty text. Pages without a host form a host of their own. Repeated rows and other
    pages of equal content count as one page. A long page is one stream, read whole. Other columns are ignored, whatever
    their names; an empty table gives no rows. `unit` bounds the bytes that a task holds at a time (a longer page is a
    unit by itself) and changes no result. Pages of equal content are always in one unit, so units' counts add up."""
    base = rows.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host_"), F.col(html_col).alias("html"))
    kinds = dict(base.dtypes)
    own = f"id {kinds['id']}, url {kinds['url']}"
    settled = base.select("id", "url", "html").mapInArrow(_settled, f"{own}, text string")
    parsed = materialise(base.select(F.xxhash64("host_").alias("host"), "id", "url", "html").mapInArrow(_evidence, f"host long, {own}, ident long, open boolean, marks binary, texts string"))
    sizes = parsed.groupBy("host").agg(F.sum(F.length("texts")).alias("size_"), F.max("open").alias("open_"))
    hosts = materialise(sizes.filter("open_").select(F.col("host").alias("host_"), F.greatest(F.lit(1), F.ceil(F.col("size_") / unit)).cast("long").alias("shards")))
    dealt = parsed.join(maybe_broadcast(hosts), F.col("host") == F.col("host_"))
    dealt = dealt.select(F.xxhash64("host", F.pmod("ident", F.col("shards"))).alias("unit"), "host", "shards", "id", "url", "ident", "marks", "texts")
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    together = lambda df, by: df.repartition(parts, by).sortWithinPartitions(by)
    counted = together(dealt.filter("shards > 1").select("unit", "host", "shards", "ident", "marks", "texts"), "unit").mapInArrow(_counted(run_log, pages), "cell long, unit long, prints binary, counts binary")
    repeated = together(counted, "cell").mapInArrow(_summed(pages), "unit long, prints binary")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    back = repeated.select("unit", none("id", kinds["id"]), none("url", kinds["url"]), none("ident", "long"), none("marks", "binary"), none("texts", "string"), "prints")
    all_ = dealt.select("unit", "id", "url", "ident", "marks", "texts", none("prints", "binary")).unionAll(back)
    decided = together(all_, "unit").mapInArrow(_decided(run_log, pages), f"{own}, text string")
    return settled.unionAll(decided).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
