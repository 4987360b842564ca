"""HTML main text by block labelling and nearest-URL page differencing.

A page is cut into lines, one per block, each with its place: inside an
article, inside a main element, inside a container named as content, in the
open body, or in boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts, styles, told by element name, role, class or
id).  Boilerplate lines go.

The rest is decided by differencing, on every page:
the pages with lines are ordered by host and URL path; neighbours that share at
least ``NEAR_COPY`` of their characters are copies of each other and form a run;
every page is paired with the nearest page before its run in its host (in the
first run of a host with the one after), and the two line sequences are aligned
by longest common subsequence.  Of articles, main elements and content
containers that stand apart, the kind with most text that the neighbour does not
share is the page's text (of equal ones the kind with most text), so a container
that repeats from page to page does not win by its size.  All lines inside the
outermost such elements stay, shared ones too (a title and lead beside the
article in <main> belong to it): neighbouring pages may carry copies of one
article, which deleting shared lines would take (README).  Of a page with an
open body only, the shared lines are deleted.  So a line goes only if a page
that says something else has it too, and copies do not wipe each other out.

Pages meet by hashes of their lines; texts are cut again at the end and move only to the decisions that a
neighbour changed (not at all if those are few).

The order is a range partitioning by (host, path, id), so a host with a third
of all pages spreads over many tasks; global positions come from the rows'
numbers inside the partitions, and a run finds its neighbour by position.

Defined results: NULL html is empty text; NULL url belongs to host '' and path
''; of equal (host, path, id) rows the html's hash orders; repeated rows each get
their row; a page or run of copies alone in its host keeps its open lines, but
rows of one page that are all their host has are each other's neighbours; a page without lines is no neighbour, except that NULL
html is one that shares nothing; unclosed and stray tags are tolerated; other columns
are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylens.llm.common import materialise
from citylens.llm.op6_urls import host_of, path_of

# Element names (HTML living standard) and words of roles, classes and ids.
RAW = {"script", "style", "template", "noscript", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"nav", "header", "footer", "aside", "dialog", "menu", "button", "select", "head"}
MAIN_WORDS = {"article", "articlebody", "content", "post", "entry", "story", "main", "maincontent"}
# Parts that may follow a boilerplate word in a class name ("sidebar-left"), and parts that make it speak of the rest ("has-sidebar").
PART_WORDS = {"left", "right", "top", "bottom", "inner", "outer", "wrapper", "wrap", "container", "box", "bar", "area", "block", "section", "list",
              "links", "link", "item", "items", "widget", "widgets", "button", "buttons", "icons", "form", "panel", "text", "content", "slot",
              "unit", "message", "info", "overlay", "icon", "signup", "row", "col", "column", "primary", "secondary", "mobile", "desktop", "global", "fixed", "sticky", "thread", "posts", "articles"}
STATE_WORDS = {"has", "have", "with", "without", "no", "not", "is", "under", "over", "below", "above", "after", "before", "hide", "show", "toggle", "to"}
PREFIX_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "gdpr", "disqus"}
LAYOUT_WORDS = {"sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "banner",
                "notice", "notices", "social", "share", "sharing"}
COMMENT_WORDS = {"comment", "comments", "reply", "ad", "advert", "promo", "sponsored"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
SPACE = {"br", "wbr", "img", "input"}
PARAGRAPH_ENDERS = {"p", "div", "ul", "ol", "li", "table", "section", "article", "main", "nav", "header", "footer", "aside", "form",
                    "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dl", "figure", "hr", "address", "details", "fieldset"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
BOILERPLATE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
                     "cookie", "cookies", "consent", "gdpr", "notice", "notices", "sidebar", "menu", "nav", "navbar", "navigation",
                     "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "comment", "comments", "disqus", "share", "sharing",
                     "social", "newsletter", "subscribe", "popup", "modal", "related", "recommended"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)|[^<]+|<""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z0-9]+")

OPEN, CONTAINER, MAIN, ARTICLE = range(4)
LIFTED, KEPT, LAYOUT, GONE = range(-1, 3)      # inside an article in a layout wrapper, no boilerplate, a layout wrapper, other boilerplate
NEAR_COPY = 0.9          # shared part of the characters of two pages from which they are copies
RUN_BLOCK = 12           # positions whose runs are numbered together, as a power of two: sizes tasks, changes no result


def _attributes(text: str):
    """Names and values, lower-cased, of a start tag's attributes."""
    for name, *values in _ATTRIBUTE.findall(text):
        yield name.lower(), "".join(values).lower()


def _place(name: str, attributes: str) -> int:
    """Where the inside of an element stands, by the element alone."""
    if name == "article":
        return ARTICLE
    if name == "main":
        return MAIN
    if not attributes or name in ("html", "body"):
        return OPEN
    for key, value in _attributes(attributes):
        if key == "role" and value.strip() in ("main", "article"):
            return MAIN
        if key in ("class", "id") and not MAIN_WORDS.isdisjoint(_WORDS.findall(value)):
            return CONTAINER
    return OPEN


def _class_word(name: str) -> str | None:
    """The boilerplate word that a class or id names its element by: the whole name, its last word, or its first before known parts."""
    parts = _WORDS.findall(name)
    if not parts or not STATE_WORDS.isdisjoint(parts):
        return None
    if parts[0] in PREFIX_WORDS:
        return parts[0]
    while len(parts) > 1 and (parts[-1] in PART_WORDS or parts[-1].isdigit()):
        parts.pop()
    return parts[-1] if parts[-1] in BOILERPLATE_WORDS else None


def _boilerplate(name: str, attributes: str) -> int:
    """KEPT, LAYOUT (a form, or named by class or id as a layout part: may yet hold the article) or GONE."""
    if name in DROPPED:
        return GONE
    found = LAYOUT if name == "form" else KEPT
    if not attributes or name in ("html", "body"):
        return found
    for key, value in _attributes(attributes):
        if key == "role" and value.strip() in BOILERPLATE_ROLES:
            return GONE
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return GONE
        if key in ("class", "id"):
            if name in ("article", "main"):
                if not COMMENT_WORDS.isdisjoint(value.split()):
                    return GONE
                continue
            for word in filter(None, map(_class_word, value.split())):
                if word not in LAYOUT_WORDS:
                    return GONE
                found = LAYOUT
    return found


def blocks(page: str | None) -> list[tuple[int, str]]:
    """Lines of a page that are not boilerplate, in page order: (place, text)."""
    return [(place, line) for place, line, _ in _lines(page)]


def _lines(page: str | None) -> list[tuple[int, str, int]]:
    """Lines of a page that are not boilerplate, in page order: (place, text, place of the outermost content element).

    Lines of an article, main or content container inside a layout wrapper count if
    the page has no such element elsewhere and less text outside.
    """
    out: list[tuple[int, str, int]] = []
    lifted: list[int] = []                            # positions in out
    held: list[str] = []
    stack: list[tuple[str, int, int, int]] = []       # name, inside boilerplate, place, outermost place
    dropped, place, outer = KEPT, OPEN, OPEN

    def end_block():
        if held:
            line = " ".join(_html.unescape("".join(held)).split())
            if line:
                if dropped == LIFTED:
                    lifted.append(len(out))
                out.append((place, line, outer))
            held.clear()

    at, text = 0, page or ""
    while m := _TOKEN.match(text, at):
        at, name = m.end(), m[2]
        if name is None:
            if dropped <= KEPT and not m[0].startswith(("<!", "<?")):
                held.append(m[0])
            continue
        name = name.lower()
        if name in RAW:
            if not m[1] and not m[3].endswith("/"):
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(text, at)
                at = close.end() if close else len(text)
            held.append(" ")
            continue
        if name in VOID:
            if name in SPACE:
                held.append(" ")
            elif name == "hr":
                end_block()
            continue
        inline = name in INLINE
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if not inline:
                end_block()
            if depth >= 0 and not (inline and any(s[0] not in INLINE for s in stack[depth + 1:])):
                del stack[depth:]
                dropped, place, outer = stack[-1][1:] if stack else (KEPT, OPEN, OPEN)
            continue
        if not inline:
            end_block()
            if name in PARAGRAPH_ENDERS:              # an open paragraph ends where a block begins
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), -1)
                if depth >= 0 and stack[depth][0] == "p":
                    del stack[depth:]
                    dropped, place, outer = stack[-1][1:] if stack else (KEPT, OPEN, OPEN)
        if m[3].endswith("/") and inline:
            continue
        own = _boilerplate(name, m[3])
        here = OPEN if own or dropped == GONE else _place(name, m[3])
        if own:
            dropped = max(own, dropped)
        elif dropped == LAYOUT and here > OPEN:
            dropped = LIFTED
        place, outer = max(place, here), outer or here
        stack.append((name, dropped, place, outer))
    end_block()
    if lifted:
        inside = set(lifted)
        others = [x for i, x in enumerate(out) if i not in inside]
        if any(p > OPEN for p, *_ in others) or sum(len(out[i][1]) for i in lifted) <= sum(len(x) for _, x, _ in others):
            return others
    return out


def _main_place(lines: list, places: list[int], gone: set[int]) -> int:
    """The kind of outermost content element that holds most of the text that the neighbour does not share (of equal
    ones most of the text, then the closest), OPEN if there is none."""
    own, whole = Counter(), Counter()
    for i, (line, place) in enumerate(zip(lines, places)):
        if place > OPEN:
            whole[place] += _size(line)
            own[place] += 0 if i in gone else _size(line)
    return max(whole, key=lambda k: (own[k], whole[k], k), default=OPEN)


def shared(mine: list[str], other: list[str]) -> set[int]:
    """Positions of ``mine`` that a longest common subsequence with ``other`` covers."""
    lead = 0
    while lead < min(len(mine), len(other)) and mine[lead] == other[lead]:
        lead += 1
    tail = 0
    while tail < min(len(mine), len(other)) - lead and mine[-1 - tail] == other[-1 - tail]:
        tail += 1
    found = {*range(lead), *range(len(mine) - tail, len(mine))}
    common = set(mine[lead:len(mine) - tail]) & set(other[lead:len(other) - tail])
    a = [i for i in range(lead, len(mine) - tail) if mine[i] in common]
    b = [other[j] for j in range(lead, len(other) - tail) if other[j] in common]
    if a and b:
        codes = {x: i for i, x in enumerate(common)}
        y = np.array([codes[x] for x in b])
        rows = [np.zeros(len(b) + 1, dtype=np.int32)]
        for i in a:
            up = rows[-1]
            rows.append(np.r_[0, np.maximum.accumulate(np.where(y == codes[mine[i]], up[:-1] + 1, up[1:]))].astype(np.int32))
        i, j = len(a), len(b)
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                found.add(a[i - 1])
                i, j = i - 1, j - 1
    return found


def _size(line: str | tuple) -> int:
    """Characters of a line, a text or its ``(hash, characters)``."""
    return len(line) if isinstance(line, str) else line[1]


def near_copies(mine: list | None, other: list | None) -> bool:
    """Whether a longest common subsequence holds ``NEAR_COPY`` of the characters of both."""
    if not mine or not other or mine == other:
        return bool(mine) and mine == other
    least = NEAR_COPY * max(sum(map(_size, mine)), sum(map(_size, other)))
    if sum(_size(x) * n for x, n in (Counter(mine) & Counter(other)).items()) < least:
        return False
    return sum(_size(mine[i]) for i in shared(mine, other)) >= least


def _line_lists(column: pa.Array) -> list[list | None]:
    """Rows of lines: texts, or ``(hash, characters)`` pairs."""
    rows = column.to_pylist()
    if not pa.types.is_struct(column.type.value_type):
        return rows
    return [None if row is None else [tuple(x.values()) for x in row] for row in rows]


def _cut_blocks(pages: DataFrame) -> DataFrame:
    """Add ``best`` (the place that holds most text) and ``lines`` with their ``places`` (NULL of NULL html)."""
    kind = pages.schema["page_id"].dataType.simpleString()
    kept = ["page_id", "url", "host", "path", "tie", "key"]

    def run(batches):
        for b in batches:
            found = [None if page is None else _lines(page) for page in b.column("html").to_pylist()]
            lines, places = ([None if x is None else [line[k] for line in x] for x in found] for k in (1, 2))
            best = [_main_place(x or [], y or [], set()) for x, y in zip(lines, places)]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(best, pa.int32()), pa.array(lines, pa.list_(pa.string())), pa.array(places, pa.list_(pa.int32()))],
                names=[*kept, "best", "lines", "places"])

    return pages.mapInArrow(run, f"page_id {kind}, url string, host string, path string, tie bigint, key bigint, best int, "
                                 "lines array<string>, places array<int>")


def _with_positions(ordered: DataFrame) -> DataFrame:
    """Add ``at``: consecutive numbers in the order of a range-partitioned, sorted, written table.

    The row's number inside its partition is native; only one count per partition is summed up.
    """
    own = F.col("row_id").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright("row_id", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    return ordered.withColumn("part", part).join(starts, "part").withColumn("at", F.col("start") + own).drop("part", "start", "row_id")


def _with_runs(placed: DataFrame) -> DataFrame:
    """Narrow rows ``(at, host, key, start)``: start is the first position of the run of copies that the page is in."""

    def run(batches):
        for b in batches:
            columns = (*(b.column(c).to_pylist() for c in ("host", "up_host")), *(_line_lists(b.column(c)) for c in ("lines", "up_lines")))
            starts = [host != up_host or not near_copies(mine, other) for host, up_host, mine, other in zip(*columns)]
            yield pa.RecordBatch.from_arrays([b.column("at"), b.column("host"), b.column("key"), pa.array(starts, pa.bool_())],
                                             names=["at", "host", "key", "starts"])

    up = placed.select((F.col("at") + 1).alias("at"), F.col("host").alias("up_host"), F.col("lines").alias("up_lines"))
    pairs = placed.join(up, "at", "left").select("at", "host", F.xxhash64("page_id", "url", "tie").alias("key"), "up_host", "lines", "up_lines")
    marked = materialise(pairs.mapInArrow(run, "at bigint, host string, key bigint, starts boolean"), "html-marks").select(
        "*", F.shiftright("at", RUN_BLOCK).alias("block"), F.when(F.col("starts"), F.col("at")).alias("mark"))
    last = marked.groupBy("block").agg(F.max("mark").alias("last"))
    before = last.select("block", F.max("last").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    own = F.max("mark").over(Window.partitionBy("block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("own", own).join(before, "block").select("at", "host", "key", F.coalesce("own", "before").alias("start"))


def _difference(rows: DataFrame) -> DataFrame:
    """``tie, key, stays`` (by line, whether it is main text) of pages whose neighbour changes that.  What it does not share
    tells the kind of element that holds the main text, whose lines stay; on an open page the lines that it does not share stay."""

    def run(batches):
        for b in batches:
            told = []
            for tie, key, mine, places, other in zip(b.column("tie").to_pylist(), b.column("key").to_pylist(), _line_lists(b.column("lines")),
                                                     b.column("places").to_pylist(), _line_lists(b.column("other"))):
                gone = shared(mine, other) if mine and other else set()
                best, alone = (_main_place(mine, places, x) for x in (gone, set()))
                stays = [place == best if best > OPEN else i not in gone for i, place in enumerate(places)]
                if best != alone or best == OPEN and gone:
                    told.append((tie, key, stays))
            ties, keys, stays = zip(*told) if told else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ties, pa.int64()), pa.array(keys, pa.int64()), pa.array(stays, pa.list_(pa.bool_()))],
                                             names=["tie", "key", "stays"])

    return rows.select("tie", "key", "lines", "places", "other").mapInArrow(run, "tie bigint, key bigint, stays array<boolean>")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""
    url = F.col("url")
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).select(
        "page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"), F.xxhash64("html").alias("tie"), "html")
    cut = _cut_blocks(slim.withColumn("key", F.xxhash64("page_id", "url", "tie")))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # pages meet by the hashes of their lines; the texts are cut again below
    short = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("hash"), F.length(x).alias("n")))
    narrow = materialise(cut.where("lines is null or size(lines) > 0").select(
        "page_id", "url", "host", "path", "tie", "key", short.alias("lines"), "places"), "html-lines")
    ordered = (narrow.repartitionByRange(parts, "host", "path", "page_id", "tie").sortWithinPartitions("host", "path", "page_id", "tie")
               .withColumn("row_id", F.monotonically_increasing_id()))
    placed = materialise(_with_positions(materialise(ordered, "html-order")), "html-at")
    of_run = materialise(_with_runs(placed), "html-runs")
    runs = of_run.groupBy("start").agg(F.min("host").alias("r_host"), (F.min("at") + F.count("*")).alias("next"),
                                       ((F.min("key") == F.max("key")) & (F.count("*") > 1)).alias("one_page"))
    up = placed.select((F.col("at") + 1).alias("start"), F.col("host").alias("up_host"), F.col("lines").alias("up_lines"))
    down = placed.select(F.col("at").alias("next"), F.col("host").alias("down_host"), F.col("lines").alias("down_lines"))
    has_up, has_down = (F.coalesce(F.col(c) == F.col("r_host"), F.lit(False)) for c in ("up_host", "down_host"))
    partners = runs.join(up, "start", "left").join(down, "next", "left").select(
        "start", F.when(has_up, F.col("up_lines")).when(has_down, F.col("down_lines")).alias("partner"),
        (F.col("one_page") & ~has_up & ~has_down).alias("only_page"))
    paired = (placed.where("lines is not null").join(of_run.select("at", "start"), "at").join(partners, "start")
              .withColumn("other", F.when(F.col("only_page"), F.col("lines")).otherwise(F.col("partner"))))
    # rows of one page are copies in one run, so what is decided for one holds for all
    decided = materialise(_difference(paired).dropDuplicates(["tie", "key"]), "html-decided")
    alone = (F.col("best") == OPEN)
    stays = F.filter("lines", lambda _, i: F.when(F.col("stays").isNotNull(), F.col("stays")[i]).otherwise(alone | (F.col("places")[i] == F.col("best"))))
    out = cut.select("page_id", "url", "tie", "key", "best", "lines", "places").join(decided, ["tie", "key"], "left").select(
        "page_id", "url", F.coalesce(F.array_join(stays, "\n"), F.lit("")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
