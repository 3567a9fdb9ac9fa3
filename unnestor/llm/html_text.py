"""Main text of web pages by nearest-URL page differencing.

A page is cut into lines, one per block, in page order. Parts whose element
says that they aren't the article (navigation, forms, adverts and the like) are
left out, and if a page marks its article, so is what lies outside. The page is
then paired with the page of its host whose URL path is nearest and whose
longest line is another one, so that copies of the article are passed over;
lines that the longest common subsequence of both shares come from the template
and go. Plain prose inside a marked article is kept even if shared. So is
everything where the pair holds two versions of one article: most words of the
page's sentences, lines of at least ``SENTENCE`` words, are shared. Lines as
short as a template's mostly are don't count there, however many they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, partitions, stage

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
# elements that hold no article
OTHER = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe svg canvas object dialog menu "
    "datalist map audio video math title xmp".split()
)
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# words of a class or id that say the same
OTHER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner sidebar widget "
    "widgets menu nav navbar navigation breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments disqus respond replies pagination pager toolbar".split()
)
HEADINGS = frozenset("header topbar".split())
ARTICLE_NAMES = frozenset("article articlebody entry post story content maintext".split())
# an open element of these is closed by the next one
SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption".split())
SENTENCE = 10
LINES = "array<struct<text: string, plain: boolean>>"


class _Element:
    __slots__ = ("tag", "other", "level", "named")

    def __init__(self, tag: str, other: bool, level: int, named: bool):
        self.tag, self.other, self.level, self.named = tag, other, level, named


def _open(tag: str, attrs: str, outer: _Element) -> _Element:
    """What an element says about its content: is it no part of the article,
    how strongly is it marked as the article (3 article, 2 main, 1 by name),
    and has it, or an element between it and that mark, a class or id?"""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attrs)} if "=" in attrs else {}
    names = set(re.split(r"[^a-z0-9]+", f"{found.get('class', '')} {found.get('id', '')}".lower())) - {""}
    role = found.get("role", "").lower()
    whole = tag in ("html", "body", "main", "article")
    other = tag in OTHER or role in OTHER_ROLES or (not whole or bool(names & {"comment", "comments"})) and bool(names & OTHER_NAMES)
    if (tag == "header" or names & HEADINGS) and not outer.level and not names & ARTICLE_NAMES:
        other = True
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attrs) or found.get("aria-hidden") == "true" or re.search(
        r"display\s*:\s*none", found.get("style", ""))
    level = 3 if tag == "article" else 2 if tag == "main" or role == "main" else 1 if names & ARTICLE_NAMES or found.get("itemprop") == "articleBody" else 0
    if level > outer.level:
        return _Element(tag, outer.other or other or bool(hidden), level, False)
    return _Element(tag, outer.other or other or bool(hidden), outer.level, outer.named or bool(names))


def page_lines(html: str | None) -> list[tuple[str, bool]]:
    """(text, plain) of each block of the article, in page order; plain: prose
    in a marked article, under no class or id."""
    html = html or ""
    stack = [_Element("", False, 0, False)]
    lines: list[tuple[str, int, bool, bool]] = []  # text, level, plain, heading
    buffer: list[str] = []
    block = ""

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            top = stack[-1]
            plain = top.level > 0 and not top.named and (block in PROSE or block in ("article", "main", ""))
            lines.append((text, top.level, plain, block == "h1"))

    at = 0
    while at < len(html):
        m = TOKEN.match(html, at)
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0][0] != "<" or m[0] == "<":
                if not stack[-1].other:
                    buffer.append(unescape(m[0]))
            continue
        if m["end"]:
            if tag in BLOCKS:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            if tag in BLOCKS:
                block = ""
            continue
        if tag in BLOCKS:
            flush()
            block = "" if tag in ("br", "hr") else tag
        closes = SIBLINGS.get(tag, {"p"} if tag in BLOCKS and tag not in ("br", "hr") else ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in closes:
                del stack[i:]
                break
            if stack[i].tag in BLOCKS:
                break
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID and not m["attrs"].endswith("/"):
            stack.append(_open(tag, m["attrs"], stack[-1]))
    flush()
    # the strongest mark that holds most of what is marked; a teaser's doesn't
    words = [len(text.split()) for text, *_ in lines]
    marked = sum(n for n, line in zip(words, lines) if line[1])
    best = next((k for k in (3, 2, 1) if marked and 2 * sum(n for n, line in zip(words, lines) if line[1] >= k) > marked), 0)
    begin = next((i for i, line in enumerate(lines) if line[1] >= best), 0)
    # and the headline that stands before it in a weaker one
    return [(text, plain) for i, (text, level, plain, head) in enumerate(lines) if level >= best or level and head and i < begin]


def common_lines(a: list, b: list) -> set[int]:
    """Places of ``a`` in a longest common subsequence with ``b``, found row by
    row on bits: the cost doesn't depend on how many lines are equal, and of
    the rows only the first of each stretch is kept."""
    both = set(a) & set(b)
    at = [i for i, line in enumerate(a) if line in both]
    b = [line for line in b if line in both]
    if not at:
        return set()
    places: dict = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    mask, size = (1 << len(b)) - 1, len(b) // 8 + 1
    stretch = max(64, int(len(at) ** 0.5))

    def rows(first: int, row: int) -> Iterator[int]:
        """Rows first + 1, ... of a stretch: a zero bit is a step of the length."""
        for i in at[first : first + stretch]:
            u = row & places[a[i]]
            row = (row + u | row - u) & mask
            yield row

    starts, row = [], mask
    for first in range(0, len(at), stretch):
        starts.append(row)
        for row in rows(first, row):
            pass
    found, column = set(), len(b)
    for k in range(len(starts) - 1, -1, -1):
        held = [r.to_bytes(size, "little") for r in (starts[k], *rows(k * stretch, starts[k]))]
        here = len(held) - 1
        while here and column:
            byte, bit = divmod(column - 1, 8)
            if held[here][byte] >> bit & 1:
                column -= 1
                continue
            here -= 1
            if held[here][byte] >> bit & 1:  # the step is new in this row: its line is the match
                found.add(at[k * stretch + here])
                column -= 1
    return found


def difference(lines: list[tuple[str, bool]], own: list, other: list) -> list[str]:
    """The lines of a page that remain when compared with another page's;
    ``own`` and ``other`` are the hashes of both pages' lines."""
    shared = common_lines(own, other)
    words = [n if (n := len(t.split())) >= SENTENCE else 0 for t, _ in lines]
    if 2 * sum(words[i] for i in shared) > sum(words):
        return [t for t, _ in lines]
    return [t for i, (t, plain) in enumerate(lines) if plain or i not in shared]


def _lines(html):
    @F.arrow_udf(LINES)
    def lines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("text", pa.string()), ("plain", pa.bool_())]))
        for pages in batches:
            yield pa.array([[{"text": t, "plain": p} for t, p in page_lines(h.as_py())] for h in pages], kind)

    return lines(html)


def _difference(lines, own, other):
    @F.arrow_udf("string")
    def remain(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, keys, others in batches:
            out = []
            for page, mine, there in zip(pages.to_pylist(), keys.to_pylist(), others.to_pylist()):
                out.append("\n".join(difference([(r["text"], r["plain"]) for r in page], mine, there or [])))
            yield pa.array(out, pa.string())

    return remain(lines, own, other)


def neighbours(urls: DataFrame) -> DataFrame:
    """(row, other): for rows (row, host, path, longest) a row of the same host
    with another ``longest``: of the last such row before it and the first
    after it, in the order of host, path and row, the one whose path is nearer
    by edit distance (the earlier at a tie). Rows without a host, or with no
    such row, have none. Rows are ordered by range partitions; what lies beyond
    a partition is looked up in a table with a row per partition, so a run of
    equal ``longest`` may be of any length."""
    spark = urls.sparkSession
    order = ["host", "path", "row"]
    ranged = urls.where("host is not null").repartitionByRange(partitions(spark), *order)
    placed = stage(ranged.withColumn("part", F.spark_partition_id()), "urls")
    me = F.struct(*order, "longest")

    def unlike(one: Column, other: Column) -> Column:
        """``one`` if it is there and stands outside the run of ``other``."""
        same = (one["host"] == other["host"]) & one["longest"].eqNullSafe(other["longest"])
        return F.when(one.isNotNull() & ~same, one)

    def latest(value: Column, window) -> Column:
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    inside = Window.partitionBy("part")
    up, down = inside.orderBy(*order), inside.orderBy(*[F.desc(c) for c in order])
    rows = placed.withColumn("me", me)
    rows = rows.withColumn("step", unlike(F.lag("me").over(up), F.col("me"))).withColumn("before", latest(F.col("step"), up))
    rows = rows.withColumn("step", unlike(F.lag("me").over(down), F.col("me"))).withColumn("after", latest(F.col("step"), down))
    ends = rows.groupBy("part").agg(
        F.min("me").alias("first"), F.min_by("after", "me").alias("first_after"), F.max("me").alias("last"), F.max_by("before", "me").alias("last_before"))

    def beyond(ends: DataFrame, edge: str, inner: str, along, names: tuple[str, str]) -> DataFrame:
        """The nearest row beyond each partition, and the nearest that is unlike it."""
        ends = ends.withColumn("step", F.coalesce(F.col(inner), unlike(F.lag(edge).over(along), F.col(edge))))
        ends = ends.withColumn("step", latest(F.col("step"), along))
        return ends.withColumn(names[0], F.lag(edge).over(along)).withColumn(names[1], F.lag("step").over(along))

    ends = beyond(ends, "last", "last_before", Window.orderBy("part"), ("a1", "a2"))
    ends = beyond(ends, "first", "first_after", Window.orderBy(F.desc("part")), ("b1", "b2"))
    near = attach(rows.drop("step"), ends.select("part", "a1", "a2", "b1", "b2"), ["part"])
    near = near.withColumn("a", F.coalesce("before", unlike(F.col("a1"), F.col("me")), "a2"))
    near = near.withColumn("b", F.coalesce("after", unlike(F.col("b1"), F.col("me")), "b2"))
    far = lambda c: F.when(F.col(f"{c}.host") == F.col("host"), F.levenshtein(F.col(f"{c}.path"), F.col("path")))
    near = near.withColumn("to_a", far("a")).withColumn("to_b", far("b"))
    pick = F.when(F.col("to_b").isNull() | (F.col("to_a") <= F.col("to_b")), F.when(F.col("to_a").isNotNull(), F.col("a.row"))).otherwise(F.col("b.row"))
    return near.select("row", pick.alias("other")).where("other is not null")


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` instead of the html: the blocks of the article
    that page differencing leaves, one per line, white space inside a block as
    one space. Null or empty html gives an empty text. Pages without a
    readable URL are not paired. An input column ``text`` is replaced. Equal
    pages have equal texts, of equally near neighbours the earlier counts, long
    pages are read whole, and an empty table gives no rows."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    others = [c for c in pages.columns if c not in (html_col, "text")]
    # pages are named by their content, so equal ones are one page of the search
    name = F.concat(F.hex(F.xxhash64(url, html)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), html, url)))
    keys = lambda lines: F.transform(lines, lambda r: F.xxhash64(r["text"]))
    longest = F.array_max(F.transform("lines", lambda r: F.struct(F.length(r["text"]).alias("size"), F.xxhash64(r["text"]).alias("key"))))["key"]
    cut = stage(
        pages.select(
            name.alias("row"), F.lower(F.try_parse_url(url, F.lit("HOST"))).alias("host"),
            F.rtrim(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")).alias("path"), _lines(html).alias("lines"),
        ).select("row", "host", "path", keys(F.col("lines")).alias("keys"), longest.alias("longest")).dropDuplicates(["row"]),
        "page-keys",
    )
    pairs = stage(neighbours(cut.select("row", "host", "path", "longest")), "page-pairs")
    there = cut.select(F.col("row").alias("other"), F.col("keys").alias("there"))
    paired = pairs.join(there.hint("merge"), "other").select(F.col("row").alias("__row"), "there")
    own = pages.select(
        name.alias("row"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("page"), _lines(html).alias("lines"))
    joined = own.join(paired.hint("merge"), F.col("row") == F.col("__row"), "left")
    return joined.select("page", _difference(F.col("lines"), keys(F.col("lines")), F.col("there")).alias("text")).select("page.*", "text")
