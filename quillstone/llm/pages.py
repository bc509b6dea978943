"""Main text of web pages by nearest-URL page differencing over structured lines.

A page becomes lines, one a text block, each knowing whether it stands in an article and whether it stands in
a part that is never main text (menus, headers, footers, asides, adverts, notices, forms, comments). Pages of
one host are put in the order of their URL paths; a page is aligned with the neighbour that shares the longer
path beginning, by a longest common subsequence of lines, and shared lines are the template's.

Shared lines are deleted except inside an article: texts repeat themselves from page to page (licences,
copied articles), and deleting those lines there would cut main text. A page whose every line is shared is a
copy of its neighbour, which says nothing: its other neighbour is asked, and where that is a copy too, nothing
is deleted as shared.
"""

from __future__ import annotations

import html
import json
import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillstone.llm.common import shuffle_partitions, staged

# A quote only opens a value right after an equals sign; elsewhere it is a letter like others.
REST = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+|))*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    rf"|<(script|style|noscript|template|iframe|svg|object|canvas|textarea|select|title)(?=[\s/>]|\Z){REST}(?:>|\Z).*?(?:</\1\s*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({REST})(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?<![^\s/\"'])([^\s/>=\"']+)\s*(?:=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]*))?", re.I)
BLANKS = re.compile(r"\s+")

# Tag and name lists; plain text, to be extended as needed.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav footer aside form button dialog menu head search fieldset".split())
ARTICLE = frozenset("article main".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar alert".split())
NEVER_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments consent cookie cookies dfp disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promoted promotion reactions related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
NEVER_NAMES |= frozenset("ad-banner ad-container ad-slot ad-unit ad-wrapper comment-form comment-list comments-area cookie-banner cookie-bar cookie-consent cookie-notice main-nav main-navigation nav-menu page-footer related-articles related-posts share-buttons site-footer site-header site-nav social-share".split())
#: Names of a page's header; an article's own header is main text, as with the tag.
HEADER_NAMES = frozenset("header masthead".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "li", "td", "th", "tr", "dd", "dt", "option"}


@dataclass
class Line:
    text: str
    article: bool
    never: bool


def _kind(tag: str, rest: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """(opens an article, is never main text, has a whole class or id that names a part) of a start tag."""
    named = False
    never, article = tag in NEVER or (tag == "header" and not inside_article), tag in ARTICLE
    if rest:
        for name, value in ATTRIBUTE.findall(rest):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role":
                never |= value in NEVER_ROLES
                article |= value in ("main", "article")
            elif name in ("class", "id"):
                names = NEVER_NAMES.intersection(value.replace("_", "-").split())
                named |= tag not in ("html", "body") and bool(names - HEADER_NAMES if inside_article else names)
            elif (name == "hidden" and value in ("", "hidden")) or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                never = True
    return article, never, named


def page_lines(source: str | None) -> list[Line]:
    """Text blocks in page order, character references decoded and white space made single blanks."""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool, bool]] = []
    article = never = named = False
    buffer: list[str] = []
    at = 0

    def flush():
        if buffer:
            text = BLANKS.sub(" ", html.unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                lines.append(Line(text, article, never or named))

    source = source or ""
    for m in TOKEN.finditer(source):
        if m.start() > at:
            buffer.append(source[at : m.start()])
        at = m.end()
        tag = m.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            buffer.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if m.group(2):
            if tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    _, article, never, named = stack[k]
                    del stack[k:]
                    break
            continue
        if tag in BLOCKS:
            flush()
        a, n, by_name = _kind(tag, m.group(4), article)
        if a or n or by_name or tag in BLOCKS:
            if not m.group(4).endswith("/") or tag in BLOCKS:
                if tag in CLOSES_P and stack and stack[-1][0] == "p":  # a p can't hold a block: it ends here
                    _, article, never, named = stack.pop()
                stack.append((tag, article, never, named))
                if a and not article and not by_name:  # a named part around an article does not silence it
                    named = False
                elif tag not in ARTICLE:
                    named |= by_name
                article, never = article or a, never or n
    if at < len(source):
        buffer.append(source[at:])
    flush()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[bool]:
    """Which of a's entries are on a longest common subsequence with b; rows of bits stand for the table."""
    shared = [False] * len(a)
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < min(end_a, end_b) and a[lo] == b[lo]:
        shared[lo] = True
        lo += 1
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
        shared[end_a] = True
    x, y = a[lo:end_a], b[lo:end_b]
    where: dict[int, int] = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]  # a zero bit j: the row's length grows at column j
    for v in x:
        u = row & where.get(v, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    i, j = len(x), len(y)
    while i and j:
        if not rows[i] >> (j - 1) & 1 and rows[i - 1] >> (j - 1) & 1 and x[i - 1] == y[j - 1]:
            shared[lo + i - 1] = True
            i, j = i - 1, j - 1
        elif not rows[i] >> (j - 1) & 1 and not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        elif not rows[i] >> (j - 1) & 1:
            i -= 1
        else:
            j -= 1
    return shared


def main_text(lines: list[tuple[str, bool, bool]], shared: list[bool]) -> str:
    """What stays of a page's (text, in an article, never) lines: an article only keeps its own shared lines."""
    copy = all(shared)
    return "\n".join([t for (t, a, n), s in zip(lines, shared, strict=True) if not n and (a or copy or not s)])


def _prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


def nearest(path: str, before: str | None, after: str | None) -> int:
    """-1 or 1: the neighbour that shares the longer path beginning, the earlier of two alike; 0: none."""
    if before is None and after is None:
        return 0
    if before is None:
        return 1
    return -1 if after is None or _prefix(path, before) >= _prefix(path, after) else 1


def _shared(lines: list[tuple], other: list[tuple]) -> list[bool]:
    number: dict[str, int] = {}
    a, b = ([number.setdefault(x[0], len(number)) for x in page] for page in (lines, other))
    return common_lines(a, b)


def _resolve(path: str, lines: list[tuple], before: tuple | None, after: tuple | None) -> tuple[str, int, int]:
    """(text, lines, shared lines) of a page, given (path, lines) of its neighbours of the same host.

    Where the nearest neighbour is a copy, the other one is asked.
    """
    side = nearest(path, before and before[0], after and after[0])
    shared = [False] * len(lines)
    for other in (before, after) if side < 0 else (after, before):
        if other:
            shared = _shared(lines, other[1])
            if not all(shared):
                break
    return main_text(lines, shared), len(lines), sum(shared)


def _squeeze(lines: list[tuple]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(json.dumps(lines, ensure_ascii=False).encode("utf-8", "surrogatepass"))


def _expand(data: bytes) -> list[tuple]:
    return [tuple(x) for x in json.loads(zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass"))]


ANSWER = [("text", pa.string()), ("n_lines", pa.int64()), ("n_shared", pa.int64())]
#: A run's first and last page wait for the page across the border; inner: the neighbour on this side of it.
EDGE = [("run", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_()), ("host", pa.string()), ("path", pa.string()), ("lines", pa.binary()), ("inner_host", pa.string()), ("inner_path", pa.string()), ("inner_lines", pa.binary())]
KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
_shape = {v: k for k, v in KINDS.items()}


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_lines, n_shared) of every page; text is "" if nothing is left.

    A null html is an empty page. A null url has the empty host and path. Nulls and repeats in the id pass
    through, a row each; other columns are not read; an empty table gives no rows. Pages stand in the order of
    host, path, url, id and content, whatever the partitions: runs of the sort settle the pages inside, and
    their first and last pages are settled with the page across the border. No host gathers in one task.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1), F.lit(""))
    src = src.select("id", "url", host.alias("host"), path.alias("path"), F.xxhash64("html").alias("mark"), "html")
    kind = src.schema["id"].dataType.simpleString()
    id_type = to_arrow_type(src.schema["id"].dataType)

    def parse(batches):
        for b in batches:
            data = [_squeeze([(x.text, x.article, x.never) for x in page_lines(h)]) for h in b.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(data, pa.binary())], ["id", "url", "host", "path", "mark", "lines"])

    row = [("id", id_type), ("url", pa.string()), *ANSWER, *EDGE]

    def pair(batches):
        run = TaskContext.get().partitionId()
        held: list[tuple] = []

        def rows():
            for b in batches:
                for i, u, h, p, _, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                    yield i, u, h, p, _expand(x)

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held, strict=True), row, strict=True)], [n for n, _ in row])
            held.clear()
            return batch

        def edge(page, first, last, inner):
            own = page[2], page[3], _squeeze(page[4])
            near = (inner[2], inner[3], _squeeze(inner[4])) if inner else (None, None, None)
            return page[0], page[1], None, None, None, run, first, last, *own, *near

        def settle(before, now, after):
            if before is None or after is None:
                return edge(now, before is None, after is None, before or after)
            near = [(x[3], x[4]) if x[2] == now[2] else None for x in (before, after)]
            return now[0], now[1], *_resolve(now[3], now[4], *near), *[None] * len(EDGE)

        before = now = None
        for after in rows():
            if now is not None:
                held.append(settle(before, now, after))
            before, now = now, after
            if len(held) >= 500:
                yield out()
        if now is not None:
            held.append(settle(before, now, None))
            yield out()

    def across(batches):
        for b in batches:
            got = []
            for x in b.to_pylist():
                def near(name, x=x):
                    return (x[f"{name}_path"], _expand(x[f"{name}_lines"])) if x[f"{name}_host"] == x["host"] else None

                got.append(_resolve(x["path"], _expand(x["lines"]), near("before" if x["first"] else "inner"), near("after" if x["last"] else "inner")))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *[pa.array(c, t) for c, (_, t) in zip(zip(*got, strict=True), ANSWER, strict=True)]] if got else [*b.columns[:2], *[pa.array([], t) for _, t in ANSWER]], ["id", "url", *[n for n, _ in ANSWER]])

    shape = ", ".join(f"{n} {_shape[t]}" for n, t in ANSWER)
    parsed = src.mapInArrow(parse, f"id {kind}, url string, host string, path string, mark long, lines binary")
    order = ["host", "path", "url", "id", "mark"]
    sorted_pages = parsed.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    settled = staged(sorted_pages.mapInArrow(pair, f"id {kind}, url string, {shape}, " + ", ".join(f"{n} {_shape[t]}" for n, t in EDGE)), "pages")
    edges = settled.where("run IS NOT NULL")
    runs = sorted(r["run"] for r in edges.select("run").distinct().collect())  # one number a partition
    beside = spark.createDataFrame([(r, a, b) for r, a, b in zip(runs, [None, *runs], [*runs[1:], None], strict=False)], "run long, prior long, following long")

    def outer(name, side, key):
        return edges.where(side).select(F.col("run").alias(key), *[F.col(c).alias(f"{name}_{c}") for c in ("host", "path", "lines")])

    met = edges.join(beside, "run").join(outer("before", "last", "prior"), "prior", "left").join(outer("after", "first", "following"), "following", "left")
    names = ["id", "url", "host", "path", "lines", "first", "last", *[f"{n}_{c}" for n in ("inner", "before", "after") for c in ("host", "path", "lines")]]
    rest = met.select(*names).mapInArrow(across, f"id {kind}, url string, {shape}")
    out = settled.where("run IS NULL").select("id", "url", *[n for n, _ in ANSWER]).unionByName(rest)
    return out.withColumnRenamed("url", url_col).withColumnRenamed("id", id_col)
