"""Main text of web pages by differencing with the page of the nearest URL.

A page is cut into text lines, one per block. Pages of a host are put in the order of their
URL paths; pages with equal lines are one. Each is paired with the neighbour that shares the
longer path beginning and is not nearly the same page, and the lines of both are aligned by
longest common subsequence. What both pages say in the same
order belongs to the site and is deleted. Markup decides where it speaks clearly: lines in
menus, headers, footers, sidebars, notices, adverts, forms and comments always go; lines of
an article element are its text even if another page quotes them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywatch.llm.common import map_batches, replace_columns, stored, table

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)"
    r"(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
"""One attribute: its whole name, and its value by the kind of quotes."""
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol "
    "option p pre section select summary table tbody tfoot thead tr ul".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset("br td th img input button label".split())
ENDED_BY_BLOCK = "p"
REPEATING = frozenset("li dt dd tr td th option".split())
CONTENT, NEUTRAL, SITE = 2, 1, 0
SITE_TAGS = frozenset(
    "nav footer aside form head menu dialog button select object canvas".split())
SITE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu "
    "menubar toolbar".split())
SITE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner sidebar nav navbar navigation menu breadcrumb breadcrumbs masthead footer cookie "
    "cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe "
    "subscription signup login social share sharing comment comments disqus replies related "
    "recommended recommendations widget toolbar pagination pager copyright "
    "skiplink".split())
HIDDEN_NAMES = frozenset(["hidden", "is-hidden", "visually-hidden"])
"""Whole class names; as a part the word is ambiguous (overflow-hidden)."""
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card cards center col column container "
    "content desktop fixed floating grid group holder icon icons inline inner item items js "
    "layer left link links list main mobile module outer page panel placeholder post posts "
    "primary right row secondary section site slot space sticky strip tab tabs title top unit "
    "wrap wrapper zone".split())
"""Words that only say where or how: a name of a site word and these is the site's, while one
with any other word (social-science, login-flow, has-sidebar) is not."""
OUTSIDE_WORDS = frozenset(["header", "topbar"])
"""Words that mark site parts only outside an article."""
SAME_PAGE = 0.9
"""Share of the free text of both pages in common lines from which they are one page."""
CONTENT_TAGS = frozenset(["article", "main"])
CONTENT_ROLES = frozenset(["main", "article"])
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Line:
    text: str
    region: int


def names_site_part(name: str, words: frozenset[str] = SITE_WORDS) -> bool:
    """Whether a class name or id consists of site words and plain ones."""
    parts = [part for part in re.split(r"[^a-z0-9]+", name) if part.strip("0123456789x")]
    return any(part in words for part in parts) and all(
        part in words or part in SITE_WORDS or part in PLAIN_WORDS for part in parts)


def region_of(name: str, rest: str, around: int) -> int:
    """Region that an element opens inside a region. Nothing leaves a site region. An article or
    main element is the site's by a whole class name only, not by parts of one."""
    names, role, hidden = [], "", False
    if rest.strip(" /"):
        for key, *values in ATTRIBUTE.findall(rest):
            value = "".join(values).lower()
            key = key.lower()
            if key in ("class", "id"):
                names += value.split()
            elif key == "role":
                role = value.strip()
            elif key == "style":
                hidden |= bool(HIDDEN.search(value))
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
    if hidden or role in SITE_ROLES or not HIDDEN_NAMES.isdisjoint(names) or around == SITE:
        return SITE
    if name in CONTENT_TAGS or role in CONTENT_ROLES:
        return CONTENT if SITE_WORDS.isdisjoint(names) else SITE
    if name in SITE_TAGS or any(map(names_site_part, names)):
        return SITE
    if around != CONTENT and (
            name == "header" or any(names_site_part(n, OUTSIDE_WORDS) for n in names)):
        return SITE
    return around


def closed_elements(page: str) -> set[int]:
    """Where the elements begin that an end tag of their own closes."""
    closed: set[int] = set()
    stack: list[tuple[str, int]] = []
    for found in PIECE.finditer(page):
        name = (found["name"] or "").lower()
        if not name or name in VOID:
            continue
        if not found["end"]:
            stack.append((name, found.start()))
            continue
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == name:
                closed.add(stack[at][1])
                del stack[at:]
                break
    return closed


def page_lines(page: str) -> list[Line]:
    """Text lines of a page in order, without markup and blank lines.

    An article in a site part is part of it, such as a reader's comment or a card, unless the
    site part was never closed. If that leaves the page without any text of its own, articles
    count wherever they stand.
    """
    lines = lines_of(page, False)
    if lines and all(line.region == SITE for line in lines):
        return lines_of(page, True)
    return lines


def lines_of(page: str, everywhere: bool) -> list[Line]:
    """The lines; ``everywhere``: articles leave site parts that are closed, too."""
    closed: set[int] | None = None
    lines: list[Line] = []
    words: list[str] = []
    stack: list[tuple[str, int, int]] = []
    region = NEUTRAL

    def close_line() -> None:
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                lines.append(Line(text, region))
            words.clear()

    def pop(name: str) -> None:
        nonlocal region
        for at in range(len(stack) - 1, -1, -1):
            if stack[at][0] == name:
                del stack[at:]
                region = stack[-1][1] if stack else NEUTRAL
                return

    at = 0
    for found in PIECE.finditer(page):
        if found.start() > at:
            words.append(page[at:found.start()])
        at = found.end()
        name = found["name"]
        if not name:
            words.append(" ") if found["raw"] else None
            continue
        name = name.lower()
        if name in BLOCKS:
            close_line()
        elif name in SPACED:
            words.append(" ")
        if found["end"]:
            pop(name)
            continue
        if name in VOID:
            continue
        if name in BLOCKS and stack and stack[-1][0] == ENDED_BY_BLOCK:
            pop(ENDED_BY_BLOCK)
        if name in REPEATING and stack and stack[-1][0] == name:
            pop(name)
        rest = found["rest"] or ""
        inside = region_of(name, rest, region)
        if region == SITE and region_of(name, rest, NEUTRAL) == CONTENT:
            # the element that opened the site part
            opener = next(begin for _, kind, begin in stack if kind == SITE)
            if not everywhere and closed is None:
                closed = closed_elements(page)
            if everywhere or opener not in closed:
                inside = CONTENT
        if inside != region:
            close_line()
        region = inside
        stack.append((name, region, found.start()))
    words.append(page[at:])
    close_line()
    return lines


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def common_lines(left: list[int], right: list[int]) -> list[int]:
    """Positions in ``left`` of a longest common subsequence with ``right``.

    Rows of the length table are kept as bit vectors: a zero bit says that the length grows
    at this line of ``left``.
    """
    begin = 0
    while begin < min(len(left), len(right)) and left[begin] == right[begin]:
        begin += 1
    end = 0
    while end < min(len(left), len(right)) - begin and left[-1 - end] == right[-1 - end]:
        end += 1
    outer = [*range(begin), *range(len(left) - end, len(left))]
    a, b = left[begin:len(left) - end], right[begin:len(right) - end]
    if not set(a) & set(b):
        return outer
    # a line that the other side lacks cannot be shared
    of_b = set(b)
    own = [i for i, line in enumerate(a) if line in of_b]
    a, b = [a[i] for i in own], [line for line in b if line in set(a)]
    places: dict[int, int] = {}
    for i, line in enumerate(a):
        places[line] = places.get(line, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows = [full]
    for line in b:
        row = rows[-1]
        hit = row & places.get(line, 0)
        rows.append((row + hit | row - hit) & full)
    found, i, j = [], len(a) - 1, len(b)
    while i >= 0 and j > 0:
        if rows[j] >> i & 1:
            i -= 1
        elif not rows[j - 1] >> i & 1:
            j -= 1
        else:
            found.append(begin + own[i])
            i, j = i - 1, j - 1
    return sorted(outer + found)


def host_and_path(url: str) -> tuple[str, str]:
    """Lower-case host, and path with query and fragment; odd URLs have no host."""
    try:
        parts = urlsplit(url)
        return (parts.netloc.lower(), url.split(parts.netloc, 1)[1] if parts.netloc else url)
    except ValueError:
        return "", url


def page_key() -> Column:
    """Digest of URL and content; equal pages have equal results."""
    return F.md5(F.concat_ws("\x00", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))


def outlines(pages: DataFrame) -> DataFrame:
    """One row per page with an article, and per host and different sequence of lines without:
    the keys of the pages (``page_keys``), the first path and its ``page_key``, the hashes of the
    lines outside articles (``marks``) and their lengths where markup does not decide (``sizes``,
    else 0)."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            places = [host_and_path(u or "") for u in batch.column("url").to_pylist()]
            whole = [page_lines(h or "") for h in batch.column("html").to_pylist()]
            lines = [[x for x in own if x.region != CONTENT] for own in whole]
            return replace_columns(
                batch, ["url", "html"], host=pa.array([p[0] for p in places], pa.string()),
                path=pa.array([p[1] for p in places], pa.string()),
                marks=pa.array([[line_hash(x.text) for x in own] for own in lines],
                               pa.list_(pa.int64())),
                sizes=pa.array([[len(x.text) if x.region == NEUTRAL else 0 for x in own]
                                for own in lines], pa.list_(pa.int32())),
                free=pa.array([len(a) == len(b) for a, b in zip(lines, whole)], pa.bool_()),
            )

        return step

    rows = pages.select(page_key().alias("page_key"), "url", "html")
    found = map_batches(
        rows, make,
        "page_key string, host string, path string, marks array<long>, sizes array<int>, "
        "free boolean")
    texts = [F.col(c).cast("array<string>") for c in ("marks", "sizes")]
    outline = F.when(F.col("free"), F.md5(F.concat_ws(",", *texts))).otherwise(F.col("page_key"))
    return found.groupBy("host", outline.alias("outline")).agg(
        F.min(F.struct("path", "page_key")).alias("least"),
        F.collect_set("page_key").alias("page_keys"),
        F.first("marks").alias("marks"), F.first("sizes").alias("sizes")).select(
        "host", "least.path", "least.page_key", "page_keys", "marks", "sizes")


def ranked(pages: DataFrame) -> DataFrame:
    """Rows numbered 0, 1, ... by host, path and key. The sort is cut into ranges of rows,
    so one large host is spread over many tasks; only the ranges' sizes reach the driver."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            place = pa.array(range(seen, seen + batch.num_rows), pa.int64())
            seen += batch.num_rows
            yield replace_columns(batch, [], place=place)

    ordered = pages.orderBy("host", "path", "page_key").withColumn(
        "part", F.spark_partition_id())
    schema = StructType(ordered.schema.fields + StructType.fromDDL("place long").fields)
    placed = stored(ordered.mapInArrow(number, schema), "ranked")
    sizes = sorted((r.part, r["count"]) for r in placed.groupBy("part").count().collect())
    before, total = {}, 0
    for part, size in sizes:
        before[part] = total
        total += size
    if not before:
        return placed.withColumn("rank", F.col("place"))
    pairs = [x for part, start in before.items() for x in (F.lit(part), F.lit(start))]
    return placed.withColumn("rank", F.create_map(*pairs)[F.col("part")] + F.col("place"))


def shared_prefix(left: str, right: str) -> int:
    n = 0
    for a, b in zip(left, right):
        if a != b:
            break
        n += 1
    return n


def same_page(
    left: list[int], right: list[int], left_sizes: list[int], right_sizes: list[int],
) -> bool:
    """Whether the free text of both pages lies nearly all in lines that both hold."""
    if not sum(left_sizes) + sum(right_sizes):
        return False
    of_left, of_right = set(left), set(right)
    for marks, sizes, other in ((left, left_sizes, of_right), (right, right_sizes, of_left)):
        whole = sum(sizes)
        if sum(n for m, n in zip(marks, sizes) if m in other) < SAME_PAGE * whole:
            return False
    return True


def site_lines(pages: DataFrame) -> DataFrame:
    """(page_key, shared): positions, among a page's lines outside articles, of the lines it
    shares with its partner. Pages that are alone on their host share nothing, nor do pages
    between two that are nearly the same."""
    rows = ranked(outlines(pages)).select(
        "rank", "page_keys", "host", "path", "marks", "sizes")
    neighbour = F.struct("host", "path", "marks", "sizes")
    # each row visits the rows before and after it
    visits = rows.select((F.col("rank") - 1).alias("rank"), neighbour.alias("next")).join(
        rows, "rank", "right").join(
        rows.select((F.col("rank") + 1).alias("rank"), neighbour.alias("last")), "rank", "left")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for row in batch.select(["host", "path", "marks", "sizes", "last", "next"]).to_pylist():
                best, closest = None, -1
                for other in (row["last"], row["next"]):
                    if other and other["host"] == row["host"] and row["host"]:
                        near = shared_prefix(other["path"], row["path"])
                        if near > closest and not same_page(
                                row["marks"], other["marks"], row["sizes"], other["sizes"]):
                            best, closest = other, near
                out.append(common_lines(row["marks"], best["marks"]) if best else [])
            return pa.RecordBatch.from_arrays(
                [batch.column("page_keys"), pa.array(out, pa.list_(pa.int32()))],
                ["page_keys", "shared"])

        return step

    found = map_batches(
        visits.select("page_keys", "host", "path", "marks", "sizes", "last", "next"), make,
        "page_keys array<string>, shared array<int>")
    return found.select(F.explode("page_keys").alias("page_key"), "shared")


def main_text(page: str, shared: list[int]) -> str:
    """Lines of the article; without one, the neutral lines that the partner lacks."""
    lines = page_lines(page)
    if any(line.region == CONTENT for line in lines):
        return "\n".join(line.text for line in lines if line.region == CONTENT)
    gone = set(shared)
    outside = [line for line in lines if line.region != CONTENT]
    return "\n".join(
        line.text for i, line in enumerate(outside) if line.region == NEUTRAL and i not in gone)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_shared_lines) of every row; a null html has an empty text.

    Repeated rows have equal results. Without URL or host a page has no partner.
    """
    found = stored(site_lines(pages.select("url", "html")), "shared")
    rows = pages.select("page_id", "url", "html", page_key().alias("page_key"))
    both = rows.join(found, "page_key", "left")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [
                main_text(h or "", s or []) for h, s in zip(
                    batch.column("html").to_pylist(), batch.column("shared").to_pylist())
            ]
            return replace_columns(batch, ["html", "shared"], text=pa.array(texts, pa.string()))

        return step

    narrow = both.select("page_id", "url", F.size("shared").alias("n_shared_lines"), "html", "shared")
    schema = StructType(
        [narrow.schema[c] for c in ("page_id", "url", "n_shared_lines")]
        + StructType.fromDDL("text string").fields)
    return map_batches(narrow, make, schema)


def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = extract_pages(table(spark, folder, "pages"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
        "n_shared_lines")
