"""Main text of web pages by differencing each page with its nearest neighbour.

Pages of a host are put in the order of their URL paths and queries; a page's neighbour is the adjoining one that shares
more leading segments. The text lines of both are aligned by a longest common subsequence. Shared lines are what the
site puts on every page and go, as do lines whose markup says that they are menus, adverts and the like. Lines inside
the page's own article element are checked against that element and stay: two addresses may show one article.

Markup is judged by tags, roles and the class names of an element. A form, or an element whose classes name both the
content and something else, may also be a frame around the whole page; whether it is one shows only in what it holds,
so its lines are marked as doubtful first and decided when the page has been read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rimstone.llm.common import global_positions, materialize, per_slice

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|select)\b[^>]*+(?:>.*?(?:</(?P=raw)\s*+>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?P<close>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*=\s*("[^"]*"?|'[^']*'?|[^\s"']+)""")
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot "
    "thead tr ul".split()
)
CHROME = set("nav footer aside button menu dialog object canvas head".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
NAMES = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup modal "
    "overlay newsletter subscribe signup share sharing social related recommended comment comments disqus replies "
    "pagination pager toolbar widget copyright".split()
)
OWN = set("content article main post entry story body".split())
STATES = set("has with no without is not enabled disabled open closed on off".split())  # sidebar-off names no sidebar
OUTSIDE, ARTICLE, SITE, MAIN = 0, 1, 2, 3  # where a line stands; MAIN: in the main element, but in no article
DOUBTFUL = 4  # this and larger numbers: in an element that is either part of the site or a frame around the page


def judged(tag: str, attrs: str, where: int) -> str:
    """What an element's markup says: "site", "form" or "mixed" where it may be a frame, and "" where it says nothing.

    Within an article a class that names a sidebar, comments and so on decides, whatever else it names. Outside, an
    element that names the content too may be what surrounds article and sidebar, and an article is its own root.
    """
    in_article = where == ARTICLE
    if tag in CHROME or tag == "header" and where not in (ARTICLE, MAIN) or tag == "form" and in_article:
        return "site"
    doubt = "form" if tag == "form" else ""
    if not attrs or tag in ("html", "body", "main"):
        return doubt
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attrs)}
    if found.get("role") in ROLES - {"form"} or found.get("aria-hidden") == "true":
        return "site"
    if found.get("role") == "form":
        doubt = "site" if in_article else "form"
    names = [set(re.findall(r"[a-z]+", name)) for name in f"{found.get('class', '')} {found.get('id', '')}".split()]
    own = any(words & OWN for words in names)
    if any(words & NAMES and not words & STATES for words in names):
        if not own or in_article:
            return "site"
        return doubt if tag == "article" else doubt or "mixed"
    if any("header" in words for words in names) and where not in (ARTICLE, MAIN) and not own:
        return "site"
    return doubt


def decided(lines: list[tuple[str, int]], doubts: list[tuple[int, str, set[str]]]) -> list[tuple[str, int]]:
    """`lines` with what each doubtful element is: its surroundings' place where it is a frame, else part of the site.

    A form is a frame if it holds an article, a main element, a menu or a top heading. A mixed element is one if it
    holds an article, a main element or a top heading, and the page has no article or main element elsewhere. If
    nothing is left of a page otherwise, forms with paragraphs are frames.
    """
    if not doubts:
        return lines

    def resolve(frames: dict[str, set[str]]) -> list[tuple[str, int]]:
        place: list[int] = []
        for parent, kind, signs in doubts:  # parents come before what they hold
            above = place[parent - DOUBTFUL] if parent >= DOUBTFUL else parent
            held = ARTICLE if kind == "article" and above != SITE else above
            place.append(held if signs & frames[kind] else SITE)
        return [(line, place[at - DOUBTFUL] if at >= DOUBTFUL else at) for line, at in lines]

    held = {"article", "main", "h1"}
    frames: dict[str, set[str]] = {"form": held | {"nav"}, "mixed": set(), "article": {"article"}}
    made = resolve(frames)
    if not any(at in (ARTICLE, MAIN) for _, at in made):
        made = resolve(frames := frames | {"mixed": held})
    if all(at == SITE for _, at in made):
        made = resolve(frames | {"form": held | {"nav", "p"}})
    return made


def page_lines(page: str) -> list[tuple[str, int]]:
    """Text lines of a page, one for each block, and where each stands. Cut tags and entities at the end are allowed."""
    stack: list[tuple[str, int]] = []
    lines: list[tuple[str, int]] = []
    text: list[str] = []
    doubts: list[tuple[int, str, set[str]]] = []  # place around, kind, and telling elements inside
    where = OUTSIDE

    def flush() -> None:
        if line := " ".join("".join(text).split()):
            lines.append((line, where))
        text.clear()

    def doubtful(kind: str, signs: set[str]) -> int:
        doubts.append((where, kind, signs))
        return DOUBTFUL + len(doubts) - 1

    for m in TOKEN.finditer(page):
        if (plain := m["text"]) is not None:
            text.append(html.unescape(plain) if "&" in plain else plain)
            continue
        tag = (m["tag"] or "").lower()
        if not tag or not m["close"]:
            continue
        if tag in BLOCK:
            flush()
        elif tag in ("br", "td", "th", "img"):
            text.append(" ")
        if m["end"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if at is not None:
                if any(s[0] in BLOCK for s in stack[at:]) or stack[at][1] != where:
                    flush()
                where = stack[at][1]
                del stack[at:]
        elif tag not in VOID and not m["attrs"].endswith("/"):
            if tag == "p" and stack and stack[-1][0] == "p":
                where = stack.pop()[1]
            stack.append((tag, where))
            if where != SITE:
                # Inside a doubtful element the nearest place that is known counts.
                known, above = where, False
                while known >= DOUBTFUL:
                    above |= doubts[known - DOUBTFUL][1] == "article"
                    known = doubts[known - DOUBTFUL][0]
                known = ARTICLE if above else known
                says = judged(tag, m["attrs"], known)
                if tag in ("article", "main", "h1", "p") and not says or tag == "nav":
                    around = where
                    while around >= DOUBTFUL:
                        doubts[around - DOUBTFUL][2].add(tag)
                        around = doubts[around - DOUBTFUL][0]
                inside = where
                if says:
                    inside = SITE if says == "site" else doubtful(says, set())
                elif tag == "article" and known in (OUTSIDE, MAIN):
                    inside = doubtful("article", {"article"}) if where >= DOUBTFUL else ARTICLE
                elif where == OUTSIDE and (tag == "main" or 'role="main"' in m["attrs"]):
                    inside = MAIN
                if inside != where:
                    flush()
                where = inside
    flush()
    return decided(lines, doubts)


def shared_lines(mine: list, other: list) -> set[int]:
    """Places of `mine` in a longest common subsequence with `other`.

    Bit-parallel: row i is an integer whose clear bits mark the places of `other` where the length grows, so a page
    of thousands of lines costs a few wide integer operations for each line. Lines that only one side has are left out
    first, so memory grows with what both have.
    """
    both = set(mine) & set(other)
    places = [i for i, line in enumerate(mine) if line in both]
    mine, other = [mine[i] for i in places], [line for line in other if line in both]
    where: dict = {}
    for j, line in enumerate(other):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    rows, row = [full], full
    for line in mine:
        hit = row & where.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    shared, i, j = set(), len(mine), len(other)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1  # the length does not grow at j
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1  # it grew there without line i as well
        else:
            shared.add(places[i - 1])
            i, j = i - 1, j - 1
    return shared


def main_lines(lines: list[str], at: list[int], own: list[bool], marks: list[int], other: list[int]) -> tuple[list[str], int]:
    """Lines of the main text, and how many lines the neighbour shares.

    `lines` may be main text, `at` are their places on the page and `own` tells which are of the page's own article.
    """
    shared = shared_lines(marks, other)
    kept = [line for line, i, mine in zip(lines, at, own, strict=True) if mine or i not in shared]
    return kept or lines, len(shared)  # two equal pages have no difference to tell by


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path and query of an address; a query without what only says where a visitor comes from."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    query = F.regexp_replace(query, r"(?i)(^|&)(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, "^&", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), "/+$", "")
    return F.when(query == "", path).otherwise(F.concat(path, F.lit("?"), query))


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, the lines that may be main text, their places, and a 64-bit mark of every line."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lines, at, own, marks = [], [], [], []
        for page in batch["html"].to_pylist():
            found = page_lines(page or "")
            best = (ARTICLE, MAIN) if any(where in (ARTICLE, MAIN) for _, where in found) else (OUTSIDE,)
            at.append([i for i, (_, where) in enumerate(found) if where in best])
            lines.append([found[i][0] for i in at[-1]])
            own.append([found[i][1] == ARTICLE for i in at[-1]])
            marks.append([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "big", signed=True) for x, _ in found])
        named = {c: batch[c] for c in ("page_id", "url", "host", "path")}
        named |= {"lines": pa.array(lines, pa.list_(pa.string())), "at": pa.array(at, pa.list_(pa.int32()))}
        named |= {"own": pa.array(own, pa.list_(pa.bool_())), "marks": pa.array(marks, pa.list_(pa.int64()))}
        yield pa.RecordBatch.from_pydict(named)

    read = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    schema = (
        "page_id long, url string, host string, path string, lines array<string>, at array<int>, own array<boolean>, "
        "marks array<long>"
    )
    return read.mapInArrow(per_slice(run, "html"), schema)


def neighbours(paths: DataFrame) -> DataFrame:
    """host, path, and the `near` path of the same host for distinct paths; hosts of one path have none."""
    placed, _, _ = global_positions(paths, ["host", "path"])
    placed = placed.select("host", "path", F.col("__row").alias("at"))
    sides = [
        placed.select((F.col("at") + step).alias("at"), F.col("host").alias(f"host{i}"), F.col("path").alias(f"path{i}"))
        for i, step in enumerate((1, -1))
    ]
    both = placed.join(sides[0], "at", "left").join(sides[1], "at", "left")

    def common(i: int) -> Column:
        """One more than the number of leading segments in common; null for a page of another host."""
        equal = F.zip_with(F.split("path", "[/?&]"), F.split(f"path{i}", "[/?&]"), lambda a, b: F.coalesce(a == b, F.lit(False)))
        return F.when(F.col(f"host{i}") == F.col("host"), F.array_position(equal, False))

    best = F.when(common(1).isNull() | (common(0) >= common(1)), F.when(common(0).isNotNull(), F.col("path0")))
    return both.select("host", "path", F.coalesce(best, F.when(common(1).isNotNull(), F.col("path1"))).alias("near"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_shared (lines shared with the neighbour) for every row of `pages`.

    A null page is empty and has the empty text, as has one that holds nothing but parts of the site. Pages of one path share their neighbour; the page with the smallest
    id stands for a path. Addresses without host form a host of their own. Other columns are ignored, repeated rows
    are extracted each. Only paths are sorted globally; no host is gathered in one task.
    """
    lines = parsed(pages)
    # Only marks are written and sorted; pages are read again for their lines, which then move once.
    marks = materialize(lines.select("page_id", "url", "host", "path", "marks"), "page-marks")
    one = marks.groupBy("host", "path").agg(F.min_by("marks", F.struct("page_id", "url", "marks")).alias("other"))
    near = neighbours(marks.select("host", "path").distinct())
    of_path = near.join(one.select("host", F.col("path").alias("near"), "other"), ["host", "near"])
    of_path = materialize(of_path.select("host", "path", "other"), "neighbours")
    joined = lines.join(of_path, ["host", "path"], "left")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("lines", "at", "own", "marks", "other"))
            made = [main_lines(*row[:4], row[4] or []) for row in zip(*columns, strict=True)]
            texts = ["\n".join(kept) for kept, _ in made]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"], "url": batch["url"], "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                    "n_shared": pa.array([n for _, n in made], pa.int64()),
                }
            )

    schema = "page_id long, url string, text string, n_chars long, n_shared long"
    return joined.select("page_id", "url", "lines", "at", "own", "marks", "other").mapInArrow(run, schema)
