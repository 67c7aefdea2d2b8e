"""Page extraction: markup rules, and the whole query against a plain version on a site without articles."""

import random

import pytest
from pyspark.sql import functions as F

from rimstone.llm import html
from rimstone.llm.html import ARTICLE, MAIN, OUTSIDE, SITE, page_lines

SCHEMA = "page_id long, url string, html string"


def main(page: str) -> list[str]:
    found = page_lines(page)
    best = (ARTICLE, MAIN) if any(at in (ARTICLE, MAIN) for _, at in found) else (OUTSIDE,)
    return [line for line, at in found if at in best]


@pytest.mark.parametrize("name", ["post-comments", "comment-body", "entry-footer", "article-sidebar", "story-share", "post ad"])
def test_names_of_the_site_win_inside_an_article(name):
    page = f"<article class='post comments-open'><h1>Head</h1><div class='entry-content no-sidebar'>Text</div><div class='{name}'>Other</div></article>"
    assert main(page) == ["Head", "Text"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><form><nav>Menu</nav><div>Text</div></form></body>", ["Text"]),  # a form around the page
        ("<body><form><p>Text</p><button>Go</button></form></body>", ["Text"]),  # nothing else on the page
        ("<body><p>Text</p><form><p>Your name</p></form></body>", ["Text"]),
        ("<main><p>Text</p><form><p>Your name</p></form></main>", ["Text"]),
        ("<form><article><p>Text</p><form>Name</form></article><p>Other</p></form>", ["Text"]),
        ("<div class='content sidebar'><h1>Head</h1><p>Text</p></div>", ["Head", "Text"]),
        ("<div class='content sidebar'><article>Text</article><p>Other</p></div>", ["Text"]),
        ("<article>Text</article><div class='post-related'><article>Other</article><h1>More</h1></div>", ["Text"]),
        ("<article>Text<article class='comment post'>Nice</article></article>", ["Text"]),
        ("<p>Text</p><div class='post-comments'><p>Nice</p></div>", ["Text"]),
        ("<div role='form'><p>Your name</p></div><p>Text</p>", ["Text"]),
        ("<nav>Menu</nav><footer>End</footer>", []),
        ("<div class='content ad'><form>" * 400 + "<h1>Head</h1>", ["Head"]),
    ],
)
def test_frames_around_the_page(page, text):
    assert main(page) == text


def longest_common(a: list[str], b: list[str]) -> set[int]:
    """Places of `a` in the longest common subsequence, by the plain table."""
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            size[i + 1][j + 1] = size[i][j] + 1 if x == y else max(size[i][j + 1], size[i + 1][j])
    places, i, j = set(), len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            places.add(i - 1)
            i, j = i - 1, j - 1
        elif size[i - 1][j] >= size[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return places


def test_differencing_decides_the_rows_of_a_site_without_articles(spark):
    """Hosts with path and query addresses; every line occurs once on a page, in one order, so the subsequence is unique."""
    rng = random.Random(5)
    rows, lines_of, address = [], {}, {}
    for host in range(4):
        frame = [f"Frame {host} {i}" for i in range(6)]
        for page in range(1 if host == 3 else 12):
            path = f"/index.php?id={page + 10}" if host == 0 else f"/s{page % 3}/{rng.randrange(9)}/p{page + 10}"
            kept = [line for line in frame if rng.random() < 0.7]
            at = rng.randrange(len(kept) + 1)
            lines = kept[:at] + [f"Own {host} {page} {i}" for i in range(rng.randrange(3))] + kept[at:]
            page_id = host * 100 + page
            tail = "#top" if page % 2 else "&utm_source=x" if "?" in path else "/?utm_source=x"
            rows.append((page_id, f"http://h{host}.example{path}{tail}", "".join(f"<p>{line}</p>" for line in lines)))
            lines_of[page_id], address[page_id] = lines, (host, path)
    expected = {}
    for page_id, (host, path) in address.items():
        around = sorted(p for h, p in address.values() if h == host)
        i = around.index(path)

        def common(other: str, mine: str = path) -> int:
            a, b = (p.replace("?", "/").replace("&", "/").split("/") for p in (mine, other))
            return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

        near = [around[j] for j in (i - 1, i + 1) if 0 <= j < len(around)]
        other = max(near, key=common, default=None)  # the former one in a tie
        theirs = next((lines_of[k] for k, v in address.items() if v == (host, other)), [])
        shared = longest_common(lines_of[page_id], theirs)
        kept = [line for k, line in enumerate(lines_of[page_id]) if k not in shared]
        expected[page_id] = "\n".join(kept or lines_of[page_id])
    assert sum(expected[k] != "\n".join(v) for k, v in lines_of.items()) > 20
    wide = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("at", "marks", "near", "other", "text")})
    assert {r.page_id: r.text for r in html.extract_main_text(wide).collect()} == expected


def test_very_long_pages(spark):
    own = [f"Line {i} " + "word " * 50 for i in range(20_000)]
    pages = ["".join(f"<p>{line}</p>" for line in ["Top", *own[k::2], "End"]) for k in (0, 1)]
    frame = spark.createDataFrame([(k, f"http://h.example/{k}", page) for k, page in enumerate(pages)], SCHEMA)
    got = {r.page_id: r.text for r in html.extract_main_text(frame).collect()}
    assert got == {k: "\n".join(line.strip() for line in own[k::2]) for k in (0, 1)}
