"""Main text of made pages, and repeated words of hosts against all pairs of pages."""

import collections
import html
import random
import re

import pytest

from tidemark.llm import html_text
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_articles_of_the_table(spark):
    pages = {r.page_id: r.html for r in table(spark, SMALL, "pages").collect()}
    rows = QUERIES["op5_html_text"](spark, SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"(?:</?(?:p|h1|b)>|<br>)+", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


CASES = [
    ("<article><p>One &amp; two&nbsp;three</p><p> four\n five </p></article>", "One & two three\n\nfour five"),
    ("<article>a<b>b</b><i> c</i><br>d</article>", "ab c d"),
    ("<nav>menu</nav><article><p>x</article><footer>foot</footer>", "x"),
    ("<header>top</header><main><header><h1>Title</h1></header><p>x</p></main>", "Title\n\nx"),
    ("<article><p>x</p><div class='share-bar social'>tweet</div><p>y</p></article>", "x\n\ny"),
    ("<article><p>x</p><section id=comments><article><p>hi</p></article></section></article>", "x"),
    ("<article><p>x</p><div class=comment><p>one<p>two</div><p>y</article>", "x\n\ny"),
    ("<article><script>var t='</p>';if(a<b){}</script><style>p{}</style><p>x</p></article>", "x"),
    ("<article><!-- <p>no</p> --><p>x<!--a-->y</p></article>", "xy"),
    ("<article><p title='a > b' class=\"lead\">x</p></article>", "x"),
    ("<article><form><p>name</p><input></form><aside><p>side</p></aside><p>x", "x"),
    ("<article><p class='ad'>buy<p>x</p></article>", "x"),
    ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\n\nb\n\nc\n\nd"),
    ("<article><div class=header-image>caption</div>1 < 2 &lt; 3 &#x41;&copy &bogus;</article>", "caption\n\n1 < 2 < 3 A© &bogus;"),
    ("<article><p>x</p><p hidden>no</p><div role=navigation>no</div></article>", "x"),
    ("<p>lonely</p>text", "lonely\n\ntext"),
    ("<div><article></article></div>", ""),
    ("</p></div><article>x</b></article></body>", "x"),
    ("<article><p>a<script>b", "a"),
    ("<ARTICLE><P>x<BR/>y</P></ARTICLE>", "x y"),
    ("", ""),
    ("<", "<"),
    ("<article><p>x <", "x <"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_blocks(page, text):
    inner, outer, found = html_text.blocks(page)
    assert "\n\n".join(inner if found else outer) == text


CONTAINERS = [
    ("<body class='has-sidebar'><article><p>x</p></article></body>", "x"),
    ("<body class='sidebar menu'><p>x</p></body>", "x"),
    ("<div id=page class='content with-sidebar'><p>x</p></div><p>y</p>", "x\n\ny"),
    ("<article class='post related'><p>x</p></article>", "x"),
    ("<main id=main-nav-content class='page-menu'><p>x</p></main>", "x"),
    ("<div class='layout-sidebar'><article><p>x</p><div class='share-bar'>no</div></article></div><p>y</p>", "x"),
    ("<div class='layout-sidebar'><p>x</p><nav>no</nav></div>", "x"),
    ("<div class='site-header'>no</div><article><p>x</p></article><div class='widget-area'><article>no</article></div>", "x"),
    ("<div class='cookie-banner'>no</div><p>x</p>", "x"),
    ("<div class=comments><article>no</article></div><p>x</p>", "x"),
    ("<article><p>x</p><article class='comment-body'>no</article></article>", "x"),
]


@pytest.mark.parametrize("page, text", CONTAINERS)
def test_names_of_containers(page, text):
    inner, outer, found = html_text.blocks(page)
    assert "\n\n".join(inner if found else outer) == text


def test_repeated_strings_of_a_host_go(spark):
    """Pages without article elements: words in strings of eight that another page of the host has."""
    rng = random.Random(1)
    menus = [" ".join(f"m{h}x{i}" for i in range(12)) for h in range(3)]
    rows = []
    for i in range(60):
        host = i % 3
        own = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randint(1, 30))) for _ in range(3)]
        parts = [menus[host][: rng.choice([20, 200])], *own, menus[(host + (i % 7 == 0)) % 3]]
        rows.append((i, f"http://h{host}.example/{i}", "<body>" + "".join(f"<div>{p}</div>" for p in parts)))
    rows += [(100, rows[0][1], rows[0][2]), (100, rows[0][1], rows[0][2]), (101, "http://one.example", "<p>" + menus[0])]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages = collections.defaultdict(set)
    words = {}
    for page in {(r[0], r[1], r[2]) for r in rows}:
        flat = words[page] = " ".join(html_text.blocks(page[2])[1]).split(" ")
        for i in range(len(flat) - 7):
            pages[html_text.host_of(page[1]), tuple(flat[i : i + 8])].add(page)
    want = collections.Counter()
    for page in rows:
        flat, gone = words[page], set()
        for i in range(len(flat) - 7):
            if len(pages[html_text.host_of(page[1]), tuple(flat[i : i + 8])]) > 1:
                gone |= set(range(i, i + 8))
        want[page[0], " ".join(w for i, w in enumerate(flat) if i not in gone)] += 1
    found = html_text.main_text(frame).collect()
    assert collections.Counter((r.page_id, r.text.replace("\n\n", " ")) for r in found) == want
    assert any(menus[0] in r.text for r in found if r.page_id == 101)


def test_copies_of_articles_stay(spark):
    body = "<article><p>" + " ".join(f"w{i}" for i in range(50)) + "</p></article>"
    rows = [(i, "http://a.example/", body) for i in range(5)]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in found} == {" ".join(f"w{i}" for i in range(50))} and len(found) == 5


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "::bad[", "<p>x"), (2, "http://[", ""), (2, "http://[", ""), (3, "", "<p>" + "y " * 100_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    frame = frame.selectExpr("*", "'t' AS text", "1 AS page", "2 AS host")
    found = html_text.main_text(frame).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in found) == [(0, 1), (1, 0), (2, 0), (2, 0), (3, 199_999)]
    assert html_text.main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article style="overflow:hidden"><p>Text</p></article>', "Text"),
        ('<article><p>See <a href="/hidden-gems">hidden gems</a> here.</p></article>', "See hidden gems here."),
        ('<article><p title="a hidden valley">Down there.</p></article>', "Down there."),
        ('<article><div aria-hidden="false">Shown</div><div aria-hidden="true">Icon</div></article>', "Shown"),
        ('<article><div data-id="menu">Dishes</div><div data-role="navigation">Routes</div></article>', "Dishes\n\nRoutes"),
        ('<article><h2 id="notices">Notices</h2><p class="related work">Others did so.</p></article>', "Notices\n\nOthers did so."),
        ('<article>Main</article><article class="comment">Nice post</article>', "Main"),
        ('<article>Main<article class="user comment">Nice post</article></article>', "Main"),
        ("<div><p>Text</p><article></article></div>", "Text"),
        ('<div><p>Text</p><article><div hidden>No</div></article></div>', "Text"),
        ("<article><p hidden>No</p><p HIDDEN=until-found>No</p><p class='x' hidden = ''>No</p><p>Yes</p></article>", "Yes"),
        ('<article><div class="newsletter">Sign up</div><p>Yes</p></article>', "Yes"),
        ("<article/><p>a</p>", "a"),
    ],
)
def test_attributes_count_by_name_and_value(page, want):
    inner, outer, found = html_text.blocks(page)
    assert "\n\n".join(inner if found else outer) == want
