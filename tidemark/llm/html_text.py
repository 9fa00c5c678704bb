"""Main text of web pages: structure first, then a suffix array of each host.

A page is read once, tag by tag. Text in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments goes, by element, role or class, or because it is hidden. If
the page has an ``article`` or ``main`` with text, its blocks are the main text.

Class and id words say little about an element that holds the page: they are not asked of
html, body, main and outermost articles (but readers' comments, which may be articles too),
nor where the name is a state (``has-sidebar``), nor of headings and paragraphs of an article (but those with listed class words only).
Elements outside of articles that go for a part of a longer name (``layout-sidebar``) stay
if the page's only articles, or all of its text, are inside them.

A page without them keeps what its host's other pages do not have: the words of all host
pages outside articles are one stream per page; the stream's suffixes, ordered by their
first ``LEAST`` words, stand beside their equals, and a string that stands in two distinct
pages is boilerplate. Its words are removed and the runs between them kept. Suffixes are
needed in order to that depth only, so Spark's aggregation by host and hashed leading words
brings equals together: per host and lead the smallest and the largest page. Leads are
combined in each task first, so neither a host with a third of all pages nor a menu on all
of them goes to one task whole.

Inside an article nothing is removed for being repeated: copies of an article, and
passages that articles share, are main text.

Null html or url counts as empty; every row gives a row, repeated rows too (equal rows are
not distinct pages). A page without text gives an empty text. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Words of a string that is boilerplate where it repeats.
LEAST = 8

# A raw element with all it holds, a comment, or a tag.
PARTS = re.compile(
    r"(<(?:script|style|textarea|title|iframe|noframes|noembed|xmp)\b.*?(?:</(?:script|style|textarea|title|iframe|noframes|noembed|xmp)\s*>|\Z)"
    r"|<!--.*?(?:-->|\Z)"
    r"|<[/!?a-zA-Z](?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^>]*(?:>|\Z)))",
    re.S | re.I,
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# An attribute of a tag: its name, and its value in one of three forms.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "nav footer aside form button select option dialog menu noscript template svg canvas object head datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
CLASSES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner cookie cookies consent gdpr notice notices notification "
    "sidebar menu menus nav navbar navigation breadcrumb breadcrumbs comment comments discussion disqus respond promo "
    "promotion sponsor sponsored newsletter subscribe subscription share sharing social related widget popup modal "
    "overlay toolbar pagination pager masthead footer topbar".split()
)


#: Elements of the text itself: inside an article their names say what they are about, unless
#: the listed words are all there is.
TEXTUAL = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre dt dd td th caption figcaption".split())
#: Class names of articles that are not the page's.
REPLIES = frozenset("comment comments reply respond discussion".split())

#: Parts of names that tell what a page has or shows, not what the element is.
STATES = frozenset("has have with without no not".split())
WHOLE = frozenset("html body main".split())


def _is_dropped(name: str, tag: str, inside: bool) -> tuple[bool, bool]:
    """Whether the element goes, and whether it does for no more than a part of its class or id names."""
    if name in DROPPED or name == "header" and not inside:
        return True, False
    if " " not in tag and "\n" not in tag and "\t" not in tag:
        return False, False
    named = name not in WHOLE and (inside or name != "article") and not (inside and name in TEXTUAL)
    weak = False
    for key, *values in ATTRIBUTE.findall(tag, len(name) + 1):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in ROLES:
            return True, False
        if name == "article" and key == "class" and not REPLIES.isdisjoint(value.split()):
            return True, False
        if key == "class" and inside and name in TEXTUAL and value.split() and CLASSES.issuperset(value.split()):
            return True, False
        if key in ("class", "id") and named:
            for token in value.split():
                parts = [x for x in re.split(r"[^a-z0-9]+", token) if x]
                if not STATES.isdisjoint(parts):
                    continue
                if not CLASSES.isdisjoint(parts) or not inside and "header" in parts:
                    if len(parts) == 1:
                        return True, False
                    weak = True
    return weak, weak


def blocks(page: str) -> tuple[list[str], list[str], bool]:
    """(blocks of articles, other kept blocks, whether there is an article), in page order."""
    inner, outer, found, hid = _blocks(page, True)
    found &= bool(inner) or not outer
    if hid and not found:
        again = _blocks(page, False)
        if again[2] and again[0] or not outer:
            return again[:3]
    return inner, outer, found


def _blocks(page: str, by_part: bool) -> tuple[list[str], list[str], bool, bool]:
    """As ``blocks``, and whether an element outside of articles went for a part of a name;
    without ``by_part`` none does."""
    inner: list[str] = []
    outer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, dropped, opens an article
    held: list[str] = []
    dropped = articles = 0
    found = hid = False

    def close_block():
        if held:
            text = " ".join("".join(held).split())
            if text:
                (inner if articles else outer).append(text)
            held.clear()

    def pop_to(at: int):
        nonlocal dropped, articles
        while len(stack) > at:
            _, drop, article = stack.pop()
            dropped -= drop
            articles -= article

    for i, part in enumerate(PARTS.split(page)):
        if i % 2 == 0:
            if part and not dropped:
                held.append(html.unescape(part) if "&" in part else part)
            continue
        match = NAME.match(part)
        if match is None:
            continue  # a comment or declaration
        name = match[1].lower()
        if part[1] == "/":
            if name not in INLINE:
                close_block()
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == name:
                    pop_to(at)
                    break
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in ("script", "style", "textarea", "title", "iframe", "noframes", "noembed", "xmp"):
            if name != "script" and name != "style":
                close_block()
            continue
        if name not in INLINE:
            close_block()
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == "p":  # a paragraph holds no block
                    pop_to(at)
                    break
        if name in VOID or part.endswith("/>") and name in ("path", "use", "circle", "rect"):
            continue
        drop, weak = _is_dropped(name, part, articles > 0)
        if weak and not articles and not dropped:
            hid = True
            drop = by_part
        if drop:
            close_block()
        article = name in ("article", "main") and not dropped and not drop
        found |= article
        stack.append((name, drop, article))
        dropped += drop
        articles += article
    close_block()
    return inner, outer, found, hid


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def leads(words: list[str], least: int) -> list[int]:
    """A signed 64-bit hash of the ``least`` words from each place on."""
    joined = [xxhash.xxh3_64_intdigest("\0".join(words[i : i + least])) for i in range(len(words) - least + 1)]
    return np.array(joined, np.uint64).view(np.int64).tolist()


COLUMNS = (
    "page_id bigint, url string, text string, host string, page bigint, blocks array<string>, lead bigint"
)


def _read(least: int):
    """A row per page (with its text, or its blocks if its host decides), and one per lead and page."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64()]

    def rows(batches):
        for batch in batches:
            out, suffixes = [], set()
            for page_id, url, page, key in zip(*(c.to_pylist() for c in batch.columns)):
                inner, outer, found = blocks(page or "")
                host = host_of(url)
                words = [w for block in outer for w in block.split(" ")]
                suffixes.update((host, key, lead) for lead in leads(words, least))
                out.append(
                    (page_id, url, "\n\n".join(inner) if found else None, host, key, None if found else outer, None)
                )
            out += [(None, None, None, host, key, None, lead) for host, key, lead in suffixes]
            for i in range(0, len(out), 10_000):
                columns = zip(*out[i : i + 10_000])
                yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return rows


def _kept(least: int):
    """Blocks without the words that repeated leads cover."""

    def rows(batches):
        for batch in batches:
            texts = []
            for own, repeated in zip(batch.column("blocks").to_pylist(), batch.column("leads").to_pylist()):
                words = [block.split(" ") for block in own]
                flat = [w for block in words for w in block]
                covered = np.zeros(len(flat), bool)
                gone = set(repeated or ())
                for i, lead in enumerate(leads(flat, least)):
                    if lead in gone:
                        covered[i : i + least] = True
                kept, at = [], 0
                for block in words:
                    left = [w for w, c in zip(block, covered[at : at + len(block)]) if not c]
                    at += len(block)
                    if left:
                        kept.append(" ".join(left))
                texts.append("\n\n".join(kept))
            yield pa.record_batch(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return rows


def main_text(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, text) of every page."""
    key = F.xxhash64("page_id", "url", "html")
    read = stored(
        pages.select("page_id", "url", "html", key.alias("page")).mapInArrow(_read(least), COLUMNS), "html-pages"
    )
    suffixes = read.where("lead IS NOT NULL").select("host", "page", "lead")
    repeated = (
        suffixes.groupBy("host", "lead")
        .agg(F.min("page").alias("p"), F.max("page").alias("q"))
        .where("p <> q")
        .select("host", "lead")
    )
    waiting = read.where("blocks IS NOT NULL").select("page_id", "url", "page", "blocks")
    gone = (
        suffixes.join(waiting.select("page").distinct(), "page", "left_semi")
        .join(repeated, ["host", "lead"])
        .groupBy("page")
        .agg(F.collect_list("lead").alias("leads"))  # of one page
    )
    late = (
        waiting.join(gone, "page", "left")
        .select("page_id", "url", "blocks", "leads")
        .mapInArrow(_kept(least), "page_id bigint, url string, text string")
    )
    return read.where("text IS NOT NULL").select("page_id", "url", "text").unionByName(late)
