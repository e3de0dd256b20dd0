"""Main text of web pages from flat text blocks and a small decision tree.

A page is read as one flat run of text blocks, cut at block-level tags.  Each
block has its word count, its link density and those of its neighbours, and
whether it stands in page furniture (navigation, adverts, comments, ...) or in
the page's main element.  A decision tree, trained on the small labelled table
``EXAMPLES``, tells which blocks are main text; these are joined in page
order.  Markup, scripts, styles, forms and comments never become text.

Class and id names mark furniture by their words, but never on a heading or on
the article or main element that holds the text: there only role and hidden
do.  Inside such an element a name counts as a whole: comments, related links
and adverts go (``comments-area``, ``related``), sections on a topic stay
(``market-share``, an id ``discussion``).  Names that tell a state or a topic
(has-sidebar, category-social) say nothing.

Edge cases: a null or empty html, and a page without main text, give an empty
text; unclosed and cut-off tags end where the page ends; repeated rows are
read one by one; an empty table gives an empty result; other columns are
ignored.

Scale: a page's blocks and their neighbours lie in one row, so there is no
shuffle; the tree is a few numbers that travel with the task.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["FEATURES", "EXAMPLES", "blocks", "features", "labelled_table", "train_tree", "classify", "main_text"]

# Element names and the words of class, id and role that HTML authors use; fixed values.
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|title|select|textarea|button"
BREAKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = set("nav footer aside form menu dialog fieldset".split())
MAIN = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
FURNITURE_WORDS = set("""ad ads adv advert advertisement adverts advertising banner breadcrumb breadcrumbs comment
comments commentlist consent contentinfo complementary cookie cookies copyright discussion disqus dialog dropdown footer
gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination
pager popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup
skip social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets banner-ad alert""".split())
MAIN_WORDS = set("article articlebody body content entry main maincontent post story text".split())
#: Of these, words that also name the topic of a section.
TOPICS = set("""ad alert banner complementary consent copyright dialog discussion login menu notice notices notification
popup promotion recommended related reply replies respond search share sharing social skip subscription tags""".split())
#: Words that say how or where something stands; with a furniture word they leave the name one of furniture.
NEUTRAL = set("""area articles bar blog bottom bottombar box block btn button buttons card cards column container content count
element entries entry feed footer form group header holder icons inner inline item items left link links list main media module
news order outer page panel post posts primary reader right row section secondary simple site slot stories story template text thread
title top unit user users view wrap wrapper article""".split())
#: First words of names that tell a state, a topic or a format of what they stand on, not what it is.
ABOUT = set("has no not is with without show hide category cat tag format type topic".split())

# a raw element closed in its own tag ("/>", not the end of an unquoted value) has no content; an option, whose end
# tag may be left out, goes up to the next option or block
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])(?:(?:\"[^\"]*\"|'[^']*'|=\s*[^\s\"'>]+|[^>\"'/]|/(?!>))*+/>"
    r"|[^>]*>.*?(?:</\1\s*>|\Z))"
    rf"|<(option)(?=[\s/>])[^>]*>.*?(?:</option\s*>|(?=</?(?:{'|'.join(sorted(BREAKS))}|optgroup|option|select|datalist)[\s/>])|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPLIT = re.compile(r"[^a-z0-9]+")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)

FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "furniture", "main")


def _names_furniture(parts: list[str], is_id: bool, in_main: bool) -> bool:
    """Whether a class or id name, in its words, is one of page furniture.

    In main text only the whole name tells, and no id that may be a heading's: ``comments-area`` is furniture,
    ``market-share`` and an id ``discussion`` are not.
    """
    if parts[0] in ABOUT and len(parts) > 1 or FURNITURE_WORDS.isdisjoint(parts):
        return False
    whole = all(p in FURNITURE_WORDS or p in NEUTRAL or p.isdigit() for p in parts)
    if in_main:
        return whole and not (is_id and len(parts) == 1 and parts[0] in TOPICS)
    return whole or not (FURNITURE_WORDS - TOPICS).isdisjoint(parts)


def _place(tag: str, attributes: str, in_main: bool) -> tuple[bool, bool]:
    """(opens furniture, opens main text) for an element."""
    if tag in ("html", "body"):
        return False, False
    names, roles, marked = set(), set(), False
    if attributes:
        given: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(attributes):
            given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")  # of equal attributes the first counts
        if ("hidden" in given or given.get("aria-hidden", "").strip().lower() == "true"
                or NO_DISPLAY.search(given.get("style", ""))):
            return True, False
        roles = set(given.get("role", "").lower().split())
        for kind in ("class", "id"):
            for name in given.get(kind, "").split():
                parts = [p for p in SPLIT.split(HUMP.sub("-", name).lower()) if p]
                if parts and (parts[0] not in ABOUT or len(parts) == 1):
                    names.update(parts)
                    marked = marked or _names_furniture(parts, kind == "id", in_main)
    if tag in FURNITURE or roles & FURNITURE_WORDS:
        return True, False
    # names tell nothing on a heading, nor on the article or main element that a page's text stands in
    if not (tag in HEADINGS or tag in MAIN and not in_main) and (
            marked or not in_main and (tag == "header" or "header" in names)):
        return True, False
    names |= roles
    return False, tag in MAIN or bool(names & MAIN_WORDS)


def blocks(page: str | None) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, words in links, in furniture, in main) of the page's text blocks."""
    out: list[tuple[str, int, int, bool, bool]] = []
    page = page or ""
    stack: list[tuple[str, bool, bool]] = []
    furniture = main = False
    parts: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(entities.unescape(p).split()) for p, inside in parts if inside)
                words = len(text.split(" "))
                out.append((text, words, min(linked, words), furniture, main))
            parts.clear()

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            parts.append((page[at:m.start()], links > 0))
        at = m.end()
        tag = (m[4] or "").lower()
        if not tag:
            if m[2] or m[1] and m[1].lower() in ("textarea", "select", "button", "title"):
                parts.append((" ", False))
            continue
        if tag == "br":
            parts.append((" ", links > 0))
        elif tag == "a":
            links = max(0, links - 1) if m[3] else 1
        if tag in BREAKS:
            flush()
            links = 0
        if tag in VOID or m[5].endswith("/"):
            continue
        if m[3]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag not in BREAKS and any(s[1] != furniture or s[2] != main for s in stack[k:]):
                        flush()
                    _, furniture, main = stack[k]
                    del stack[k:]
                    break
            continue
        if tag in BREAKS and stack and (stack[-1][0] == "p" or tag == "li" == stack[-1][0]):
            _, furniture, main = stack.pop()  # a block ends an open paragraph, an item ends the last one
        opens, main_text = _place(tag, m[5], main)
        if tag in BREAKS or opens or main_text:
            if opens and not furniture:
                flush()
            stack.append((tag, furniture, main))
            furniture, main = furniture or opens, main or main_text
    if at < len(page):
        parts.append((page[at:], links > 0))
    flush()
    return out


def features(found: list[tuple[str, int, int, bool, bool]]) -> np.ndarray:
    """A row of FEATURES for each block."""
    n = len(found)
    words = np.array([b[1] for b in found], float)
    density = np.array([b[2] for b in found], float) / np.maximum(words, 1)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    out[:, 6] = [b[3] for b in found]
    out[:, 7] = [b[4] for b in found]
    return out


_W = "word "
def _in_main(tag: str, *sizes: int) -> str:
    """A page that is all main text: paragraphs of so many words, the link of every third one included."""
    return f"<{tag}>" + "".join(f'<p data-label="1">{"<a href=/x>" * (k % 3 == 2)}{_W * n}</a></p>' for k, n in enumerate(sizes))


#: Labelled pages: blocks marked data-label="1" are main text, all others are not.
EXAMPLES = (
    '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News of the day</a></li></ul></nav><article>'
    '<h1 data-label="1">A short title</h1><p data-label="1">' + _W * 40 + '</p><p data-label="1">Yes.</p>'
    '<p data-label="1">' + _W * 12 + '<a href="/x">one link</a></p></article><footer>' + _W * 9 + '</footer>',
    '<header><a href="/">Site</a> ' + _W * 20 + '</header><main><h2 data-label="1">Title</h2><p data-label="1">' + _W * 3
    + '</p><div class="ad">' + _W * 25 + '</div><p data-label="1">' + _W * 60 + '</p><ul><li data-label="1">First</li>'
    '<li data-label="1">Second of them</li></ul><div class="comments"><p>' + _W * 35 + '</p><p>Nice!</p></div></main>'
    '<aside><p>' + _W * 30 + '</p></aside>',
    '<div><a href="/a">One</a> <a href="/b">Two</a> <a href="/c">Three</a></div><div><a href="/">' + _W * 6 + '</a></div>'
    '<p data-label="1">' + _W * 50 + '</p><p data-label="1">' + _W * 35 + '</p><p data-label="1">' + _W * 14 + '</p>'
    '<p data-label="1">' + _W * 45 + '</p><div>' + _W * 3 + '</div><div><a href="/a">' + _W * 4 + '</a></div>'
    '<div><a href="/a">' + _W * 5 + '</a></div><p>All rights</p>',
    '<div class="cookie-notice">' + _W * 45 + '</div><div class="content"><h1 data-label="1">' + _W * 7 + '</h1>'
    '<p data-label="1">Short one.</p><p data-label="1"><a href="/all">' + _W * 5 + '</a></p><p data-label="1">' + _W * 80
    + '</p></div><form>' + _W * 12 + '</form><div id="sidebar"><h3>Other</h3><p>' + _W * 22 + '</p></div>',
    '<p>Menu</p><p><a href="/x">' + _W * 2 + '</a></p><p data-label="1">' + _W * 28 + '</p><p data-label="1">' + _W * 70
    + '</p><p data-label="1">' + _W * 22 + '<a href="/y">' + _W * 4 + '</a></p><p>' + _W * 2 + '</p>',
    '<div class="menu"><p>' + _W * 15 + '</p></div><p data-label="1">' + _W * 18 + '</p><p data-label="1">' + _W * 30
    + '</p><div class="newsletter"><p>' + _W * 16 + '</p></div><footer><p>' + _W * 40 + '</p><p>' + _W * 50 + '</p></footer>',
    '<div><a href="/a">' + _W * 12 + '</a></div><div><a href="/b">' + _W * 9 + '</a> by</div><div><a href="/c">' + _W * 15
    + '</a></div><p data-label="1">' + _W * 33 + '</p><p data-label="1">' + _W * 4 + '</p><p data-label="1">' + _W * 41 + '</p>'
    '<p data-label="1">' + _W * 3 + '</p><p data-label="1">' + _W * 26 + '<a href="/d">' + _W * 5 + '</a></p>'
    '<div><a href="/e">' + _W * 11 + '</a></div><div><a href="/f">' + _W * 20 + '</a></div><div>' + _W * 2 + '</div>',
    '<div>Log in</div><div><a href="/a">' + _W * 8 + '</a></div><p data-label="1">' + _W * 19 + '</p><p data-label="1">' + _W * 5
    + '</p><p data-label="1">' + _W * 48 + '</p><div><a href="/b">' + _W * 10 + '</a> and <a href="/c">' + _W * 7 + '</a></div>'
    '<div><a href="/d">' + _W * 14 + '</a></div>',
    '<article><p data-label="1">' + _W * 2 + '</p><p data-label="1"><a href="/z">' + _W * 10 + '</a></p>'
    '<p data-label="1"><a href="/z">Link</a></p><p data-label="1">' + _W * 5 + '</p></article><p>' + _W * 3 + '</p>',
    # pages of short paragraphs, without a main element
    '<div><a href="/">' + _W * 2 + '</a></div>' + "".join(f'<p data-label="1">{_W * n}</p>' for n in (6, 9, 5, 12, 8, 7, 10, 6))
    + '<div><a href="/a">' + _W * 3 + '</a></div>',
    "".join(f'<p data-label="1">{_W * n}</p>' for n in (5, 7, 6, 9, 4, 8)),
    '<ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul><h1 data-label="1">' + _W * 5 + '</h1>'
    + "".join(f'<p data-label="1">{_W * n}</p>' for n in (11, 6, 14, 8, 5, 9)) + '<p><a href="/c">' + _W * 4 + '</a></p>',
    '<p data-label="1">' + _W * 8 + '</p><p data-label="1">' + _W * 6 + '<a href="/x">' + _W * 2 + '</a></p><p data-label="1">' + _W * 7
    + '</p><p><a href="/y">' + _W * 6 + '</a></p><p><a href="/z">' + _W * 5 + '</a></p>',
    _in_main("main", 6, 1, 9, 55, 2, 3, 30, 1, 4),
    _in_main("article", 3, 44, 2, 5, 71, 12, 1, 2, 60, 4, 1),
    _in_main("article", 30, 30),
    _in_main("main", 12, 40, 25, 33),
    _in_main("article", 18, 9),
    _in_main("main", 50),
    _in_main("article", 5, 80),
    _in_main("main", 7, 21, 64, 2, 38, 16),
    '<p data-label="1">' + _W * 33 + '</p><p data-label="1">' + _W * 27 + '</p>',
    '<div><a href="/a">' + _W * 3 + '</a></div><p data-label="1">' + _W * 22 + '</p><p data-label="1">' + _W * 47 + '</p><p data-label="1">' + _W * 16 + '</p>',
    _in_main("article", 1),
    _in_main("article", 8, 1, 2),
    _in_main("main", 1, 2, 1, 3, 1, 5, 1, 4, 2, 11, 1, 2),
)


def labelled_table(examples=EXAMPLES) -> list[tuple[list[float], float]]:
    """(features, 1.0 if main text) of the example pages' blocks."""
    out = []
    for page in examples:
        marked = blocks(re.sub(r'<(\w+) data-label="1">', r"<\1>@@", page))
        plain = blocks(page)
        out += [(row.tolist(), float(m[0].startswith("@@"))) for m, row in zip(marked, features(plain), strict=True)]
    return out


def train_tree(spark: SparkSession, labelled=None, depth: int = 5) -> list[tuple]:
    """A decision tree fitted by Spark ML, as (feature, threshold, left, right) nodes and (-1, class) leaves."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense(x), y) for x, y in (labelled if labelled is not None else labelled_table())]
    table = spark.createDataFrame(rows, ["features", "label"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=3).fit(table)
    nodes: list[tuple] = []

    def walk(node) -> int:
        here = len(nodes)
        nodes.append(())
        if node.numDescendants() == 0:
            nodes[here] = (-1, node.prediction() > 0.5)
        else:
            split = node.split()
            nodes[here] = (split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild()))
        return here

    walk(model._java_obj.rootNode())
    return nodes


def classify(tree: list[tuple], rows: np.ndarray) -> np.ndarray:
    """Whether the tree takes each row of FEATURES for main text."""
    out = np.zeros(len(rows), bool)
    todo = [(0, np.arange(len(rows)))]
    while todo:
        at, some = todo.pop()
        node = tree[at]
        if node[0] < 0:
            out[some] = node[1]
        elif len(some):
            left = rows[some, node[0]] <= node[1]
            todo += [(node[2], some[left]), (node[3], some[~left])]
    return out


def extract(page: str | None, tree: list[tuple]) -> str:
    found = blocks(page)
    return "\n".join(found[k][0] for k in np.flatnonzero(classify(tree, features(found)))) if found else ""


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              tree: list[tuple] | None = None) -> DataFrame:
    """page_id, url, text (main blocks joined by newlines) and n_chars of every page."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    tree = tree if tree is not None else train_tree(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x, tree) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    id_type, url_type = (dict(src.dtypes)[c] for c in ("page_id", "url"))
    return src.mapInArrow(run, f"page_id {id_type}, url {url_type}, text string, n_chars bigint")
