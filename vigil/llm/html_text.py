"""Operator 4: main text of raw HTML pages.

A page is cut into flat text blocks at block-level tags. A block has its word
count and link density, those of its two neighbours, and flags of the elements
and class names around it. A decision tree, trained on the small labelled table
of ``html_labels``, tells blocks of the article from menus, headers, footers,
sidebars, notices, adverts, forms and reader comments. Scripts, styles and
other content that is never shown are no blocks at all. An ``article`` or
``main`` inside an element whose class name or id stands for something else is
the article all the same; class names such as ``has-sidebar`` or
``right-sidebar`` on an element that holds the article describe the layout. A
``head`` ends where the first block begins, also without ``</head>``.

In the text character references are decoded, white space inside a block is
one space, blocks are trimmed, empty blocks dropped and the rest joined by one
line end in page order. Every page is worked on alone, in Arrow batches.

Defined cases: null and empty pages and pages without text give the empty text;
markup that is never closed ends with the page; text outside any element is a
block too; null ids and repeated rows are returned as they are; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import map_arrow, only, read_table
from vigil.llm.html_labels import PAGES

#: Elements that begin and end a block, elements without content, and elements that are never shown as text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption label legend".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("head script style noscript template svg annotation annotation-xml textarea select option button iframe object canvas title".split())
HEAD_TAGS = frozenset("head base basefont bgsound link meta noframes noscript script style template title".split())
CLOSES_P = BLOCK_TAGS - {"body", "html", "label", "legend"}

#: Elements, roles and parts of class names or ids that stand for what is not the article, and for the article.
OUTER_TAGS = frozenset("nav footer aside form dialog menu".split())
OUTER_ROLES = frozenset("navigation banner contentinfo complementary search dialog form".split())
OUTER_NAMES = re.compile(
    r"(^|[-_\s])(ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notice|gdpr|popup|modal|overlay|side-?bar|widget|menu\w*|nav\w*|breadcrumbs?|"
    r"header|masthead|logo|foot\w*|copyright|imprint|comments?|disqus|replies|respond|share|sharing|social|related|recommend\w*|trending|newsletter|"
    r"subscri\w*|sign-?up|login|search|form|toolbar|pagination|pager|tags)($|[-_\s])", re.I)
#: Class names that only say how the page is laid out, and names of boxes whose articles are teasers or comments.
LAYOUT_NAMES = re.compile(r"(?<!\S)((has|no|with|without)[-_]\S+|\S+[-_](open|closed))(?!\S)", re.I)
SIDE_LAYOUT = re.compile(r"(?<!\S)((left|right)[-_]side-?bar|side-?bar[-_](left|right))(?!\S)", re.I)
LAYOUT = re.compile(r"(?<!\S)(layout|page|site|wrapper|wrap|container|grid|row|columns)(?!\S)", re.I)
HARD_NAMES = re.compile(
    r"((^|[-_\s])(ads?|advert\w*|sponsor\w*|promo\w*|comments?|disqus|replies|respond|related|recommend\w*|trending|newsletter|widget|popup|modal|overlay|cookies?|consent|foot(?!note)\w*)($|[-_\s])"
    r"|(?<!\S)side-?bar(?!\S))", re.I)
#: Names of boxes that are no text of the article they lie in, and elements whose names say nothing there.
WITHIN_NAMES = re.compile(
    HARD_NAMES.pattern + r"|(^|[-_\s])(banner|gdpr|menu\w*|nav\w*|breadcrumbs?|logo|copyright|imprint|share|sharing|social|subscri\w*|sign-?up|login|search|toolbar|pagination|pager)($|[-_\s])",
    re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_TAGS = HEADINGS | frozenset("p li dl dt dd header figure figcaption blockquote pre table caption thead tbody tfoot tr td th hr details summary span em strong b i a".split())
INNER_NAMES = re.compile(r"(^|[-_\s])(article|content|post|entry|story|text|body|main|page-?body)($|[-_\s])", re.I)

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "outer", "inner", "heading", "item", "header", "point", "first")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    outer: bool
    inner: bool
    heading: bool
    item: bool
    header: bool


class _Blocks(HTMLParser):
    """Collects the blocks of one page. What the open elements say together is kept as counts and as the state at the
    top of the stack, so that a tag costs the same however deeply it lies."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # open elements: tag, whether text in it is outer (2: also in an article inside), whether it is inner
        self.stack: list[tuple[str, int, bool]] = []
        self.places: dict[str, list[int]] = {}  # places in the stack by tag
        self.hidden = self.inner = self.headings = 0
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            header = self._has("header") and not self._has("article") and not self.inner
            self.blocks.append(Block(text, len(text.split()), len(" ".join(self.linked).split()), self._state() > 0, self.inner > 0,
                                     self.headings > 0, self._has("li"), header))
        self.parts, self.linked = [], []

    def _state(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _has(self, tag: str) -> bool:
        return bool(self.places.get(tag))

    def _push(self, tag: str, mark: int, inner: bool) -> None:
        """``mark`` 1 or 2 makes outer, -1 or -2 ends such states from further out, 0 leaves them."""
        before = self._state()
        state = max(before, mark) if mark >= 0 else 0 if before <= -mark else before
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, state, inner))
        self.hidden += tag in HIDDEN_TAGS
        self.headings += tag in HEADINGS
        self.inner += inner

    def _pop(self, at: int) -> None:
        for tag, _, inner in self.stack[at:]:
            self.places[tag].pop()
            self.hidden -= tag in HIDDEN_TAGS
            self.headings -= tag in HEADINGS
            self.inner -= inner
        del self.stack[at:]

    def _open(self, tag: str) -> int:
        return self.places[tag][-1] if self._has(tag) else -1

    def _end_head(self) -> None:
        if self.stack and self.stack[-1][0] == "head":
            self._pop(len(self.stack) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD_TAGS:
            self._end_head()
        if tag == "body" and (k := self._open("head")) >= 0:
            self._pop(k)
        if tag in BLOCK_TAGS:
            self._flush()
            if tag in CLOSES_P and (k := self._open("p")) >= 0:
                self._pop(k)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        if tag in ("li", "td", "tr") and self.stack and self.stack[-1][0] == tag:
            self._pop(len(self.stack) - 1)
        named = {k: v or "" for k, v in attrs if k in ("class", "id", "role")}
        role = named.get("role", "")
        main = tag == "main" or role == "main"
        article = main or tag == "article" or role == "article"
        if tag in ("article", "main") and not (self._has("article") or self._has("main")):
            # page furniture holds no article: what is still open was never closed
            if at := [k for k in map(self._open, ("nav", "header", "footer")) if k >= 0]:
                self._pop(min(at))
        within = self._has("article") or self._has("main")
        names = named.get("class", "") if within and tag == "section" else f"{named.get('class', '')} {named.get('id', '')}"
        names = LAYOUT_NAMES.sub(" ", names)
        if LAYOUT.search(names):
            names = SIDE_LAYOUT.sub(" ", names)
        plain = tag in ("html", "body")
        if within and tag in TEXT_TAGS:  # names of the article's own parts; the id of a heading is its anchor
            names = ""
        outer_names = HARD_NAMES if article or within and tag == "ol" else WITHIN_NAMES if within else OUTER_NAMES
        named_outer = outer_names.search(names) and not main
        outer = not plain and (tag in OUTER_TAGS or role in OUTER_ROLES or bool(named_outer))
        inner = not plain and not outer and (article or bool(names.strip() and INNER_NAMES.search(names)))
        hard = tag in OUTER_TAGS - {"form"} or role in OUTER_ROLES - {"form"} or bool(HARD_NAMES.search(names))
        self._push(tag, 1 + hard if outer else -2 if main and inner else -1 if article and inner else 0, inner)

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        elif tag in BLOCK_TAGS:
            self._flush()

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self._flush()
        if (k := self._open(tag)) >= 0:
            self._pop(k)

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        if not self.hidden:
            self.parts.append(data)
            if self._has("a"):
                self.linked.append(data)

    def result(self) -> list[Block]:
        self._flush()
        return self.blocks


#: A tag that the end of the page cuts off.
CUT_TAG = re.compile(r"<[A-Za-z/]")


def blocks(html: str) -> list[Block]:
    """The text blocks of a page in order."""
    parser = _Blocks()
    html = html.replace("\0", "")
    if cut := CUT_TAG.search(html, html.rfind(">") + 1):  # without this the parser would try each of its tags to the end
        html = html[: cut.start()]
    parser.feed(html)
    parser.close()
    return parser.result()


def features(page: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` for each block."""
    n = len(page)
    words = np.array([0, *[b.words for b in page], 0], float)
    links = np.array([0, *[min(1.0, b.linked / max(b.words, 1)) for b in page], 0], float)
    flags = np.array([[b.outer, b.inner, b.heading, b.item, b.header, b.text[-1] in ".!?…:;\"'”»", k == 0] for k, b in enumerate(page)], float).reshape(n, 7)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], flags]) if n else np.zeros((0, len(FEATURES)))


@dataclass
class Node:
    """A split (feature, at most ``cut`` goes left) or, without children, a leaf with the share of label 1."""

    share: float
    feature: int = -1
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> Node:
    """A decision tree by Gini impurity; ties go to the first feature and the lowest cut."""
    share = float(y.mean()) if len(y) else 0.0
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return Node(share)
    best = (share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = x[:, f] <= cut
            a, b = y[low], y[~low]
            if min(len(a), len(b)) >= least:
                worth = a.mean() * (1 - a.mean()) * len(a) + b.mean() * (1 - b.mean()) * len(b)
                if worth < best[0] - 1e-9:
                    best = (worth, f, float(cut))
    if best[1] < 0:
        return Node(share)
    low = x[:, best[1]] <= best[2]
    return Node(share, best[1], best[2], grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least))


def classify(node: Node, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    if node.left is None:
        return np.full(len(x), node.share >= 0.5)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x), bool)
    out[low], out[~low] = classify(node.left, x[low]), classify(node.right, x[~low])
    return out


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    xs, ys = [], []
    for html in PAGES:
        page = blocks(html)
        ys += [b.text.startswith("+") for b in page]
        for b in page:
            b.text = b.text.lstrip("+- ")
            b.words -= 1
        xs.append(features(page))
    return np.vstack(xs), np.array(ys, float)


@lru_cache(maxsize=1)
def tree() -> Node:
    return grow(*labelled())


def main_text(html: str | None) -> str:
    """The main text of one page."""
    page = blocks(html or "")
    if not page:
        return ""
    return "\n".join(b.text for b, good in zip(page, classify(tree(), features(page))) if good)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    source = only(pages, page_id=id_col, url=url_col, html=html_col)

    def run(batches):
        for b in batches:
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = source.schema["page_id"].dataType.simpleString()
    return map_arrow(source, run, f"page_id {kind}, url string, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query: the main text of all ``pages``."""
    return extract(read_table(spark, sf_dir, "pages"))
