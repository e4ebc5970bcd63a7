"""Main text of web pages by composite text density.

A tolerant parser reads the whole page into a tree of nodes in page order.  Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are cut away where their tag, role or name says so: the id or a token of the class of
blocks, as a whole or put together from such a name and words for places and boxes only
(``post-comments``, ``ad-slot``).  A name that an article's own parts bear too cuts there
only what is mostly links, a notice only what is less than a quarter of the page's text.  What holds the main element, an article no shorter than those
elsewhere, or most of the page's text outside links (unless an article or main element
elsewhere has text) stays.  For every node left, its
characters, tags, link characters and link tags give the link-adjusted characters
per tag::

    density = C / T * log_b(C / nL * T / LT),   b = ln(C / nL * L + Lb / Cb * C + e)

(C characters, T tags, L characters in links, LT link tags, nL = C - L, Lb and Cb those
of the body; Sun, Song and Liao, 2011).  A node's density sum is that of its children.
The node with the greatest sum is found in subtrees whose density reaches the threshold,
the least density on the path from the body to the densest place; where it lies in an
article or main element, the whole of that element is the content.

Character references are decoded, white space inside a block becomes one space, and
blocks are joined in page order by one space.  NULL and empty pages give an empty text.
Pages are handled one by one, so repeated rows repeat their result; the cost of a page is
proportional to its length.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MATH = frozenset(
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
#: Elements whose text runs on with the text around them.
FLOWING = INLINE | MATH
BLOCK_IN_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: An opening tag closes an open element of these, looked for no further than the tags after it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
#: Elements that are never content, and those that hold no page.
CONTROLS = frozenset("button select input object embed audio video canvas map".split())
CUT_TAGS = frozenset("nav footer aside form menu dialog head".split()) | CONTROLS | RAW
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Classes and ids that name something that is not content, of these reader comments, and names that parts of an article bear too.
COMMENT_NAMES = frozenset("comment comments commentlist comment-list comments-area disqus disqus_thread respond replies".split())
CUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menubar breadcrumb breadcrumbs"
    " site-header page-header masthead footer site-footer page-footer sidebar aside cookie cookies cookie-notice cookie-banner cookie-consent gdpr popup modal"
    " newsletter subscribe signup login share sharing recommended recommendations pagination pager".split()
)
SHARED_NAMES = frozenset("banner menu header widget disclaimer overlay social related toolbar skip".split())
NOTICE_NAMES = frozenset("consent notice notices".split())
#: Names that hold of a hyphenated name too, where its other parts only say where or what box it is.
LEADING_PARTS = frozenset("ad ads advert advertisement sponsored promo share sharing related recommended newsletter sidebar cookie cookies".split())
COMMENT_PARTS = frozenset("comment comments".split())
PLACE_PARTS = frozenset(
    "post posts article articles page site entry story stories user reader slot unit box banner container wrapper wrap block area widget bar button buttons"
    " link links list item items signup form left right top bottom primary secondary notice consent message popup section".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTENT_TAGS = frozenset(("article", "main"))
#: Why an element may be cut away.
NAMED, SHARED, COMMENTS, CONTROL, NOTICE = 1, 2, 3, 4, 5


class Node:
    __slots__ = ("tag", "parent", "children", "pieces", "mark", "own", "text", "plain", "left", "article", "main", "within", "inside", "chars", "tags", "link_chars", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, mark: int) -> None:
        self.tag, self.parent, self.mark = tag, parent, mark  # mark: why it may be cut, or 0
        self.children: list[Node] = []
        self.pieces: list[str | Node] = []  # text and children in page order
        self.own = self.text = self.plain = self.left = 0  # characters: its own, all, outside links, of these outside marked nodes
        self.article = self.inside = 0  # the longest article below it, and free article and main elements around it
        self.main = self.within = False  # whether a main element is below it, and whether an article or main element is around it
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


def attributes_of(source: str) -> dict[str, str]:
    """Attributes by their full names; of repeated ones the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        found.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    return found


def _mark(tag: str, attributes: str, inside: Node) -> int:
    """Why an element may be something other than content; 0 if nothing says so."""
    if tag in CONTROLS:
        return CONTROL
    if tag in CUT_TAGS:
        return NAMED
    if tag == "header":
        node: Node | None = inside
        while node is not None and node.tag not in CONTENT_TAGS:
            node = node.parent
        return NAMED if node is None else 0
    if not attributes or tag in ("html", "body", "article", "main"):
        return 0
    return _mark_of(tag in HEADINGS or tag in FLOWING, attributes)


@lru_cache(maxsize=1 << 12)
def _mark_of(nameless: bool, attributes: str) -> int:
    a = attributes_of(attributes)
    if a.get("role", "").strip().lower() in CUT_ROLES or "hidden" in a or a.get("aria-hidden", "").strip().lower() == "true":
        return NAMED
    if UNSEEN.search(a.get("style", "").lower()):
        return NAMED
    if nameless:
        return 0
    names = {*a.get("class", "").lower().split(), a.get("id", "").strip().lower()}
    if names & CUT_NAMES or any(_put_together(n, LEADING_PARTS) for n in names):
        return NAMED
    if names & COMMENT_NAMES or any(_put_together(n, COMMENT_PARTS) for n in names):
        return COMMENTS
    return NOTICE if names & NOTICE_NAMES else SHARED if names & SHARED_NAMES else 0


def _put_together(name: str, leading: frozenset[str]) -> bool:
    """Whether a hyphenated name consists of one of the leading parts and words for places and boxes."""
    parts = {*re.split("[-_]+", name)} - {""}
    return len(parts) > 1 and bool(parts & leading) and parts <= leading | PLACE_PARTS


def _free(nodes: list[Node]) -> list[Node]:
    """The article and main elements that no marked node holds and that have text of their own outside links and marked nodes."""
    for node in reversed(nodes):
        node.left = 0 if node.tag == "a" else node.own + sum(c.left for c in node.children if not c.mark)
    free = []
    todo = [(nodes[0], 0)]
    while todo:
        node, inside = todo.pop()
        node.inside = inside
        if node.tag in CONTENT_TAGS and node.left:
            free.append(node)
            inside += 1
        todo.extend((c, inside) for c in node.children if not c.mark)
        for c in node.children:
            c.inside = inside
    return free


def settle(root: Node) -> None:
    """Takes the marked nodes out of the tree, but those that hold the page's content."""
    nodes = _walk(root)
    for node in reversed(nodes):
        node.own = sum(len("".join(p.split())) for p in node.pieces if isinstance(p, str))
        if node.mark == CONTROL:
            node.own = 0
        node.text = node.plain = node.own
        main = False
        for c in node.children:
            node.text += c.text
            node.plain += c.plain
            node.article = max(node.article, c.article, c.plain if c.tag in CONTENT_TAGS else 0)
            main = main or c.main or c.tag == "main"
        node.main = main
        if node.tag == "a":
            node.plain = 0
    marked = []
    for node in nodes:
        up = node.parent
        node.within = up is not None and (up.within or up.tag in CONTENT_TAGS)
        if node.mark == SHARED and (node.within or node.tag == "p") and 2 * node.plain > node.text:
            node.mark = 0
        if node.mark == NOTICE and (node.tag == "p" or 4 * node.plain >= root.plain) and 2 * node.plain > node.text:
            node.mark = 0
        if node.mark and node.main:
            node.mark = 0
        if node.mark:
            marked.append(node)
    if not marked:
        return
    longest = max((n.left for n in _free(nodes)), default=0)
    for node in marked:
        if node.mark != COMMENTS and node.article > 0 and node.article >= longest:
            node.mark = 0
    if not _free(nodes):
        for node in marked:
            if node.article:
                node.mark = 0
    free = len(_free(nodes))
    for node in marked:
        if node.mark and node.mark != CONTROL and node.tag not in FLOWING and 2 * node.plain > root.plain and free <= node.inside:
            node.mark = 0
    for node in nodes:
        if any(c.mark for c in node.children):
            node.children = [c for c in node.children if not c.mark]
            node.pieces = [p for p in node.pieces if isinstance(p, str) or not p.mark]


def parse(page: str) -> Node:
    """The tree of a page without what is cut away."""
    root = Node("#root", None, 0)
    stack = [root]
    at, end = 0, len(page)

    def text(piece: str) -> None:
        if piece:
            stack[-1].pieces.append(html.unescape(piece) if "&" in piece else piece)

    def close(tags: set[str] | frozenset[str], limits: set[str] | frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                del stack[k:]
                return
            if stack[k].tag in limits:
                return

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        closing, opening, attributes = m.groups()
        if closing:
            tag = closing.lower()
            if tag == "br":
                stack[-1].pieces.append(" ")
            elif tag not in VOID:
                close({tag}, {"article", "main"} if tag in INLINE or tag == "p" else set())
            continue
        if not opening:
            continue
        tag = opening.lower()
        if tag in BLOCK_IN_P:
            close({"p"}, {"article", "main", "section", "div", "td", "th", "li", "blockquote", "button", "#root"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        top = stack[-1]
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        if tag in VOID:
            top.pieces.append("\x00" if tag == "hr" else " " if tag == "br" else "")
            top.tags += 1
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        node = Node(tag, top, _mark(tag, attributes, top))
        top.children.append(node)
        top.pieces.append(node)
        if not attributes.rstrip().endswith("/") or tag in BLOCK_IN_P or tag in INLINE:
            stack.append(node)
    settle(root)
    return root


def _walk(root: Node) -> list[Node]:
    """All nodes, parents first."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(reversed(node.children))
    return order


def measure(body: Node) -> list[Node]:
    """Densities and density sums of all nodes below and including ``body``, parents first."""
    nodes = _walk(body)
    for node in reversed(nodes):
        node.chars += node.own
        for c in node.children:
            node.chars += c.chars
            node.tags += c.tags + 1
            node.link_chars += c.link_chars
            node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars = node.chars
    share = body.link_chars / max(body.chars, 1)
    for node in nodes:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, max(node.link_tags, 1)
        if c:
            plain = max(c - lc, 1)
            base = math.log(c / plain * lc + share * c + math.e)
            node.density = max(c / t * math.log(c / plain * t / lt + 1e-9) / math.log(max(base, 1.001)) if lc else c / t, 0.0)
    for node in reversed(nodes):
        node.sum = sum(c.density for c in node.children) or (node.density if not node.children else 0.0)
    return nodes


def content(root: Node) -> Node | None:
    """The node whose subtree is the main content."""
    body = next((n for n in _walk(root) if n.tag == "body"), root)
    nodes = measure(body)
    if not body.chars:
        return None
    densest = max(nodes, key=lambda n: n.density)
    threshold, node = body.density, densest
    while node is not body and node.parent is not None:
        threshold, node = min(threshold, node.density), node.parent
    best, todo = body, [body]
    while todo:
        node = todo.pop()
        if node.density >= threshold:
            if node.sum > best.sum and node.children:
                best = node
            todo.extend(node.children)
    while best.tag in FLOWING and best.parent is not None and best is not body:
        best = best.parent
    node = best
    while node is not None and node is not body:
        if node.tag in CONTENT_TAGS:
            return node
        node = node.parent
    return best


def blocks(node: Node) -> Iterator[str]:
    """The texts of the blocks below a node in page order, white space as single spaces."""
    open_: list[str] = []
    todo: list[str | Node | None] = [node]
    while todo:
        piece = todo.pop()
        if piece is None or piece == "\x00" or (isinstance(piece, Node) and piece.tag not in FLOWING):
            block = " ".join("".join(open_).split())
            if block:
                yield block
            open_ = []
        if isinstance(piece, Node):
            if piece.tag not in FLOWING:
                todo.append(None)
            todo.extend(reversed(piece.pieces))
        elif piece is not None and piece != "\x00":
            open_.append(piece)
    block = " ".join("".join(open_).split())
    if block:
        yield block


def main_text(page: str | None) -> str:
    if not page:
        return ""
    node = content(parse(page))
    return "" if node is None else " ".join(blocks(node))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, pages in slices(batches, 2):
        texts = [main_text(p) for p in pages.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row: page_id, url, text and n_chars."""
    source = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    found = source.mapInArrow(_batches, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
