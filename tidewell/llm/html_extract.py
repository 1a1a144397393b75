"""Main text of web pages by tree scoring.

A page becomes a tree; parts that are never article text (menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts, styles, hidden
parts) are cut out by tag, role and class. Each paragraph passes points for its
length and its commas, discounted by the share of its text inside links, to all
of its ancestors. The best container is the lowest one that holds most of the
points of the page. It is kept whole, with the siblings of it and of its
ancestors below the page's body that are no lists of links; beside its outermost
ancestor, or the article element around it, siblings must score or read like it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_map, named

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements whose start and end separate blocks of text.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead caption tr ul".split())
CELL = frozenset(("td", "th"))
#: What a start tag closes if it is the open element of its kind: tag -> (closed, not beyond).
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)),
    "a": (("a",), ("td", "th", "table", "object")),
}
#: What may be in a head; any other start tag ends it.
HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = BLOCK - {"body", "html"}
DROP_TAGS = frozenset("nav header footer aside form script style noscript template iframe object embed svg math canvas audio video button select textarea input dialog menu head title map noembed noframes xmp search datalist".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
#: Words that, first or last in a class name or id, mark a part of the page as no article text.
DROP_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adbox adslot adsense alert sponsor sponsored promo promotion promotions banner cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations menu submenu mainmenu nav navbar topnav subnav sidenav navigation navi breadcrumb breadcrumbs pagination pager footer masthead toolbar sidebar aside widget widgets login search skip comment comments commentlist discussion disqus respond reply replies outbrain taboola topbar toplinks sitenav rail".split())
#: Of these, the words that do so anywhere in a name.
DROP_ANYWHERE = frozenset("ad ads advert advertisement comments cookie navbar newsletter sidebar sponsored".split())
#: Of these, the words that also name parts of an article; inside one they need more than the name.
MAY_BE_TEXT = frozenset("alert notice notices related recommended promotion promotions social search share sharing subscription notification notifications discussion reply respond banner skip login".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words outside links, and their share of all, from which a part so named is text.
LEAST_WORDS, LEAST_SHARE = 12, 0.75
#: Elements that are content wherever they stand, unless they are mostly links.
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure p".split())
#: Share of the page's points from which a part of the page is the article, and of a container's from which one inside it is.
PAGE_SHARE, MOST = 0.5, 0.9
#: Share of text in links from which a sibling is a list of links.
LISTING = 0.5
GOOD_NAMES = frozenset("article post story content entry body main text page hentry".split())
#: Words that turn a name into a statement about the layout.
LAYOUT = frozenset("has no with without show hide is".split())
KEEP_TAGS = frozenset(("html", "body", "main"))
PARAGRAPH = frozenset(("p", "pre", "td", "li", "dd", "blockquote", "figcaption"))

_PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+)>""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>=][^\s/>=]*+)(\s*+=\s*+)?+""")
_BARE = re.compile(r"[^\s>]*+")
_PARTS = re.compile(r"[\s_\-:]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "points", "chars", "linked", "doubtful")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.points = self.chars = self.linked = 0.0
        self.doubtful = False  # named like no article text, which names of parts of an article are too


def _tag(page: str, at: int, last: dict[str, int]) -> tuple[str, bool, dict[str, str], int] | None:
    """Name, whether it is an end tag, attributes and end of the tag at ``at``."""
    m = _PLAIN_TAG.match(page, at)
    if m and "=" not in m[3]:
        rest = m[3].split()
        return m[2].lower(), bool(m[1]), dict.fromkeys((x.lower() for x in rest), "") if rest else {}, m.end()
    name = _NAME.match(page, at)
    if not name:
        return None
    found: dict[str, str] = {}
    at, n = name.end(), len(page)
    while at < n:
        m = _ATTRIBUTE.match(page, at)
        if not m:
            end = page.find(">", at)
            return name[1].lower(), page[name.start() + 1] == "/", found, n if end < 0 else end + 1
        at = m.end()
        value = ""
        if m[2] and at < n:
            quote = page[at]
            if quote in "\"'" and at < last[quote]:
                end = page.index(quote, at + 1)
                value, at = page[at + 1 : end], end + 1
            else:
                v = _BARE.match(page, at)
                value, at = v[0], v.end()
        found.setdefault(m[1].lower(), value)
    return name[1].lower(), page[name.start() + 1] == "/", found, n


def parse(page: str) -> Node:
    """The page's tree, with the end tags that may be left out put in."""
    root = Node("#root", {}, None)
    here, opened = root, {}
    last = {'"': page.rfind('"'), "'": page.rfind("'")}
    at, n = 0, len(page)

    def close(stop: Node) -> Node:
        """Leave all elements down to and including ``stop``."""
        node = here
        while True:
            opened[node.tag] -= 1
            if node is stop:
                return node.parent
            node = node.parent

    def open_one(names: tuple[str, ...], limits: frozenset | tuple[str, ...]) -> Node | None:
        if not any(opened.get(x) for x in names):
            return None
        node = here
        while node is not root and node.tag not in limits:
            if node.tag in names:
                return node
            node = node.parent
        return None

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            here.children.append(page[at:])
            break
        if lt > at:
            here.children.append(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            if page.startswith("<![CDATA[", lt):
                end = page.find("]]>", lt)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        got = _tag(page, lt, last)
        if got is None:
            here.children.append("<")
            at = lt + 1
            continue
        tag, is_end, attributes, at = got
        if is_end:
            limits = () if tag in BLOCK or tag in CELL else BLOCK | CELL
            node = open_one((tag,), limits)
            if node is not None:
                here = close(node)
            continue
        if tag in CLOSES_P and opened.get("p"):
            node = open_one(("p",), ("td", "th", "table", "button", "object"))
            if node is not None:
                here = close(node)
        if tag in CLOSES:
            node = open_one(*CLOSES[tag])
            if node is not None:
                here = close(node)
        if tag not in HEAD and opened.get("head"):
            node = open_one(("head",), ())
            here = close(node) if node is not None else here
        new = Node(tag, attributes, here)
        here.children.append(new)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if end is None:
                at = n
            else:
                new.children.append(page[at : end.start()])
                close_at = page.find(">", end.end())
                at = n if close_at < 0 else close_at + 1
            continue
        here = new
        opened[tag] = opened.get(tag, 0) + 1
    return root


def _names(node: Node) -> list[str]:
    a = node.attributes
    return f"{a.get('class', '')} {a.get('id', '')}".lower().split() if a else []


def is_dropped(node: Node) -> bool:
    """Whether the part is none of the article by tag, role, class, id or being hidden."""
    return _is_marked(node) or _is_named(node, DROP_NAMES)


def _is_marked(node: Node) -> bool:
    """Whether it is none of the article by tag, role or being hidden."""
    tag, a = node.tag, node.attributes
    if tag in DROP_TAGS:
        return True
    if not a or tag in KEEP_TAGS:
        return False
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(a.get("style", "")):
        return True
    return a.get("role", "").lower() in DROP_ROLES


def _is_named(node: Node, ends: frozenset[str]) -> bool:
    """Whether a class or id starts or ends with one of ``ends``, or has one of DROP_ANYWHERE."""
    if not node.attributes or node.tag in KEEP_TAGS:
        return False
    for name in _names(node):
        parts = [x for x in _PARTS.split(name) if x]
        if parts and LAYOUT.isdisjoint(parts) and (parts[0] in ends or parts[-1] in ends or not DROP_ANYWHERE.isdisjoint(parts)):
            return True
    return False


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or node.attributes.get("role", "").lower() in ("main", "article")


def prune(root: Node) -> list[Node]:
    """Take the dropped parts out of the tree; the remaining nodes, parents first.

    A part marked by its name or a form around the article stays, since the
    article cannot be without it. A part whose name may be that of a part of an
    article is doubtful if it reads like text: it stays, but is not scored.
    """
    holds: set[int] = set()  # nodes with an article or main element below
    every, stack = [], [root]
    while stack:
        node = stack.pop()
        every.append(node)
        for child in node.children:
            if isinstance(child, Node):
                if _is_article(child) and not is_dropped(child):
                    up = node
                    while up is not None and id(up) not in holds:
                        holds.add(id(up))
                        up = up.parent
                stack.append(child)
    words: dict[int, tuple[int, int]] = {}

    def goes(node: Node) -> bool:
        if not is_dropped(node) or id(node) in holds and (node.tag == "form" or node.tag not in DROP_TAGS):
            return False
        line = node.tag in HEADINGS or node.tag in PARAGRAPH
        if _is_marked(node) or node.tag not in HEADINGS and _is_named(node, DROP_NAMES - MAY_BE_TEXT):
            return True
        if not words:
            words.update(_words(every))
        free, linked = words[id(node)]
        node.doubtful = free >= (1 if line else LEAST_WORDS) and free >= LEAST_SHARE * (free + linked)
        return not node.doubtful

    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        node.children = [c for c in node.children if isinstance(c, str) or not goes(c)]
        todo += [c for c in node.children if isinstance(c, Node)]
    return order


def _words(every: list[Node]) -> dict[int, tuple[int, int]]:
    """Words outside and inside links of every node; ``every`` has parents first."""
    found: dict[int, tuple[int, int]] = {}
    for node in reversed(every):
        free = linked = 0
        if node.tag not in DROP_TAGS:
            for child in node.children:
                if isinstance(child, str):
                    free += len(child.split())
                else:
                    x, y = found[id(child)]
                    free, linked = free + x, linked + y
        found[id(node)] = (0, free + linked) if node.tag == "a" else (free, linked)
    return found


def score(order: list[Node]) -> None:
    """Characters, linked characters and points of every node: those of all paragraphs in it."""
    for node in reversed(order):  # children first
        below = [c for c in node.children if isinstance(c, Node)]
        if node.tag in PARAGRAPH or node.tag in ("div", "section", "article", "body"):
            own = not any(c.tag in BLOCK for c in below) or node.tag == "blockquote" and not any(c.points for c in below)
        else:
            own = False
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(" ".join(child.split()))
            elif not child.doubtful:
                node.chars += child.chars
                node.linked += child.chars if child.tag == "a" else child.linked
                node.points += child.points
        if own and node.chars:
            commas = sum(c.count(",") for c in node.children if isinstance(c, str))
            node.points += (1 + commas + min(node.chars / 100, 3.0)) * (1 - node.linked / node.chars)


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _weight(node: Node) -> float:
    """Points that count when containers are compared."""
    prior = 25.0 if _is_article(node) else 10.0 if any(p in GOOD_NAMES for name in _names(node) for p in _PARTS.split(name)) else 0.0
    return (node.points + prior) * (1 - _density(node))


def _reads_like(node: Node, top: Node) -> bool:
    """Whether a sibling of ``top`` belongs to the article."""
    density = _density(node)
    if node.doubtful or not node.chars or density >= (0.5 if node.tag in HEADINGS else 0.25):
        return False
    if node.tag == "p":
        return node.chars > 80 or density == 0 and not _is_article(top)
    if node.tag in CONTENT:
        return not _is_article(top) or node.tag in ("h1", "h2")
    if node.tag == top.tag and node.attributes.get("class") == top.attributes.get("class") and (node.tag != "div" or node.attributes.get("class")):
        return True
    points = node.points * (1 - density)
    return points >= 0.2 * top.points and (points >= 10.0 or _has_paragraph(node))


def _has_paragraph(node: Node) -> bool:
    stack = [node]
    while stack:
        node = stack.pop()
        if node.tag in ("p", "pre", "blockquote") and node.chars:
            return True
        stack += [c for c in node.children if isinstance(c, Node)]
    return False


def choose(order: list[Node]) -> tuple[list[Node], set[int]]:
    """The parts of the article in page order, and what goes inside them."""
    page = next((n for n in order if n.tag == "body"), order[0])
    best = page
    while True:
        below = [c for c in best.children if isinstance(c, Node) and c.points > 0 and c.tag not in PARAGRAPH and not c.doubtful]
        child = max(below, key=_weight, default=None)
        if child is None or not _is_article(child) and child.points < (PAGE_SHARE if best is page else MOST) * best.points:
            break
        best = child
    if best is page or best.parent is None:
        return [page], {id(n) for n in order if n.doubtful}
    gone, top, whole = set(), best, best
    while top.parent is not page and top.parent is not None and not _is_article(top):
        top = top.parent
    up = top  # a part of an article stands for the outermost one
    while up is not None and up is not page:
        whole = up if _is_article(up) else whole
        up = up.parent
    if _is_article(whole):
        top = whole
    node = best
    while node is not top:
        for sibling in node.parent.children:
            if isinstance(sibling, Node) and sibling is not node:
                named = sibling.doubtful and sibling.tag not in PARAGRAPH and (sibling.tag != node.tag or sibling.tag == "div")
                if named or sibling.tag not in HEADINGS and _density(sibling) >= LISTING:
                    gone.add(id(sibling))
        node = node.parent
    return [n for n in top.parent.children if n is top or isinstance(n, Node) and _reads_like(n, top)], gone


def text_of(nodes: list[Node], gone: set[int] | frozenset[int] = frozenset()) -> str:
    """Blocks in page order without the parts whose ids are in ``gone``, one to a line; white space inside a block is one space."""
    lines: list[str] = []
    block: list[str] = []

    def flush() -> None:
        if block:
            line = " ".join(html.unescape("".join(block)).split())
            if line:
                lines.append(line)
            block.clear()

    stack: list[Node | str | None] = list(reversed(nodes))
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            block.append(item)
        elif item.tag in ("br", "wbr", "img"):
            block.append(" " if item.tag == "br" else "")
        elif id(item) not in gone:
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            elif item.tag in CELL:
                block.append(" ")
            stack += reversed(item.children)
    flush()
    return "\n".join(lines)


def main_text(page: str | None) -> str:
    """The article's text; empty for a null, empty or textless page."""
    if not page:
        return ""
    order = prune(parse(page))
    score(order)
    return text_of(*choose(order))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page, in one pass without shuffle.

    A null page is empty. Repeated rows give repeated rows, an empty table none;
    a null page_id or url stays null; further columns are ignored.
    """

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for page_id, url, page in zip(named(batch, "page_id").to_pylist(), named(batch, "url").to_pylist(), named(batch, "html"), strict=True):
            text = main_text(page.as_py())
            yield page_id, url, text, len(text)

    return arrow_map(pages.select("page_id", "url", F.col("html")), rows, "page_id long, url string, text string, n_chars long")
