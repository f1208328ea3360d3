"""Main text of web pages by composite text density.

Every node of the page's tree has a number of characters per tag, lowered by the share of its characters in links. The node whose
children's densities have the largest sum is the core of the article; an article element around it is taken with it. The least
density on the way from the core up to the body is the threshold: other subtrees that reach it are taken too, each with
its own node of largest sum, and further article elements as well only if they reach it. Menus, headers, footers, side bars,
notices, adverts, forms, comments, scripts and styles are taken out before.

A box whose class or id only names such a part (``no-sidebar``, ``content-with-widget``) is not one, and a named box goes
only if the page is not inside it: it stays if few of its characters are links and it outweighs all text outside
named boxes, and either has the page's only main heading or article element, or has a name of another part (``alert-news``) and four times that text.

Defined cases: null, empty or malformed html gives what text can be found, else an empty string; text without any tag is
one block; every row gives one row.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
_DROPPED = frozenset(
    "head nav header footer aside form button select dialog menu figure audio video canvas noembed label fieldset".split()
) - {"figure"}
_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption address details summary hr hgroup center".split()
)
_INLINE_CLOSED = frozenset("p h1 h2 h3 h4 h5 h6".split())  # ended by the start of a block
_SAME = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbox adslot sponsor sponsored promo promotion promoted banner"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login"
    " nav navbar navigation menu topbar toolbar breadcrumb breadcrumbs pagination pager"
    " sidebar aside rail widget widgets related recommended recommendations trending"
    " footer foot masthead copyright share sharing social"
    " comment comments commentlist discussion replies respond disqus reactions".split()
)
_JOINED = ("sidebar", "advert", "cookie", "breadcrumb", "newsletter", "navbar", "comment-", "comments", "footer", "popup")
_COMMENTS = frozenset("comment comments commentlist discussion replies respond disqus reactions".split())
_MODIFIERS = frozenset("no not has have with without hide show is".split())
_MAIN = frozenset("h1 main article".split())
_GONE, _NAMED, _PARTLY = 3, 2, 1  # never text; named as another part; another part in the name
_AROUND = 4  # a box partly named so holds this many times the text outside named boxes, or has the main heading


def _by_name(word: str) -> int:
    parts = re.split(r"[-_]", word)
    if not _MODIFIERS.isdisjoint(parts):
        parts = parts[:next(i for i, part in enumerate(parts) if part in _MODIFIERS)]
        word = "-".join(parts)
    if not parts or _NAMES.isdisjoint(parts) and not word.startswith(_JOINED):
        return 0
    if word in _NAMES or parts[-1] in _NAMES or not _COMMENTS.isdisjoint(parts) or word.startswith(_JOINED):
        return _NAMED
    return _PARTLY


def _unwanted(tag: str, attrs: str) -> tuple[int, bool]:
    """How sure it is that an element is no text, and whether it is named as reader comments."""
    if tag in _DROPPED:
        return _GONE, False
    if not attrs or tag in ("body", "html", "article", "main"):
        return 0, False
    sure, comments = 0, False
    for name, *values in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return _GONE, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _GONE, False
        if name == "role" and value.strip() in _ROLES:
            return _GONE, False
        if name in ("class", "id"):
            for word in value.split():
                found = _by_name(word)
                sure = max(sure, found)
                comments |= found == _NAMED and not _COMMENTS.isdisjoint(re.split(r"[-_]", word))
    return sure, comments


class _Node:
    __slots__ = ("attrs", "chars", "children", "density", "dropped", "link_chars", "link_tags", "parent", "parts", "sum", "tag", "tags")

    def __init__(self, tag: str, attrs: str, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[_Node] = []
        self.parts: list = []  # strings and nodes in page order
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        self.dropped = False


def _tree(page: str) -> tuple[_Node, list[_Node]]:
    root = _Node("body", "", None)
    nodes, top, at, lower = [root], root, 0, None
    while True:
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            top.parts.append(html.unescape(text))
        if m is None:
            return root, nodes
        at = m.end()
        if m["data"] is not None:
            top.parts.append(m["data"])
        tag = (m["tag"] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if m["end"]:
            node = top
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                top = node.parent
            continue
        if tag in _RAW:
            if not m["attrs"].endswith("/") or tag in ("script", "style", "title", "textarea"):
                lower = page.lower() if lower is None or len(lower) != len(page) else lower
                stop = lower.find(f"</{tag}", at)
                close = page.find(">", stop) if stop >= 0 else -1
                at = close + 1 if close >= 0 else len(page)
            continue
        if tag in _BLOCKS or tag in _DROPPED:
            node = top
            while node is not root and node.tag not in _BLOCKS and node.tag not in _DROPPED:
                node = node.parent
            if node.tag in _INLINE_CLOSED:
                top = node.parent
        if tag in _SAME:
            node = top
            same = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
            while node is not root and node.tag not in same and node.tag not in _SAME[tag]:
                node = node.parent
            if node.tag in same:
                top = node.parent
        node = _Node(tag, m["attrs"], top)
        top.parts.append(node)
        if tag in _VOID or m["attrs"].endswith("/") and tag not in _BLOCKS and tag != "a":
            continue
        top.children.append(node)
        nodes.append(node)
        top = node


def _own_chars(node: _Node) -> int:
    return sum(len(_SPACE.sub(" ", p).strip()) for p in node.parts if isinstance(p, str))


def _drop(nodes: list[_Node]) -> None:
    """Mark elements that are no text. The largest named boxes are judged first, then those inside the ones that stay."""
    boxes: list[list] = []  # node, sureness, comments, all characters, link characters, characters and main elements outside inner boxes
    of: dict[int, list] = {}  # the innermost box around a node
    outside = [nodes[0], 0, False, 0, 0, 0, 0]
    of[id(nodes[0])] = outside
    for node in nodes[1:]:
        above = node.parent
        in_article = node.tag == "header" and above.tag in ("article", "main", "section") and not above.dropped
        sure, comments = (0, False) if in_article else _unwanted(node.tag, node.attrs)
        node.dropped = above.dropped or sure == _GONE
        box = of[id(above)]
        if not node.dropped and sure:
            box = [node, sure, comments, 0, 0, 0, 0]
            boxes.append(box)
        of[id(node)] = box
    if not boxes:
        return
    links: set[int] = set()
    for node in nodes:
        if node.dropped:
            continue
        if node.tag == "a" or node.parent is not None and id(node.parent) in links:
            links.add(id(node))
        box, own = of[id(node)], _own_chars(node)
        box[5] += own
        box[6] += node.tag in _MAIN
        box[3] += own
        box[4] += own if id(node) in links else 0
    for box in reversed(boxes):  # inner boxes come later
        around = of[id(box[0].parent)]
        around[3] += box[3]
        around[4] += box[4]
    text, heads = outside[5], outside[6]
    for box in sorted(boxes, key=lambda b: -b[3]):
        node, sure, comments, chars, linked, own, main = box
        above = of[id(node.parent)][0]
        if above.dropped:
            node.dropped = True
            continue
        stays = not comments and 2 * linked < max(1, chars) and own >= text and (
            main > 0 and not heads or sure == _PARTLY and own >= _AROUND * text
        )
        if stays:
            text, heads = text + own, heads + main
        else:
            node.dropped = True
    for node in nodes[1:]:
        node.dropped = node.dropped or node.parent.dropped


def _measure(nodes: list[_Node]) -> None:
    _drop(nodes)
    for node in reversed(nodes):
        if node.dropped:
            continue
        node.chars += _own_chars(node)
        if node.tag == "a":
            node.link_chars = node.chars
            node.link_tags += 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            node.parent.tags += node.tags + 1
            node.parent.link_tags += node.link_tags
    body = nodes[0]
    share = body.link_chars / max(1, body.chars)
    for node in nodes:
        if node.dropped or not node.chars:
            continue
        chars, links = node.chars, node.link_chars
        base = math.log(chars / max(1, chars - links) * links + share * chars + math.e)
        ratio = chars / max(1, links) * max(1, node.tags) / max(1, node.link_tags)
        node.density = chars / max(1, node.tags) * max(0.0, math.log(max(1.0, ratio)) / max(1e-9, math.log(base + 1e-9)))
        if node.parent is not None:
            node.parent.sum += node.density


def _core(nodes: list[_Node]) -> _Node:
    return max(nodes, key=lambda n: n.sum if n.children else n.density)


def _inside(node: _Node) -> list[_Node]:
    found, stack = [], [node]
    while stack:
        node = stack.pop()
        if not node.dropped:
            found.append(node)
            stack.extend(node.children)
    return found


def _chosen(nodes: list[_Node]) -> set[int]:
    live = [n for n in nodes if not n.dropped and n.chars]
    if not live:
        return set()
    core = _core(live)
    threshold, node, taken = core.density, core, core
    while node is not None:
        threshold = min(threshold, node.density)
        if node.tag in ("article", "main") and taken is core:
            taken = node
        node = node.parent
    chosen, stack = {id(taken)}, [nodes[0]] if taken is not nodes[0] else []
    around = {id(nodes[0])}
    node = taken
    while node is not None:
        around.add(id(node))
        node = node.parent
    while stack:
        for child in stack.pop().children:
            if child.dropped or not child.chars or child is taken:
                continue
            if id(child) in around:
                stack.append(child)
            elif child.density >= threshold:
                best = _core([n for n in _inside(child) if n.chars])
                chosen.add(id(best if best.tag in _BLOCKS and best.chars >= 0.9 * child.chars else child))
    for node in live:
        if node.tag == "article" and id(node) not in around and node.density < threshold and 2 * node.link_chars > node.chars:
            node.dropped = True  # a linked teaser inside the core
    if taken.tag not in _BLOCKS and taken.parent is not None:
        chosen.add(id(taken.parent))
    return chosen


def main_text(page: str) -> str:
    """The article of a page, one line per block."""
    root, nodes = _tree(page)
    _measure(nodes)
    chosen = _chosen(nodes)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        block = _SPACE.sub(" ", "".join(line)).strip()
        line.clear()
        if block:
            blocks.append(block)

    stack: list = [(root, id(root) in chosen, False)]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
            continue
        node, taken, titles_only = item
        if isinstance(node, str):
            if taken and not titles_only:
                line.append(node)
            continue
        if node.dropped:
            continue
        if node.tag == "br":
            line.append(" ")
            continue
        taken = taken or id(node) in chosen
        titles_only = (titles_only or node.tag == "header") and node.tag not in _HEADINGS
        block = node.tag in _BLOCKS
        if block:
            flush()
            stack.append(None)
        stack.extend((part, taken, titles_only) for part in reversed(node.parts))
    flush()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [main_text(p or "") for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
