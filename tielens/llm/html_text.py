"""HTML extraction by composite text density.

A page becomes a tree; parts that never hold article text (scripts, menus, headers, footers, sidebars, adverts, forms,
notices, reader comments) are taken out by their tags and by names that say so as a whole. Every node gets its composite text density: characters per tag, adjusted by
how much of them are links and how that compares with the whole body. A node's density sum adds its children's
densities. The node with the largest sum leads to the content; the least density on its path from the body is the
threshold, and every subtree with at least that density, reached from the body through such subtrees, gives its node of
largest sum as content. Beside that path (of the body's children those with several tags), blocks count as dense by their
characters outside links per tag too, a measure that doesn't grow with a node's size. A node below the body that holds several of these is content as a whole; of the body's children,
those between the first and the last that hold some are, unless most of their text is links. Headings before content,
beside it or beside what holds it, belong to it.

Defined results: null or empty HTML, or a page without text, gives an empty string. Unclosed and truncated tags are
closed where HTML closes them. Nothing is cut: all text of a content subtree is kept. Blocks are joined by one ``\\n``;
white space within a block becomes one space. Other columns are ignored; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

#: HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style head title noscript template iframe noembed noframes object embed svg math canvas audio video nav header footer aside form button select option textarea input label fieldset dialog menu".split())
BLOCK = frozenset(
    "html body div p article section main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption pre blockquote address figure figcaption hr center details summary hgroup".split()
)
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "dt", "dd", "li"} | {"form", "nav", "header", "footer", "aside", "fieldset", "menu"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table html body div article section main aside nav header footer form".split())
#: Words of class, id and role names that mark what is not the article.
ASIDE = frozenset(
    "ad ads advert adverts advertisement advertising banner banners sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar aside rail masthead footer comments disqus respond replies cookie cookies consent gdpr newsletter subscribe subscription signup login popup modal share sharing social related recommended pagination pager toolbar search copyright".split()
)
#: Words that mark it only as a whole name or among the others.
VAGUE = frozenset("header comment notice notices form overlay widget".split())
#: Words that change nothing beside them: place, container, kind of content.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container content contents cookies div global group icons inner item items left legal level links list main message network outer overlay page panel policy post posts primary right row section secondary site slot space stories text thread title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# A quote opens a value only after "=".
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "parts", "hidden", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, hidden: bool = False):
        self.tag, self.parent, self.parts, self.hidden = tag, parent, [], hidden


def _marks(name: str) -> bool:
    """Whether a class, id or role name as a whole says that something isn't the article."""
    words = _WORD.findall(name)
    if not words or ASIDE.isdisjoint(words) and VAGUE.isdisjoint(words):
        return False
    return all(w in ASIDE or w in VAGUE or w in BESIDE for w in words)


def _aside(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _NONE.search(value):
            return True
        if name in ("class", "id", "role") and any(map(_marks, value.lower().split())):
            return True
    return False


def parse(page: str) -> Node:
    """The tree of a page: a node's parts are strings (references decoded) and nodes, in order."""
    root = here = Node("#root", None)
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            here.parts.append(html.unescape(page[at:stop]))
        if not m:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            n = here
            while n is not root and n.tag != name:
                if name in ("b", "i", "a", "span", "em", "strong", "u", "font", "small") and n.tag in BLOCK:
                    n = root  # an inline end tag doesn't close blocks
                    break
                n = n.parent
            if n is not root:
                here = n.parent
            continue
        if name in CLOSES_P:
            n = here
            while n is not root and n.tag != "p" and n.tag not in SCOPE:
                n = n.parent
            if n.tag == "p":
                here = n.parent
        if name in SAME:
            n = here
            while n is not root and n.tag not in SAME[name] and n.tag not in SCOPE:
                n = n.parent
            if n.tag in SAME[name]:
                while n.parent.tag in SAME[name]:
                    n = n.parent
                here = n.parent
        node = Node(name, here, name in HIDDEN or _aside(name, m[3]))
        here.parts.append(node)
        if name in VOID or m[3].endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            close = re.compile(rf"</{name}[\s/>]", re.I).search(page, at)
            node.parts.append(page[at : close.start() if close else end])
            gt = page.find(">", close.start()) if close else -1
            at = gt + 1 if gt >= 0 else end
            continue
        if name in ("article", "main"):  # what holds the article isn't beside it: a form around the page, a name that says too little
            n = here
            while n is not root:
                n.hidden = n.hidden and n.tag != "form" and n.tag in HIDDEN
                n = n.parent
        here = node
    return root


def _ordered(root: Node) -> list[Node]:
    """Nodes that aren't hidden, parents first."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        out.append(n)
        stack += [p for p in reversed(n.parts) if isinstance(p, Node) and not p.hidden]
    return out


def _children(n: Node) -> list[Node]:
    return [p for p in n.parts if isinstance(p, Node) and not p.hidden]


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all visible nodes."""
    nodes = _ordered(root)
    for n in nodes:
        n.chars = sum(len(_WHITE.sub(" ", p).strip()) for p in n.parts if isinstance(p, str))
        n.tags = n.link_tags = 0
        n.link_chars, n.total = 0, 0.0
    for n in reversed(nodes):
        if n.tag == "a":
            n.link_chars = n.chars
        if n.parent is not None:
            up = n.parent
            up.chars += n.chars
            up.tags += n.tags + 1
            up.link_chars += n.link_chars
            up.link_tags += n.link_tags + (n.tag == "a")
    whole = max(root.chars, 1)
    share = root.link_chars / whole
    for n in nodes:
        c, t, lc, lt = n.chars, max(n.tags, 1), max(n.link_chars, 1), max(n.link_tags, 1)
        plain = max(c - n.link_chars, 1)
        base = math.log(c / plain * n.link_chars + share * c + math.e)
        n.density = c / t * math.log(max(c * t / (lc * lt), 1.0)) / base if c else 0.0
    for n in nodes[1:]:
        if n.tag in BLOCK:  # inline mark-up is part of its block's text, not a place of content of its own
            n.parent.total += n.density
    return nodes


def _plain(n: Node) -> float:
    """Characters outside links per tag."""
    return (n.chars - n.link_chars) / max(n.tags, 1)


def content(root: Node) -> list[Node]:
    """The content subtrees, in page order."""
    nodes = measure(root)
    bodies = [n for n in nodes if n.tag == "body"]
    body = bodies[0] if bodies else root
    best = max(nodes, key=lambda n: n.total)
    if not best.total:
        return [body]
    threshold, plain, n, path = best.density, _plain(best), best, set()
    while n is not None:
        path.add(id(n))
        threshold, plain, n = min(threshold, n.density), min(plain, _plain(n)), None if n is body else n.parent
    if id(body) not in path:
        body = root
    top: dict[int, Node] = {}
    for n in reversed(nodes):  # the node of largest sum in each subtree
        mine = top.setdefault(id(n), n)
        if n.parent is not None and mine.total > top.setdefault(id(n.parent), n.parent).total:
            top[id(n.parent)] = mine
    chosen, stack = set(), [body]
    while stack:
        n = stack.pop()
        beside = n.tag in BLOCK and n.parent is not None and id(n.parent) in path and (n.parent is not body or n.tags > 1)
        if (n.density >= threshold or beside and 0 < plain <= _plain(n)) and id(n) not in chosen:
            chosen.add(id(top[id(n)]))
            stack += _children(n)
    holders: dict[int, int] = {}
    for n in reversed(nodes):  # a node that holds several choices takes their place
        if n is not body and holders.get(id(n), 0) > 1:
            chosen.add(id(n))
        if n.parent is not None and (id(n) in chosen or holders.get(id(n))):
            holders[id(n.parent)] = holders.get(id(n.parent), 0) + 1
    out, stack = [], [body]
    while stack:
        n = stack.pop()
        if id(n) in chosen:
            out.append(n)
            continue
        children = _children(n)
        held = [i for i, c in enumerate(children) if id(c) in chosen or holders.get(id(c))]
        for i, c in enumerate(children):
            between = n is body and held and held[0] < i < held[-1] and 2 * c.link_chars <= c.chars
            if held and i not in held and (between or i < held[-1] and c.tag in HEADINGS):
                chosen.add(id(c))
        stack += [c for c in reversed(children) if id(c) in chosen or holders.get(id(c))]
    return out


def blocks(node: Node, whole: str = "") -> list[str]:
    """Texts of the blocks below a node."""
    out, words = [], []

    def flush():
        text = _WHITE.sub(" ", "".join(words)).strip()
        if text:
            out.append(text)
        words.clear()

    stack: list = [node]
    while stack:
        p = stack.pop()
        if p is None:
            flush()
        elif isinstance(p, str):
            words.append(p)
        elif not p.hidden or p is node:
            if p.tag == "br":
                words.append(" ")
            if p.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(p.parts)
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for n in content(parse(page)) for b in blocks(n))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each page."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            text = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["id", "url", "text", "n_chars"])

    picked = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    out = picked.mapInArrow(lean(run), f"id {kind}, url string, text string, n_chars long")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
