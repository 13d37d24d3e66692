"""Main text of HTML pages by tree scoring.

Blocks of text pass points for length and commas to their parent, half to the grandparent
and a third to the next; a container's points are discounted by its link density. The best
container is widened to the article or main element that holds it, or else joined by those
siblings that look like text; menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are left out by element, role and class or id words, unless they hold the article
or most of the page's text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*>", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "img", "nobr"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "svg", "math", "canvas", "audio",
           "video", "object", "dialog", "menu", "fieldset", "figure-actions"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
#: Class and id words of page furniture.
NOISE = set("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
            "consent disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices "
            "notification pagination pager popup promo promotion related recommended respond reply replies sharing share "
            "sidebar sidebars signup skyscraper social sponsor sponsored subscribe subscription tags toolbar widget widgets "
            "login paywall outbrain taboola copyright".split())
#: Never taken for the main text, however long; nor is what is hidden.
REPLIES = set("comment comments disqus respond reply replies related recommended".split())
#: Furniture of a page whose article has less text than this outside of furniture may hold the article.
ENOUGH = 250
KEEP = {"article", "main", "body", "html"}
#: Elements closed by the opening of one of the named elements.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
             "option": {"option"}}
STOP_CLOSING = {"table", "ul", "ol", "dl", "div", "section", "article", "body", "html", "td", "th", "blockquote"}


class Node:
    """An element: children are nodes and strings; points, text length and linked length of its kept text."""

    __slots__ = ("tag", "parent", "children", "noise", "fixed", "weak", "points", "length", "linked")

    def __init__(self, tag: str, parent: Node | None, noise: bool, fixed: bool = False, weak: bool = False):
        self.fixed, self.weak = fixed, weak
        self.tag, self.parent, self.noise = tag, parent, noise
        self.children: list[Node | str] = []
        self.points = 0.0
        self.length = self.linked = 0


def _is_noise(tag: str, token: str) -> bool:
    if tag in DROPPED:
        return True
    if " " not in token and "\n" not in token and "\t" not in token:
        return False
    for name, a, b, c in ATTRIBUTE.findall(token):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and tag not in KEEP:
            if not NOISE.isdisjoint(WORDS.findall(value)):
                return True
        elif name == "role" and value in ROLES or name == "aria-hidden" and value == "true":
            return True
        elif name == "hidden" and not value or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _is_weak(tag: str, token: str) -> bool:
    """Noise only by a part of a longer class or id name ("share-wrapper")."""
    if tag in DROPPED:
        return False
    for name, a, b, c in ATTRIBUTE.findall(token):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            if not NOISE.isdisjoint(value.split()):
                return False
        elif name == "role" and value in ROLES:
            return False
    return True


def _is_fixed(tag: str, token: str) -> bool:
    """Noise whatever it holds."""
    if tag in ("head", "select", "option", "svg", "math", "dialog", "footer"):
        return True
    for name, a, b, c in ATTRIBUTE.findall(token):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and any(
                not REPLIES.isdisjoint(WORDS.findall(x)) for x in value.split() if not x.startswith(("has-", "no-", "with-"))) or name == "aria-hidden" and value == "true" \
                or name == "hidden" and not value or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def parse(page: str) -> Node:
    """Element tree of a page; unclosed, misnested and unknown tags are repaired."""
    root = node = Node("html", None, False)
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at:m.start()])
        token, at = m[0], m.end()
        if token[1] in "!?":
            if token.startswith("<![CDATA["):
                node.children.append(token[9:-3])
            continue
        tag = NAME.match(token)[1].lower()
        if token[1] == "/":
            up = node
            while up is not None and up.tag != tag:
                up = None if tag not in STOP_CLOSING and up.tag in ("article", "main", "body", "table") else up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            if not token.endswith("/>"):
                at = page.find(">", close.end()) + 1 if close else end
                at = at or end
            continue
        if tag not in INLINE and tag not in VOID:  # a block ends an open paragraph and inline elements in it
            up = node
            while up.parent is not None and up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        closes = CLOSED_BY.get(tag)
        if closes:
            up = node
            while up.parent is not None and up.tag not in closes and up.tag not in STOP_CLOSING:
                up = up.parent
            while up.tag in closes and up.parent is not None:
                node = up.parent
                up = node
                break
        if tag in ("html", "body"):
            continue
        noise = _is_noise(tag, token)
        child = Node(tag, node, noise, noise and _is_fixed(tag, token), noise and _is_weak(tag, token))
        node.children.append(child)
        if tag not in VOID and not token.endswith("/>"):
            node = child
    return root


def _prose(root: Node, skip: bool) -> tuple[int, int, int]:
    """Unlinked text, linked text and blocks with text below an element; ``skip``: without what is noise."""
    plain = linked = blocks = 0
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag == "a"
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        plain, linked = plain + (0 if inside else own), linked + (own if inside else 0)
        blocks += bool(own) and node.tag not in INLINE
        stack.extend((c, inside) for c in node.children if not isinstance(c, str) and not (c.fixed or skip and c.noise))
    return plain, linked, blocks


def _restore(root: Node) -> None:
    """Elements of an article or main element that are noise by a part of their name only count as text
    where they read like it: several blocks, few links, and blocks not much shorter than the article's."""
    stack, found = [root], []
    while stack:
        node = stack.pop()
        if node.fixed or node.noise and not node.weak:
            continue
        if node.noise:
            up = node.parent
            while up is not None and up.tag not in ("article", "main"):
                up = up.parent
            if up is not None:
                found.append((node, up))
            continue
        stack.extend(c for c in node.children if not isinstance(c, str))
    around = {id(up): _prose(up, True) for _, up in found}
    for node, up in found:
        plain, linked, blocks = _prose(node, False)
        rest, _, others = around[id(up)]
        if blocks >= 3 and linked < 0.25 * (plain + linked) and 2 * plain * others >= rest * blocks:
            node.noise = False


def _rescue(root: Node) -> None:
    """Noise that holds the article or most of the page's text counts as no noise."""
    order, stack = [], [(root, False, False)]
    text: dict[int, int] = {}  # unlinked text of an element, and of the articles in or around it
    article: dict[int, int] = {}
    outside = 0
    while stack:
        node, linked, hidden = stack.pop()
        if node.fixed:
            continue
        order.append(node)
        linked, hidden = linked or node.tag == "a", hidden or node.noise
        own = 0 if linked else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        text[id(node)], article[id(node)] = own, 0
        if not hidden and own:
            up = node
            while up is not None and up.tag not in ("article", "main"):
                up = up.parent
            outside += own if up is not None else 0
        stack.extend((c, linked, hidden) for c in node.children if not isinstance(c, str))
    if outside >= ENOUGH:
        return
    for node in reversed(order):
        if node.tag in ("article", "main"):
            article[id(node)] = text[id(node)]
        if node.parent is not None:
            text[id(node.parent)] += text[id(node)]
            article[id(node.parent)] += article[id(node)]
    for node in order:
        own, whole = text[id(node)], text[id(root)]
        most = 2 * own > whole and own > 4 * outside and (own >= ENOUGH or own == whole)
        if node.noise and (most or article[id(node)] > outside):
            node.noise = False


def _measure(root: Node) -> None:
    """Kept text length and linked length of every element, bottom up."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        if node.noise:
            continue
        order.append(node)
        linked = linked or node.tag == "a"
        for c in node.children:
            if isinstance(c, str):
                n = len(c.strip())
                node.length += n
                node.linked += n if linked else 0
            else:
                stack.append((c, linked))
    for node in reversed(order):
        if node.parent is not None:
            node.parent.length += node.length
            node.parent.linked += node.linked


def _elements(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.noise:
            continue
        yield node
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))


def _commas(node: Node) -> int:
    n, stack = 0, [node]
    while stack:
        x = stack.pop()
        for c in x.children:
            if isinstance(c, str):
                n += c.count(",")
            elif c.tag in INLINE and not c.noise:
                stack.append(c)
    return n


def _score(root: Node) -> Node:
    """Best container."""
    best, top = root, 0.0
    for node in _elements(root):
        if node.tag in INLINE or node.tag in VOID:
            continue
        direct = sum(len(c.strip()) if isinstance(c, str) else (c.length if c.tag in INLINE and not c.noise else 0)
                     for c in node.children)
        if not direct:
            continue
        points = (1 + _commas(node) + min(direct / 100, 3)) * (1 - node.linked / max(node.length, 1))
        up, share = node.parent if node.tag not in ("div", "td", "section", "article", "main") else node, 1.0
        for part in (1.0, 0.5, 1 / 3):
            if up is None:
                break
            up.points += points * part
            up = up.parent
    for node in _elements(root):
        s = node.points * (1 - node.linked / max(node.length, 1))
        if s > top:
            best, top = node, s
    return best


def _widen(best: Node) -> list[Node]:
    """The article or main element around the best container, or it with siblings that look like text."""
    up, found = best, None
    while up is not None:
        if up.tag in ("article", "main"):
            found = up
            if up.tag == "article":
                break
        up = up.parent
    if found is not None:
        if found.tag == "article" and found.parent is not None:  # sibling articles that are text, in page order
            return [c for c in found.parent.children if c is found or not isinstance(c, str) and c.tag == "article" and not c.noise
                    and c.linked < 0.25 * c.length and c.length - c.linked >= 0.2 * (found.length - found.linked)]
        return [found]
    parts = [best]
    while best.parent is not None:
        kept = []
        for c in best.parent.children:
            if isinstance(c, str) or c.noise:
                continue
            density = c.linked / max(c.length, 1)
            if c is best or c in parts or (c.length and density < 0.25 and
                                           (c.points >= 0.2 * best.points or c.tag not in ("div", "section", "ul", "ol", "table"))):
                kept.append(c)
        if len(kept) > 1 or best.parent.parent is None:
            loose = any(isinstance(c, str) and c.strip() for c in best.parent.children)
            return [best.parent] if loose and len(kept) == sum(1 for c in best.parent.children if not isinstance(c, str)) else kept or parts
        best = best.parent
        parts = [best]
    return parts


def _blocks(parts: list[Node]) -> Iterator[str]:
    """Texts of blocks in page order, white space folded."""
    buffer: list[str] = []

    def flush() -> Iterator[str]:
        text = SPACE.sub(" ", html.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            yield text

    for part in parts:
        stack: list = [part]
        while stack:
            x = stack.pop()
            if x is None:
                yield from flush()
            elif isinstance(x, str):
                buffer.append(x)
            elif not x.noise:
                block = x.tag not in INLINE
                if block:
                    yield from flush()
                    stack.append(None)
                stack.extend(reversed(x.children))
        yield from flush()


def main_text(page: str | None) -> str:
    """Main text of a page, blocks joined by line feeds; empty for NULL, empty and text-free pages."""
    if not page:
        return ""
    root = parse(page)
    _restore(root)
    _rescue(root)
    _measure(root)
    if not root.length:
        return ""
    return "\n".join(_blocks(_widen(_score(root))))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``; a NULL or empty page gives empty text.

    Rows stand alone: repeats, NULL ids and empty tables need no care. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(_run, "page_id long, url string, text string, n_chars long")
