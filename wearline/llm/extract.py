"""Main text of web pages by tree scoring."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F

#: Elements whose content is never article text.
DROPPED = frozenset((
    "script", "style", "noscript", "template", "svg", "math", "canvas", "iframe", "object", "nav", "footer",
    "aside", "form", "button", "select", "textarea", "input", "dialog", "menu", "head", "title"))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
    "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul", "dialog", "menu"))
PARAGRAPHS = frozenset(("p", "pre", "td", "blockquote", "li", "dd"))
#: An opening tag ends an open one of these kinds in the same block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar"))
#: Words of a class or id that mark what is not article text.
BOILERPLATE = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent\w*|gdpr|notice\w*|popup\w*|modal\w*"
    r"|overlay|newsletter\w*|subscri\w*|signup|share|sharing|social\w*|related\w*|recommend\w*|sidebar\w*|side|widget\w*"
    r"|menu\w*|nav|navbar\w*|navigation|breadcrumb\w*|pagination|pager|footer\w*|masthead\w*|comment\w*|disqus\w*"
    r"|respon(?:d|ses)|repl(?:y|ies)|discussion|login|toolbar\w*|skip\w*|hidden|print)(?![a-z])")
KEPT_NAMES = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|body|post|entry|story)(?![a-z])")
SPACES = re.compile(r"\s+")
#: A tag that the end of the page cuts off.
CUT_TAG = re.compile(r"<[/!a-zA-Z][^<>]*\Z")
SIBLING_SHARE = 0.2
BY_NAME = "name"


class Node:
    __slots__ = ("tag", "parent", "children", "drop", "score", "chars", "linked", "named", "article", "block", "open_p")

    def __init__(self, tag, parent, drop=False, named=False):
        self.tag, self.parent, self.drop, self.named = tag, parent, drop, named
        self.children: list = []
        self.score = 0.0
        self.chars = self.linked = 0
        is_block = tag in BLOCKS
        self.article = tag in ("article", "main") or parent is not None and parent.article
        self.block = self if is_block or parent is None else parent.block
        self.open_p = self if tag == "p" else None if is_block or parent is None else parent.open_p


def _layout(value: str) -> bool:
    """Whether one of the names is that of content and none of boilerplate, as in "content no-sidebar"."""
    return any(KEPT_NAMES.search(name) and not BOILERPLATE.search(name) for name in value.split())


def _unwanted(tag: str, attrs: list, inside_article: bool) -> bool | str:
    """Whether an element is dropped; BY_NAME if only its class or id says so."""
    if tag in DROPPED or tag == "header" and not inside_article:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    by_name, layout = False, False
    for name, value in attrs:
        if name in ("class", "id") and value:
            said = value.lower().replace("_", "-")
            if BOILERPLATE.search(said) and not (tag == "header" and inside_article):
                by_name = BY_NAME
            layout = layout or not inside_article and _layout(said)
        elif name == "role" and value and value.lower() in ROLES:
            return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return True
    return False if layout else by_name


class Tree(HTMLParser):
    """A small element tree; missing and crossed end tags are mended by block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.articles: list[Node] = []

    def _open(self, tags) -> Node | None:
        """The nearest open element of these tags below the nearest enclosing container."""
        node = self.at.block
        while node.parent is not None:
            if node.tag in tags:
                return node
            if node.tag not in PARAGRAPHS:
                return None
            node = node.parent.block
        return None

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag in ("br", "hr"):
                self.at.children.append(" ")
            return
        if tag in ("html", "body"):
            return
        if tag in BLOCKS and self.at.open_p is not None:
            self.at = self.at.open_p.parent
        if tag in CLOSES and (old := self._open(CLOSES[tag])) is not None:
            self.at = old.parent
        named = any(k in ("class", "id", "itemprop") and v and KEPT_NAMES.search(v.lower()) for k, v in attrs)
        node = Node(tag, self.at, _unwanted(tag, attrs, self.at.article), named or tag in ("article", "main"))
        self.at.children.append(node)
        if tag in ("article", "main") and not node.parent.article and not any(
                k in ("class", "id") and v and BOILERPLATE.search(v.lower().replace("_", "-")) for k, v in attrs):
            self.articles.append(node)
        self.at = node

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            if tag not in BLOCKS and node.tag in BLOCKS:
                return
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _parse(page: str) -> Node:
    tree = Tree()
    tree.feed(CUT_TAG.sub("", page))
    tree.close()
    # A wrapper that only its name drops stays if it holds the main element or the only articles.
    above = []
    for node in tree.articles:
        dropped, up = [], node.parent
        while up is not None:
            if up.drop:
                dropped.append(up)
            up = up.parent
        above.append((node, dropped))
    none_left = all(dropped for _, dropped in above)
    for node, dropped in above:
        if (none_left or node.tag == "main") and all(d.drop == BY_NAME for d in dropped):
            for d in dropped:
                d.drop = False
    return tree.root


def _measure(root: Node) -> None:
    """Characters and linked characters of each element, and points passed to its ancestors."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.drop]
    commas: dict[int, int] = {}
    for node in reversed(order):
        n_commas = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(c)
                n_commas += c.count(",")
            elif not c.drop:
                node.chars += c.chars
                node.linked += c.linked
                n_commas += commas.get(id(c), 0)
        if node.tag == "a":
            node.linked = node.chars
        commas[id(node)] = n_commas
    for node in order:
        if node.tag in PARAGRAPHS and node.chars >= 25:
            points = 1 + commas[id(node)] + min(node.chars // 100, 3)
            ancestor, share = node.parent, 1.0
            for _ in range(3):
                if ancestor is None:
                    break
                ancestor.score += points * share
                ancestor, share = ancestor.parent, share / 2
    for node in order:
        if node.named:
            node.score += 25
        if node.chars:
            node.score *= 1 - node.linked / node.chars


def _best(root: Node) -> Node:
    best, stack = root, [root]
    while stack:
        node = stack.pop()
        if node.tag in BLOCKS and node.tag not in ("p",) and node.chars and node.score > best.score:
            best = node
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.drop]
    # An article that holds the best container is the better one.
    node = best
    while node is not None:
        if node.tag in ("article", "main") and node.score > 0:
            return node
        node = node.parent
    return best


def _kept(best: Node) -> list[Node]:
    if best.parent is None or best.tag in ("article", "main"):
        peers = [c for c in best.parent.children if isinstance(c, Node) and not c.drop and c.tag == best.tag] \
            if best.parent is not None and best.tag == "article" else [best]
        return [c for c in peers if c is best or c.score >= SIBLING_SHARE * best.score]
    bar = max(10.0, SIBLING_SHARE * best.score)
    out = []
    for c in best.parent.children:
        if c is best:
            out.append(c)
        elif isinstance(c, Node) and not c.drop and c.chars:
            density = c.linked / c.chars
            if c.score >= bar or c.tag in ("h1", "h2", "h3") or \
                    c.tag in ("p", "blockquote", "pre") and density < (0.25 if c.chars > 80 else 0.01):
                out.append(c)
    return out


def _blocks(nodes: list[Node]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def close():
        text = SPACES.sub(" ", "".join(run)).strip()
        run.clear()
        if text:
            out.append(text)

    for top in nodes:
        stack = [iter([top])]
        open_: list[Node] = []
        while stack:
            child = next(stack[-1], None)
            if child is None:
                stack.pop()
                if open_ and open_.pop().tag in BLOCKS:
                    close()
            elif isinstance(child, Node):
                if not child.drop:
                    if child.tag in BLOCKS:
                        close()
                    open_.append(child)
                    stack.append(iter(child.children))
            else:
                run.append(child)
        close()
    return out


def main_text(page: str | None) -> str:
    """The article of one page: blocks joined by an empty line; "" if there is none.

    A null or empty page has no text. White space inside a block becomes one space, and character
    references are decoded once.
    """
    if not page or not page.strip():
        return ""
    root = _parse(page)
    _measure(root)
    return "\n\n".join(_blocks(_kept(_best(root))))


def text_column(page):
    """main_text of a column of pages."""
    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return run(page)
