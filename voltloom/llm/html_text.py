"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph with text earns points for its length and its commas and passes them to its
ancestors, the whole to the parent, half to the grandparent, less further up. A container's points are discounted by
the share of its text that lies in links. The best container is kept with those siblings that score or read like it;
menus, headers, footers, sidebars, notices, adverts, forms and comments below it go.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: elements without end tag, elements whose content is no markup, elements that are blocks,
#: and start tags that close an open element (with the elements beyond which they don't look).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
SCOPE = {"table", "td", "th", "button", "object", "html"}

#: Elements that never hold main text, and names in class, id or role that mark what surrounds it.
DROPPED = RAW | set("nav footer aside button select svg canvas object audio video dialog menu head input datalist".split())
#: Words of names in class or id that mark what surrounds the main text: always, as reader comments, and where the element doesn't read
#: like text itself. A name counts only if all its words are such words or say what kind of container it is; so "related-posts" does,
#: "related-work" and "has-sidebar" don't.
MARKS = set(
    "ad ads adv advert adverts advertisement advertisements advertising adsbygoogle banner breadcrumb breadcrumbs consent cookie "
    "cookies footer footnav gdpr masthead menu menubar menus modal nav navbar navigation navs newsletter "
    "notice notices notification notifications outbrain pagination paywall popup promo promos promotion promotions shoutbox "
    "sidebar skyscraper sponsor sponsored sponsors taboola toolbar tooltip".split()
)
COMMENTS = set("comment commentlist comments discuss disqus replies reply respond response responses shoutbox".split())
UNSURE = set("byline header legal pager related search share sharing signup social subscribe widget widgets".split())
KINDS = set(
    "area bar block blocks body bottom box button buttons card cards container content control controls entry feed footer form group header icon icons inner item items left "
    "link links list main meta outer page panel post posts primary articles stories right row secondary section site slot story thread top unit wrap wrapper".split()
)
ADVERTS = set("advert adverts advertisement advertising promo promotion sponsor sponsored sponsors".split())
ROLES = set("alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar tooltip".split())
#: Characters outside links, and share of text in links, from which an element with an unsure name reads like text.
READS, LINKED = 160, 0.3
TEXTUAL = {"h1", "h2", "h3", "h4", "h5", "h6", "p"}
PARAGRAPHS = {"p", "pre", "blockquote", "td", "li", "dd", "h1", "h2", "h3", "div", "section", "article", "main", "body", "center"}
#: Points that a container starts with.
PRIOR = {"article": 15.0, "main": 10.0, "div": 2.0, "section": 2.0, "blockquote": 1.0, "form": -5.0, "ul": -3.0, "ol": -3.0, "td": 1.0, "th": -5.0}

_TOKEN = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTES = re.compile(r"""\s*/?\s*([^\s=>/"']+|["'])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element with its children: text or nodes, in page order."""

    __slots__ = ("children", "dead", "low", "parent", "score", "tag")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children, self.dead, self.low, self.score = tag, parent, [], 0, False, 0.0


def _named(said: str, marks: set[str]) -> bool:
    """Whether a name says what ``marks`` say: one of its words does, and its other words only name kinds of containers."""
    for name in said.split():
        words = {x.lower() for x in _NAMES.findall(name)}
        if words & marks and words <= marks | MARKS | COMMENTS | UNSURE | KINDS:
            return True
    return False


def _marked(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """Whether an element and all below it is no main text: 0, 1 for its kind, 2 by its names, 3 by names of comments, 4 by unsure
    names; inside: below an article or main element, where ids, as those of all sections, are of the text's parts. Forms count as
    named, as one may hold a page."""
    if tag in DROPPED or (tag == "header" and not inside) or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return 1
    if tag in ("body", "html"):
        return 0
    if "display:none" in attributes.get("style", "").replace(" ", "") and tag not in ("article", "main"):
        return 1
    if tag in TEXTUAL:
        return 0
    names, own = attributes.get("class", ""), attributes.get("id", "")
    if _named(f"{names} {'' if inside else own}", COMMENTS):
        return 3
    if tag in ("article", "main"):
        return 2 * _named(names, ADVERTS)
    if not inside and tag != "section":
        names += " " + own
    if tag == "form" or attributes.get("role", "").strip().lower() in ROLES or _named(names, MARKS):
        return 2
    return 4 * _named(names, UNSURE - {"header", "byline"} if inside else UNSURE)


def _revive(order: list[Node]) -> None:
    """Keep elements with unsure names that hold text of some length, little of it in links; their score is lowered. order: parents
    before their children."""
    if not any(x.dead == 4 for x in order):
        return
    link: dict[Node, bool] = {}
    plain: dict[Node, int] = {}
    linked: dict[Node, int] = {}
    for x in order:
        link[x] = x.tag == "a" or (x.parent is not None and link.get(x.parent, False))
        n = sum(len(" ".join(c.split())) for c in x.children if isinstance(c, str))
        plain[x], linked[x] = (0, n) if link[x] else (n, 0)
    for x in reversed(order):
        if x.parent in plain and x.dead not in (2, 3):
            plain[x.parent] += plain[x]
            linked[x.parent] += linked[x]
        if x.dead == 4 and plain[x] >= READS and linked[x] < LINKED * (plain[x] + linked[x]):
            x.dead, x.low = 0, True


def _restore(root: Node, named: bool) -> None:
    """Keep elements with unsure names that read like text, with a lowered score, and keep what names drop if it is the main container: it holds most of the page's paragraph points, and the page's heading,
    article or main element, or all points, or, unless its names are of comments, three quarters. Without ``named``, names
    drop nothing."""
    order, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.dead > 1 and not named:
            x.dead = 0
        if x.dead != 1:
            order.append(x)
            todo.extend(c for c in x.children if isinstance(c, Node))
    _revive(order)
    if not any(x.dead for x in order):
        return
    points: dict[Node, float] = {}
    holds: set[Node] = set()
    for x in reversed(order):
        if x.tag in PARAGRAPHS:
            text, linked = _own_text(x)
            if text:
                points[x] = points.get(x, 0.0) + _points(text, linked)
        if x.parent:
            points[x.parent] = points.get(x.parent, 0.0) + points.get(x, 0.0)
            if x in holds or x.tag in ("h1", "main") or (x.tag == "article" and not x.dead):
                holds.add(x.parent)
    total = points.get(root, 0.0)
    for x in order:
        mine = points.get(x, 0.0)
        if x.dead and mine > total / 2 and (x in holds or mine > total - 1e-6 or (x.dead == 2 and mine > 0.75 * total)):
            x.dead = 0


def _points(text: str, linked: int) -> float:
    """What a paragraph earns for its length and its commas, less the share of it that lies in links."""
    return (1 + text.count(",") + text.count("，") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))


class _Open:
    """The open elements while a page is read, with the places of each tag, so that looking for one takes no walk."""

    def __init__(self, root: Node):
        self.nodes, self.places, self.blocks = [root], {}, []

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, k: int) -> None:
        """Close the element at place ``k`` and all within it."""
        for x in self.nodes[k:]:
            self.places[x.tag].pop()
            if x.tag in BLOCKS:
                self.blocks.pop()
        del self.nodes[k:]

    def nearest(self, tags) -> int:
        """The place of the innermost open element with one of the tags; 0 if there is none."""
        return max((found[-1] for t in tags if (found := self.places.get(t))), default=0)

    def imply(self, closed: set[str], beyond: set[str]) -> None:
        """Close the innermost element of ``closed``, unless one of ``beyond`` is nearer."""
        k = self.nearest(closed)
        if k and k > self.nearest(beyond):
            self.cut(k)

    def end(self, tag: str) -> None:
        """An end tag; that of an inline element closes no blocks."""
        k = self.nearest((tag,))
        if k and (tag in BLOCKS or not self.blocks or self.blocks[-1] <= k):
            self.cut(k)


def parse(page: str) -> Node:
    """The tree of a page; broken markup is closed the way browsers close it, a tag cut off at the end is dropped."""
    root = Node("html", None)
    open_ = _Open(root)
    stack = open_.nodes
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        close, tag = m[1], (m[2] or "").lower()
        if not tag:
            shut = page.find("-->", m.end() - 2) if m[0] == "<!--" else page.find(">", m.end() - 1)
            at = end if shut < 0 else shut + (3 if m[0] == "<!--" else 1)
            continue
        attributes: dict[str, str] = {}
        at = m.end()
        while at < end and page[at] != ">":
            a = _ATTRIBUTES.match(page, at)
            if not a or a.end() == at:
                at += 1
                continue
            attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            at = a.end()
        if at >= end:
            break  # the page ends within the tag
        at += 1
        if close:
            open_.end(tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES_P:
            open_.imply({"p"}, SCOPE)
        if tag in CLOSES:
            open_.imply(*CLOSES[tag])
        node = Node(tag, stack[-1])
        node.dead = _marked(tag, attributes, open_.nearest(("article", "main")) > 0)
        stack[-1].children.append(node)
        if tag in RAW:
            shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            at = page.find(">", shut.start()) + 1 or end if shut else end
        elif tag not in VOID:
            open_.push(node)
    return root


def _texts(node: Node, out: list[str]) -> None:
    """The text below a node; blocks and line breaks are set apart by white space."""
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(entities.unescape(x) if "&" in x else x)
        elif not x.dead:
            apart = x.tag in BLOCKS or x.tag == "br"
            if apart:
                out.append(" ")
                todo.append(" ")
            todo.extend(reversed(x.children))


def text_of(nodes: list[Node]) -> str:
    out: list[str] = []
    for n in nodes:
        _texts(n, out)
        out.append(" ")
    return " ".join("".join(out).split())


def _own_text(node: Node) -> tuple[str, int]:
    """A paragraph's text without that of blocks within it, and the characters of it that lie in links."""
    out, linked, todo = [], 0, [(c, False) for c in reversed(node.children)]
    while todo:
        x, link = todo.pop()
        if isinstance(x, str):
            t = " ".join((entities.unescape(x) if "&" in x else x).split())
            out.append(t)
            linked += len(t) * link
        elif not x.dead and x.tag not in BLOCKS:
            todo.extend((c, link or x.tag == "a") for c in reversed(x.children))
    return " ".join(t for t in out if t), linked


def main_text(page: str | None) -> str:
    """The main text of one page; empty for a null or empty page or one without text."""
    if not page:
        return ""
    # where names leave nothing, they mislead
    return _scored(parse(page), True) or _scored(parse(page), False)


def _scored(root: Node, named: bool) -> str:
    _restore(root, named)
    length: dict[Node, int] = {}
    links: dict[Node, int] = {}
    order: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        if x.dead:
            continue
        order.append(x)
        todo.extend(c for c in x.children if isinstance(c, Node))
    scored: set[Node] = set()
    for x in order:
        if x.tag not in PARAGRAPHS and x.tag not in BLOCKS:
            continue
        text, linked = _own_text(x)
        if not text:
            continue
        length[x], links[x] = len(text), linked
        if x.tag not in PARAGRAPHS:
            continue
        points, depth = _points(text, linked), 0
        up = x if x.tag in ("div", "section", "article", "main", "body", "center", "td") else x.parent
        while up and depth < 5:
            if up not in scored:
                scored.add(up)
                up.score = PRIOR.get(up.tag, 0.0)
            up.score += points / (1, 2, 6, 9, 12)[depth]
            up, depth = up.parent, depth + 1
    if not scored:
        return text_of([root])
    for x in reversed(order):  # parents come before their children
        if x.parent and x in length:
            length[x.parent] = length.get(x.parent, 0) + length[x]
            links[x.parent] = links.get(x.parent, 0) + links[x]
    value = {x: x.score * (1 - links.get(x, 0) / max(1, length.get(x, 0))) * (0.25 if x.low else 1) if x.score > 0 else x.score for x in scored}
    best = max((x for x in order if x in value), key=lambda x: value[x])
    top, up = value[best], best.parent
    while up:  # an article or main element around the best container is the container
        if up.tag in ("article", "main") and up in value:
            best = up
        up = up.parent
    if best.parent is None:
        return text_of([best])
    kept = []
    for x in best.parent.children:
        if isinstance(x, str) or x.dead or (x.low and x is not best):
            continue
        density = links.get(x, 0) / max(1, length.get(x, 0))
        if x is best or (value.get(x, -1.0) >= max(10.0, 0.2 * top) and density < 0.5) or (x.tag == "p" and length.get(x, 0) > 80 and density < 0.25 and best.tag not in ("article", "main")):
            kept.append(x)
    return text_of(kept)


def extract(pages: DataFrame, html: str = "html", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """The main text of every page from its whole html.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order by
    one space. A null or empty page gives an empty text; ids and urls pass through, null or repeated; a page of any length
    or nesting is read whole, in time in proportion to its length; ties between containers go to the first in page order;
    an empty table gives an empty result; other columns are ignored. Map-only.

    Returns: ``page_id``, ``url``, ``text``, ``n_chars`` (code points).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [main_text(x if isinstance(x, str) else None) for x in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
