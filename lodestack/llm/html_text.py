"""HTML extraction by tree scoring.

A page becomes a light tree. Parts that are never article text (scripts, menus,
forms, page headers and footers, and blocks whose class, id or role says
sidebar, notice, advert or comments) are cut. Every paragraph then passes points
for its length and commas to its parent, half of them to its grandparent and
less further up; a container's points are discounted by its link density. The
best container is kept with all of the declared article around it that is not
cut, and so are the page's other articles that are no teasers (short texts whose
heading is a link). Inside a declared article names say less: headings, paragraphs
and ids never count, a class or role counts only if all its parts are names of
page furniture, and then a container goes if it is for adverts, comments or
notices to subscribe, or else if it holds forms or mostly links. Without an article, all of ``main`` or else of its parent stays if links are few in
the rest; otherwise lists of links go and blocks of prose beside it stay. A header
inside an article is the article's own and stays; a page header goes.

Spark maps pages to rows in Arrow batches; a page needs only itself, so there is
no shuffle, and a task's memory is one batch. Defined cases: a null or empty
page gives an empty text; markup cut off in the middle is closed at the end of
the page; a page without any paragraph gives the text that is left of its body;
of equally good containers the last one in the page is best; rows that repeat a
page repeat its text; extra columns pass through, but one that is called
``main_text`` is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
CUT = frozenset(
    "script style noscript template head title nav footer header aside form button select option textarea iframe svg canvas "
    "object embed dialog menu noembed noframes xmp audio video map datalist".split()
)
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr".split()
)
#: What an opening tag closes when it is open, up to the nearest scope.
CLOSES = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
SCOPE = frozenset("ul ol dl table div section article main body html td th blockquote".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
#: Parts of class, id and role names that mark what is no article text.
OTHER = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav aside widget footer header masthead topbar banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup promo promotion sponsor "
    "sponsored advert adverts advertisement advertising ad ads adsense adbox comment comments commentlist disqus reply replies respond "
    "discussion social share sharing related recommended recommendations pagination pager login search searchbox form toolbar "
    "complementary contentinfo skip print hidden paywall".split()
)
#: Inside an article these mark a container on their own; the other names need links or forms in it.
FURNITURE = frozenset(
    "sidebar sidenav cookie cookies consent gdpr newsletter subscribe subscription signup promo promotion sponsor sponsored advert adverts "
    "advertisement advertising ad ads adsense adbox comment comments commentlist disqus reply replies respond".split()
)
#: What stands beside such names in the name of a piece of furniture.
LAYOUT = frozenset(
    "area bar block bottom box btn button buttons container content count entry extra group heading icons inline inner item items left level line "
    "link links list main mid outer page panel post posts right row section side single slot sticky text thread title top unit wrap wrapper".split()
)
CONTAINERS = frozenset("div section ul ol dl table details figure article fieldset".split())
#: Ids that no section of an article has.
COMMENT_IDS = frozenset(("comments", "disqus_thread"))
CONTROLS = frozenset("form input button select textarea label".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Text of a teaser, at most.
TEASER = 400
#: Blocks of prose: what holds one and few links stays beside the best container.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
KEPT_WHOLE = frozenset(("html", "body", "article", "main"))
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?(?:[A-Za-z][^<]*)?\Z", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
NAME_PART = re.compile(r"[a-z]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


class Node:
    __slots__ = ("tag", "up", "inside", "cut", "size", "linked", "commas", "points", "marked", "holds", "article", "sure", "controls")

    def __init__(self, tag: str, up: "Node | None"):
        self.tag, self.up, self.inside, self.cut, self.marked = tag, up, [], False, False
        self.size = self.linked = self.commas = 0
        self.holds = self.sure = self.controls = False
        self.points = 0.0
        self.article = tag == "article" or (up is not None and up.article)


def _marked(attributes: str, article: bool) -> tuple[bool, bool]:
    """Whether names say that the part is no article text, and whether it is hidden; an article may have a header."""
    other = OTHER - {"header"} if article else OTHER
    named = hidden = False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id", "role"):
            for name in value.split():
                parts = NAME_PART.findall(name)
                # has-sidebar, with-comments and no-ads describe a layout, not the part itself
                named |= bool(parts) and parts[0] not in ("has", "with", "no", "without", "js") and not other.isdisjoint(parts)
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            hidden = True
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "")
    return named, hidden


def _furniture(tag: str, attributes: str) -> int:
    """Inside an article: 2 if names mark a container whatever it holds, 1 if they do with links or forms in it, else 0."""
    if tag not in CONTAINERS:
        return 0
    found = 0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "id":
            found = max(found, 2 * (value in COMMENT_IDS))
        elif key in ("class", "role"):
            for name in value.split():
                parts = {x for x in NAME_PART.findall(name) if len(x) > 1}
                if parts & OTHER and parts <= OTHER | LAYOUT:
                    found = max(found, 2 if parts & FURNITURE else 1)
    return found


def tree(page: str) -> Node:
    root = node = Node("#page", None)
    at, raw = 0, None
    for m in TAG.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            node.inside.append(page[at : m.start()])
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            continue
        if m[1]:
            up = node
            while up is not None and up.tag != tag:
                up = None if up.tag in ("td", "th") and tag in ("p", "div", "li") else up.up
            if up is not None and up.up is not None:
                node = up.up
            elif tag == "p":
                node.inside.append(" ")
            continue
        if tag == "br" or tag == "hr":
            node.inside.append(" ")
        if tag in VOID:
            continue
        closes = CLOSES.get(tag) or ({"p"} if tag not in INLINE else ())
        up = node
        while closes and up.up is not None:
            if up.tag in closes:
                node = up.up
                if tag not in CLOSES:
                    break
            elif up.tag in SCOPE and not (tag in ("tr", "td", "th") and up.tag in ("td", "th")):
                break
            up = up.up
        child = Node(tag, node)
        node.inside.append(child)
        if m[3]:
            named, hidden = _marked(m[3], child.article)
            if child.article:
                found = _furniture(tag, m[3])
                # An article in or beside another may be a reader's.
                child.marked = named = found > (1 if tag == "article" else 0)
                child.sure = found == 2
            child.marked, child.cut = named and (tag not in KEPT_WHOLE or child.article), hidden
        child.cut |= tag in CUT and not (tag == "header" and child.article)
        if tag in RAW:
            raw = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = raw.start() if raw else len(page)
            close = page.find(">", at)
            at = close + 1 if raw and close >= 0 else len(page)
        elif not m[3].endswith("/") or tag not in ("svg", "path"):
            node = child
    if at < len(page):
        node.inside.append(page[at:])
    return root


def _walk(root: Node) -> list[Node]:
    """Nodes that are not cut, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(x for x in node.inside if isinstance(x, Node) and not x.cut)
    return out


def _measure(nodes: list[Node]) -> None:
    for node in nodes:
        node.size = node.linked = node.commas = 0
        node.holds = node.tag in ("article", "main", "h1")
        node.controls = any(isinstance(x, Node) and x.tag in CONTROLS for x in node.inside)
    for node in reversed(nodes):
        for x in node.inside:
            if isinstance(x, str):
                node.size += len(x) - (len(x) if x.isspace() else 0)
                node.commas += x.count(",")
        if node.tag == "a":
            node.linked = node.size
        if node.up is not None:
            node.up.size += node.size
            node.up.linked += node.linked
            node.up.commas += node.commas
            node.up.holds |= node.holds
            node.up.controls |= node.controls


def text_of(root: Node) -> str:
    """White space becomes one space; block ends are white space."""
    out: list[str] = []
    stack: list[Node | str] = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif not x.cut:
            block = x.tag not in INLINE
            if block:
                out.append(" ")
                stack.append(" ")
            stack.extend(reversed(x.inside))
    return SPACE.sub(" ", entities.unescape("".join(out))).strip(" \t\n\x0b\x0c\r")


def _density(node: Node) -> float:
    return node.linked / node.size if node.size else 0.0


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = tree(page)
    nodes = _walk(root)
    _measure(nodes)
    for node in nodes:
        # A marked part is a layout, not a sidebar, if it holds most of the prose with an article or title, or nearly all of a page without.
        if node.article:
            node.cut |= node.marked and (node.sure or node.controls or _density(node) > 0.5)
            continue
        most = 2.0 if node.holds else 1.1
        node.cut |= node.marked and (node.holds < root.holds or most * (node.size - node.linked) <= root.size - root.linked)
    nodes = _walk(root)
    _measure(nodes)
    for node in nodes:
        own = sum(len(x) for x in node.inside if isinstance(x, str) and not x.isspace())
        if node.size and (node.tag in PARAGRAPHS or (node.tag not in INLINE and 2 * own > node.size)):
            points = (1 + node.commas + min(node.size / 100, 3.0)) * (1 - _density(node))
            up, share = node.up, 1.0
            for share in (1.0, 0.5, 0.17, 0.12):
                if up is None:
                    break
                up.points += points * share
                up = up.up
    articles = _articles(nodes)
    told = [a for a in articles if not _is_teaser(a)]
    # Declared articles win over equal containers around them; teasers are none beside an article.
    for a in articles:
        a.cut |= bool(told) and a not in told
    nodes = _walk(root)
    best = max(
        (n for n in nodes if n.points), key=lambda n: n.points * (1 - _density(n)) * (1.25 if n.tag in ("article", "main") else 1.0),
        default=None,
    )
    if best is None:
        return text_of(root)
    while best.up is not None and best.tag in PARAGRAPHS | INLINE:
        best = best.up
    keep = [best] if best.tag in KEPT_WHOLE else _around(best)
    if len(told) > 1 and len(keep) == 1 and keep[0].tag == "article":
        keep = told
    return " ".join(t for t in map(text_of, keep) if t)


def _articles(nodes: list[Node]) -> list[Node]:
    """Articles that lie in no other one, in the order of the page; nodes are walked from its end."""
    return [n for n in reversed(nodes) if n.tag == "article" and not (n.up and n.up.article)]


def _is_teaser(article: Node) -> bool:
    """A short text under a heading that is a link, or mostly links."""
    if _density(article) > 0.5:
        return True
    linked = any(n.tag in HEADINGS and n.size and _density(n) > 0.9 for n in _walk(article))
    linked |= any(n.tag == "a" and any(isinstance(x, Node) and x.tag in HEADINGS for x in _walk(n)) for n in _walk(article))
    return linked and article.size <= TEASER


def _around(best: Node) -> list[Node]:
    """The declared article around the best container; else the container that continues it, or siblings that do."""
    above, up = [], best.up
    while up is not None:
        above.append(up)
        up = up.up
    for x in above:
        if x.tag == "article":
            return [x]
    holder = above[0] if above else None
    whole = next((x for x in above if x.tag == "main"), holder)
    if whole is None:
        return [best]
    rest = whole.size - best.size
    if whole.tag not in ("html", "body", "#page") and whole.linked - best.linked < 0.25 * rest:
        return [whole]
    if whole.tag == "main":
        # Lists of links beside the article go; everything else that main declares stays.
        return _text_blocks(whole, best, lambda x: _density(x) < 0.33)
    return _text_blocks(holder, best, _continues)


def _text_blocks(whole: Node, best: Node, stays: Callable[[Node], bool]) -> list[Node]:
    """A copy of ``whole`` with the blocks around the best one that stay; text between blocks stays, lone links go."""
    line = {best}
    while (up := best.up) is not whole:
        line.add(best := up)
    shell = Node("div", None)

    def fill(node: Node, copy: Node) -> None:
        for x in node.inside:
            if isinstance(x, str) or (x.tag in INLINE and _density(x) < 0.5):
                copy.inside.append(x)
            elif x in line and x.inside and any(y in line for y in x.inside if isinstance(y, Node)):
                copy.inside.append(part := Node(x.tag, copy))
                fill(x, part)
            elif not x.cut and (x in line or stays(x)):
                copy.inside.append(x)

    fill(whole, shell)
    return [shell]


def _continues(x: Node) -> bool:
    return x.size > 0 and _density(x) < 0.33 and any(n.tag in BLOCKS and n.size for n in _walk(x))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, plus ``main_text`` string."""
    keep = [c for c in pages.columns if c not in (html_col, "main_text")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in keep] + ["main_text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], names=[*keep, "main_text"])

    return pages.select(*keep, html_col).mapInArrow(run, schema)
