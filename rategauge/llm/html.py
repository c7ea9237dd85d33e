"""Main text of web pages by composite text density.

A page is parsed into a tree by one tolerant walk over its tags. Parts that are no article by their
kind (menus, headers, footers, sidebars, forms, scripts, styles) or by name (adverts, notices,
comments) are left out; but a form or a part of such a name that holds the article, or most of the
page's unlinked text where no article stands beside it, is a wrapper and stays, unless it is named as
comments. Every node then has its characters, tags, and those inside links; its
composite density is characters per tag, weighed down by the share of linked text; the density of a
body without links is the smoothing. A node's sum is that of its children's densities. From the node
of the greatest sum up to the body the least density is the threshold; that node and every largest
subtree off its path that reaches the threshold are text. Each is widened to the article or main
around it, and other articles count as well; where the best node is in an article they are joined in
page order, else the common ancestor of those outside articles is taken, without lists of links.

A page is handled by itself, in linear time: no shuffle, whatever the number of pages of a host.

Defined results: a null or empty page, and one without text, gives an empty text; tags left open or
closed out of order end with their parent; rows that repeat are extracted each; an empty table gives
an empty result; columns other than id, url and html play no part.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rategauge.llm.arrays import pieces

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|aria-label|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
#: Blocks that are left out beside the text when most of theirs is inside links.
_LISTS = frozenset("address center details dir div dl fieldset figure ol section summary table tbody td tr ul".split())
#: Parts of a page that are no article, by the kind of tag.
_DROPPED = frozenset(
    "nav aside footer form script style noscript iframe template svg canvas button select option textarea "
    "input label object audio video dialog menu head title".split()
)
#: ... of which these are its words inside an article; a form around them leaves them out.
_INLINE = frozenset("label button".split())
#: ... and by a whole token of their class, id or role: a word of these, alone or with words of place and form.
_NAMED = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|gdpr|popup|modal|nav|navbar|navigation|"
    r"menus?|breadcrumbs?|sidebar|sidebars|side|aside|widgets?|footer|header|masthead|topbar|comments?|commentlist|"
    r"respond|disqus|replies|reply|related|share|sharing|social|newsletter|subscribe|signup|login|search|pagination|"
    r"pager|skip|complementary|contentinfo|alert|toolbar"
)
_OF_PLACE = frozenset(
    "site page main top bottom left right global primary secondary sticky mobile desktop post article entry user".split()
)
_OF_FORM = frozenset(
    "bar box list container wrapper wrap inner area block section item items link links button buttons form slot unit "
    "top bottom left right main primary secondary".split()
)
#: Other people's text may be longer than the article, and be marked up as articles.
_REPLIES = re.compile(r"comments?|commentlist|respond|disqus|replies|reply")
_KEPT, _SOFT, _GONE = range(3)
_CLOSES = {
    "p": _BLOCK - {"body", "html"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
}


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "sum", "gone", "drop")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0
        self.gone = False
        self.drop = _KEPT


def _named(token: str, inside_article: bool) -> int:
    """Whether a token names a part that is no article, and whether it may still hold one."""
    parts = [p.rstrip("0123456789") for p in re.split("[_-]+", token.lower())]
    parts = [p for p in parts if p]
    named = [k for k, p in enumerate(parts) if _NAMED.fullmatch(p)]
    if not named or any(p not in _OF_PLACE for p in parts[: named[0]]):
        return _KEPT
    if any(k not in named and p not in _OF_FORM for k, p in enumerate(parts) if k > named[0]):
        return _KEPT
    words = {parts[k] for k in named}
    if words == {"header"} and (inside_article or not {"post", "article", "entry"}.isdisjoint(parts)):
        return _KEPT  # an article's own heading
    return _GONE if any(map(_REPLIES.fullmatch, words)) else _SOFT


def _drop(tag: str, attributes: str, inside_article: bool) -> int:
    if tag == "header" and not inside_article or tag in _DROPPED and tag != "form" and not (inside_article and tag in _INLINE):
        return _GONE
    drop = _SOFT if tag == "form" else _KEPT
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return _GONE
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main"):
            drop = max([drop, *(_named(token, inside_article) for token in value.split())])
    return drop


def _leave_out(nodes: list[Node]) -> None:
    """Mark what is left out: not a named part or form that holds the article or most of the unlinked text."""
    soft: set[Node] = set()
    linked: set[Node] = set()
    for node in nodes:
        up = node.parent
        node.gone = node.drop == _GONE or up is not None and up.gone
        if node.drop == _SOFT or up in soft:
            soft.add(node)
        if node.tag == "a" or up in linked:
            linked.add(node)
    if not soft:
        return
    plain: dict[Node, int] = {}
    own: dict[Node, int] = {}
    mains: dict[Node, int] = {}
    articles: dict[Node, int] = {}
    for node in reversed(nodes):
        if node.gone:
            continue
        text = 0 if node in linked else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        own[node] = own.get(node, 0) + text
        plain[node] = plain.get(node, 0) + text
        up = node.parent
        if up is not None:
            plain[up] = plain.get(up, 0) + plain[node]
            if node.tag not in _BLOCK:
                own[up] = own.get(up, 0) + own[node]
            mains[up] = mains.get(up, 0) + mains.get(node, 0) + (node.tag == "main")
            articles[up] = articles.get(up, 0) + articles.get(node, 0) + (node.tag == "article")
    within: dict[Node, Node] = {}  # the nearest article around a node, else the body
    outside = any(n.tag in ("article", "main") and not n.gone and n not in soft and plain[n] for n in nodes)
    for node in nodes:
        up = node.parent
        within[node] = node if up is None or node.tag in ("article", "main") else within[up]
        if node.gone or up is not None and up.gone:
            node.gone = True
        elif node.drop == _SOFT:
            text = plain[node] - (own[node] if node.tag == "form" else 0)  # labels are no article
            holds = mains.get(node, 0) or articles.get(node, 0) and not outside
            # beside an article of the page, size makes no article; inside one, the article's text is what counts
            beside = outside and within[node] is nodes[0]
            node.gone = not holds and (beside or 2 * text <= plain[within[node]])


def parse(page: str) -> tuple[Node, list[Node]]:
    """The root and all nodes in page order. Text outside any tag is under the root."""
    root = Node("body", None)
    nodes, here, at, articles = [root], root, 0, 0
    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if m[1]:
            up: Node | None = here
            while up is not None and up.tag != tag:
                # a block's end tag closes what is open inside it; an inline one stays within its block
                up = None if tag not in _BLOCK and up.tag in _BLOCK else up.parent
            if up is not None and up.parent is not None:
                node = here
                while node is not up.parent:
                    articles -= node.tag in ("article", "main")
                    node = node.parent
                here = up.parent
            continue
        node = here
        while node.parent is not None and node.tag not in _BLOCK:
            node = node.parent
        if tag in _CLOSES.get(node.tag, ()):
            here = node.parent
        child = Node(tag, here)
        child.drop = _drop(tag, m[3], articles > 0)
        here.children.append(child)
        nodes.append(child)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if tag not in ("script", "style"):
                child.children.append(page[at : end.start() if end else n])
            at = end.end() if end else n
        elif tag not in _VOID and not m[3].endswith("/"):
            here = child
            articles += tag in ("article", "main")
    _leave_out(nodes)
    return root, nodes


def _measure(nodes: list[Node]) -> None:
    for node in nodes:
        node.chars = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if not node.gone else 0
    for node in reversed(nodes):
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        up = node.parent
        if up is not None and not node.gone:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
    body = nodes[0]
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        if node.chars == 0 or node.gone:
            continue
        plain = max(node.chars - node.link_chars, 1)
        linked, tags, links = max(node.link_chars, 1), max(node.tags, 1), max(node.link_tags, 1)
        base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
        node.density = node.chars / tags * math.log(max(node.chars / linked * tags / links, 1.0) + 1e-9, max(base, 1.0001))
    for node in nodes[1:]:
        node.parent.sum += node.density


def _linked(node: Node) -> bool:
    """Whether most of the text is inside links."""
    return 2 * node.link_chars > node.chars


def _main(nodes: list[Node]) -> tuple[list[Node], set[Node]]:
    """The subtrees that are the text, in page order, and the lists of links inside them that are not."""
    body = nodes[0]
    unlinked = [n for n in nodes if n.chars and not n.gone and not _linked(n)]
    best = max(unlinked or nodes, key=lambda n: n.sum)
    least, node, path = best.density, best, set()
    while node is not None:
        least = min(least, node.density)
        path.add(node)
        node = node.parent
    depth: dict[Node, int] = {}
    whole: dict[Node, Node | None] = {}  # the outermost article around a node
    inside: set[Node] = set()
    chosen: list[Node] = []
    for node in nodes:
        up = node.parent
        depth[node] = depth[up] + 1 if up is not None else 0
        outer = whole[up] if up is not None else None
        whole[node] = outer or (node if node.tag in ("article", "main") and not node.gone else None)
        if up in inside:
            inside.add(node)
        elif node is best or node not in path and not node.gone and node.chars and node.density >= least and not _linked(node):
            chosen.append(node)
            inside.add(node)
    in_article = whole[best] is not None
    tops = {n for n in nodes if whole[n] is n and n.chars and not _linked(n)}
    tops |= {whole[n] for n in chosen if whole[n] is not None}
    loose = [n for n in chosen if whole[n] is None]
    links: set[Node] = set()
    if not in_article:
        # all text of their common ancestor, short lines between them too, but no list of links beside them
        holding = dict.fromkeys(loose, 1)
        for node in reversed(nodes[1:]):
            if node in holding:
                holding[node.parent] = holding.get(node.parent, 0) + holding[node]
        top = max((n for n in nodes if holding.get(n) == len(loose)), key=lambda n: depth[n], default=body)
        if top.tag in ("p", "span", "b", "i", "em", "strong", "a", "li", "font", "br", "h1", "h2", "h3", "blockquote"):
            while top.parent is not None and top.tag not in ("article", "main", "section", "div", "td", "body"):
                top = top.parent
        keep = set(loose)
        seen = {top} - keep
        for node in nodes:
            if node.parent in seen and node not in keep and not node.gone:
                if node not in holding and node.tag in _LISTS and _linked(node):
                    links.add(node)
                else:
                    seen.add(node)
        loose = [top]
    roots, covered = [], set()
    wanted = tops | set(loose)
    for node in nodes:
        if node.parent in covered:
            covered.add(node)
        elif node in wanted:
            roots.append(node)
            covered.add(node)
    return roots or [body], links


def _blocks(node: Node, left_out: set[Node]) -> Iterator[str]:
    run: list[str] = []
    stack: list[Node | str | None] = [node]
    while stack:
        item = stack.pop()
        if item is None:
            yield "".join(run)
            run.clear()
        elif isinstance(item, str):
            run.append(item)
        elif item.gone and item is not node or item in left_out:
            continue
        elif item.tag == "br":
            run.append(" ")
        else:
            block = item.tag in _BLOCK
            if block:
                stack.append(None)
            stack.extend(reversed(item.children))
            if block:
                stack.append(None)
    yield "".join(run)


def main_text(page: str) -> str:
    """Blocks of the main text, one to a line."""
    if not page:
        return ""
    _, nodes = parse(page)
    _measure(nodes)
    roots, links = _main(nodes)
    lines = (" ".join(_html.unescape(b).split()) for root in roots for b in _blocks(root, links))
    return "\n".join(line for line in lines if line)


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(h or "") for h in batch.column("html").to_pylist()]
            yield pa.record_batch(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    source = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    out = source.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnRenamed("id", id).withColumnRenamed("url", url)
