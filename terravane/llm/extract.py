"""Main text of web pages by composite text density."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard, by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template nav header footer aside button select textarea input iframe "
    "svg canvas object audio video menu dialog math title link meta".split()
)
#: Words of a class, id or role that name what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
    "sidebar aside complementary contentinfo comment comments reply replies disqus share sharing social related "
    "recommended newsletter subscribe subscription signup login popup modal overlay widget toolbar pagination "
    "pager search form hidden skip copyright".split()
)
#: Words that may stand beside them in such a name; with any other word it names something else.
BESIDE = frozenset(
    "area bar block body bottom box button container content entry group icons inner item items left links list "
    "main notice notices outer panel post posts right section text top unit wrap wrapper".split()
)
#: Blocks that hold a run of text: the article is an element around such blocks.
RUNS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption summary address tr td th thead tbody".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("body html table ul ol dl article section div blockquote main td th".split())

HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Beside the way to the main node an element is boilerplate if more than this share is links.
MOST_LINKS = 1 / 3

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    """An element: its children are nodes and strings in page order."""

    __slots__ = (
        "anchors", "chars", "children", "density", "doubtful", "dropped", "heads", "link_chars", "link_tags", "mains",
        "name", "tags", "total",
    )

    def __init__(self, name: str, dropped: bool = False, doubtful: bool = False):
        self.name, self.dropped, self.doubtful, self.children = name, dropped, doubtful, []


class Builder(HTMLParser):
    """Tree of a page; unclosed elements end where a block that cannot be inside them begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("body")
        self.open = [self.root]

    def handle_starttag(self, name, attrs):
        if name in ("html", "body"):
            return
        if name not in INLINE and name not in VOID:
            self._end_within("p", SCOPES - {"p"})
        for other in CLOSED_BY.get(name, ()):
            self._end_within(other, frozenset(["ul", "ol", "dl", "table", "select"]))
        node = Node(name, name in DROPPED or _hidden(attrs), name == "form" or _marked(attrs))
        self.open[-1].children.append(node)
        if name not in VOID:
            self.open.append(node)

    def handle_startendtag(self, name, attrs):
        self.handle_starttag(name, attrs)
        if name not in VOID and self.open[-1].name == name and len(self.open) > 1:
            self.open.pop()

    def handle_endtag(self, name):
        if name in VOID or name in ("html", "body"):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name == name:
                del self.open[depth:]
                return
            if name in INLINE and self.open[depth].name not in INLINE:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def _end_within(self, name, scopes):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name == name:
                del self.open[depth:]
                return
            if self.open[depth].name in scopes:
                return


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(
        key == "hidden"
        or key == "aria-hidden" and value == "true"
        or key == "style" and bool(value) and bool(re.search(r"display\s*:\s*none", value))
        for key, value in attrs
    )


def _marked(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a whole class, id or role names what is not the article: ``comment-list`` does,
    ``no-comments`` and ``social-science`` do not."""
    for key, value in attrs:
        if key in ("class", "id", "role"):
            for token in (value or "").split():
                words = {w.lower() for w in _WORD.findall(token)}
                if not words.isdisjoint(MARKS) and words <= MARKS | BESIDE:
                    return True
    return False


def _doubts(nodes: list[Node]) -> None:
    """Drop forms and elements with a mark where that cannot take the article away.

    What holds an unmarked main stays. What holds an unmarked article or h1, or half of the
    page's text, stays too, unless there is an unmarked article or main outside such elements;
    even then an article or h1 with half of the text stays.
    """
    for node in reversed(nodes):
        inner = [c for c in node.children if not isinstance(c, str)]
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars = own + sum(c.chars for c in inner)
        plain = not node.doubtful
        node.mains = any(c.mains for c in inner) or plain and node.name == "main"
        node.heads = any(c.heads for c in inner) or plain and node.name in ("article", "h1")
        # Articles and mains that no doubtful element below the node holds.
        node.anchors = sum(c.anchors for c in inner if not c.doubtful) + (plain and node.name in ("article", "main"))
    outside, half = nodes[0].anchors, nodes[0].chars / 2
    for node in nodes:
        if not node.doubtful:
            continue
        large = node.chars > 0 and node.chars >= half
        if node.mains or node.heads and (large or not outside) or large and not outside:
            outside += node.anchors
        else:
            node.dropped = True


def _order(root: Node) -> list[Node]:
    """Nodes that are not dropped, parents first; no recursion, pages nest as they like."""
    nodes, at = [root], 0
    while at < len(nodes):
        nodes[at].children = [c for c in nodes[at].children if isinstance(c, str) or not c.dropped]
        nodes += [c for c in nodes[at].children if not isinstance(c, str)]
        at += 1
    return nodes


def _measure(nodes: list[Node]) -> None:
    """Characters, tags and their linked parts of each node, then its densities."""
    for node in reversed(nodes):
        inner = [c for c in node.children if not isinstance(c, str)]
        own = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars = own + sum(c.chars for c in inner)
        node.tags = len(inner) + sum(c.tags for c in inner)
        link = node.name == "a"
        node.link_chars = node.chars if link else sum(c.link_chars for c in inner)
        node.link_tags = node.tags + 1 if link else sum(c.link_tags for c in inner)
    body = nodes[0]
    linked = body.link_chars / max(body.chars, 1)
    for node in nodes:
        chars, tags = node.chars, max(node.tags, 1)
        links, link_tags = max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(chars / max(chars - node.link_chars, 1) * node.link_chars + linked * chars + math.e)
        ratio = chars / links * tags / link_tags
        node.density = chars / tags * (math.log(ratio) / math.log(base) if ratio > 1 and base > 1 else 0.0)
        if base <= 1.0 + 1e-12 and ratio > 1:
            node.density = chars / tags * math.log(ratio)
    for node in nodes:
        node.total = sum(
            len("".join(c.split())) if isinstance(c, str) else c.density for c in node.children
        )


def main_text(html: str | None) -> str:
    """Article of a page as blocks, one to a line.

    Elements that are never part of an article go first, and forms and elements whose class, id
    or role names something else where the article is not in them. Of the rest the node whose children's
    composite densities have the largest sum is found, and the outermost article around it, or
    else the outermost main, is kept whole. What stands beside the way from the body to it is
    kept if its density is at least the least one on that way, and headings without links are.
    Without an article or main the node itself is kept whole, and beside the way to it stays, of
    whatever length, what is not mostly links.
    """
    builder = Builder()
    builder.feed(html or "")
    builder.close()
    _doubts(_order(builder.root))
    nodes = _order(builder.root)
    _measure(nodes)
    best = max((n for n in nodes if n.name not in INLINE | RUNS), key=lambda n: n.total)
    parents = {id(c): n for n in nodes for c in n.children if not isinstance(c, str)}
    path = [best]
    while id(path[-1]) in parents:
        path.append(parents[id(path[-1])])
    around = [n for n in path if n.name == "article" and not n.doubtful]
    around = around or [n for n in path if n.name == "main" and not n.doubtful]
    if around:
        best = around[-1]
        path = path[path.index(best) :]
    threshold, on_path = min(n.density for n in path), {id(n) for n in path[1:]}

    def stays(beside: Node | str) -> bool:
        if isinstance(beside, str):
            return not around or len("".join(beside.split())) >= threshold
        unlinked = beside.link_chars <= MOST_LINKS * beside.chars
        return unlinked if not around else beside.density >= threshold or unlinked and beside.name in HEADINGS
    blocks, words = [], []

    def end_block() -> None:
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            blocks.append(text)

    todo: list = [builder.root]
    while todo:
        item = todo.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            words.append(item)
        else:
            inside = item.children
            if id(item) in on_path:
                inside = [c for c in inside if id(c) in on_path or c is best or stays(c)]
            if item.name == "br":
                words.append(" ")
            if item.name not in INLINE:
                end_block()
                todo.append(None)
            todo += reversed(inside)
    end_block()
    return "\n".join(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``.

    The whole html is read. A null, empty or textless page gives an empty text; ids and urls are
    carried as they are, null or repeated; other columns are not read; an empty table gives an
    empty result.
    """
    schema = "page_id long, url string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
