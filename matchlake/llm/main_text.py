"""Main text of web pages by composite text density over the tree of a page.

Menus, forms, adverts and the like are left out by their elements and by the names of their classes first, unless they
hold the page's article or most of its text. For every node left, the composite density is its characters per tag, weighed down where much of its text is links. The densities of a
node's block children add up to its density sum. The node with the largest sum leads to the content: the least density on
the path from the body to it is the threshold that a node beside the path must reach to be taken as well. Bare text of the
nodes on the path stays; children of the best node go where they are mostly links and thinner than that. No element decides by its name that it is the content.
"""

from __future__ import annotations

import math
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose contents are no text of the page at all.
NO_TEXT = frozenset("script style title select option textarea input iframe svg canvas".split())
#: Elements that hold no main text.
PRUNED = frozenset(
    "script style noscript template head title nav header footer aside form button select option textarea input iframe svg object dialog menu canvas".split())
BLOCKS = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address "
    "details summary hr br fieldset center".split())
#: Classes, ids and roles of an element that holds no main text; whole ones, not parts of hyphenated names.
NOT_CONTENT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer "
    "header masthead comment comments disqus reply replies respond cookie cookies consent notice notices newsletter subscribe signup popup modal social share sharing "
    "related recommended search login widget".split())
#: Elements that end an open one of the second group when they begin, inside the third.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
_ENDS_P = BLOCKS - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body"} | {"nav", "header", "footer", "aside", "form"}
_HOLDS_P = {"body", "article", "section", "main", "div", "td", "th", "table", "li", "blockquote", "button", "object"}


class Node:
    __slots__ = ("tag", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "sum", "pruned", "unread", "block")

    def __init__(self, tag: str, parent: Node | None, pruned: bool) -> None:
        self.tag, self.parent, self.pruned = tag, parent, pruned  # so far by its own name only; see prune
        self.unread = tag in NO_TEXT or (parent is not None and parent.unread)
        self.block = tag in BLOCKS and tag != "br"
        self.parts: list = []  # texts and nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = 0.0


class TreeBuilder(HTMLParser):
    """A page's tree; unclosed paragraphs, items and cells are closed where the next one begins."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, False)
        self.open = [self.root]
        self.nodes = [self.root]
        #: How many elements of each tag are open, so that an end tag without a start costs nothing.
        self.tags = Counter()

    def _close_to(self, depth: int) -> None:
        self.tags.subtract(node.tag for node in self.open[max(depth, 1) :])
        del self.open[max(depth, 1) :]

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of an unknown kind is a bogus comment; it ends at the next >."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i, report)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "html":
            return
        ended, within = _CLOSES.get(tag, (set(), set()))
        if tag in _ENDS_P:
            ended, within = ended | {"p"}, within | _HOLDS_P
        if any(self.tags[t] for t in ended):
            for depth in range(len(self.open) - 1, 0, -1):
                if self.open[depth].tag in ended:
                    self._close_to(depth)
                    break
                if self.open[depth].tag in within:
                    break
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).lower()
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        named = tag not in ("html", "body", "article", "main") and not NOT_CONTENT.isdisjoint(names.split())
        parent = self.open[-1]
        node = Node(tag, parent, hidden or named or tag in PRUNED)
        parent.parts.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.tags[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if not self.tags[tag]:
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self._close_to(depth)
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].parts.append(data)


def _within(node: Node | None) -> set[int]:
    """The node and all above it."""
    out = set()
    while node is not None:
        out.add(id(node))
        node = node.parent
    return out


def prune(nodes: list[Node]) -> None:
    """Hand ``pruned`` down from the elements that look like no content to all below them.

    Neither what holds the page's <main> or longest <article> nor what holds more than half of its characters outside links
    is pruned, whatever its name; but a footer and the like beside a <main> or <article> are, however long they are.
    """
    def plain(node: Node) -> int:
        return node.chars - node.link_chars

    mains = [n for n in nodes if n.tag == "main" and not n.unread and plain(n)]
    articles = [n for n in nodes if n.tag == "article" and not n.unread and plain(n)]
    beside = frozenset("nav header footer aside menu dialog".split()) if mains or articles else frozenset()
    spared = _within(max(mains, key=plain, default=None)) | _within(max(articles, key=plain, default=None))
    for node in nodes:
        own = node.pruned and not (id(node) in spared or (node.tag not in beside and 2 * plain(node) > plain(nodes[0])))
        node.pruned = node.unread or own or (node.parent is not None and node.parent.pruned)


def measure(nodes: list[Node]) -> Node:
    """Set ``pruned``, densities and sums of all nodes (parents stand before their children); returns the body.

    Menus and the like count in the densities of the nodes that hold them, but in no sum. Inline elements are part of the
    text of their block.
    """
    for node in reversed(nodes):
        if node.unread:
            continue
        node.chars += sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars, up.tags = up.chars + node.chars, up.tags + node.tags + 1
            up.link_chars, up.link_tags = up.link_chars + node.link_chars, up.link_tags + node.link_tags
            up.block = up.block or node.block
    prune(nodes)
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    page_links = body.link_chars / body.chars if body.chars else 0.0
    for node in nodes:
        if node.unread or not node.chars:
            continue
        node.density = _density(node.chars, node.tags, node.link_chars, node.link_tags, page_links)
        if node.parent is not None and node.block and not node.pruned:
            node.parent.sum += node.density
    return body


def _density(chars: int, tags: int, link_chars: int, link_tags: int, page_links: float) -> float:
    """Composite density: characters per tag, weighed down by the share of links in them and in the page."""
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + page_links * chars + math.e)
    weight = chars / max(link_chars, 1) * max(tags, 1) / max(link_tags, 1)
    return chars / max(tags, 1) * math.log(max(weight, 1.0)) / math.log(max(base, math.e))


def _runs(node: Node, on_path: set[int]) -> list[Node | list]:
    """The parts of a node in page order: child nodes, and lists of bare text with the inline children that stand in it."""
    out: list[Node | list] = []
    run: list = []

    def end_run() -> None:
        if any(isinstance(p, str) and p.strip() for p in run):
            out.append(list(run))
        else:
            out.extend(p for p in run if isinstance(p, Node))
        run.clear()

    for part in node.parts:
        if isinstance(part, Node) and (part.block or id(part) in on_path):
            end_run()
            out.append(part)
        else:
            run.append(part)
    end_run()
    return out


def _keeps(run: list, threshold: float, page_links: float) -> bool:
    """Whether bare text of a node on the path is content: always, but for a row of links that is thinner than the threshold."""
    inline = [p for p in run if isinstance(p, Node) and not p.pruned]
    bare = sum(len("".join(p.split())) for p in run if isinstance(p, str))
    chars, links = bare + sum(n.chars for n in inline), sum(n.link_chars for n in inline)
    tags, link_tags = sum(n.tags + 1 for n in inline), sum(n.link_tags for n in inline)
    return 2 * links <= chars or _density(chars, tags, links, link_tags, page_links) >= threshold


def content(nodes: list[Node]) -> list[Node | list]:
    """What makes up the main text, in page order: nodes with all below them, and runs of bare text of the nodes above the densest."""
    body = measure(nodes)
    live = [n for n in nodes if not n.pruned and n.chars]
    if not live:
        return []
    best = max(live, key=lambda n: n.sum)
    if best.sum <= 0:
        return [body] if body.chars else [nodes[0]]
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    on_path = path[: path.index(body) + 1] if body in path else path
    threshold = min(n.density for n in on_path)
    page_links = body.link_chars / body.chars if body.chars else 0.0
    # Beside the path, what is as dense as the path's thinnest node belongs to the content.
    kept = [p for p in best.parts if isinstance(p, str) or not p.block or 2 * p.link_chars <= p.chars or p.density >= threshold]
    chosen: list[Node | list] = [kept] if any(isinstance(p, Node) or p.strip() for p in kept) else [best]
    on = {id(n) for n in on_path}
    for above in on_path[1:]:
        beside: list[Node | list] = []
        before = True
        for run in _runs(above, on):
            if isinstance(run, Node):
                if id(run) in on:
                    before = False
                    chosen = beside + chosen
                    beside = []
                elif not run.pruned and run.density >= threshold and run.density > 0:
                    beside.append(run)
            elif _keeps(run, threshold, page_links):
                beside.append(run)
            else:
                beside.extend(p for p in run if isinstance(p, Node) and not p.pruned and p.density >= threshold and p.density > 0)
        chosen = beside + chosen if before else chosen + beside
    return chosen


def text_of(chosen: list[Node | list]) -> str:
    """The text of subtrees and runs, block by block, joined by line feeds."""
    blocks: list[str] = []
    now: list[str] = []

    def end_block() -> None:
        text = " ".join("".join(now).split())
        if text:
            blocks.append(text)
        now.clear()

    for top in chosen:
        work: list = [top] if isinstance(top, Node) else list(reversed(top))
        while work:
            part = work.pop()
            if part is None:
                end_block()
            elif isinstance(part, str):
                now.append(part)
            elif not part.pruned:
                if part.tag in BLOCKS:
                    end_block()
                    work.append(None)
                work.extend(reversed(part.parts))
        end_block()
    return "\n".join(blocks)


def extract_text(html: str | None) -> str:
    """The main text of one page; empty if there is none."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return text_of(content(builder.nodes))


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text`` and ``n_chars``, its code points.

    NULL and empty pages, and pages without text, give an empty text. Repeated rows are worked on alike; other columns are
    ignored; no rows give no rows.
    """
    def work(batches):
        for batch in batches:
            texts = [extract_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(work, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
