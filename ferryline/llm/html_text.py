"""Main text of HTML pages by composite text density.

A page is read as a tree. Every node gets its link-adjusted density: characters per
tag, lowered where much of the text lies in links, and the sum of its children's
densities, bare text being a child. The element of layout with the largest sum is
the best; the smallest density on its path to the body is the threshold. The best grows to an
enclosing element while all parts of that belong to it, and wherever a node elsewhere reaches
the threshold, the largest sum below it is taken too. All that is printed in page order, without
its boilerplate. Boilerplate (menus, footers, adverts, forms, comments by readers ...) is known
by element and role; names in classes and ids only advise, and the text decides (``settle_noise``).
It carries no density, nor does anything inside it. An <article> or <main> decides ties, and may hold parts below the threshold that are not mostly links.

Results for odd input: NULL and empty html, and pages without text, give an empty text;
broken markup is closed as it comes, in linear time; after a quote
that is never closed tags end at the next ``>``; unknown entities stay as they are; an empty
table gives no rows. Pages are independent rows, so nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.rows import col

# Element names of HTML by their role in a page.
SKIPPED = frozenset("script style noscript template iframe svg math head title object canvas "
                    "textarea select option button form nav footer aside header dialog menu "
                    "audio video map".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article blockquote body br center dd details div dl dt fieldset "
                   "figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary "
                   "table tbody td tfoot th thead tr ul caption".split())
#: An opening tag of the key closes an open one of the value, up to the element in CLOSED_IN.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSED_IN = frozenset("ul ol dl table div article section main body html td th".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                  "menu menubar alertdialog".split())
#: Words that name boilerplate in a class or id, and words that may stand beside them.
COMMENT_WORDS = re.compile(r"(?:comments?|commentlist|disqus\w*|respond)$")
NOISE_WORDS = re.compile(
    r"(?:ads?|adv|advert\w*|banners?|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebars?|aside|"
    r"footer|foot|header|masthead|cookies?|cookiebar|consent|gdpr|notices?|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|signup|shar(?:e|ing)|social|related|recommend\w*|pagination|pager|toolbar|"
    r"widgets?|login|search|hidden)$")
BESIDE = frozenset("site page main global top bottom left right primary secondary reader readers user blog "
                   "list thread container wrapper wrap box bar block area inner content link links post "
                   "posts articles items icons buttons button form group side visually sr".split())
#: Elements whose class or id says nothing about the text in them.
NAMED_FREELY = frozenset("html body article main h1 h2 h3 h4 h5 h6 thead tr th caption figcaption dt".split())
#: What an element may be: a loose or a plain name of boilerplate, comments by readers, or boilerplate for certain.
LOOSE, PLAIN, COMMENTS, CERTAIN = 1, 2, 3, 4
_OTHERS = (r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
           r"</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|$)|<([a-zA-Z][^\s/>]*+)")
TOKEN = re.compile(_OTHERS + r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:(?:>|$)|(.))", re.S)
#: For what follows a quote that is never closed: quotes mean nothing there.
PLAIN_TOKEN = re.compile(_OTHERS + r"([^>]*+)(?:>|$)()", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s=\"'<>/])([^\s=\"'<>/]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|$|=)", re.I)
#: Elements that lay out a page; others are part of a text.
LAYOUT = frozenset("html body div article main section td center".split())
#: White space of HTML texts, no-break space included.
SPACES = re.compile(r"[\s ​﻿]+")


class Node:
    __slots__ = ("tag", "look", "noise", "parent", "parts", "chars", "tags", "link_chars", "link_tags",
                 "density", "total", "top", "said", "linked", "marks")

    def __init__(self, tag: str, look: int, parent: Node | None):
        self.tag, self.look, self.parent, self.parts, self.noise = tag, look, parent, [], False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.said = self.linked = self.marks = 0
        self.density = self.total = 0.0
        self.top: Node | None = None


def _named(value: str) -> int:
    """What a class or id says: each name in it is plain if all its words are known."""
    found = 0
    for name in value.lower().split():
        words = [w for w in re.split(r"[-_.:]+", name) if w]
        if any(COMMENT_WORDS.match(w) for w in words):
            look = COMMENTS
        elif any(NOISE_WORDS.match(w) for w in words) or words[:2] == ["side", "bar"]:
            look = PLAIN
        else:
            continue
        if not all(w in BESIDE or w.isdigit() or NOISE_WORDS.match(w) or COMMENT_WORDS.match(w) for w in words):
            look = LOOSE
        found = max(found, look)
    return found


def _look(tag: str, attributes: str) -> int:
    """What an element seems to be by its tag and attributes; the text decides all but CERTAIN."""
    if tag in SKIPPED and tag != "form":
        return CERTAIN
    found = PLAIN if tag == "form" else 0
    if not attributes or tag in ("html", "body"):
        return found
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = next((v for v in values if v), ""), name.lower()
        if name in ("class", "id") and tag not in NAMED_FREELY:
            found = max(found, _named(value))
        if name == "role" and value.lower() in ROLES or name == "aria-hidden" and value == "true":
            return CERTAIN
    return CERTAIN if HIDDEN.search(QUOTED.sub("", attributes)) else found


def _spread_noise(nodes: list[Node]) -> None:
    for node in nodes:
        node.noise = bool(node.noise or node.parent and node.parent.noise)


def _count_said(nodes: list[Node]) -> None:
    """Characters outside and inside of links, and elements that mark a main text, up to each node."""
    for node in nodes:
        node.said = node.linked = node.marks = 0
    for node in reversed(nodes):
        if node.noise:
            continue
        node.said += sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        if node.tag == "a":
            node.said, node.linked = 0, node.said + node.linked
        elif node.tag in ("article", "main", "h1") and node.said:
            node.marks += 1
        if node.parent:
            node.parent.said += node.said
            node.parent.linked += node.linked
            node.parent.marks += node.marks


def settle_noise(nodes: list[Node]) -> None:
    """Marks boilerplate and all that lies in it.

    A name alone silences nothing: what wraps <main> or an <article> with <h1> is text. Comments by
    readers are none unless nearly all of the page lies in them. An element with a plain
    name stays if it holds most of the page's text outside of links, and is not set beside an
    <article>, <main> or <h1>; one with a loose name goes only if most of it is links too.
    """
    seen = set()
    for node in nodes:
        if node.tag in ("main", "h1"):
            held, up = node.tag == "main", node.parent
            while up and (up, held) not in seen:
                seen.add((up, held))
                if held and up.look < CERTAIN:
                    up.look = 0
                held = held or up.tag == "article"
                up = up.parent
    root = nodes[0]
    for node in nodes:
        node.noise = node.look == CERTAIN
    _spread_noise(nodes)
    if not any(node.look and not node.noise for node in nodes):
        return
    _count_said(nodes)
    for node in nodes:
        if node.look == COMMENTS and 20 * (root.said - node.said) >= node.said:
            node.noise = True
    _spread_noise(nodes)
    _count_said(nodes)
    for node in nodes:
        if node.look in (LOOSE, PLAIN) and not node.noise:
            most = 2 * node.said > root.said and (node.marks or not root.marks)
            node.noise = not most and (node.look == PLAIN or node.linked > node.said)
    _spread_noise(nodes)


class Open:
    """The open elements, and where those of each tag are: no walk to the root for any token."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {root.tag: [0]}

    @property
    def here(self) -> Node:
        return self.stack[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def close(self, place: int) -> None:
        """Closes the element at a place, and all in it; the root stays."""
        while len(self.stack) > max(place, 1):
            self.places[self.stack.pop().tag].pop()

    def last(self, tags) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)


def parse(page: str) -> tuple[Node, list[Node]]:
    """The root and all nodes in page order."""
    root = Node("html", 0, None)
    nodes, at, end, token = [root], 0, len(page), TOKEN
    still, once = Open(root), set()
    while at < end:
        here = still.here
        if here.tag in RAW:
            close = re.compile(rf"</{here.tag}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = close.end() if close else end
            still.close(len(still.stack) - 1)
            continue
        m = token.search(page, at)
        if m and m[4]:  # a quote that is never closed
            token = PLAIN_TOKEN
            m = token.search(page, m.start())
        if m is None:
            here.parts.append(page[at:])
            break
        if m.start() > at:
            here.parts.append(page[at:m.start()])
        at = m.end()
        if m[2]:
            tag = m[2].lower()
            if tag == "p" or tag in BLOCKS and tag != "br":
                place = still.last(("p",))
                if place > still.last(CLOSED_IN):
                    still.close(place)
            if tag in CLOSES:
                place = still.last(CLOSES[tag])
                if place > still.last(("ul", "ol", "dl", "table")):
                    still.close(place)
            if tag in ("html", "body"):
                if tag in once:
                    continue
                once.add(tag)
            node = Node(tag, _look(tag, m[3]), still.here)
            still.here.parts.append(node)
            nodes.append(node)
            if tag not in VOID and not m[3].rstrip().endswith("/"):
                still.push(node)
        elif m[1]:
            place = still.last((m[1].lower(),))
            if place > 0:
                still.close(place)
    settle_noise(nodes)
    return root, nodes


def measure(nodes: list[Node]) -> None:
    """Counts from the leaves up, then each node's density and the sum of its children's."""
    for node in reversed(nodes):
        if node.noise:
            node.chars = node.tags = node.link_chars = node.link_tags = 0
            continue
        node.chars += sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = next((n for n in nodes if n.tag == "body"), nodes[0])
    share = body.link_chars / body.chars if body.chars else 0.0

    def density(chars: int, tags: int, link_chars: int, link_tags: int) -> float:
        tags, links, link_tags = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
        base = math.log(chars / max(chars - link_chars, 1) * link_chars + share * chars + math.e)
        ratio = chars / links * tags / link_tags
        return chars / tags * math.log(ratio) / base if ratio > 1 else 0.0

    for node in reversed(nodes):
        if node.noise:
            continue
        if node.chars:
            node.density = density(node.chars, node.tags, node.link_chars, node.link_tags)
        if node.tag in LAYOUT or "-" in node.tag:
            node.total += sum(density(len(t), 0, 0, 0) for x in node.parts
                              if isinstance(x, str) and (t := x.strip()))
            if node.chars and (node.top is None or _rank(node) >= _rank(node.top)):
                node.top = node
        if up := node.parent:
            up.total += node.density
            if node.top and (up.top is None or _rank(node.top) >= _rank(up.top)):
                up.top = node.top


def _rank(node: Node) -> tuple[float, bool]:
    return node.total, node.tag in ("article", "main")


def _belongs(part: Node, up: Node, threshold: float) -> bool:
    if part.density >= threshold or up.tag in ("article", "main") and 2 * part.link_chars < part.chars:
        return True
    return part.tag not in LAYOUT and "-" not in part.tag and not part.link_chars


def main_nodes(nodes: list[Node]) -> set[Node]:
    """The subtrees to print."""
    best = nodes[0].top
    if best is None:
        return set()
    path = [best]
    while path[-1].parent and path[-1].tag != "body":
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    grown = best
    for up in path[1:]:  # an enclosing element whose every part is as dense belongs to it
        parts = [x for x in up.parts if isinstance(x, Node) and not x.noise and x.chars]
        if up.tag in ("body", "html") or not all(_belongs(x, up, threshold) for x in parts):
            break
        grown = up
    chosen = {grown}
    if threshold > 0:
        chosen |= {n.top or n for n in nodes if n.density >= threshold}
    return chosen


def text_of(root: Node, chosen: set[Node]) -> str:
    """Blocks of the chosen subtrees in page order, joined by one space."""
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        block = SPACES.sub(" ", entities.unescape("".join(line))).strip(" ")
        if block:
            blocks.append(block)
        line.clear()

    todo: list[tuple[Node | str | None, bool]] = [(root, False)]
    while todo:
        x, inside = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if inside:
                line.append(x)
        elif not x.noise:
            block = x.tag in BLOCKS or x in chosen and not inside
            if block:
                flush()
                todo.append((None, False))
            inside = inside or x in chosen
            todo.extend((part, inside) for part in reversed(x.parts))
    flush()
    return " ".join(blocks)


def extract(page: str | None) -> str:
    if not page:
        return ""
    root, nodes = parse(page)
    measure(nodes)
    return text_of(root, main_nodes(nodes))


def extract_text(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``df`` with the main text of each page in column ``out`` (replaced if it exists)."""

    @F.pandas_udf("string")
    def main_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield batch.map(extract)

    kept = [col(c) for c in df.columns if c.lower() != out.lower()]
    return df.select(*kept, main_text(col(html).cast("string")).alias(out))
