"""HTML extraction by minimum cut.

A page becomes text blocks in page order. A linear classifier over link share, length, punctuation, landmarks
and class names gives each block a cost for calling it content or boilerplate; these are the terminal
capacities. Neighbouring blocks, and blocks of like place in the tree, are tied by smoothness edges whose
capacity falls with their distance in the DOM. The minimum cut, found by max-flow, separates content from
boilerplate. Blocks of one parent, tag and landmark are one node, so graphs stay small.

A class, id or role speaks against an element only if a whole name says what the element is: ``sidebar``
does, ``has-sidebar``, ``footer-fixed`` and ``search-open`` describe something else. Names of page parts (not those
of comments, adverts and the like) are lifted from an element that holds much of the text and all that
is marked as content, so a wrapper around everything never takes the article away; a ``form`` around
the whole page likewise. Title blocks (``entry-header``) are no page headers.

Pages are independent: one pass, no shuffle. Reading a page takes time in proportion to its length,
also where tags, quotes, comments or scripts are never closed.

Defined cases: NULL or empty html, and pages without content, give an empty text. Broken markup is read as
far as it goes: unclosed elements end with the page, stray end tags are ignored, an unclosed comment or
script runs to the end, a quote that is never closed is no quote, and so are those after it; ``<`` without
a later ``>`` is text. ``<br>`` is white space. A button inside running text is text. Repeated rows each get their
row. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Raw content that is never text of the page.
_RAW = frozenset("script style noscript template title textarea svg iframe select object canvas".split())
# A button in one of these is part of the running text.
_TEXT_TAGS = frozenset("p li td th dd dt h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption".split())
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# The rest of a tag; quotes count only where a value begins. Possessive: nothing is tried twice.
_REST = re.compile(r"""(?:[^>=]++|=(?!\s*["'])|=\s*+(?:"[^"]*+"|'[^']*+'))*+>""")
_ATTR = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
# An element that opens closes these, as browsers do.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# Names of parts that never hold the article, and of parts of the page's frame.
_APART = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletters?|subscri\w*|signup|comments?|commentlist|"
    r"respond|replies|disqus|shar(?:e|ing)|social|related|recommend\w*|breadcrumbs?|pager|pagination|popup|modal"
)
_FRAME = re.compile(
    r"banner|notices?|alert|login|sidebar|widgets?|menu|nav\w*|footer|header|masthead|tags|toolbar|copyright|legal|"
    r"search|form|complementary|contentinfo|dialog"
)
_RICH = re.compile(r"article\w*|content|main|post|entry|story|body|text")
# What follows one of the first, or ends in one of the second, describes a state or another element.
_BEFORE = frozenset("no not non has have had with without is hide hides hidden show shows toggle js can supports".split())
_AFTER = frozenset(
    "open opened closed fixed sticky enabled disabled active inactive visible hidden on off collapsed expanded loaded "
    "ready shown empty none allowed".split()
)
_PARTS = re.compile(r"[-_]+|(?<=[a-z0-9])(?=[A-Z])")
_JOINED = re.compile(r"\b(side|bread|mast|sign)[-_](bar|crumbs?|head|up)\b", re.I)
_BOILER_TAGS = frozenset("nav footer aside menu dialog button".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Weights of the linear classifier: positive means content.
WEIGHTS = {
    "bias": -0.4, "article": 2.5, "rich_name": 1.0, "boiler_tag": -6.0, "boiler_name": -5.0, "page_header": -5.0,
    "link_share": -3.0, "words": 0.5, "sentence": 0.6, "paragraph": 0.8, "heading": 0.3,
}
ADJACENT, ALIKE = 1.2, 0.6
# A block's cost counts up to this, so that no single block drags its neighbours along.
MOST_COST = 6.0
# An element with this share of the page's text and every mark of content is a wrapper.
WRAPPER_SHARE = 0.4


class Place(NamedTuple):
    """An element: its tag, parent's number, depth, and what its ancestors and it say.

    ``sure`` are its own weights against content, ``frame`` those that a wrapper is spared.
    """

    tag: str
    number: int
    parent: int
    depth: int
    article: bool
    rich: bool
    sure: float
    frame: float


class Block(NamedTuple):
    text: str
    place: Place
    linked: int


def named(names: str) -> tuple[bool, bool, bool]:
    """Whether the names say the element stands apart, is part of the frame, is content."""
    apart = frame = rich = False
    for name in _JOINED.sub(r"\1\2", names).split():
        parts = [p.lower() for p in _PARTS.split(name.split("--")[0]) if p]
        until = next((k for k, p in enumerate(parts) if p in _BEFORE), len(parts))
        parts = parts[:until]
        if not parts or parts[-1] in _AFTER:
            continue
        good = any(_RICH.fullmatch(p) for p in parts)
        frames = [p for p in parts if _FRAME.fullmatch(p)]
        if any(_APART.fullmatch(p) for p in parts):
            apart = True
        elif frames and not (good and frames == ["header"] and "main" not in parts):
            frame = True
        elif good:
            rich = True
    return apart, frame, rich


def _opened(tag: str, attrs: str, above: Place, number: int) -> Place:
    article = above.article or tag in ("article", "main")
    sure = WEIGHTS["boiler_tag"] if tag in _BOILER_TAGS else 0.0
    frame = WEIGHTS["boiler_tag"] if tag == "form" else 0.0
    if tag == "header" and not article:
        sure += WEIGHTS["page_header"]
    rich = above.rich or tag == "main"
    if "=" in attrs:
        found = (m.groups() for m in _ATTR.finditer(attrs))
        names = " ".join(a or b or c or "" for key, a, b, c in found if key.lower() in ("class", "id", "role"))
        apart, framed, good = named(names)
        rich = rich or good
        if tag not in ("html", "body", "article", "main"):
            sure += WEIGHTS["boiler_name"] * apart
            frame += WEIGHTS["boiler_name"] * framed
    return Place(tag, number, above.number, above.depth + 1, article, rich, sure, frame)


def tags(html: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, is an end tag, attributes) of each piece of markup; the tag is empty for comments.

    Raw elements come as one piece with their content. Every part of the page is looked at once.
    """
    at, quotes = 0, True
    while (start := html.find("<", at)) >= 0:
        m = _TAG.match(html, start + 1)
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            at = len(html) if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if m is None and html[start + 1 : start + 2] not in ("!", "?"):
            at = start + 1
            continue
        rest = _REST.match(html, m.end()) if m and quotes else None
        if rest:
            at = rest.end()
        else:
            quotes = quotes and m is None
            at = html.find(">", start) + 1
            if not at:
                return
        tag = m[2].lower() if m else ""
        attrs = html[m.end() : at - 1] if m else ""
        if tag in _RAW and not m[1] and not (tag == "svg" and attrs.endswith("/")):
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            end = html.find(">", close.end()) + 1 if close else 0
            at, tag = end or len(html), ""
        yield start, at, tag, bool(m and m[1]), attrs


def blocks(html: str) -> tuple[list[Block], list[Place]]:
    """The text blocks in page order, and every block element by number."""
    root = Place("", 0, -1, 0, False, False, 0.0, 0.0)
    stack, found, places = [root], [], [root]
    open_tags: Counter[str] = Counter()
    run, linked, links, skipped_head, at = [], 0, 0, 0, 0

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                found.append(Block(text, stack[-1], linked))
        run, linked = [], 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not skipped_head:
            run.append(piece)
            if links:
                linked += len(piece.strip())

    def close(k: int) -> None:
        open_tags.subtract(p.tag for p in stack[k:])
        del stack[k:]

    for start, end, tag, ends, attrs in tags(html):
        add(html[at:start])
        at = end
        if tag == "head":
            skipped_head = 0 if ends else 1
        elif tag == "body":
            skipped_head = 0
        elif tag == "br":
            add(" ")
        elif tag == "a":
            links = 0 if ends else 1
        button = tag == "button" and (open_tags[tag] > 0 if ends else stack[-1].tag not in _TEXT_TAGS)
        if tag not in _BLOCKS and not button:
            continue
        flush()
        links = 0 if tag not in ("li", "p") else links
        if ends:
            if open_tags[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        closes = _CLOSES.get(tag, ())
        while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].tag in closes):
            close(len(stack) - 1)
        if tag in _VOID:
            continue
        places.append(_opened(tag, attrs, stack[-1], len(places)))
        stack.append(places[-1])
        open_tags[tag] += 1
    add(html[at:])
    flush()
    return found, places


def against(found: list[Block], places: list[Place]) -> list[float]:
    """Each element's weights against content, its ancestors' included; wrappers are spared those of the frame."""
    n = len(places)
    strong = any(p.tag in ("article", "main") for p in places)

    def marked(p: Place) -> bool:
        return p.tag in ("article", "main") if strong else p.rich and not places[p.parent].rich

    size, marks = [0] * n, [int(marked(p)) for p in places]
    for b in found:
        size[b.place.number] += len(b.text)
    for p in reversed(places[1:]):  # children come after their parent
        size[p.parent] += size[p.number]
        marks[p.parent] += marks[p.number]
    out = [0.0] * n
    for p in places[1:]:
        wrapper = size[p.number] >= WRAPPER_SHARE * size[0] and marks[p.number] == marks[0]
        out[p.number] = out[p.parent] + p.sure + (0.0 if wrapper else p.frame)
    return out


def cost(b: Block, boiler: float) -> float:
    """The classifier's log odds that the block is content."""
    p, w = b.place, WEIGHTS
    words = b.text.count(" ") + 1
    z = w["bias"] + boiler + w["words"] * min(math.log(words), 3.0)
    z += w["article"] * p.article + w["rich_name"] * p.rich
    z += w["link_share"] * min(1.0, b.linked / len(b.text))
    z += w["sentence"] * (b.text[-1] in ".!?…\"”»:") + w["paragraph"] * (p.tag in ("p", "blockquote", "pre"))
    z += w["heading"] * (p.tag in _HEADINGS)
    return max(-MOST_COST, min(MOST_COST, z))


def max_flow_side(n: int, edges: list[tuple[int, int, float, float]], source: int, sink: int) -> list[bool]:
    """The nodes on the source's side of a minimum cut; edges are (u, v, capacity, back capacity). Dinic."""
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room = [], []
    for u, v, forth, back in edges:
        graph[u].append(len(to))
        to.append(v)
        room.append(forth)
        graph[v].append(len(to))
        to.append(u)
        room.append(back)
    tiny = 1e-9
    while True:
        level = [-1] * n
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in graph[u]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level]
        at = [0] * n
        path: list[int] = []
        u = source
        while True:
            if u == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                path, u = [], source
                continue
            while at[u] < len(graph[u]):
                e = graph[u][at[u]]
                if room[e] > tiny and level[to[e]] == level[u] + 1:
                    break
                at[u] += 1
            if at[u] < len(graph[u]):
                path.append(graph[u][at[u]])
                u = to[path[-1]]
            elif u == source:
                break
            else:
                u = to[path.pop() ^ 1]
                at[u] += 1


def _distance(a: Place, b: Place, places: list[Place]) -> int:
    """Steps between two elements in the tree."""
    n = 0
    while a.number != b.number:
        if a.depth >= b.depth:
            a = places[a.parent]
        else:
            b = places[b.parent]
        n += 1
    return n


def content(found: list[Block], places: list[Place]) -> list[bool]:
    """Which blocks are content, by minimum cut."""
    boiler = against(found, places)
    nodes: list[tuple[Place, float]] = []
    of: list[int] = []
    last = None
    for b in found:
        z = cost(b, boiler[b.place.number])
        key = (b.place.parent, b.place.tag, boiler[b.place.number])
        if key == last:
            nodes[-1] = (nodes[-1][0], nodes[-1][1] + z)
        else:
            nodes.append((b.place, z))
        last = key
        of.append(len(nodes) - 1)
    n = len(nodes)
    source, sink = n, n + 1
    edges = [(source, i, z, 0.0) if z > 0 else (i, sink, -z, 0.0) for i, (_, z) in enumerate(nodes)]
    alike: dict[tuple, int] = {}
    for i, (p, _) in enumerate(nodes):
        if i:
            c = ADJACENT / (1 + _distance(nodes[i - 1][0], p, places))
            edges.append((i - 1, i, c, c))
        key = (p.parent, p.tag)
        j = alike.get(key)
        if j is not None:
            edges.append((j, i, ALIKE, ALIKE))
        alike[key] = i
    side = max_flow_side(n + 2, edges, source, sink)
    return [side[k] for k in of]


def extract(html: str | None) -> str:
    """The page's main text: its content blocks, joined by two line ends."""
    if not html:
        return ""
    found, places = blocks(html)
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, content(found, places), strict=True) if keep)


def _extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pages.map(extract, na_action=None)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(pages.sparkSession)
    text = F.pandas_udf(_extracted, "string")
    df = pages.select("page_id", "url", F.coalesce(text(F.coalesce("html", F.lit(""))), F.lit("")).alias("text"))
    return df.withColumn("n_chars", F.char_length("text").cast("bigint"))
