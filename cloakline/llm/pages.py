"""Main text of web pages: blocks are labelled content or boilerplate by a minimum cut.

A page is cut into blocks (text between starts and ends of block-level elements).
A classifier gives each block a cost: evidence of the markup around it (element,
role, class and id names, in or out of an article) plus log-odds of its shape
(words, share of link text, sentence end, heading), counted over all pages by
Spark on the blocks whose markup is clear. Costs become capacities to the source
(content) and the sink (boilerplate); blocks next to each other and blocks of one
container are joined by smoothness edges that weaken with their distance in the
tree. The maximum flow's cut is the labelling of least cost.

Dropped before: comments, scripts, styles, the head, and elements that show no
text of the article (forms' controls, templates, frames, drawings). Character
references are decoded, white space in a block becomes one space, blocks are
joined by a line feed. ``<br>`` is white space. Null and empty pages, and pages
without content, give an empty text; unclosed elements end where HTML ends them
or with the page. Rows are independent, other columns pass through untouched.
"""

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of HTML elements, roles and usual class words.
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are a block of text of their container, not a container.
LEAVES = HEADINGS | frozenset("p li dt dd td th caption figcaption legend pre summary tr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
UNSEEN = frozenset("head noscript template svg math object audio video canvas map select button datalist".split())
EMPTY = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An element start that ends an open element of the second column, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
AGAINST_TAGS = frozenset("nav footer aside menu dialog search".split())
AGAINST_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
AGAINST_NAMES = frozenset((
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies copyright disclaimer discussion disqus footer gdpr legal login menu modal nav navbar navigation newsletter "
    "notice notification overlay pager pagination popup promo promotion recommended related replies reply search share "
    "sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget").split())
HEAD_NAMES = frozenset("header masthead topbar".split())
FOR_NAMES = frozenset("article content entry main post prose story".split())
#: Names that say what a page has elsewhere.
ASIDE_NAMES = ("has", "with", "without", "no", "js")

#: Cost of markup: within an element that holds an article, or no part of one; outside where the page has one;
#: on pages that mark none, of any block, and of each third of its text that is link.
WITHIN, AGAINST, HEADER, OUTSIDE, PLAIN, LINKED = 3.0, -9.0, -5.0, -3.0, 1.5, -2.0
#: Shape costs stay within this; blocks that teach have markup costs beyond CLEAR.
SHAPE, CLEAR = 2.0, 3.0
#: Smoothness: of neighbours in one container, of a block with its container, of containers;
#: and the share of it left between neighbours that the markup sets apart.
NEXT, HOLD, NEST, EDGE = 0.8, 0.4, 0.2, 0.25
SCALE = 1000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass(slots=True)
class Mark:
    """What the markup around a place says."""
    tag: str
    node: int
    within: float = 0.0  # evidence for an article
    against: float = 0.0  # evidence against one, the strongest met
    soft: bool = True  # the latter ends where an article begins
    unseen: bool = False


@dataclass(slots=True)
class Block:
    text: str
    node: int  # its container
    markup: float
    against: float
    inside: bool
    shape: int


def names(value: str) -> Iterator[str]:
    for name in value.split():
        parts = _NAMES.findall(_CAMEL.sub("-", name).lower())
        if parts and parts[0] not in ASIDE_NAMES:
            yield from parts


def mark(tag: str, attrs: str, over: Mark, node: int) -> Mark:
    """The element's mark, from its container's and its own names."""
    own = Mark(tag, node, over.within, over.against, over.soft, over.unseen or tag in UNSEEN)
    if tag in ("html", "body"):
        return own
    found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    role = found.get("role", "").lower()
    said = set(names(f"{found.get('class', '')} {found.get('id', '')}"))
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        own.unseen = True
    if tag in ("article", "main") or role in ("article", "main"):
        if own.soft:
            own.against = 0.0
        if not own.against:
            own.within = WITHIN
    elif said & FOR_NAMES and not own.against:
        own.within = max(own.within, WITHIN - 1)
    if tag in AGAINST_TAGS or role in AGAINST_ROLES or said & AGAINST_NAMES:
        own.against, own.soft = AGAINST, False
    elif tag == "form":
        own.against = min(own.against, AGAINST)
    elif tag == "header" or said & HEAD_NAMES:
        own.against = min(own.against, HEADER if own.within else AGAINST)
    return own


def shape_of(text: str, linked: int, heading: bool) -> int:
    """Number of the block's shape: words by powers of two, link share in thirds, sentence end or heading."""
    words = min(7, (text.count(" ") + 1).bit_length() - 1)
    links = min(2, 3 * linked // max(1, len(text)))
    kind = 2 if heading else int(text[-1] in ".!?…:\"”»'")
    return (words * 3 + links) * 3 + kind


def blocks_of(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page in order, and each container's container (0 is the page, its own)."""
    parents = [0]
    stack = [Mark("", 0)]
    out: list[Block] = []
    parts: list[str] = []
    linked, link = 0, False
    at, size = 0, len(page)

    def flush() -> None:
        nonlocal linked
        top = stack[-1]
        if parts:
            text = " ".join("".join(parts).split())
            if text and not top.unseen:
                heading = top.tag in HEADINGS
                against = 0.0 if heading and top.soft and top.within else top.against
                out.append(Block(text, top.node, top.within + against, against, bool(top.within),
                                 shape_of(text, linked, heading)))
            parts.clear()
        linked = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            parts.append(piece)
            if link:
                linked += len(piece.strip())

    def close(k: int) -> None:
        while len(stack) > k:
            flush()
            stack.pop()

    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                link = False
            elif tag in BLOCKS or tag in UNSEEN:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                flush()
                if k:
                    close(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif tag == "br":
            parts.append(" ")
        elif tag == "a":
            link = True
        elif tag == "hr":
            flush()
        elif (tag in BLOCKS or tag in UNSEEN) and tag not in EMPTY:
            if tag in BLOCKS:
                flush()
                link = False
                if tag == "body":
                    close(next((k for k, x in enumerate(stack) if x.tag == "head"), len(stack)))
                if stack[-1].tag == "p" or tag in HEADINGS and stack[-1].tag in HEADINGS:
                    close(len(stack) - 1)
                if tag in ENDS:
                    same, stop = ENDS[tag]
                    cut = 0
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag in same:
                            cut = k
                        elif stack[k].tag in stop:
                            break
                    if cut:
                        close(cut)
            if not m[3].endswith("/") or tag in BLOCKS:
                flush()
                node = stack[-1].node
                if tag not in LEAVES:
                    parents.append(node)
                    node = len(parents) - 1
                stack.append(mark(tag, m[3], stack[-1], node))
    close(0 if not stack else 1)
    flush()
    return out, parents


def markup_costs(blocks: list[Block]) -> list[float]:
    """Evidence of the markup and, where the page marks no article, of links."""
    some = any(b.inside and b.markup > 0 for b in blocks)
    return [b.markup + (0.0 if b.inside else OUTSIDE if some else PLAIN + LINKED * (b.shape // 3 % 3)) for b in blocks]


def least_cut(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """True for each node on the source's side of the largest least cut.

    ``costs``: capacity from the source where positive, to the sink where negative;
    ``edges``: (a, b, capacity both ways). Shortest augmenting paths in layers.
    """
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((there, back))

    for i, c in enumerate(costs):
        if c > 0:
            join(source, i, c, 0)
        elif c < 0:
            join(i, sink, -c, 0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        # Distances to the sink; nodes without one are on the source's side.
        level = [-1] * (n + 2)
        level[sink] = 0
        queue = deque([sink])
        while queue:
            v = queue.popleft()
            for e in near[v]:
                u = to[e]
                if level[u] < 0 and room[e ^ 1]:
                    level[u] = level[v] + 1
                    queue.append(u)
        if level[source] < 0:
            return [x < 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not room[e])
                v = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[v] < len(near[v]):
                e = near[v][turn[v]]
                if room[e] and level[to[e]] == level[v] - 1:
                    path.append(e)
                    v = to[e]
                    break
                turn[v] += 1
            else:
                if not path:
                    break
                v = to[path.pop() ^ 1]
                turn[v] += 1


def label(blocks: list[Block], parents: list[int], shapes: dict[int, float]) -> list[bool]:
    """Which blocks are content."""
    costs = [c + shapes.get(b.shape, 0.0) for c, b in zip(markup_costs(blocks), blocks)]
    if not any(c < 0 for c in costs):  # no flow: nothing is cut off
        return [True] * len(blocks)
    depth = [0] * len(parents)
    for k in range(1, len(parents)):
        depth[k] = depth[parents[k]] + 1

    def apart(a: int, b: int) -> int:
        steps = 0
        while a != b:
            if depth[a] < depth[b]:
                a, b = b, a
            a, steps = parents[a], steps + 1
        return steps

    n = len(blocks)
    used: dict[int, int] = {}
    edges = []
    for i, b in enumerate(blocks):
        if i:
            near = NEXT if b.against == blocks[i - 1].against else NEXT * EDGE
            edges.append((i - 1, i, int(SCALE * near / (1 + apart(blocks[i - 1].node, b.node)))))
        k = b.node
        below = None
        while True:  # the container and those around it, up to one already there
            new = k not in used
            if new:
                used[k] = n + len(used)
            edges.append((i, used[k], int(SCALE * HOLD)) if below is None else (used[below], used[k], int(SCALE * NEST)))
            if not new or not k:
                break
            below, k = k, parents[k]
    units = [round(SCALE * c) for c in costs] + [0] * len(used)
    return least_cut(units, edges)[:n]


def main_text(page: str, shapes: dict[int, float]) -> str:
    blocks, parents = blocks_of(page)
    keep = label(blocks, parents, shapes)
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def _count(batches):
    seen: Counter[tuple[int, bool]] = Counter()
    for batch in batches:
        for page in batch["_t"]:
            blocks, _ = blocks_of(page.as_py())
            for b, cost in zip(blocks, markup_costs(blocks)):
                if abs(cost) >= CLEAR:
                    seen[b.shape, cost > 0] += 1
    rows = [(s, int(y), n) for (s, y), n in seen.items()]
    yield pa.RecordBatch.from_pylist([dict(shape=s, y=y, n=n) for s, y, n in rows],
                                     pa.schema([("shape", pa.int32()), ("y", pa.int32()), ("n", pa.int64())]))


def train(pages: DataFrame) -> dict[int, float]:
    """Log-odds of each shape (there are 72) over the blocks of all pages whose markup is clear."""
    rows = pages.select(F.coalesce("html", F.lit("")).alias("_t")).mapInArrow(_count, "shape int, y int, n long")
    counts = {(r["shape"], r["y"]): r["n"] for r in rows.groupBy("shape", "y").agg(F.sum("n").alias("n")).collect()}
    return log_odds(counts)


def log_odds(counts: dict[tuple[int, int], int]) -> dict[int, float]:
    """Smoothed log-odds of the shapes seen, within SHAPE; nothing is said where a class is missing."""
    yes, no = (sum(n for (_, y), n in counts.items() if y == k) for k in (1, 0))
    if not yes or not no:
        return {}
    out = {}
    for s in {s for s, _ in counts}:
        # A shape's prior: 20 blocks in the classes' proportions.
        a, b = counts.get((s, 1), 0) / yes, counts.get((s, 0), 0) / no
        prior = 20 / (yes + no)
        out[s] = max(-SHAPE, min(SHAPE, log((a + prior) / (b + prior))))
    return out


def extract(pages: DataFrame, shapes: dict[int, float] | None = None, out: str = "text") -> DataFrame:
    """``pages`` with a column ``out``: the main text of ``html``."""
    shapes = train(pages) if shapes is None else shapes

    def scan(page: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py(), shapes) for p in page], pa.string())

    text: Column = F.arrow_udf(scan, "string")(F.coalesce("html", F.lit("")))
    return pages.withColumn(out, text)
