"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: runs of text between block-level tags. A classifier gives each block the cost of calling it
content and of calling it boilerplate, from the nearest telling ancestor, the share of linked text, length and
punctuation. These costs are capacities to the two terminals. Neighbouring blocks, and blocks of one container, are tied by
edges that weigh more the closer they stand in the document tree. The minimum cut, found by maximum flow, is the labelling
with the least total cost.

A null or empty page has an empty text. Broken markup is read as browsers do: unclosed tags end with their container, stray
end tags are skipped. The text of drawings, templates and formula annotations is not read; that of formulas is. Pages of one id or url are treated each for itself. A page is one row of one task; pages are spread.
Other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)", re.S | re.I)
#: What follows the name of a tag. Nothing is tried twice, so one attempt takes no longer than the text it looks at.
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_MARKS = re.compile(r"[>\"']")
#: Elements whose content is not markup, with what ends them.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)|\Z", re.I) for t in "script style iframe noembed noframes xmp title".split()}
_ATTR = re.compile(r"""\b(class|id|role|aria-label|hidden)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACES = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr "
                   "math maction merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle "
                   "msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
#: Elements whose text a reader does not see as text; they do not part the block around them.
HIDDEN = frozenset("svg template annotation annotation-xml".split())
#: Elements of a drawing that hold ordinary markup.
EMBEDS = frozenset(("foreignobject", "desc"))
#: Start tags that end an open paragraph, and elements that end an open one of their kind.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                   "menu nav ol p pre section table ul".split())
ENDS_SELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",)}
#: Start tags that end an open drawing.
ENDS_SVG = ENDS_P | frozenset("b big body br center code dd dt em embed head i img li meta s small span strong strike sub sup tt u var".split())
SCOPE = frozenset("article aside body div footer header main nav section table ul ol dl form template foreignobject".split())
MAIN = frozenset(("article", "main"))
SIDE_TAGS = frozenset("nav footer aside button select textarea menu dialog head noscript datalist fieldset".split())
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
SIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent "
    "gdpr notice notices alert warning nav navbar navigation menu breadcrumb breadcrumbs sidebar side footer foot masthead topbar toolbar "
    "header social share sharing related recommended recommendations newsletter subscribe subscription signup login search widget paywall "
    "pagination pager disclaimer copyright tags toc skip".split())
#: Of these, names that a part of an article may have as well: a section of that name within one is looked at for its text.
SECTION_NAMES = frozenset("related discussion feedback reader notice notices warning alert disclaimer search foot side".split())
COMMENT_NAMES = frozenset("comment comments commentlist respond reply replies discussion disqus reader feedback".split())
CONTENT_NAMES = frozenset("article content main post entry story body text prose".split())

#: Log-odds that a block is content, and the weights of the edges between blocks.
W_BIAS, W_MAIN, W_SIDE, W_CONTENT, W_LINKS, W_LENGTH, W_STOP, W_HEADING = -0.6, 7.0, -12.0, 1.5, -4.0, 0.35, 0.5, 0.4
#: Of a section of an article whose name may be that of boilerplate.
W_DOUBT = 1.0
E_NEXT, E_SAME = 0.8, 0.6
#: Context of a block: within the article, in boilerplate, or open.
OPEN, INSIDE, OUTSIDE = 0, 1, -1


class Node:
    __slots__ = ("tag", "place", "sticky", "depth", "parent", "named", "hidden", "foreign", "doubt", "form", "holds")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.place = parent.place if parent else OPEN
        self.sticky = parent.sticky if parent else False
        self.named = parent.named if parent else False
        self.doubt = parent.doubt if parent else False
        # The innermost form around, or this one; whether a form holds the main element of the page.
        self.form = self if tag == "form" else parent.form if parent else None
        self.holds = False
        self.hidden = tag in HIDDEN or parent is not None and parent.hidden
        self.foreign = tag == "svg" or parent is not None and parent.foreign and tag not in EMBEDS
        names: set[str] = set()
        role = ""
        if attrs and not attrs.isspace():
            for key, *values in _ATTR.findall(attrs):
                value = next((v for v in values if v), "")
                if key.lower() in ("class", "id"):
                    names.update(x.lower() for x in _NAME.findall(value))
                elif key.lower() == "role":
                    role = value.strip().lower()
        whole = tag not in INLINE and tag not in ("html", "body")
        if tag == "section" and self.place == INSIDE and not self.sticky and names & SECTION_NAMES and not names & ((SIDE_NAMES | COMMENT_NAMES) - SECTION_NAMES):
            self.doubt = True
        elif whole and names & COMMENT_NAMES:
            self.place, self.sticky = OUTSIDE, True
        elif tag in SIDE_TAGS or role in SIDE_ROLES:
            self.place, self.sticky = OUTSIDE, True
        elif (tag in MAIN or role in MAIN) and not names & SIDE_NAMES:
            self.place = self.place if self.sticky else INSIDE
            form = None if self.sticky or parent is None else parent.form
            while form is not None:
                form.holds, form = True, form.parent.form
        elif tag == "header" or whole and names & SIDE_NAMES and not (names & CONTENT_NAMES and self.place == INSIDE):
            self.place = OUTSIDE
        elif tag == "h1" and parent is not None and parent.tag == "header" and parent.parent is not None and parent.parent.place == INSIDE:
            self.place = INSIDE
        elif names & CONTENT_NAMES:
            self.named = True


class Block:
    __slots__ = ("node", "pieces", "linked", "heading", "place")

    def __init__(self, node: Node):
        self.node, self.pieces, self.linked, self.heading, self.place = node, [], 0, False, OPEN


class TagEnds:
    """Where tags end, for a page in which one does not: all answers by one pass from the end."""

    def __init__(self, page: str, first: int):
        at = [m.start() for m in _MARKS.finditer(page, first)]
        end = [-1] * (len(at) + 1)
        following = {'"': len(at), "'": len(at)}  # the next mark of each kind
        for i in range(len(at) - 1, -1, -1):
            c = page[at[i]]
            if c == ">":
                end[i] = at[i]
            else:
                close = following[c]
                end[i] = end[close + 1] if close < len(at) else -1
                following[c] = i
        self.at, self.end = at, end

    def after(self, place: int) -> int:
        """The next > that is not quoted, if quoting begins at ``place``; -1 without one."""
        return self.end[bisect_left(self.at, place)]


def blocks(page: str) -> list[tuple[str, Block]]:
    """Non-empty blocks of a page in order, with their clean text."""
    root = Node("", "", None)
    node, out, now, links = root, [], Block(root), 0

    def close() -> None:
        nonlocal now
        if now.pieces:
            text = _SPACES.sub(" ", entities.unescape("".join(now.pieces))).strip()
            if text:
                out.append((text, now))
        now = Block(node)

    def text(raw: str) -> None:
        if raw and not node.hidden:
            if not now.pieces:
                now.node = node
                inner = node
                while inner is not None and inner.tag in INLINE:
                    inner = inner.parent
                now.heading = inner is not None and inner.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            now.pieces.append(raw)
            if links:
                now.linked += len(raw)

    def leave(kinds: tuple[str, ...], stop: frozenset | set) -> bool:
        """Ends the innermost open element of these kinds, unless one of ``stop`` is open within it."""
        nonlocal node, links
        at, ended = node, 0
        while at.parent is not None and at.tag not in kinds:
            if at.tag in stop:
                return False
            ended += at.tag == "a"
            at = at.parent
        if at.parent is None:
            return False
        links = max(0, links - ended - (at.tag == "a"))
        node = at.parent
        return True

    last = seek = 0
    ends: TagEnds | None = None
    while m := _TOKEN.search(page, seek):
        tag, attrs, stop = m["tag"], "", m.end()
        if tag is not None:
            rest = None if ends else _REST.match(page, stop)
            if rest is None:
                ends = ends or TagEnds(page, stop)
                close_at = ends.after(stop)
                if close_at < 0:  # no tag, but text
                    seek = stop
                    continue
            else:
                close_at = rest.end() - 1
            attrs, stop = page[stop: close_at], close_at + 1
        text(page[last: m.start()])
        last = seek = stop
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not m["end"]:
            if not (node.foreign and attrs.endswith("/")):
                last = seek = RAW[tag].search(page, last).end()
            continue
        if tag in ENDS_SVG and not m["end"]:
            while node.foreign:
                leave(("svg",), frozenset())
        parts = tag not in INLINE and tag not in HIDDEN and not node.hidden
        if parts:
            close()
        if m["end"]:
            leave((tag,), frozenset() if tag in SCOPE or tag == "svg" else SCOPE - {tag})
        else:
            if tag in ENDS_P:
                leave(("p",), SCOPE | {"button"})
            if tag in ENDS_SELF:
                leave(ENDS_SELF[tag], {"ul", "ol", "dl", "table", "select", "template", "foreignobject"})
            if tag not in VOID and not attrs.endswith("/"):
                node = Node(tag, attrs, node)
                links += tag == "a"
        if parts:
            now = Block(node)
    text(page[last:])
    close()
    settle(out)
    return out


def settle(found: list[tuple[str, Block]]) -> None:
    """The places of blocks, with forms told apart: one that holds the main element, or half of all text, is the page's frame."""
    total = sum(len(t) for t, b in found if b.node.place != OUTSIDE)
    mass: dict[int, int] = {}
    for t, b in found:
        form = b.node.form if b.node.place != OUTSIDE else None
        while form is not None:
            mass[id(form)] = mass.get(id(form), 0) + len(t)
            form = form.parent.form
    for _, b in found:
        b.place = b.node.place
        form = b.node.form
        while form is not None and b.place != OUTSIDE:
            # Within an article a form is a form.
            frame = form.holds or form.parent.place != INSIDE and 2 * mass.get(id(form), 0) >= total
            b.place = b.place if frame else OUTSIDE
            form = form.parent.form


def log_odds(text: str, block: Block) -> float:
    """Log-odds of a block being content."""
    length = len(text)
    raw = max(1, sum(map(len, block.pieces)))
    odds = W_BIAS + W_LINKS * min(1.0, block.linked / raw) + W_LENGTH * (math.log1p(length) - 3) + W_HEADING * block.heading
    odds += W_STOP * (text[-1] in ".!?…。\"”'")
    if block.place == INSIDE and block.node.doubt:
        return odds + W_DOUBT
    if block.place == INSIDE:
        # What the markup calls the article is content, whatever it looks like.
        return max(odds, 0.0) + W_MAIN
    return odds + W_SIDE if block.place == OUTSIDE else odds + W_CONTENT * block.node.named


def container(node: Node) -> Node:
    while node.parent is not None and (node.tag in INLINE or node.tag in ("p", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "dt", "dd", "pre")):
        node = node.parent
    return node


def distance(a: Node, b: Node) -> int:
    """Steps between two nodes of the tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class Flow:
    """Maximum flow by shortest augmenting levels."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def tie(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.edges[a].append(len(self.to))
        self.to.append(b)
        self.room.append(there)
        self.edges[b].append(len(self.to))
        self.to.append(a)
        self.room.append(back)

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def cut(self, source: int, sink: int) -> list[bool]:
        """Which nodes stay on the source's side of the minimum cut."""
        while (level := self.levels(source))[sink] >= 0:
            at = [0] * len(self.edges)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    full = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.to[path[full] ^ 1]
                    del path[full:]
                    continue
                while at[a] < len(self.edges[a]):
                    e = self.edges[a][at[a]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                else:
                    if a == source:
                        break
                    e = path.pop()
                    a = self.to[e ^ 1]
                    at[a] += 1
                    continue
                path.append(e)
                a = self.to[e]
        return [x >= 0 for x in level]


def labels(found: list[tuple[str, Block]]) -> list[bool]:
    """Which blocks are content."""
    odds = [log_odds(t, b) for t, b in found]
    if not odds or min(odds) > 0 or max(odds) <= 0:  # the cut that parts no neighbours is the cheapest
        return [o > 0 for o in odds]
    n = len(found)
    flow = Flow(n + 2)
    own = [container(b.node) for _, b in found]
    latest: dict[int, int] = {}
    for i, o in enumerate(odds):
        if o > 0:
            flow.tie(n, i, o)
        else:
            flow.tie(i, n + 1, -o)
        if i and found[i - 1][1].place == found[i][1].place:  # what the markup parts is not tied
            w = E_NEXT / (1 + distance(own[i - 1], own[i]))
            flow.tie(i - 1, i, w, w)
        j = latest.get(id(own[i]))
        if j is not None and j < i - 1 and found[j][1].place == found[i][1].place:
            flow.tie(j, i, E_SAME, E_SAME)
        latest[id(own[i])] = i
    return flow.cut(n, n + 1)[:n]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(t for (t, _), keep in zip(found, labels(found), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                                              "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
