"""Main text of web pages by minimum-cut labelling of their blocks."""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm import scratch

# Element names by their part in a page.
BLOCKS = frozenset("address article aside blockquote body br_ button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
#: Elements that no reader sees, left out if they are closed; else they are ordinary ones, as in browsers.
LEFT_OUT = frozenset("template annotation".split())
BOILERPLATE = frozenset("nav footer aside head menu dialog button select option fieldset search".split())
CONTENT = frozenset("article main".split())
#: Words in class, id and role that mark boilerplate or content.
MARKS = re.compile(
    r"ads?|adverts?|advertisement|adsense|sponsor(?:ed)?|promo(?:tion)?|banner|copyright|legal|disclaimer|cc|reviews?|nav(?:bar|igation)?|menu|breadcrumbs?|sidebar|side|widget|footer|masthead|header|topbar|cookies?|cookiebar|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommend(?:ed|ations)?|comments?|commentlist|disqus|replies|reply|respond|pagination|pager|tags|toolbar|contentinfo|complementary|search",
    re.I,
)
#: Parts before a mark that make it a property of the page, and parts after one that leave it what it is.
_HAVING = frozenset("has have no not with without hide hidden show".split())
_KINDS = frozenset("window left right top bottom primary secondary list item items link links area section block box container wrapper wrap inner content slot unit posts articles buttons icons bar form text".split())
#: Whole words that cancel marks.
_CANCEL = frozenset("article articlebody main post entry story content".split())
GOOD = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|post|entry|story|content)(?:$|[\s_-])|(?:^|[\s_-])(?:text|body)(?:$|\s)", re.I)

_OPEN = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*+)|[!?/])")
_EVENT = re.compile(r"""[>"']""")
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

#: Log odds of a block by its shape, where nothing was learned: a constant, then one weight for each number of ``shape``.
WEIGHTS = (-1.0, 1.0, 1.0, -4.0, 0.0)
#: The classifier's log odds stay within this; it learns from the blocks of so many pages at most.
MOST_ODDS, FIT_PAGES = 3.5, 2000
#: Smoothness between neighbours in page order, the more of it the closer they are in the tree, and between siblings.
#: Where one of two stands in marked boilerplate and the other doesn't, the page itself parts them.
NEXT_TO, SIBLINGS, PARTED = 1.2, 0.6, 0.1


@dataclass
class Block:
    """A run of text between block boundaries, with what the costs are made of."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    bad: bool = False
    good: bool = False
    heading: bool = False
    parent: int = 0
    depth: int = 0
    text: str = ""


def _marked(marks: str, inside: bool) -> bool:
    """Whether words mark boilerplate: one as a whole or by its last part, and none says that this is content.

    A header inside an article, or one named as an article's, is no boilerplate.
    """
    bad, words = False, marks.lower().split()
    for word in words:
        parts = [x for x in re.split("[_-]+", word) if x]
        if parts and len(parts) > 2 and parts[-1] in _KINDS or len(parts) == 2 and parts[1] in _KINDS and not MARKS.fullmatch(parts[1]):
            parts.pop()
        if parts and parts[-1] == "header" and (inside or not _CANCEL.isdisjoint(parts)):
            continue
        bad = bad or MARKS.fullmatch(word) is not None or bool(parts) and MARKS.fullmatch(parts[-1]) is not None and _HAVING.isdisjoint(parts[-2:-1])
    return bad and _CANCEL.isdisjoint(words)


def _role(name: str, attributes: str, inside: bool, forms: bool) -> int:
    """-2 for an element of boilerplate, -1 for a form or one marked as such, 1 for one of content, else 0."""
    if name == "form":
        return -1 if forms else 0
    if name in BOILERPLATE or name == "header" and not inside:
        return -2
    marks = " ".join(a or b or c for a, b, c in _NAMED.findall(attributes)) if "=" in attributes else ""
    if marks and name not in ("body", "html", "article", "main") and _marked(marks, inside):
        return -1
    return 1 if name in CONTENT or marks and GOOD.search(marks) else 0


class _Ends:
    """Where tags end: at the first ``>`` outside of quotes, or the first at all if quotes leave none.

    Quotes and brackets are walked once from the end, and only if a tag has quotes that a look at it doesn't settle,
    so a page of any shape takes time in proportion to its length.
    """

    def __init__(self, page: str):
        self.page, self.marks, self.out = page, None, None

    def _walk(self) -> None:
        self.marks = [m.start() for m in _EVENT.finditer(self.page)]
        n = len(self.marks)
        self.out = [-1] * (n + 1)
        later = {'"': n, "'": n}
        for i in range(n - 1, -1, -1):
            mark = self.page[self.marks[i]]
            if mark == ">":
                self.out[i] = self.marks[i] + 1
            else:
                self.out[i] = self.out[later[mark] + 1] if later[mark] < n else -1
                later[mark] = i

    def after(self, at: int) -> int:
        """The end of the tag whose name ends at ``at``; -1 if no ``>`` follows."""
        first = self.page.find(">", at)
        if first < 0:
            return -1
        inside = self.page[at:first]
        if "'" not in inside and inside.count('"') % 2 == 0:
            return first + 1
        if self.out is None:
            self._walk()
        end = self.out[bisect_left(self.marks, at)]
        return first + 1 if end < 0 else end


def blocks(page: str, forms: bool = True) -> list[Block]:
    """Text blocks in page order; ``forms`` tells whether a form is boilerplate.

    Unclosed, stray and crossed tags are taken as browsers do, roughly.
    """
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # name, role, number of the element
    holders = [0]  # places in the stack of elements that hold blocks
    opened: Counter[str] = Counter()
    ends_of = _Ends(page)
    count = bad = good = links = 0
    held: list[int] = []  # marks around an <article> or <main>, which don't hold inside
    hard = outside = 0  # open elements of boilerplate; whether there was content outside marks
    unclosed: set[str] = set()
    now = Block()

    def close() -> None:
        nonlocal now
        text = " ".join(html.unescape("".join(now.parts)).split()) if now.parts else ""
        if text:
            now.text = text
            out.append(now)
        top = holders[-1]
        around = holders[-2] if top == len(stack) - 1 and len(holders) > 1 else top
        now = Block(bad=bad > 0, good=good > 0, heading=stack[top][0] in ("h1", "h2", "h3", "h4", "h5", "h6"), parent=stack[around][2], depth=len(stack))

    def pop(upto: int) -> None:
        nonlocal bad, good, links, hard
        while len(stack) > upto:
            name, role, _ = stack.pop()
            opened[name] -= 1
            if holders[-1] == len(stack):
                holders.pop()
            bad -= role < 0
            hard -= role == -2
            if name in CONTENT:
                bad += held.pop()
            good -= role > 0
            links -= name == "a"

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            now.parts.append(page[at:tag])
            now.linked += (tag - at) * (links > 0)
        if tag >= size:
            break
        m = _OPEN.match(page, tag)
        if not m:
            now.parts.append("<")
            at = tag + 1
            continue
        if m[1]:
            stop = page.find("-->", tag + 4)
            at = size if stop < 0 else stop + 3
            continue
        at = ends_of.after(m.end()) if m[3] else page.find(">", m.end()) + 1 or -1
        if at < 0:  # no tag ends any more
            now.parts.append(page[tag:])
            now.linked += (size - tag) * (links > 0)
            break
        name = (m[3] or "").lower()
        if not name:
            continue
        ends, attributes = bool(m[2]), page[m.end() : at - 1]
        if name in RAW:
            if not ends and not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                at = size if stop is None else (page.find(">", stop.end() - 1) + 1 or size)
            continue
        if name in LEFT_OUT and name not in unclosed and not ends and not attributes.endswith("/"):
            stop = re.compile(rf"<(/?){name}[\s/>]", re.I).search(page, at)
            if stop and stop[1]:
                at = page.find(">", stop.end() - 1) + 1 or size
                continue
            if stop is None:
                unclosed.add(name)
        if name in VOID:
            if name == "hr":
                close()
            elif name == "br":
                now.parts.append(" ")
            continue
        if ends:
            found = next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name) if opened[name] else 0
            if found:
                edge = name in BLOCKS or any(s[0] in BLOCKS for s in stack[found:])
                pop(found)
                if edge:
                    close()
            elif name == "p":
                close()
            continue
        if name in BLOCKS:
            again = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(name, ())
            if stack[holders[-1]][0] == "p" or stack[holders[-1]][0] in again:
                pop(holders[-1])
        count += 1
        role = _role(name, attributes, good > 0, forms)
        if name in CONTENT:
            held.append(bad if bad and not hard and not held and not outside else 0)
            outside = outside or not bad
            bad -= held[-1]
        bad += role < 0
        hard += role == -2
        good += role > 0
        links += name == "a"
        if name in BLOCKS:
            holders.append(len(stack))
        opened[name] += 1
        stack.append((name, role, count))
        if name in BLOCKS:
            close()
        elif role < 0:
            close()
            now.bad = True
    pop(1)
    close()
    return out


def shape(block: Block) -> list[float]:
    """What the classifier sees of a block: length, punctuation, share of linked text, whether it is a heading."""
    n = len(block.text)
    marks = sum(block.text.count(c) for c in ".,;:?!")
    return [min(2.5, n / 60), min(1.0, marks / 2), min(1.0, block.linked / n), float(block.heading)]


def evidence(block: Block, weights: tuple[float, ...] = WEIGHTS) -> float:
    """Log odds that a block is content: the classifier's, within bounds, and what its place in the page adds."""
    odds = weights[0] + sum(w * x for w, x in zip(weights[1:], shape(block), strict=True))
    return max(-MOST_ODDS, min(MOST_ODDS, odds)) + 4.0 * block.good - 12.0 * block.bad + 0.5 * (block.heading and block.good)


def _max_flow(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut between content (source) and boilerplate (sink) by Dinic's method; True on the source's side."""
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, z in enumerate(odds):
        # Terminal capacities are the costs of the two labels: -log of the probability of either.
        link(source, i, math.log1p(math.exp(min(z, 30.0))) if z < 30 else z, 0.0)
        link(i, sink, math.log1p(math.exp(min(-z, 30.0))) if z > -30 else -z, 0.0)
    for a, b, w in edges:
        link(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        tried = [0] * (n + 2)
        while True:
            path: list[int] = []
            u = source
            while u != sink:
                while tried[u] < len(out[u]):
                    e = out[u][tried[u]]
                    if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                        break
                    tried[u] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    u = to[e ^ 1]
                    tried[u] += 1
                    continue
                path.append(e)
                u = to[e]
            if u != sink:
                break
            least = min(room[e] for e in path)
            for e in path:
                room[e] -= least
                room[e ^ 1] += least


def label(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for content: the labelling of least cost.

    A block whose evidence outweighs all its edges has that label in every least labelling, so it is settled first
    and its edges become evidence for its neighbours; max-flow decides what is left, exactly as on the whole graph.
    """
    near: list[dict[int, float]] = [{} for _ in odds]
    for a, b, w in edges:
        near[a][b] = near[b][a] = near[a].get(b, 0.0) + w
    odds, settled = list(odds), [None] * len(odds)
    queue = deque(range(len(odds)))
    while queue:
        i = queue.popleft()
        if settled[i] is None and abs(odds[i]) > sum(w for j, w in near[i].items() if settled[j] is None):
            settled[i] = odds[i] > 0
            for j, w in near[i].items():
                if settled[j] is None:
                    odds[j] += w if settled[i] else -w
                    queue.append(j)
    left = [i for i, s in enumerate(settled) if s is None]
    if left:
        number = {i: k for k, i in enumerate(left)}
        cut = _max_flow([odds[i] for i in left], [(number[i], number[j], w) for i in left for j, w in near[i].items() if i < j and j in number])
        for i, yes in zip(left, cut, strict=True):
            settled[i] = yes
    return [bool(s) for s in settled]


def _labelled(found: list[Block], weights: tuple[float, ...]) -> list[bool]:
    """Cut the graph of a page's blocks; True for content."""
    edges: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    before: dict[bool, int] = {}  # the last block within marks, and outside of them

    def near(j: int, i: int) -> float:
        return NEXT_TO / (1 + abs(found[i].depth - found[j].depth) + (found[i].parent != found[j].parent))

    for i, b in enumerate(found):
        if i and found[i - 1].bad != b.bad:
            edges.append((i - 1, i, PARTED * near(i - 1, i)))
        if (j := before.get(b.bad)) is not None:
            edges.append((j, i, near(j, i)))
        if (j := last.get(b.parent)) is not None:
            edges.append((j, i, SIBLINGS * (PARTED if b.bad != found[j].bad else 1.0)))
        last[b.parent] = before[b.bad] = i
    return label([evidence(b, weights) for b in found], edges)


def main_text(page: str | None, weights: tuple[float, ...] = WEIGHTS) -> str:
    """Content blocks in page order, joined by an empty line; empty if there are none.

    If the cut finds none, forms may hold the article, as where one stands around the whole page, so they count as
    ordinary elements. If there is still none, as on a page of one short line, the unmarked blocks that are mostly not
    links are the text.
    """
    page = page or ""
    found = blocks(page)
    yes = _labelled(found, weights)
    if not any(yes) and "<form" in page.lower():
        wide = blocks(page, forms=False)
        if any(inside := _labelled(wide, weights)):
            found, yes = wide, inside
    if not any(yes):
        yes = [not b.bad and 2 * b.linked < len(b.text) for b in found]
    return "\n\n".join(b.text for b, keep in zip(found, yes, strict=True) if keep)


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shapes of blocks whose place tells what they are: within an article, or within marked boilerplate."""
    for batch in batches:
        known = [b for page in batch.column(0).to_pylist() for b in blocks(page or "") if b.good or b.bad]
        yield pa.RecordBatch.from_arrays([pa.array([0.0 if b.bad else 1.0 for b in known], pa.float64()), pa.array([shape(b) for b in known], pa.list_(pa.float64()))], names=["label", "shape"])


def fit(pages: DataFrame, html_col: str = "html") -> tuple[float, ...]:
    """Weights of a logistic classifier of blocks by shape, for blocks whose place in the page tells nothing.

    It learns from the blocks of at most FIT_PAGES pages, chosen by a hash of the page, that stand within an article
    or within marked boilerplate. Where the pages show only one kind, or none, it is WEIGHTS.
    """
    own = pages.select(F.col(html_col).alias("html")).where("html is not null")
    share = min(1.0, 0.9 * FIT_PAGES / max(1, own.count()))
    chosen = own.where(F.pmod(F.xxhash64("html", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(FIT_PAGES)
    known = scratch.write(chosen.mapInArrow(_shapes, "label double, shape array<double>"), "shapes")
    if known.select("label").distinct().count() < 2:
        return WEIGHTS
    ready = known.select("label", array_to_vector("shape").alias("features"))
    model = LogisticRegression(regParam=0.01, maxIter=50).fit(ready)
    return (float(model.intercept), *map(float, model.coefficients))


_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def _extracted(weights: tuple[float, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([main_text(p, weights) for p in part.column(2).to_pylist()], pa.string())], schema=_OUT)

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: tuple[float, ...] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, by the given weights or by those learned from the pages; null, empty and content-free pages have an empty text.

    Rows that repeat an id are extracted one by one, null ids and urls stay null, other columns are left out and an
    empty table gives no rows. Pages are independent, so nothing is shuffled.
    """
    weights = fit(pages, html_col) if weights is None else weights
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return own.mapInArrow(_extracted(weights), "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
