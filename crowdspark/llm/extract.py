"""Main-text extraction by minimum cut: classifier costs are terminal capacities, neighbours and siblings smooth."""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdspark.llm.common import small_slices

#: Rows that the block classifier is fitted on, at most, by a hash of the page.
FIT_PAGES = 400
FIT_STEPS = 200
#: Strength of the classifier's start values against the fitted pages.
FIT_PRIOR = 0.02
#: Capacity between neighbouring blocks, and between neighbouring children of one element.
NEAR, SIBLING = 0.3, 0.3
#: The first of them where the elements around two neighbours differ in kind.
NEAR_OTHER = 0.1

# Element names of the HTML standard by their role here.
RAW_TEXT = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
#: Fallbacks and drawings: part of the text around them inside an article or main, boilerplate elsewhere.
EMBEDDED = frozenset(("noscript", "object", "canvas", "svg"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt rtc "
                   "ruby s samp small span strike strong sub sup time tt u var wbr br img picture source "
                   "math semantics annotation mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom "
                   "msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd "
                   "g defs symbol use path rect circle ellipse line polyline polygon text tspan textpath desc stop".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption blockquote pre address".split())
CONTENT_ELEMENTS = frozenset(("article", "main"))
BOILERPLATE_ELEMENTS = frozenset("nav header footer aside form menu dialog button fieldset select template".split())
#: Boilerplate elements that may wrap a whole page; an article in them is one.
WRAPPERS = frozenset(("form", "fieldset"))
# Words of class, id and role attributes.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar widget complementary contentinfo search alert".split())
#: Words of areas whose articles are no articles of the page; the second ones only if they are a whole class, id or role.
COMMENT_WORDS = frozenset("comment comments disqus replies reply respond".split())
ASIDE_NAMES = frozenset("complementary contentinfo navigation related sidebar".split())
CONTENT_WORDS = frozenset("article content entry main post story body text".split())

FEATURES = ("constant", "inside article or main", "inside boilerplate element", "boilerplate words", "content words",
            "share of link text", "words", "heading", "list item", "sentence end")
#: Log-odds of content that the fit starts from and is drawn to.
START = np.array([-0.6, 3.0, -6.5, -6.5, 0.8, -3.0, 0.9, 0.6, -0.4, 0.5])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?:!|\?)[^>]*(?:>|$)"
    r"|<(?P<raw>" + "|".join(RAW_TEXT) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|$)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*[^>]*)(?:>|$)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[^\W_]+")


class Block:
    """A run of text between block-level tags, with the elements around it."""

    __slots__ = ("parts", "linked", "state", "tag", "parent", "text")

    def __init__(self, state: tuple, tag: str, parent: int):
        self.parts, self.linked, self.state, self.tag, self.parent, self.text = [], 0, state, tag, parent, ""


def _state(state: tuple, name: str, attributes: str) -> tuple:
    """(content, boilerplate element, boilerplate words, content words, firm) inside an element.

    An article or main starts anew, without the words and forms around it, unless the boilerplate is firm: an element
    like nav or aside, hidden, or a comment area.
    """
    content, element, words, good, firm = state
    if name in CONTENT_ELEMENTS:
        content = True
        if not firm:
            element = words = False
    elif name in BOILERPLATE_ELEMENTS or name in EMBEDDED:
        element = True
        firm = firm or name in BOILERPLATE_ELEMENTS and name not in WRAPPERS
    if attributes:
        if _HIDDEN.search(attributes):
            element = firm = True
        if "class" in attributes or "id" in attributes or "role" in attributes:
            hints = {w.lower() for m in _HINT.finditer(attributes) for w in _WORD.findall(m[1] or m[2] or m[3] or "")}
            # an article or body that names a sidebar layout is no sidebar
            if name not in CONTENT_ELEMENTS and name != "body" and hints & BOILERPLATE_WORDS:
                words = True
                whole = {w.lower() for m in _HINT.finditer(attributes) for w in (m[1] or m[2] or m[3] or "").split()}
                firm = firm or bool(hints & COMMENT_WORDS or whole & ASIDE_NAMES)
            if hints & CONTENT_WORDS:
                good = True
    return content, element, words, good, firm


def blocks_of(page: str) -> list[Block]:
    """The non-empty text blocks of a page, in order, with character references decoded."""
    start = (False, False, False, False, False)
    stack: list[tuple[str, tuple, int, int]] = [("", start, 0, 0)]  # name, state, own number, the parent's
    made, current, links, elements = [], None, 0, 0
    for token in _TOKEN.finditer(page):
        kind = token.lastgroup
        if kind == "text":
            if current is None:
                name, state, number, parent = stack[-1]
                current = Block(state, name, parent if name in LEAVES else number)
                made.append(current)
            text = token["text"]
            current.parts.append(text)
            if links:
                current.linked += len(text)
            continue
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if token["close"] else 1
            continue
        if name in INLINE or name in EMBEDDED and stack[-1][1][0]:
            if name in ("br", "img") and current is not None:
                current.parts.append(" ")
            continue
        current = None
        if token["close"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            links = 0
            continue
        if name == "body":
            del stack[1:]
        if stack[-1][0] == "p":  # a block-level element ends an open paragraph
            stack.pop()
        if name in ("li", "dt", "dd", "option", "tr", "td", "th") and stack[-1][0] == name:
            stack.pop()
        if name in VOID or token["rest"].endswith("/"):
            continue
        elements += 1
        stack.append((name, _state(stack[-1][1], name, token["rest"]), elements, stack[-1][2]))
    out = []
    for block in made:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
        if block.text:
            out.append(block)
    return out


def features(block: Block) -> list[float]:
    content, element, words, good, _ = block.state
    raw = sum(map(len, block.parts)) or 1
    count = block.text.count(" ") + 1
    tag = block.tag
    return [1.0, float(content), float(element), float(words), float(good), min(1.0, block.linked / raw),
            min(math.log1p(count), 5.0) / 3, float(len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()),
            float(tag == "li"), float(block.text[-1] in ".!?…\"”»")]


def min_cut(content: list[float], boilerplate: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay on the content side of the minimum cut.

    ``content[i]`` is the capacity from the source (lost if i is cut off as boilerplate) and
    ``boilerplate[i]`` that to the sink; an edge costs its capacity if its ends part. The flow that passes
    through one node alone is sent at once; shortest augmenting paths carry the rest. Of several minimum
    cuts it returns the one with the fewest content nodes.
    """
    n = len(content)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, (c, b) in enumerate(zip(content, boilerplate)):
        if c > b:
            link(source, i, c - b, 0.0)
        elif b > c:
            link(i, sink, b - c, 0.0)
    for a, b, capacity in edges:
        link(a, b, capacity, capacity)
    tiny = 1e-12
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at = [0] * (n + 2)
        path: list[int] = []  # edges from the source to the node in hand
        node = source
        while True:
            if node == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= tiny)
                node = to[path[first] ^ 1]
                del path[first:]
            while at[node] < len(out[node]):
                e = out[node][at[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                at[node] += 1
            if at[node] < len(out[node]):
                path.append(out[node][at[node]])
                node = to[path[-1]]
            elif node == source:
                break
            else:
                at[node] = 0
                level[node] = -1
                node = to[path.pop() ^ 1]


def main_text(page: str | None, weights: np.ndarray, near: float = NEAR, near_other: float = NEAR_OTHER,
              sibling: float = SIBLING) -> str:
    """The content blocks of one page, each on a line."""
    found = blocks_of(page or "")
    if not found:
        return ""
    scores = np.array([features(b) for b in found]) @ weights
    content = np.logaddexp(0, scores).tolist()  # cost of calling it boilerplate
    boilerplate = np.logaddexp(0, -scores).tolist()
    edges = [(i, i + 1, near if a.state[:4] == b.state[:4] else near_other) for i, (a, b) in enumerate(zip(found, found[1:]))]
    last: dict[int, int] = {}
    for i, block in enumerate(found):  # neighbouring children of one element
        if block.parent in last:
            edges.append((last[block.parent], i, sibling))
        last[block.parent] = i
    keep = min_cut(content, boilerplate, edges)
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def weak_label(block: Block) -> int | None:
    """1 or 0 where the page's own markup says what a block is, else None."""
    content, element, words, _, _ = block.state
    if element or words:
        return 0
    return 1 if content else None


def fit_weights(pages: DataFrame, fit_pages: int = FIT_PAGES, html_column: str = "html") -> np.ndarray:
    """Logistic weights of the block features, fitted to marked-up blocks of at most ``fit_pages`` pages.

    The pages are those with the smallest hashes. A pull towards START keeps the weights of
    features that the sample lacks, so an empty table has the start values. Counts of distinct feature rows
    come to the driver, at most a few hundred a page.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(features(b), weak_label(b)) for page in batch.column(0).to_pylist() for b in blocks_of(page)[:500]]
            rows = [(x, y) for x, y in rows if y is not None]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.list_(pa.float64())),
                                                  pa.array([y for _, y in rows], pa.int32())], names=["x", "y"])

    chosen = pages.select(F.col(html_column).cast("string").alias("p")).where("p is not null").orderBy(
        F.xxhash64("p")).limit(fit_pages)
    rows = chosen.mapInArrow(run, "x array<double>, y int").collect()
    if not rows:
        return START
    x = np.array([r.x for r in rows])
    y = np.array([r.y for r in rows], np.float64)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))  # both classes count alike
    weights = START.copy()
    for _ in range(FIT_STEPS):
        p = 1 / (1 + np.exp(-(x @ weights)))
        gradient = x.T @ (share * (p - y)) + FIT_PRIOR * (weights - START)
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + FIT_PRIOR * np.eye(len(START))
        step = np.linalg.solve(curve, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def extract_pages(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: the blocks on the content side of its minimum cut.

    Null html and pages without content have an empty text. Repeated rows are handled one by one, nulls in
    page_id and url stay, other columns are not read. White space inside a block becomes one space and
    character references are decoded; blocks are joined by a line break. Each page is cut by itself, in
    time near its length; nothing is shuffled.
    """
    weights = fit_weights(pages) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "html"):
            texts = [main_text(p, weights) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(
        run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
