"""Main text of web pages by minimum cut.

A page becomes a row of text blocks. A logistic classifier, trained on a bounded sample of blocks
whose place in the page settles what they are, and hints from the elements around a block give the
cost of calling it content or boilerplate. These costs are the capacities to the two terminals of a
graph; blocks next to each other are tied by smoothness edges, the stronger the closer they are in
the element tree. A maximum flow finds the cheapest separation, and what is on the content side is
the main text.
"""

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "script style noscript template textarea select button svg math canvas iframe object title "
    "audio video".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES_ITSELF = frozenset("li dt dd tr td th option".split())

# Hints of what an element holds, by its name and by words of its class and id.
BOILER_TAGS = frozenset("nav footer aside form menu dialog".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion nav navbar navigation "
    "menu sidebar footer header masthead cookie cookies consent gdpr notice banner popup modal "
    "overlay comment comments reply replies disqus related recommended recommendations share "
    "sharing social subscribe subscription newsletter signup login breadcrumb breadcrumbs "
    "pagination pager widget form search toolbar topbar copyright legal disclaimer".split()
)
CONTENT_WORDS = frozenset("article content post entry story main maincontent articlebody".split())
# Of these, words that also name parts of a layout that hold content.
LAYOUT_WORDS = frozenset(
    "banner header masthead menu overlay widget form search toolbar topbar legal".split()
)
# A class name tells of the layout, not of what the element holds, from such a word on.
MODIFIERS = frozenset("has with no without".split())
# The hint of layout words is below the classifier's bound of 4, so that it and the edges can overturn
# it. That of elements and words that say what they hold is beyond all that speaks for content together.
LAYOUT_HINT, BOILER_HINT, CONTENT_HINT = -3.5, -9.0, 3.0

TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|[!?/])")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
QUOTED = re.compile(r"""[>"']""")
WORDS = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    depth: int  # elements around it
    shared: int  # of these, the outer ones that are also around the block before
    hint: float
    sure: int  # 1 content, -1 boilerplate, 0 unknown, by the elements around it
    text: str = ""
    linked: int = 0


@dataclass(slots=True)
class Element:
    tag: str
    hint: float
    boiler: bool
    content: bool
    inline: bool = field(default=False)
    hard: bool = field(default=False)  # boilerplate by more than a layout word


def _tag_end(page: str, at: int) -> int:
    """Just after the ``>`` that ends a tag, which quotes can hide; -1 if it never ends."""
    while True:
        m = QUOTED.search(page, at)
        if m is None:
            return -1
        if m[0] == ">":
            return m.end()
        # A quote counts as one only after an equals sign; a stray one is a plain character.
        before = m.start() - 1
        while before >= 0 and page[before].isspace():
            before -= 1
        close = page.find(m[0], m.end()) if page[before] == "=" else m.start()
        if close < 0:
            return -1
        at = close + 1


def _element(tag: str, attributes: str, parent: Element) -> Element:
    boiler, content, hard, hint = parent.boiler, parent.content, parent.hard, parent.hint
    against_word = content_word = strong = False
    for m in ATTRIBUTE.finditer(attributes) if attributes else ():
        for name in (m[2] or m[3] or m[4] or "").split():
            words = [w.lower() for w in WORDS.findall(name)]
            layout = next((i for i, w in enumerate(words) if w in MODIFIERS), len(words))
            told = set(words[:layout])
            # One name with both, such as post-comments, is a part of the page beside the content.
            against_word |= bool(told & BOILER_WORDS)
            strong |= bool(told & (BOILER_WORDS - LAYOUT_WORDS))
            content_word |= bool(told & CONTENT_WORDS) and not told & BOILER_WORDS
    by_name = tag in BOILER_TAGS or (tag == "header" and not content)
    whole = tag in ("html", "body", *CONTENT_TAGS)
    if not whole and (by_name or (against_word and not content_word)):
        hard = hard or by_name or strong
        boiler, hint = True, BOILER_HINT if hard else LAYOUT_HINT
    elif tag in CONTENT_TAGS and boiler and not hard and (content_word or not against_word):
        boiler, content, hint = False, True, CONTENT_HINT
    elif tag in CONTENT_TAGS or content_word:
        content, hint = True, CONTENT_HINT if not boiler else hint
    return Element(tag, hint, boiler, content, tag in INLINE, hard)


class _Open:
    """The elements that are open, and how far they were closed since the last block."""

    def __init__(self) -> None:
        root = Element("", 0.0, False, False)
        self.all, self.solid = [root], [root]  # solid: those that are not inline
        self.count: Counter[str] = Counter()
        self.low = 0

    def push(self, element: Element) -> None:
        self.all.append(element)
        self.count[element.tag] += 1
        if not element.inline:
            self.solid.append(element)

    def cut(self, depth: int) -> None:
        for element in self.all[depth:]:
            self.count[element.tag] -= 1
            if not element.inline:
                self.solid.pop()
        del self.all[depth:]
        self.low = min(self.low, len(self.solid))


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order; broken or cut off markup is read as far as it goes."""
    stack = _Open()
    blocks: list[Block] = []
    pieces: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            top = stack.solid[-1]
            sure = -1 if top.boiler else 1 if top.content else 0
            shared = min(stack.low, len(stack.solid))
            blocks.append(Block(len(stack.solid), shared, top.hint, sure, text, min(linked, len(text))))
            stack.low = len(stack.solid)
        pieces.clear()
        linked = 0

    def text(raw: str) -> None:
        nonlocal linked
        decoded = html.unescape(raw) if "&" in raw else raw
        pieces.append(decoded)
        if stack.count["a"]:
            linked += len(decoded)

    def pop_to(depth: int) -> None:
        if any(not e.inline for e in stack.all[depth:]):
            flush()
        stack.cut(depth)

    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m.start() > at:
            text(page[at : m.start()])
        tag = (m[2] or "").lower()
        if not tag:
            if page.startswith("<!--", m.start()):
                end = page.find("-->", m.start() + 4)
                at = len(page) if end < 0 else end + 3
            else:
                end = page.find(">", m.end())
                at = len(page) if end < 0 else end + 1
            continue
        end = _tag_end(page, m.end())
        if end < 0:
            break  # cut off inside a tag
        at = end
        if m[1]:
            if stack.count[tag]:
                depth = len(stack.all) - 1
                while stack.all[depth].tag != tag:
                    depth -= 1
                pop_to(depth)
            continue
        if tag in DROPPED:
            if page[end - 2] != "/":
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, end)
                at = close.end() if close else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr", "img", "input"):
                pieces.append(" " if tag != "wbr" else "")
            continue
        stop = "p" if tag in CLOSES_P else tag if tag in CLOSES_ITSELF else ""
        if stack.count[stop]:
            for depth in range(len(stack.all) - 1, 0, -1):
                open_ = stack.all[depth]
                if open_.tag == stop:
                    pop_to(depth)
                    break
                if not open_.inline and not (tag in ("td", "th") and open_.tag in ("td", "th")):
                    break
        if tag not in INLINE:
            flush()
        if page[end - 2] != "/" or tag in INLINE or tag in CLOSES_P:
            stack.push(_element(tag, page[m.end() : end - 1], stack.all[-1]))
    flush()
    return blocks


def features(block: Block) -> list[float]:
    """What the words of a block say of it, whatever the elements around it, its own tag included:
    a paragraph in a footer is a paragraph too."""
    words = block.text.split()
    letters = sum(map(str.isalpha, block.text))
    return [
        1.0,
        block.linked / len(block.text),
        float(np.log1p(len(words))),
        float(block.text[-1] in ".!?…\"'»"),
        letters / len(block.text),
        float(len(words) < 6),
    ]


@dataclass(frozen=True)
class Extraction:
    """``max_pages`` and ``max_blocks`` bound the pages and the labelled blocks that train the classifier;
    every page is extracted. ``tie``: weight of the smoothness edge between neighbours in one element; it falls with
    their distance in the tree."""

    max_pages: int = 1000
    max_blocks: int = 20_000
    tie: float = 1.5
    skip_tie: float = 0.5
    doubt: float = 1.0


def train_blocks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a regularised logistic regression by Newton steps."""
    weights = np.zeros(x.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        weights = weights - np.linalg.solve(curve, slope)
    return weights


def tree_distance(blocks: list[Block], i: int, step: int) -> int:
    """Steps in the element tree from block ``i`` to the one ``step`` further on."""
    shared = min(b.shared for b in blocks[i + 1 : i + step + 1])
    return blocks[i].depth + blocks[i + step].depth - 2 * shared


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source side of the cheapest cut.

    ``gain``: capacity from the source minus capacity to the sink; what both have in common flows
    straight through and changes no choice. ``ties``: undirected edges. Dinic's algorithm.
    """
    source, sink = len(gain), len(gain) + 1
    to: list[int] = []
    left: list[float] = []
    leaving: list[list[int]] = [[] for _ in range(sink + 1)]

    def add(a: int, b: int, forth: float, back: float) -> None:
        leaving[a].append(len(to))
        leaving[b].append(len(to) + 1)
        to.extend((b, a))
        left.extend((forth, back))

    for i, g in enumerate(gain):
        if g > 0:
            add(source, i, g, 0.0)
        elif g < 0:
            add(i, sink, -g, 0.0)
    for a, b, weight in ties:
        add(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (sink + 1)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in leaving[a]:
                if left[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(len(gain))]
        turn = [0] * (sink + 1)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                amount = min(left[e] for e in path)
                for e in path:
                    left[e] -= amount
                    left[e ^ 1] += amount
                cut = next(k for k, e in enumerate(path) if left[e] <= tiny)
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[node] < len(leaving[node]):
                e = leaving[node][turn[node]]
                if left[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                turn[node] += 1
            else:
                if node == source:
                    break
                back = path.pop()
                node = to[back ^ 1]
                turn[node] += 1
                continue
            path.append(e)
            node = to[e]


def main_text(page: str | None, weights: np.ndarray, x: Extraction) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    scores = np.array([features(b) for b in blocks]) @ weights
    gain = [float(np.clip(s, -4, 4)) * x.doubt + b.hint for s, b in zip(scores, blocks, strict=True)]
    ties = []
    for step, tie in ((1, x.tie), (2, x.skip_tie)):
        for i in range(len(blocks) - step):
            ties.append((i, i + step, tie / max(1, tree_distance(blocks, i, step) - 1)))
    inside = minimum_cut(gain, ties)
    return " ".join(b.text for b, keep in zip(blocks, inside, strict=True) if keep)


def fit_blocks(pages: DataFrame, x: Extraction) -> np.ndarray:
    """The block classifier, from about ``max_blocks`` blocks that their elements settle, of about
    ``max_pages`` pages. Pages and blocks are drawn by a hash of their names and places."""
    names = ["page", "place", "sure", "features"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.float64())]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_slices(batches, "html"):
            rows = [
                (number, place, block.sure, features(block))
                for number, page in zip(batch["page"].to_pylist(), batch["html"].to_pylist(), strict=True)
                for place, block in enumerate(blocks_of(page or "")) if block.sure
            ]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, kinds)), names=names)

    total = pages.count()
    share = lambda most, of: int(min(1.0, most / max(of, 1)) * (1 << 40))
    draw = lambda *c: F.pmod(F.xxhash64(*c), F.lit(1 << 40))
    some = pages.filter(draw("page_id", "url") < share(x.max_pages, total))
    some = some.select(F.xxhash64("page_id", "url").alias("page"), "html")
    shape = "page long, place long, sure int, features array<double>"
    rows = spill(some.mapInArrow(label, shape), "blocks")
    drawn = rows.filter(draw("page", "place") < share(x.max_blocks, rows.count()))
    found = sorted((r.sure, r.features) for r in drawn.select("sure", "features").collect())
    if not found:
        return np.zeros(len(features(Block(0, 0, 0.0, 0, "x"))))
    return train_blocks(np.array([f for _, f in found]), np.array([s > 0 for s, _ in found], float))


def extract_main_text(pages: DataFrame, x: Extraction = Extraction()) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A null or empty page, and one without content, has an empty text. Repeated rows have equal
    texts; an empty table gives no rows. Other columns are not read. Each page is read whole, by
    itself, however long or deep, in time about linear in its tags. Of cuts of equal cost the one with the least
    content is taken.
    """
    ship(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    weights = fit_blocks(pages, x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_slices(batches, "html"):
            texts = [main_text(page, weights, x) for page in batch["html"].to_pylist()]
            columns = [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], *columns], names=["page_id", "url", "text", "n_chars"]
            )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
