"""HTML main-text extraction by minimum-cut labelling.

A page is cut into text blocks. A logistic classifier over block statistics gives each block the cost
of calling it content or boilerplate: its capacities to the two terminals. Blocks that follow each other
and blocks near in the DOM are tied by smoothness edges. The minimum cut, found by maximum flow,
parts content from boilerplate. Elements that can't hold an article (menus, forms, scripts, notices, ...) are tied
to the boilerplate terminal for good; an ``article`` or ``main`` element draws its blocks to the other. A form, an
element never closed or the like around the article or most of the page's text leaves its blocks to the cut.

The classifier is trained on a bounded sample of pages from the blocks whose place is certain: those of
article or main elements against those of elements that can't hold one.
"""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import map_rows, stage

#: Pages the classifier is fitted on, about (taken by a hash of the page id).
FIT_PAGES = 2_000

# Elements without text of their own, elements that end a block, and element names, roles and
# class or id words that can't hold an article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp "
             "small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
               "pre section table ul".split())
NEVER = set("head title script style noscript template nav footer aside form button select option textarea iframe svg "
            "canvas object menu dialog audio video map".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
# Of NEVER those that a page's body may lie in all the same: WRAPPERS (and roles) as they are, the others when not closed.
ENCLOSES = set("head noscript nav footer aside form object menu dialog map".split())
WRAPPERS = set("noscript form object dialog alert".split())
UNSEEN = set("title script style template select option textarea svg".split())
FURNITURE = set("ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr popup modal "
                "overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies "
                "disqus share sharing social related recommended promo promotion newsletter subscribe subscription signup "
                "login pagination pager widget copyright toolbar notice alert banner toc".split())
TOPS = set("header masthead topbar".split())
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
SPACE = re.compile(r"\s+")
FEATURES = ["log_words", "link_share", "stops", "word_length", "heading", "paragraph", "item", "near_log_words", "near_links"]


@dataclass
class Element:
    tag: str
    parent: "Element | None"
    words: frozenset = frozenset()
    role: str = ""
    depth: int = 0
    wraps: bool = False  # an article or main element is inside
    closed: bool = False  # by an end tag of its own
    chars: int = 0
    seen: int = 0  # of chars, those outside UNSEEN
    # told from parent to child: UNSEEN around; the nearest article or main around, or the page; and what ``place`` asks of the path to the page
    hidden: bool = False
    around: "Element | None" = None
    never: bool = False
    inside: bool = False
    tops: bool = False


@dataclass
class Block:
    holder: Element
    parts: list = field(default_factory=list)
    linked: int = 0
    text: str = ""


class PageBlocks(HTMLParser):
    """Text blocks of a page in order, each with the element that holds it. Never raises on broken markup."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = Element("#page", None)
        self.open: list[Element] = [self.top]
        self.elements: list[Element] = []  # parents before children
        self.tags: Counter[str] = Counter()  # of the open ones
        self.links = 0
        self.blocks: list[Block] = []
        self.now: Block | None = None

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br" and self.now:
                self.now.parts.append(" ")
            elif tag == "hr":
                self.now = None
            return
        if tag in INLINE:
            self.links += tag == "a"
            return
        if tag in CLOSES_P:
            self._leave({"p"}, CLOSES_P - {"p"})
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self._leave({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag},
                        {"ul", "ol", "dl", "table", "select"} | ({"tr"} if tag in ("td", "th") else set()))
        got = {k: v or "" for k, v in attrs}
        named = SPLIT.split(got.get("class", "") + " " + got.get("id", ""))
        up = self.open[-1]
        self.open.append(Element(tag, up, frozenset(w.lower() for w in named if w), got.get("role", "").lower(), up.depth + 1))
        self.elements.append(self.open[-1])
        self.tags[tag] += 1
        self.now = None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in INLINE:
            self.handle_endtag(tag)

    def _leave(self, tags, stop, own=False):
        """Close the innermost open element of ``tags`` unless one of ``stop`` lies within; ``own``: by its end tag."""
        if not any(self.tags[t] for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self.open[i].closed = own
                self.tags.subtract(e.tag for e in self.open[i:])
                del self.open[i:]
                self.now = None
                return
            if self.open[i].tag in stop:
                return

    def handle_endtag(self, tag):
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in VOID or tag in INLINE:
            return
        self.now = None
        self._leave({tag}, set(), own=True)

    def handle_data(self, data):
        if not data:
            return
        if self.now is None:
            if not data.strip():
                return
            self.now = Block(self.open[-1])
            self.blocks.append(self.now)
        self.now.parts.append(data)
        if self.links:
            self.now.linked += len("".join(data.split()))


def page_blocks(html: str) -> list[Block]:
    """The blocks of a page, their elements told what lies below and around them: one pass up and one down, however deep."""
    parser = PageBlocks()
    parser.feed(html)
    parser.close()
    for e in parser.elements:
        e.hidden = e.parent.hidden or e.tag in UNSEEN
        e.around = e.parent if e.parent.parent is None or e.parent.tag in ("article", "main") else e.parent.around
    for b in parser.blocks:
        b.text = SPACE.sub(" ", "".join(b.parts)).strip()
        b.holder.chars += len(b.text)
        b.holder.seen += 0 if b.holder.hidden else len(b.text)
    for e in reversed(parser.elements):
        e.parent.chars += e.chars
        e.parent.seen += e.seen
        e.parent.wraps = e.parent.wraps or e.wraps or e.tag in ("article", "main")
    for e in parser.elements:
        _tell(e, parser.top)
    return [b for b in parser.blocks if b.text]


def encloses(e: Element) -> bool:
    """Whether an element that holds no article by its name or role lies around the article (or main) here, or, as one of
    WRAPPERS or never closed, around most of the text of the article or main it is in, or of a page without them."""
    if e.tag in NEVER and e.tag not in ENCLOSES:
        return False
    if e.wraps:
        return True
    if e.closed and (e.tag in NEVER - WRAPPERS or e.role in ROLES - WRAPPERS):
        return False
    around = e.around
    return (around.parent is not None or not around.wraps) and e.seen * 10 > around.seen * 6


def _tell(e: Element, page: Element) -> None:
    """never: an element that can't hold an article is around or this one is; inside: an article or main is, and no element that
    ``encloses`` is nearer; tops: a page's head is."""
    up = e.parent
    loose = e.tag in NEVER or e.role in ROLES
    e.never, e.tops = up.never or loose and not encloses(e), up.tops
    article = e.tag in ("article", "main")
    e.inside = not loose and (article or up.inside)
    if not article and e.tag not in ("html", "body") and not e.wraps:
        e.never = e.never or bool(e.words & FURNITURE) and e.chars * 10 <= page.chars * 6
        e.tops = e.tops or e.tag == "header" or bool(e.words & TOPS)


def place(block: Block) -> int:
    """-1: an element that can't hold an article is around the block; 1: an article or main is; 0: neither, or an
    element that ``encloses`` is nearer than the article or main."""
    e = block.holder
    return -1 if e.never else 1 if e.inside else -1 if e.tops else 0


def features(blocks: list[Block]) -> list[list[float]]:
    """FEATURES of every block; the last two are means over the two blocks on either side."""
    own = []
    for b in blocks:
        words, dense = b.text.split(), sum(map(len, b.text.split()))
        own.append([math.log1p(len(words)), min(1.0, b.linked / max(1, dense)),
                    sum(b.text.count(c) for c in ".,;:!?") / max(1, len(words)), dense / max(1, len(words)) / 10,
                    float(b.holder.tag in ("h1", "h2", "h3", "h4", "h5", "h6")), float(b.holder.tag == "p"),
                    float(b.holder.tag in ("li", "td", "th", "dt", "dd"))])
    out = []
    for i, x in enumerate(own):
        near = [own[j] for j in (i - 2, i - 1, i + 1, i + 2) if 0 <= j < len(own)]
        out.append(x + [sum(y[k] for y in near) / max(1, len(near)) for k in (0, 1)])
    return out


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements of the DOM. From block to block these walks go over every edge twice at most."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


class FlowNetwork:
    """Maximum flow by Dinic's algorithm over integer capacities; node 0 is the source, 1 the sink."""

    def __init__(self, nodes: int):
        self.to: list[int] = []
        self.room: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def tie(self, a: int, b: int, forth: int, back: int = 0) -> None:
        for x, y, c in ((a, b, forth), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(c)

    def levels(self) -> list[int]:
        level = [-1] * len(self.out)
        level[0], queue = 0, deque([0])
        while queue:
            u = queue.popleft()
            for e in self.out[u]:
                if self.room[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[u] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self) -> list[bool]:
        """Push all flow; whether each node lies on the source's side of the least cut."""
        while (level := self.levels())[1] >= 0:
            at, path, u = [0] * len(self.out), [], 0
            while True:
                if u == 1:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    full = next(i for i, e in enumerate(path) if not self.room[e])
                    u = self.to[path[full] ^ 1]
                    del path[full:]
                    continue
                while at[u] < len(self.out[u]):
                    e = self.out[u][at[u]]
                    if self.room[e] and level[self.to[e]] == level[u] + 1:
                        break
                    at[u] += 1
                else:
                    if not path:
                        break
                    u = self.to[path.pop() ^ 1]
                    at[u] += 1
                    continue
                path.append(e)
                u = self.to[e]
        return [x >= 0 for x in level]


def label_blocks(blocks: list[Block], bias: float, weights: list[float], smooth: float = 1.0, draw: float = 6.0) -> list[bool]:
    """Whether each block is content: the source's side of the page's minimum cut."""
    scale, never = 1000, 10 ** 9
    net = FlowNetwork(len(blocks) + 2)
    last: dict[int, int] = {}
    for i, (b, x) in enumerate(zip(blocks, features(blocks), strict=True)):
        where = place(b)
        logit = bias + sum(w * v for w, v in zip(weights, x, strict=True)) + draw * (where > 0)
        logit = max(-20.0, min(20.0, logit))
        # log(1 + e^x) is the cost of calling content boilerplate, log(1 + e^-x) of the reverse
        net.tie(0, i + 2, 0 if where < 0 else int(scale * math.log1p(math.exp(logit))))
        net.tie(i + 2, 1, never if where < 0 else int(scale * math.log1p(math.exp(-logit))))
        if i:
            tie = int(scale * smooth / (1 + _distance(blocks[i - 1].holder, b.holder)))
            net.tie(i + 1, i + 2, tie, tie)
        box = id(b.holder.parent or b.holder)
        if last.get(box, i - 1) != i - 1:  # the block before in the same box, when others lie between
            net.tie(last[box] + 2, i + 2, int(scale * smooth / 3), int(scale * smooth / 3))
        last[box] = i
    return net.source_side()[2:]


def fit_blocks(pages: DataFrame, id_col: str, html_col: str, fit_pages: int = FIT_PAGES) -> tuple[float, list[float]]:
    """(bias, weights) of the block classifier, from about ``fit_pages`` pages.

    Without certain blocks of both kinds the classifier is flat: every block costs the same either way.
    """
    total = pages.count()
    share = min(1.0, fit_pages / total) if total else 1.0
    key = F.xxhash64(F.col(id_col).cast("string"), F.lit("fit")).cast("double") / 2.0 ** 64 + 0.5

    def certain(html):
        blocks = page_blocks(html or "")
        for b, x in zip(blocks, features(blocks), strict=True):
            if (where := place(b)) and b.holder.tag not in ("script", "style", "title"):
                yield float(where > 0), x

    rows = stage(map_rows(pages.filter(key < share).select(html_col), certain, "label double, x array<double>", rows=32),
                 "page-blocks")
    kinds = rows.select("label").distinct().count()
    if kinds < 2:
        return 0.0, [0.0] * len(FEATURES)
    fitted = LogisticRegression(regParam=0.01, maxIter=50).fit(rows.select("label", array_to_vector("x").alias("features")))
    return float(fitted.intercept), [float(w) for w in fitted.coefficients]


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple = ("url",),
            fit_pages: int = FIT_PAGES) -> DataFrame:
    """``id_col``, ``keep``, text and n_chars per input row.

    Text is the content blocks in page order, character references decoded, white space inside a block
    one space, blocks joined by one space. Null or empty html, and pages without a content block, give an
    empty text. Broken or cut-off markup is read as far as it goes. Nothing is dropped or capped for
    length. Rows repeat as they came; an empty table gives no rows; other columns aren't looked at.
    """
    bias, weights = fit_blocks(pages, id_col, html_col, fit_pages)

    @F.udf("string", useArrow=True)
    def main_text(html: str | None) -> str:
        blocks = page_blocks(html or "")
        return " ".join(b.text for b, yes in zip(blocks, label_blocks(blocks, bias, weights), strict=True) if yes)

    made = pages.select(id_col, *keep, main_text(F.col(html_col)).alias("text"))
    return made.withColumn("n_chars", F.length("text").cast("long"))
