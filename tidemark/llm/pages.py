"""Main text of web pages by gradient-boosted trees over DOM nodes and a hierarchical decoding.

Pages carry no labels, but most mark their article and their boilerplate by tags and attribute words. Nodes
of a bounded sample of such pages are the examples, each page as it is and with lists, wrappers and marked
boilerplate put between its paragraphs. Marks and attribute tokens are hidden from the trees at random, so that
they also learn what text density, links, depth and siblings tell about pages that mark nothing. The trees alone
judge a node. A page is then decoded as a whole: the set of kept nodes is the likeliest one in which every
kept node's parent is kept too.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import escape
from html.parser import HTMLParser
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import renamed, settled

# What HTML's element names and usual attribute words stand for.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "head title script style noscript template svg math iframe object canvas audio video select option button"
    " textarea datalist".split()
)
# Elements that can stand in a head; any other ends it. Of the silent ones these close at a slash.
HEAD_TAGS = frozenset("html base basefont bgsound link meta title noscript noframes style script template".split())
FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small"
    " span strike strong sub sup time tt u var".split()
)
MAIN_TAGS = frozenset(("article", "main"))
MAIN_WORDS = frozenset("main articlebody article-body post-content entry-content article-content story-body".split())
ASIDE_TAGS = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"))
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice alert popup modal overlay newsletter subscribe signup share sharing social sidebar related"
    " recommended recommendations comment comments respond discussion disqus breadcrumb breadcrumbs pagination pager"
    " menu nav navbar navigation footer header masthead toolbar widget login search skip complementary contentinfo"
    " form".split()
)
TEXT_TAGS = frozenset(("p", "pre", "blockquote"))
HEADING_TAGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
LIST_TAGS = frozenset(("ul", "ol", "dl", "li", "dt", "dd"))
# An opening tag of the key ends an open element of the value.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
BOUNDS = frozenset(("ul", "ol", "dl", "table", "article", "section", "div", "body", "main", "aside", "nav"))
_WORD = re.compile(r"[a-z]+(?:-[a-z]+)*")
# Words that say what a page has or in which state it is, and headers that belong to the article.
_STATE = re.compile(r"(?:has|have|with|without|no)-.*|.*-(?:has|with|without|no)-.*|.*-(?:open|opened|closed|enabled|disabled)")
_OWN_HEADER = re.compile(r"(?:.*-)?(?:entry|post|article|story)-header")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、]")

IN_MAIN, IN_ASIDE, HAS_MAIN = "in_main", "in_aside", "has_main"
FEATURES = (
    IN_MAIN, IN_ASIDE, HAS_MAIN, "aside_here", "text", "heading", "list", "depth", "own_chars", "chars", "share",
    "link_share", "density", "punctuation", "children", "nodes", "position", "siblings", "sibling_chars", "alike",
    "paragraph_share",
)
# The tag and the attribute words of a node are hashed to so many features.
TOKENS = 48
MARKS = {IN_MAIN, HAS_MAIN}
ALL_MARKS = {IN_MAIN, HAS_MAIN, IN_ASIDE, "aside_here"}
# What is hidden from the trees: nothing, what marks the article, all marks, or the tokens as well.
HIDDEN = (frozenset(), frozenset(MARKS), frozenset(ALL_MARKS), frozenset(ALL_MARKS | {"tokens"}))


@lru_cache(65_536)
def _token(word: str) -> int:
    return 1 << crc32(word.encode("utf-8", "surrogatepass")) % TOKENS


class Page(HTMLParser):
    """The block nodes of a page in document order, and its text with the node that each part belongs to."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.last, self.depth, self.position = [-1], [0], [0], [0]
        # What a node says itself: it is main, it is aside by its tag, it is aside by a word.
        self.kind, self.said = [0], [(False, False, False)]
        self.own, self.linked, self.points = [0], [0], [0]
        self.children = [0]
        self.tokens = [0]
        # Text parts are (node, text); a node without text is the edge of a block.
        self.parts: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("", 0)]
        # Where in ``_open`` elements of a name stand.
        self._places: dict[str, list[int]] = {}
        self._silent = self._links = 0
        self.feed(html)
        self.close()
        while len(self._open) > 1:
            self._pop()
        self.last[0] = len(self.parent) - 1
        self.marks = self._marks()

    def parse_starttag(self, i: int) -> int:
        self._at = i
        return super().parse_starttag(i)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._silent and tag not in HEAD_TAGS:
            self._end("head", SILENT if tag != "body" else frozenset(("template",)))
        if tag in VOID:
            self.parts.append((self._open[-1][1], " " if tag in ("br", "wbr", "img") else ""))
            return
        for ended in ENDS.get(tag, ()):
            self._end(ended, BOUNDS - {ended})
        if tag not in INLINE and tag not in SILENT:
            self._end("p", frozenset(("table", "button")))
        node = self._open[-1][1]
        words = self._words(attrs) if attrs else ()
        if (tag not in INLINE and tag not in SILENT) or not ASIDE_WORDS.isdisjoint(words):
            node = self._node(tag, words, node)
        self._silent += tag in SILENT
        self._links += tag == "a"
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append((tag, node))
        if tag not in INLINE:
            self.parts.append((node, ""))

    @staticmethod
    def _words(attrs: list) -> set[str]:
        values = " ".join(v for name, v in attrs if v and name in ("class", "id", "role", "itemprop")).lower()
        found = set(_WORD.findall(values.replace("_", "-")))
        parts = {part for word in found if not _STATE.fullmatch(word) and not _OWN_HEADER.fullmatch(word) for part in word.split("-")}
        return found | parts | {part for word in found if _OWN_HEADER.fullmatch(word) for part in word.split("-")[:-1]}

    def _node(self, tag: str, words, parent: int) -> int:
        node = len(self.parent)
        own_header = tag == "header" and any(map(_OWN_HEADER.fullmatch, words))
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.position.append(self.children[parent])
        self.children[parent] += 1
        self.children.append(0)
        tokens = _token(f"<{tag}>")
        for word in words:
            tokens |= _token(word)
        self.tokens.append(tokens)
        main = tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)
        self.said.append((main, tag in ASIDE_TAGS and not own_header, not ASIDE_WORDS.isdisjoint(words)))
        self.kind.append(1 if tag in TEXT_TAGS else 2 if tag in HEADING_TAGS else 3 if tag in LIST_TAGS else 0)
        self.last.append(node)
        for counts in (self.own, self.linked, self.points):
            counts.append(0)
        return node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN or tag in SILENT and not self._ended_later(tag):
            self._end(tag, frozenset())

    def _ended_later(self, tag: str) -> bool:
        """Whether the tag that is read now has an end tag before the next element of its name starts."""
        following = re.compile(rf"<(/?){tag}(?=[\s/>])", re.IGNORECASE).search(self.rawdata, self._at + 1)
        return following is not None and following[1] == "/"

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self._end(tag, frozenset() if tag not in INLINE else BOUNDS)

    def _end(self, tag: str, bounds: frozenset) -> None:
        places = self._places.get(tag)
        if places and not any(self._places[bound][-1] > places[-1] for bound in bounds if self._places.get(bound)):
            start = places[-1]
            while len(self._open) > start:
                self._pop()

    def _pop(self) -> None:
        tag, node = self._open.pop()
        self._places[tag].pop()
        self._silent -= tag in SILENT
        self._links -= tag == "a"
        if node != self._open[-1][1]:
            self.last[node] = len(self.parent) - 1
        if tag not in INLINE:
            self.parts.append((self._open[-1][1], ""))

    def handle_data(self, data: str) -> None:
        if self._silent and data.strip():
            self._end("head", SILENT)
        if self._silent:
            return
        node = self._open[-1][1]
        self.parts.append((node, data))
        size = len(data.strip())
        if size:
            self.own[node] += size
            self.linked[node] += size if self._links else 0
            self.points[node] += len(_PUNCTUATION.findall(data))

    def _marks(self) -> list[tuple[bool, bool, bool]]:
        """For each node whether it is in the marked main region, in something aside, and aside itself.

        A word does not make aside what holds, or is, the first main region and has over half of the page's text.
        """
        chars = list(self.own)
        for node in range(len(chars) - 1, 0, -1):
            chars[self.parent[node]] += chars[node]
        marks = [(False, False, False)]
        by_tag = [False]
        for node in range(1, len(chars)):
            by_tag.append(by_tag[self.parent[node]] or self.said[node][1])
        first = next((node for node, said in enumerate(self.said) if said[0] and not by_tag[node]), 0)
        holders = set()
        while first:
            if chars[first] * 2 > chars[0]:
                holders.add(first)
            first = self.parent[first]
        for node in range(1, len(chars)):
            in_main, in_aside, _ = marks[self.parent[node]]
            main, tag, word = self.said[node]
            here = tag or (word and node not in holders)
            marks.append((in_main or main, in_aside or here, here))
        return marks

    def labels(self) -> np.ndarray:
        """1 for nodes of the marked article outside marked boilerplate, and for what they stand in."""
        wanted = np.array([in_main and not in_aside for in_main, in_aside, _ in self.marks])
        for node in range(len(wanted) - 1, 0, -1):
            wanted[self.parent[node]] |= wanted[node]
        return wanted.astype(float)

    def text(self, kept: list[bool]) -> str:
        blocks, block = [], []
        for node, part in [*self.parts, (0, "")]:
            if part:
                if kept[node]:
                    block.append(part)
            elif block:
                blocks.append(" ".join("".join(block).split()))
                block = []
        return "\n".join(filter(None, blocks))


def features(pages: list[Page]) -> np.ndarray:
    """A row for every node of the pages, one page after the other: ``FEATURES``, then its tokens."""
    sizes = np.array([len(page.parent) for page in pages])
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)

    def column(name: str) -> np.ndarray:
        return np.array([value for page in pages for value in getattr(page, name)], float)

    parent = np.maximum(column("parent").astype(int), 0) + begin
    last = column("last").astype(int) + begin
    marks = np.array([mark for page in pages for mark in page.marks], float)
    kind, own, children = column("kind"), column("own"), column("children")

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.r_[0.0, np.cumsum(values)]
        return sums[last + 1] - sums[np.arange(len(values))]

    chars, linked, points = below(own), below(column("linked")), below(column("points"))
    nodes = last - np.arange(len(last)) + 1.0
    paragraphs = below(own * (kind == 1))
    total = np.maximum(chars[begin], 1)
    siblings = np.maximum(children[parent], 1)
    around = np.bincount(parent, chars, len(parent))[parent] / siblings
    alike = np.zeros(len(parent))
    for one in range(4):
        alike += (kind == one) * np.bincount(parent, kind == one, len(parent))[parent] / siblings
    masks = np.array([mask for page in pages for mask in page.tokens], np.int64)
    return np.column_stack(
        [
            marks[:, 0], marks[:, 1], np.maximum.reduceat(marks[:, 0], np.cumsum(sizes) - sizes).repeat(sizes),
            marks[:, 2], kind == 1, kind == 2, kind == 3, column("depth"), np.log1p(own), np.log1p(chars), chars / total,
            linked / np.maximum(chars, 1), np.log1p(chars / nodes), points / np.maximum(chars, 1), np.log1p(children),
            np.log1p(nodes), column("position") / siblings, np.log1p(siblings), np.log1p(around), alike,
            paragraphs / np.maximum(chars, 1), (masks[:, None] >> np.arange(TOKENS)) & 1,
        ]
    )


@dataclass(frozen=True)
class NodeModel:
    """Boosted trees as arrays: node n of tree t goes left if its feature is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weights: np.ndarray
    depth: int

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """How likely each row is part of the main text."""
        margin = np.zeros(len(rows))
        every = np.arange(len(rows))
        for tree, weight in enumerate(self.weights):
            at = np.zeros(len(rows), int)
            for _ in range(self.depth):
                goes = rows[every, self.feature[tree, at]] <= self.threshold[tree, at]
                at = np.where(goes, self.left[tree, at], self.right[tree, at])
            margin += weight * self.value[tree, at]
        return 1 / (1 + np.exp(-2 * margin))


def varied(html: str, draw: random.Random) -> str:
    """The page with lists, wrappers and marked boilerplate of its own words put before some of its paragraphs."""
    words = re.sub(r"<[^>]*>", " ", html).split() or ["x"]

    short = draw.random() < 0.4

    def piece() -> str:
        start = draw.randrange(len(words))
        return escape(" ".join(words[start : start + draw.randint(1, 3 if short else 30)]))

    def named() -> str:
        """A class that says nothing, for elements that stay."""
        return f" class='{''.join(draw.choices('abcdefghiklmnoprstuvw', k=draw.randint(3, 8)))}'" if draw.random() < 0.6 else ""

    def before(paragraph: re.Match) -> str:
        kind = draw.random()
        if kind < 0.08:
            added = f"<{(tag := draw.choice(sorted(ASIDE_TAGS)))}><p>{piece()}</p></{tag}>"
        elif kind < 0.2:
            inner = "".join(f"<{(tag := draw.choice(('p', 'li', 'div')))}>{piece()}</{tag}>" for _ in range(draw.randint(1, 3)))
            added = f"<{(tag := draw.choice(('div', 'section', 'ul', 'span')))} class='{draw.choice(sorted(ASIDE_WORDS))}'>{inner}</{tag}>"
        elif kind < 0.3:
            added = f"<ul{named()}>" + "".join(f"<li>{piece()}" for _ in range(draw.randint(1, 6))) + "</ul>"
        elif kind < 0.38:
            if draw.random() < 0.3:
                return f"<header class={draw.choice(('entry', 'post'))}-header><h1>{piece()}</h1></header>{paragraph[0]}"
            added = f"<{(tag := draw.choice(('h2', 'h3', 'pre', 'blockquote', 'div')))}{named()}>{piece()}</{tag}>"
        elif kind < 0.42:
            added = f"<{draw.choice(('div', 'section'))}{named()}>"
        else:
            added = ""
        return added + paragraph[0]

    # Half of the pages get short: few paragraphs of few words, often with nothing around the article.
    if short:
        region = re.search(r"<(article|main)\b.*</\1>", html, re.DOTALL)
        html = region[0] if region and draw.random() < 0.7 else html
        some = iter(range(len(html)))
        most = draw.randint(1, 4)
        html = re.sub(r"<p\b[^>]*>[^<]*", lambda m: f"<p>{piece()}" if next(some) < most else "<p>", html)
    # Layouts are named after what stands beside the article.
    around = f" class='{draw.choice(sorted(ASIDE_WORDS))}'" if draw.random() < 0.2 else named()
    return f"<div{around}>" + re.sub(r"<p\b", before, html, flags=re.IGNORECASE)


def train(pages: DataFrame, sample: int = 600, trees: int = 30, depth: int = 5) -> NodeModel | None:
    """Boost trees on the nodes of about ``sample`` pages, chosen by a hash of the id; None if none marks an article."""
    total = pages.count()
    place = F.pmod(F.xxhash64(F.col("page_id").cast("string"), "html"), F.lit(1 << 30)) / (1 << 30)
    chosen = pages.where(place < sample / max(total, 1)).select("html")

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for html in batch["html"]:
                page = Page(html)
                if page.labels().any():
                    draw = random.Random(crc32(html.encode("utf-8", "surrogatepass")))
                    for one in (page, Page(varied(html, draw))):
                        rows, label = features([one]), one.labels()
                        for hidden in (HIDDEN[0], draw.choice(HIDDEN[1:])):
                            shown = [name not in hidden for name in FEATURES] + ["tokens" not in hidden] * TOKENS
                            yield pd.DataFrame({"label": label, "features": list(rows * shown)})

    rows = settled(chosen.mapInPandas(examples, "label double, features array<double>"), "page-nodes")
    if rows.select("label").distinct().count() < 2:
        return None
    classifier = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7)
    return _arrays(classifier.fit(rows.select("label", array_to_vector("features").alias("features"))), depth)


def _arrays(model, depth: int) -> NodeModel:
    size = 2 ** (depth + 1) - 1
    shape = (len(model.trees), size)
    feature, left, right = (np.zeros(shape, int) for _ in range(3))
    threshold, value = np.zeros(shape), np.zeros(shape)
    for number, tree in enumerate(model.trees):
        waiting, free = [(0, tree._call_java("rootNode"))], 1
        while waiting:
            at, node = waiting.pop()
            value[number, at] = node.prediction()
            left[number, at] = right[number, at] = at
            if node.subtreeDepth():
                split = node.split()
                feature[number, at], threshold[number, at] = split.featureIndex(), split.threshold()
                left[number, at], right[number, at] = free, free + 1
                waiting += [(free, node.leftChild()), (free + 1, node.rightChild())]
                free += 2
    return NodeModel(feature, threshold, left, right, value, np.array(model.treeWeights), depth)


def decoded(page: Page, probability: np.ndarray) -> list[bool]:
    """The likeliest set of kept nodes that holds every kept node's parent; the root is always in it."""
    sure = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(sure).tolist(), np.log(1 - sure).tolist()
    for node in range(len(keep) - 1, 0, -1):
        parent = page.parent[node]
        drop[parent] += drop[node]
        keep[parent] += max(keep[node], drop[node])
    kept = [True] * len(keep)
    for node in range(1, len(keep)):
        kept[node] = kept[page.parent[node]] and keep[node] >= drop[node]
    return kept


def main_texts(pages: DataFrame, **bounds: int) -> DataFrame:
    """One row per page: page_id, url, text and n_chars.

    Blocks of the article are joined by a newline, white space inside a block is one space, character
    references are decoded. NULL and empty html, and pages without text, give the empty text. Very long pages
    are read whole, repeated rows come out alike, NULL ids and urls are kept. If no page of the sample marks an
    article, nodes are judged by their own marks alone.
    """
    rows = renamed(pages, {"page_id": "page_id", "url": "url", "html": "html"})
    rows = rows.withColumn("html", F.coalesce("html", F.lit("")))
    shared = pages.sparkSession.sparkContext.broadcast(train(rows, **bounds))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["page_id", "url"]].assign(text=_texts(batch["html"].tolist(), shared.value))

    types = {name: rows.schema[name].dataType.simpleString() for name in ("page_id", "url")}
    texts = rows.mapInPandas(run, f"page_id {types['page_id']}, url {types['url']}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def _texts(pages: list[str], model: NodeModel | None) -> list[str]:
    texts = []
    for at in range(0, len(pages), 64):
        parsed = [Page(html) for html in pages[at : at + 64]]
        rows = features(parsed)
        # Without a model the marks decide.
        likely = model.probability(rows) if model else 0.9 - 0.8 * rows[:, FEATURES.index(IN_ASIDE)]
        stop = np.cumsum([len(page.parent) for page in parsed])
        for page, end in zip(parsed, stop):
            texts.append(page.text(decoded(page, likely[end - len(page.parent) : end])))
    return texts
