"""Main text of web pages by maximum-scoring subsequence (operator 5).

A page is a sequence of tags and runs of words.  Words score above zero and
tags below; the weights come from labelled pages.  One linear scan finds the
contiguous stretch of the largest sum, and the text of the stretch, without
what lies inside boilerplate elements, is the page's main text.

Labels.  Pages that mark their content themselves, by exactly one ``article``
or ``main`` element, are labelled pages: what lies inside is content.  On a
bounded sample of them (``sample_pages``) words are counted inside and outside
for every element feature (tag name, class, id and role tokens), and tags
inside and outside.  An element whose features hold almost no content words is
boilerplate; a tag costs more the more often it stands outside.  ``PRIOR``
adds what is known of common names as counts, so a page set without any label
works too.

What a page marks is taken whole: inside its one ``article`` or ``main`` tags
cost nothing, and boilerplate is left out without splitting the content.  The
names of an element around all of the content say nothing about it: those of
``html``, ``body`` and of elements around the marked content (without one:
around more than half of the page's words) are not applied.

Text rules: character references are decoded, white space inside a block
becomes one space, blocks are joined by one space.

Defined cases: a null or empty page, or one without words, has an empty text;
broken or unclosed markup is read on; equal scores take the first stretch.
Input columns named as the results are replaced.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverline.llm import common as C

SAMPLE_PAGES = 400
#: Elements of raw text, which end at their closing tag alone.
_SKIPPED = "script|style|textarea|title|iframe"
#: Elements that hold no text of the page; they close with what is around them,
#: and one that is never closed holds nothing.
_DROPPED = frozenset("noscript template select svg math object head button".split())
#: What may stand in the head; any other tag ends it.
_IN_HEAD = frozenset("meta link base title script style template noscript basefont bgsound".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<skip>{_SKIPPED})\b[^>]*>.*?(?:</(?P=skip)\s*>|(?=<body\b)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_DROPPED_END = re.compile("</(" + "|".join(sorted(_DROPPED)) + r")\b", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead
    tr ul""".split())
_MAIN = ("article", "main")
#: Elements a new one of the same kind closes.
_SELF_CLOSING = frozenset("p li dt dd tr td th option".split())

#: Words inside and outside the content that elements of such a name count
#: from the start: boilerplate names and content names.
PRIOR = {
    **{name: (0, 400) for name in """nav footer aside form menu sidebar breadcrumb breadcrumbs ad ads advert advertisement advertising banner
        sponsor sponsored promo cookie cookies consent notice popup modal newsletter subscribe share sharing social related recommended
        comment comments respond disqus replies navigation navbar topbar toolbar pagination copyright masthead skip login search
        contentinfo complementary dialog label input""".split()},
    "header": (20, 400),
    **{name: (400, 0) for name in "article main".split()},
}
#: An element is boilerplate from this log ratio of outside to inside words on.
_BOILERPLATE = 2.5


@dataclass(frozen=True)
class Weights:
    """Log ratio of content to other words for each element feature, and the cost of each tag."""

    features: dict[str, float]
    tags: dict[str, float]


class Element:
    """An open element: its names, the one around it, whether it lies in the marked content or is around it."""

    __slots__ = ("around", "names", "parts", "within", "encloses", "dropped", "words", "weight")

    def __init__(self, around: Element | None, names: tuple[str, ...], parts: dict[str, tuple[str, ...]]):
        #: tag and whole class, id and role values; the words of each such value
        self.around, self.names, self.parts = around, names, parts
        self.dropped = names[0] in _DROPPED or (around is not None and around.dropped)
        self.within = names[0] in _MAIN or (around is not None and around.within)
        self.encloses = names[0] in ("html", "body")
        self.words = 0
        #: the lowest feature weight on the way down to it, once asked for
        self.weight: float | None = None


class Page:
    """Tokens of a page: runs of text and tags, with the element around them."""

    __slots__ = ("items", "elements", "contained")

    def __init__(self, source: str):
        #: (tag, closing, None, element) or (None, False, text, element)
        self.items: list[tuple[str | None, bool, str | None, Element | None]] = []
        self.elements: list[Element] = []  # those around others come first
        self.contained = 0  # article and main elements outside each other
        stack: list[tuple[str, Element | None]] = []
        open_tags: Counter = Counter()
        now: Element | None = None
        at = 0
        last_end = dict.fromkeys(_DROPPED, -1)
        for m in _DROPPED_END.finditer(source):
            last_end[m[1].lower()] = m.start()
        for m in _TOKEN.finditer(source):
            if m.start() > at and not (now and now.dropped):
                self.items.append((None, False, source[at:m.start()], now))
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            closing = bool(m["close"])
            if tag in _VOID:
                self.items.append((tag, closing, None, now))
                continue
            if not closing and open_tags["head"] and tag not in _IN_HEAD:
                while stack.pop()[0] != "head":
                    pass
                open_tags.clear()
                open_tags.update(t for t, _ in stack)
                now = stack[-1][1] if stack else None
            if not closing and tag != "head" and last_end.get(tag, at) < at:
                continue
            if not closing:
                if tag in _SELF_CLOSING and stack and stack[-1][0] == tag:
                    stack.pop()
                    open_tags[tag] -= 1
                    now = stack[-1][1] if stack else None
                if tag in _MAIN and not (now and now.within):
                    self.contained += 1
                self.items.append((tag, closing, None, now))
                now = Element(now, *_features(tag, m["attrs"]))
                self.elements.append(now)
                stack.append((tag, now))
                open_tags[tag] += 1
            elif open_tags[tag]:  # what is still open inside closes with it
                while stack:
                    last, _ = stack.pop()
                    open_tags[last] -= 1
                    if last == tag:
                        break
                now = stack[-1][1] if stack else None
            if closing:
                self.items.append((tag, closing, None, now))
        if at < len(source) and not (now and now.dropped):
            self.items.append((None, False, source[at:], now))


def _features(tag: str, attrs: str | None) -> tuple[tuple[str, ...], dict[str, tuple[str, ...]]]:
    """The tag and the whole values of class, id and role, and the words of each value."""
    names, parts = [tag], {}
    if attrs:
        for kind, value in _ATTRIBUTE.findall(attrs):
            for whole in value.lower().strip("\"'").split():
                names.append(whole)
                parts[whole] = tuple(_NAME.findall(whole))
        if _HIDDEN.search(attrs):
            names.append("!hidden")
    return tuple(names), parts


def count_page(page: Page, words: Counter, tags: Counter) -> None:
    """Add the counts of a labelled page: (feature, inside) and (tag, inside)."""
    depth = 0
    for tag, closing, text, element in page.items:
        if tag is not None:
            # the content's own opening and closing tag stand outside it
            if tag in _MAIN and closing:
                depth = max(0, depth - 1)
            tags[(f"/{tag}" if closing else tag, depth > 0)] += 1
            if tag in _MAIN and not closing:
                depth += 1
        elif n := len(text.split()):
            inside = element is not None and element.within
            names = set()
            while element is not None:
                names.update(element.names, *element.parts.values())
                element = element.around
            for name in names:
                words[name, inside] += n


def fit(words: dict, tags: dict) -> Weights:
    """Smoothed log ratios from the counts and the prior."""
    features = {}
    for name in {n for n, _ in words} | set(PRIOR):
        inside, outside = PRIOR.get(name, (0, 0))
        features[name] = float(np.log((words.get((name, True), 0) + inside + 20) / (words.get((name, False), 0) + outside + 20)))
    features["!hidden"] = -9.0
    costs = {}
    for tag in {t for t, _ in tags}:
        inside, outside = tags.get((tag, True), 0), tags.get((tag, False), 0)
        costs[tag] = float(np.clip(0.3 + np.log((outside + 5) / (inside + 5)), 0.1, 6.0))
    return Weights(features, costs)


#: Elements of every kind of text, whose bare tag says nothing; their class, id and role count.
_NEUTRAL = frozenset("""html body div section span p ul ol li dl dt dd a b i u s em strong small font center table thead tbody tfoot tr td th
    h1 h2 h3 h4 h5 h6 pre blockquote figure figcaption img br""".split())


def _mark_enclosing(page: Page) -> None:
    """Find the elements around the content."""
    if page.contained == 1:
        element = next(e for e in page.elements if e.within).around
        while element is not None:
            element.encloses = True
            element = element.around
        return
    total = 0
    for tag, _, text, element in page.items:
        if tag is None:
            n = len(text.split())
            total += n
            if element is not None:
                element.words += n
    for element in reversed(page.elements):
        if element.around is not None:
            element.around.words += element.words
        # hidden text stays hidden
        if 2 * element.words > total and "!hidden" not in element.names:
            element.encloses = True


def _score(page: Page, weights: Weights) -> tuple[list[float], list[bool]]:
    """(score, whether its text is the page's) of each item."""
    marked = page.contained == 1
    _mark_enclosing(page)
    scores, kept = [], []
    for tag, closing, text, element in page.items:
        within = marked and element is not None and element.within
        own = True
        if tag is not None:
            score = 0.0 if within else -weights.tags.get(f"/{tag}" if closing else tag, 0.5)
        else:
            n = len(text.split())
            if n and element is not None and _lowest(element, weights) <= -_BOILERPLATE:
                score, own = 0.0 if within else -0.25 * n, False
            elif marked and not within:
                # where one element marks the content, other words weigh more against it
                score, own = -1.0 * n, n == 0
            else:
                score = 1.0 * n
        scores.append(score)
        kept.append(own)
    return scores, kept


def _lowest(element: Element, weights: Weights) -> float:
    """The lowest weight of a feature of the element or those around it."""
    chain: list[Element] = []
    while element is not None and element.weight is None:
        chain.append(element)
        element = element.around
    low = element.weight if element is not None else 0.0
    for e in reversed(chain):
        for k, name in enumerate(() if e.encloses else e.names):
            # a header inside the content is a headline, not the page's header
            if not (k == 0 and name in _NEUTRAL) and not (name == "header" and e.within):
                low = min(low, _weight(name, e, weights))
        e.weight = low
    return low


def _weight(name: str, element: Element, weights: Weights) -> float:
    """Weight of a feature.  A value of several words that is not known as a
    whole takes the lowest weight of its words; inside the marked content,
    where names like share-price and related-work occur, the highest."""
    parts = element.parts.get(name, ())
    if name in weights.features or len(parts) < 2:
        return weights.features.get(name, weights.features.get(parts[0], 0.0) if parts else 0.0)
    return (max if element.within else min)(weights.features.get(p, 0.0) for p in parts)


def main_text(source: str | None, weights: Weights) -> str:
    """Text of the best-scoring contiguous stretch of the page."""
    if not source:
        return ""
    page = Page(source)
    scores, kept = _score(page, weights)
    best, best_from, best_to, run, run_from = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, run_from = 0.0, i
        run += s
        if run > best:
            best, best_from, best_to = run, run_from, i + 1
    blocks, now = [], []
    for (tag, _, text, _), own in zip(page.items[best_from:best_to], kept[best_from:best_to]):
        if tag is None:
            if own:
                now.append(text)
        elif tag in _BLOCK and now:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    words = (html_lib.unescape(b).split() for b in blocks)
    return " ".join(" ".join(w) for w in words if w)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, tags = Counter(), Counter()
    for batch in batches:
        for source in batch.column(0).to_pylist():
            page = Page(source)
            if page.contained == 1:
                count_page(page, words, tags)
    found = [("word", n, i, c) for (n, i), c in words.items()] + [("tag", n, i, c) for (n, i), c in tags.items()]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], names=["kind", "name", "inside", "n"])


def learn_weights(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from about ``sample_pages`` pages, picked by a hash of their text."""
    C.prepared(pages.sparkSession)
    source = pages.select(F.col(f"`{html_col}`").alias("html")).filter(F.col("html").isNotNull())
    total = source.count()
    share = min(1.0, sample_pages / max(total, 1))
    sample = source.filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    sample = sample.distinct() if share < 1.0 else sample
    rows = sample.mapInArrow(_count, "kind string, name string, inside boolean, n long").groupBy("kind", "name", "inside").agg(F.sum("n").alias("n")).collect()
    counts = {k: {(r["name"], r["inside"]): r["n"] for r in rows if r["kind"] == k} for k in ("word", "tag")}
    return fit(counts["word"], counts["tag"])


def extract_text(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points."""
    C.prepared(pages.sparkSession)

    def compute(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(source, weights) for source in column.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return C.add_columns(pages, html_col, compute, [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
