"""Main text of a page as the best-scoring run of its words and tags.

A page is read as one sequence. Words score one, more inside an ``article`` or ``main`` element, and less by what
labelled pages show against each class word around them; where that leaves nothing the words are no content and score
negative, as do tags and each step across the border of a marked element. The contiguous run with the highest sum (one
linear scan) is the article, so long text outside the marks wins over a marked teaser. Inside the run, blocks in
surroundings that are no content, such as a sidebar or an advert in mid-article, are left out; inside a marked element
they and their tags cost nothing, so that the article goes on behind them, however long they are; references are decoded, white space becomes single spaces, and blocks are joined by blank lines.

Labelled pages are pages that mark their article with exactly one ``article`` or ``main`` element. Over a bounded
number of them (``LABELLED_PAGES``, those with the least hashes) the words inside and outside are counted for every
tag name and class word that surrounds them, and every tag inside and outside. What is known of page markup in
general enters as counts of ``PRIOR`` words or ``PRIOR_PART`` of all, and words of known boilerplate inside the mark do
not speak for it, so pages of other make are read by the same scores.

Null or empty pages give an empty text, as do pages without words. No page is cut. Broken markup is read as far as
it goes: unclosed elements end with their parent, stray end tags are ignored. Rows are independent.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled pages learned from at most, and the words that general knowledge counts for, or that part of the counted
#: words where it is more, so that a few pages do not outvote it.
LABELLED_PAGES, PRIOR, PRIOR_PART = 2_000, 200, 0.05
#: What a tag costs that was not seen, what it costs at most, and what a word costs in surroundings that are no content.
USUAL_TAG, DEAREST_TAG, WORD_COST = 0.1, 0.5, 0.2
#: What a word scores, what it gains inside a marked element, and what a step across the border of the marks costs.
WORD, MARK, BORDER = 1.0, 1.0, 100.0
#: Element names and class words of the markup language and of common usage.
DROPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video select button textarea head title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("header h1 h2 h3 h4 h5 h6".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE = frozenset(
    "nav footer aside form dialog header ad ads advert adverts advertisement advertising adbox sponsor sponsored promo promotion "
    "sidebar navbar navigation menu breadcrumb breadcrumbs masthead topbar foot copyright cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended comment "
    "comments respond reply replies disqus widget pagination pager toolbar disclaimer".split()
)
CONTENT = frozenset("article main content entry post story body text title headline".split())
#: Of the dropped ones: those whose content is no markup, and those whose content is no text either way.
RAW = frozenset("script style textarea title iframe".split())
CODE = frozenset("script style".split())
# Quotes count only after "="; else a tag ends at the next ">". Nothing is tried twice, so the time is linear.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|([^<]++|<)", re.S
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _features(name: str, attributes: str) -> tuple[str, ...]:
    """The class words of a tag, or its name where it has none or where the name itself says what it is."""
    found = [p.lower() for m in _NAMES.finditer(attributes) for p in _PART.findall("".join(x or "" for x in m.groups()))] if "=" in attributes else []
    if "header" in found and CONTENT.intersection(found):
        found = [p for p in found if p != "header"]
    if not found or name in BOILERPLATE or name in ("article", "main"):
        found.append(name)
    return tuple(f if f == name else "." + f for f in found)


class _Reader:
    """Goes through a page: (kind, text or tag, surroundings); kinds are ``text``, ``open`` and ``close``.

    A dropped element is one ``close``, and nothing inside it is told. It ends with its end tag or with its parent; one
    whose end tag is nowhere to come is empty, but for scripts and styles, which then end with their parent.
    """

    def __init__(self, page: str) -> None:
        self._page = page
        self._lower: str | None = None
        self._last: dict[str, int] = {}

    def _closes_after(self, name: str, at: int) -> bool:
        if name not in self._last:
            self._lower = self._page.lower() if self._lower is None else self._lower
            self._last[name] = self._lower.rfind("</" + name)
        return self._last[name] >= at

    def _after(self, name: str, at: int) -> int:
        """Behind the next end tag of ``name``; there is one. Lower case may be longer in other letters than ASCII."""
        closing = re.compile(rf"</{re.escape(name)}[^>]*+(?:>|\Z)", re.I).search(self._page, at)
        return closing.end() if closing else at

    def events(self):
        page, at, end = self._page, 0, len(self._page)
        stack: list[tuple[str, tuple[str, ...]]] = []
        held: Counter = Counter()
        hidden = 0  # dropped elements around

        def pop() -> str:
            nonlocal hidden
            gone = stack.pop()[0]
            held[gone] -= 1
            hidden -= gone in DROPPED
            return gone

        while at < end:
            m = _TOKEN.match(page, at)
            at = m.end()
            slash, name, attributes, text = m.groups()
            if text is not None:
                if not hidden:
                    yield "text", text, stack
                continue
            if name is None:
                continue
            name = name.lower()
            if slash:
                told = not hidden
                if held[name]:
                    while pop() != name:
                        pass
                if told or not hidden and name not in DROPPED:
                    yield "close", name, stack
            elif name in DROPPED:
                if not hidden:
                    yield "close", name, stack
                if attributes.endswith("/") or name in EMPTY:
                    continue
                if self._closes_after(name, at):
                    if name in RAW:
                        at = self._after(name, at)
                        continue
                elif name not in CODE:
                    continue
                stack.append((name, (name,)))
                held[name] += 1
                hidden += 1
            else:
                if held["head"] and (name in BLOCKS or name == "body"):
                    while pop() != "head":
                        pass
                if name in BLOCKS and held["p"] and name != "body":
                    depth = len(stack) - 1
                    while depth >= 0 and stack[depth][0] not in BLOCKS:
                        depth -= 1
                    if depth >= 0 and stack[depth][0] == "p":
                        while len(stack) > depth:
                            pop()
                if name not in EMPTY and not attributes.endswith("/"):
                    stack.append((name, _features(name, attributes)))
                    held[name] += 1
                if not hidden:
                    yield "open", name, stack


class _Trail:
    """What surrounds the words here, kept up as the stack grows and shrinks, so that depth costs nothing.

    ``inside``: whether they belong to a marked article; ``features``: all class words and names around them; ``blocks``: those
    of boilerplate below a marked element; ``headings``: elements of headings around them.
    """

    def __init__(self) -> None:
        self._known: list[tuple[tuple, bool]] = []
        self.features: Counter = Counter()
        self.blocks: Counter = Counter()
        self.inside, self.headings = False, 0

    def _turn(self, element: tuple[str, tuple[str, ...]], within: bool, by: int) -> None:
        name, features = element
        self.headings += by * (name in HEADINGS)
        for f in features:
            for held, counts in ((self.features, True), (self.blocks, within and f != "header" and f.lstrip(".") in BOILERPLATE)):
                if counts:
                    held[f] += by
                    if not held[f]:
                        del held[f]

    def follow(self, stack: list) -> None:
        known = self._known
        while known and (len(known) > len(stack) or known[-1][0] is not stack[len(known) - 1]):
            element, self.inside = known.pop()
            self._turn(element, self.inside, -1)
        for element in stack[len(known) :]:
            known.append((element, self.inside))
            self._turn(element, self.inside, 1)
            self.inside = self.inside or element[0] in ("article", "main")


def _marked(page: str) -> int:
    """The marked elements of a page; text, comments and scripts that look like one are none."""
    return sum(kind == "open" and stack[-1:] != [] and stack[-1][0] == what and what in ("article", "main") for kind, what, stack in _Reader(page).events())


def _wrappers(page: str) -> set[str]:
    """Boilerplate names that stand around all marked words of a page but its headings, so they are none there."""
    common: set[str] | None = None
    trail = _Trail()
    for kind, what, stack in _Reader(page).events():
        trail.follow(stack)
        if kind == "text" and what.strip() and trail.inside and not trail.headings:
            common = set(trail.blocks) if common is None else common & trail.blocks.keys()
            if not common:
                break
    return common or set()


def count_features(pages: list[str]) -> Counter:
    """(feature, inside) to words, and ("<" + tag, inside) to tags, over pages with exactly one marked article.

    What stands in boilerplate inside the mark, such as comments or an advert, is counted neither way.
    """
    counts: Counter = Counter()
    for page in pages:
        if not page or _marked(page) != 1:
            continue
        wrappers, trail = _wrappers(page), _Trail()
        for kind, what, stack in _Reader(page).events():
            trail.follow(stack)
            inside = trail.inside
            if inside and trail.blocks.keys() - wrappers:
                continue
            if kind == "text":
                n = len(what.split())
                if n:
                    for feature in trail.features:
                        counts[feature, inside] += n
                    counts["", inside] += n
            elif kind == "close" or what in EMPTY or stack[-1:] == [(what, (what,))]:  # classes speak for themselves
                counts["<" + what, inside] += 1
    return counts


class Scores:
    """What words and tags score, from counts over labelled pages and general knowledge."""

    def __init__(self, counts: dict[tuple[str, bool], int]) -> None:
        features = {f for f, _ in counts if f[:1] != "<"}
        features |= BOILERPLATE | {"." + f for f in BOILERPLATE}
        self.against: dict[str, float] = {}
        prior = max(PRIOR, PRIOR_PART * (counts.get(("", True), 0) + counts.get(("", False), 0)))
        # what stands around everything, such as a wrapper's class, says nothing
        usual = max(0.0, math.log((counts.get(("", False), 0) + 1) / (counts.get(("", True), 0) + 1)))
        for f in features:
            plain = f.lstrip(".")
            inside, outside = counts.get((f, True), 0), counts.get((f, False), 0)
            if plain in CONTENT or (f[:1] != "." and f not in BOILERPLATE):
                continue  # a bare link or list may stand anywhere; what its tags cost is enough
            outside += prior * (plain in BOILERPLATE)
            self.against[f] = max(0.0, math.log((outside + 1) / (inside + 1)) - usual)
        words = {way: max(1, counts.get(("", way), 0)) for way in (True, False)}
        self.tags: dict[str, float] = {}
        for f in {f for f, _ in counts if f[:1] == "<"}:
            rate = {way: (counts.get((f, way), 0) + 1) / words[way] for way in (True, False)}
            self.tags[f[1:]] = min(DEAREST_TAG, max(USUAL_TAG, math.log(rate[False] / rate[True])))

    def against_of(self, features: tuple[str, ...], within: bool) -> float:
        """What one element takes from the score of the words in it."""
        return sum(self.against.get(f, 0.0) for f in features if f != "header" or not within)


class _Surroundings:
    """Score of a word and whether it is marked, for a stack that grows and shrinks at its end; each element is looked at once."""

    def __init__(self, scores: Scores) -> None:
        self._scores = scores
        self._known: list[tuple[tuple, float, bool]] = []

    def __call__(self, stack: list) -> tuple[float, bool]:
        known = self._known
        del known[len(stack) :]
        while known and known[-1][0] is not stack[len(known) - 1]:
            known.pop()
        for element in stack[len(known) :]:
            _, against, within = known[-1] if known else (None, 0.0, False)
            known.append((element, against + self._scores.against_of(element[1], within), within or element[0] in ("article", "main")))
        _, against, within = known[-1] if known else (None, 0.0, False)
        return WORD + MARK * within - against, within


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the highest sum, of equals the last, in one scan; (0, 0) if none is positive."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total >= best and total > 0:
            best, span = total, (start, i + 1)
    return span


def extract(page: str | None, scores: Scores) -> str:
    """The main text of one page."""
    if not page:
        return ""
    items: list[tuple[float, str | None]] = []  # score, and a text or None for the end of a block
    around = _Surroundings(scores)
    last = None  # whether the content before was marked
    for kind, what, stack in _Reader(page).events():
        weight, inside = around(stack)
        if kind == "text":
            n = len(what.split())
            if weight <= 0:
                items.append((0.0 if inside else -n * WORD_COST, None))
            else:
                if n:
                    if last not in (None, inside):
                        items.append((-BORDER, ""))
                    last = inside
                items.append((n * weight, what))
        else:
            cost = 0.0 if inside and weight <= 0 else scores.tags.get(what, USUAL_TAG)
            items.append((-cost, None if what in BLOCKS or what in DROPPED else " " if what == "br" else ""))
    span = best_run([score for score, _ in items])
    blocks: list[str] = []
    parts: list[str] = []
    for _, what in [*items[span[0] : span[1]], (0.0, None)]:
        if what is None:
            block = " ".join("".join(parts).split())
            if block:
                blocks.append(block)
            parts = []
        else:
            parts.append(html.unescape(what))
    return "\n\n".join(blocks)


def learn(pages: DataFrame, page: str = "html") -> Scores:
    """Scores from the marked pages among the ``LABELLED_PAGES`` with the least hashes."""
    hashed = pages.select(F.xxhash64(page).alias("_h"), page).where(F.col(page).isNotNull())
    last = hashed.select("_h").orderBy("_h").limit(LABELLED_PAGES).agg(F.max("_h")).first()[0]
    if last is None:
        return Scores({})

    def count(frames):
        for frame in frames:
            rows = [(f, inside, n) for (f, inside), n in count_features(list(frame[page])).items()]
            yield pd.DataFrame(rows, columns=["feature", "inside", "n"])

    chosen = hashed.where(F.col("_h") <= last).limit(LABELLED_PAGES).select(page)
    counted = chosen.mapInPandas(count, "feature string, inside boolean, n bigint").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return Scores({(r.feature, r.inside): r.n for r in counted.collect()})


def text_of(page: str | Column, scores: Scores) -> Column:
    """The main text of each page; never null."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([extract(p.as_py(), scores) for p in pages], pa.string())

    return run(page)
