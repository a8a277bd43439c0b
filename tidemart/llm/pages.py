"""Main text of web pages by a tree-structured graphical model (operator 4).

A page's block elements form a tree; each block is content or not. Node potentials come from
a block's tag, name hints, words and links; parent-child potentials say how states follow
each other down the tree. One sum-product pass upward and one downward give every block's
content marginal; blocks at one half or more are the text, in page order.

Potentials are counts over labelled pages: a bounded sample of the corpus' pages that mark
their article with ``article`` or ``main`` (each seen once more with its telling tags made
plain, so that other clues get weight), and the labelled examples below, which show what a
corpus may lack. Only the counts, of a fixed set of features, leave the workers.

Null and empty pages give empty texts. Unclosed, stray and nested tags are closed as browsers
do for blocks; a head ends at the first tag or text that may not stand in it. Of the other hidden
elements one with an end tag hides all up to it, one without hides no more than the text up to
the next block; only an open template hides the rest, as in browsers. Pages may be of any length; trees of any depth are walked without recursion.
Repeated rows get equal rows.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

SAMPLE = 400
#: An example counts as much as one in so many sampled pages.
_EXAMPLE_SHARE = 20

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HINT_WORD = re.compile(r"[a-z]+")
# Elements whose content is no text, blocks, and void elements.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_HIDDEN = {"head", "template", "noscript", "svg", "math", "select", "button", "object", "canvas", "datalist"}
# What may stand in a head; all else ends it.
_IN_HEAD = set("html head base basefont bgsound link meta title noframes style script template noscript".split())
_BLOCKS = set(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article "
    "main nav header footer aside form fieldset blockquote pre figure figcaption address hgroup details summary "
    "dialog menu center hr".split()
)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# An opening tag of the set closes an open element of the key first.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "p": _BLOCKS,
}
_CLOSED_BY = {tag: [own for own, tags in _CLOSES.items() if tag in tags] for tag in _BLOCKS}
_SCOPES = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
_PLAIN = {"article": "div", "main": "div", "nav": "div", "header": "div", "footer": "div", "aside": "div"}
_TELLING = {"article", "main", "nav", "header", "footer", "aside", "form"}
_HINTS = set(
    "ad ads advert advertisement sponsor promo banner nav navigation menu breadcrumb breadcrumbs footer header sidebar "
    "side widget related share social cookie consent notice newsletter subscribe signup login form search comment "
    "comments reply respond pagination pager copyright legal popup modal tags article content entry post story main "
    "body text page title".split()
)

#: Labelled examples: ``data-label`` gives the state of an element and all below it.
EXAMPLES = (
    '<body><header data-label="0"><div class="banner">Shop the sale today</div><nav><ul><li><a href="/">Home</a></li>'
    '<li><a href="/a">News</a></li></ul></nav></header><main data-label="1"><h1>A morning at the harbour</h1><p>The boats '
    "came in before the sun rose, and the market was already full of people.</p><p>Nobody spoke of the storm. It had passed.</p>"
    '<aside data-label="0" class="related"><h3>Related</h3><ul><li><a href="/b">Older story</a></li></ul></aside></main>'
    '<footer data-label="0"><p>Copyright, all rights reserved. <a href="/t">Terms</a></p></footer></body>',
    '<body><div id="cookie" class="notice" data-label="0"><p>We use cookies. <button>Accept</button></p></div>'
    '<div class="menu" data-label="0"><a href="/">Start</a> <a href="/x">Topics</a></div><div class="content" data-label="1">'
    "<h2>Growing beans</h2><p>Beans need warm soil, so wait until the nights are mild before you sow them outside.</p>"
    "<ul><li>Water them in the morning.</li><li>Keep the snails away.</li></ul><blockquote>A bean forgives much.</blockquote></div>"
    '<div class="sidebar" data-label="0"><div class="widget"><p>Subscribe to the letter</p><form><p>Your mail</p></form></div>'
    '<div class="ad"><p>Buy better shoes now.</p></div></div><div class="footer" data-label="0">Imprint</div></body>',
    '<body><nav data-label="0"><ol class="breadcrumb"><li><a href="/">Home</a></li></ol></nav><article data-label="1"><h1>On maps</h1>'
    "<p>A map leaves out nearly all there is. What remains is a decision, and decisions can be read.</p><figure><figcaption>An "
    "old map of the coast.</figcaption></figure><p>Read them with care.</p>"
    '<div class="share" data-label="0"><a href="/s">Share</a></div><section class="comments" data-label="0"><h3>Comments</h3>'
    '<div class="comment"><p>Great read, thank you for this!</p></div><div class="comment"><p>I do not agree with it at all.</p></div>'
    '<form class="reply"><p>Leave a reply</p></form></section></article><aside data-label="0" class="promo"><p>Get the app.</p></aside>'
    '<footer data-label="0"><div class="legal">Legal notice</div></footer></body>',
    '<body><div class="header" data-label="0"><p>The Daily Page</p></div><div class="page"><div class="post entry" data-label="1"><h1>Rain</h1>'
    "<p>It rained for nine days.</p><p>On the tenth the river was calm again, and we went out to see what was left of the road.</p>"
    '<table><tr><td>Monday</td><td>41 mm</td></tr></table></div><div class="advert" data-label="0"><p>Sponsored: umbrellas at half price.</p>'
    '</div></div><form class="newsletter" data-label="0"><p>Sign up for news.</p></form><div class="copyright" data-label="0">2020</div></body>',
)


@dataclass
class Block:
    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    label: str | None = None
    within: frozenset[str] = frozenset()
    words: int = 0
    linked: int = 0
    ends: bool = False
    children: int = 0


@dataclass
class Page:
    """Blocks with parents before children, and the runs of text with their blocks, in order."""

    blocks: list[Block] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)


def _tags(source: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(start, end, whether it is an end tag, name, attributes); the name of a comment is None.

    What an element of ``_RAW`` holds belongs to its tag.
    """
    at = 0
    while (m := _TOKEN.search(source, at)) is not None:
        at = m.end()
        name = m[2] or m[5]
        tag = name.lower() if name else None
        ending = bool(m[1] or m[4])
        if tag in _RAW and not ending:
            end = re.compile(f"</{tag}[\\s/>]", re.I).search(source, at)
            stop = source.find(">", end.start()) if end else -1
            at = stop + 1 if stop >= 0 else len(source)
        yield m.start(), at, ending, tag, m[3] or ""


def _ended(source: str) -> set[int]:
    """Starts of the hidden elements that have an end tag of their own."""
    found: set[int] = set()
    begun: dict[str, list[int]] = {}
    for start, _, ending, tag, attributes in _tags(source):
        if tag in _HIDDEN and not (tag in ("svg", "math") and attributes.endswith("/")):
            places = begun.setdefault(tag, [])
            if not ending:
                places.append(start)
            elif places:
                found.add(places.pop())
    return found


def parse(source: str) -> Page:
    page = Page([Block("html", -1)])
    open_tags: list[tuple[str, int]] = [("html", 0)]  # open elements and their blocks
    # What is open, so that a tag that meets nothing is not looked for: blocks by name, their depths,
    # and of each the other elements in it by name.
    opened: Counter = Counter()
    solid: list[int] = [0]
    loose: list[Counter] = [Counter(), Counter()]
    pieces: list[str] = []
    veils: list[tuple[int, bool]] = []  # open hidden elements: their depths, and whether an end tag is to come
    ended: set[int] | None = None
    links = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            place = open_tags[-1][1]
            block = page.blocks[place]
            block.words += text.count(" ") + 1
            block.ends = block.ends or text[-1] in ".!?\"'"
            page.runs.append((place, text))

    def close(depth: int) -> None:
        nonlocal links
        while len(open_tags) > depth:
            tag, _ = open_tags[-1]
            if tag in _BLOCKS:
                flush()
            open_tags.pop()
            if tag in _BLOCKS:
                opened[tag] -= 1
                solid.pop()
                loose.pop()
            else:
                loose[-1][tag] -= 1
            if veils and veils[-1][0] == len(open_tags):
                veils.pop()
            links -= tag == "a"

    def unveil(tag: str | None) -> None:
        """Close the hidden elements that end at an opening tag, or at text (None)."""
        while veils:
            depth, closed = veils[-1]
            own = open_tags[depth][0]
            if own == "head":
                ends = tag not in _IN_HEAD
            elif closed or tag is None:
                ends = False
            else:
                in_head = len(veils) > 1 and open_tags[veils[-2][0]][0] == "head"
                ends = tag in _BLOCKS or tag == own or in_head and tag not in _IN_HEAD
            if not ends:
                break
            close(depth)

    def say(text: str) -> None:
        if veils and text and not text.isspace():
            unveil(None)
        if text and not veils:
            pieces.append(text)
            if links:
                page.blocks[open_tags[-1][1]].linked += len(text.split())

    at = 0
    for start, end, ending, tag, attributes in _tags(source):
        say(source[at:start])
        at = end
        if tag is None:
            continue
        if ending:
            if tag == "br" or tag == "p" and not opened["p"]:
                say(" ")
            elif tag in _BLOCKS:
                if opened[tag]:
                    close(next(depth for depth in reversed(solid) if open_tags[depth][0] == tag))
            elif loose[-1][tag]:  # an inline end tag does not close blocks
                close(next(d for d in range(len(open_tags) - 1, 0, -1) if open_tags[d][0] == tag))
            continue
        if veils:
            unveil(tag)
        if tag in _RAW:
            continue
        if tag in _VOID and tag != "hr":
            say(" ")
            continue
        if tag in _BLOCKS and any(opened[own] for own in _CLOSED_BY[tag]):
            for depth in solid[::-1]:
                own = open_tags[depth][0]
                if own in _CLOSES and tag in _CLOSES[own]:
                    close(depth)
                    if own == tag or own == "p":
                        break
                elif own in _SCOPES.get(tag, ()) or tag not in _CLOSES:
                    break
        if tag in ("html", "hr"):
            flush()
            continue
        if tag in _BLOCKS:
            flush()
            parent = open_tags[-1][1]
            hints: tuple[str, ...] = ()
            label = None
            if attributes:
                hints = tuple(sorted({
                    w for v in _ATTRIBUTE.findall(attributes) for w in _HINT_WORD.findall(v.lower()) if w in _HINTS}))
                if "data-label" in attributes:
                    label = "1" if 'data-label="1"' in attributes else "0"
            page.blocks[parent].children += 1
            above = page.blocks[parent]
            own = {above.tag} & _TELLING | set(above.hints)
            within = above.within if own <= above.within else above.within | own
            page.blocks.append(Block(tag, parent, hints, label, within))
            opened[tag] += 1
            solid.append(len(open_tags))
            loose.append(Counter())
            open_tags.append((tag, len(page.blocks) - 1))
        elif tag in ("svg", "math") and attributes.endswith("/"):
            continue
        else:
            loose[-1][tag] += 1
            open_tags.append((tag, open_tags[-1][1]))
            if tag in _HIDDEN:
                if ended is None and tag not in ("head", "template"):
                    ended = _ended(source)
                veils.append((len(open_tags) - 1, tag == "template" or tag != "head" and start in ended))
            links += tag == "a"
    say(source[at:])
    close(0)
    return page


def features(block: Block, plain: bool = False) -> list[str]:
    tag = _PLAIN.get(block.tag, block.tag) if plain else block.tag
    found = [f"tag {tag}", f"words {min(block.words.bit_length(), 4)}"]
    if block.words:
        found.append(f"linked {min(3, 4 * block.linked // block.words)}")
        found.append(f"ends {block.ends}")
    found += [f"hint {h}" for h in block.hints]
    found += [f"within {h}" for h in block.within if not (plain and h in _PLAIN)]
    return found


def _top(block: Block) -> int:
    """1 for the page itself, whose children are of any kind; elsewhere states seldom change."""
    return int(block.tag in ("html", "body"))


def _labels(page: Page, given: bool) -> list[int] | None:
    """States of the blocks: by ``data-label``, or by the page's own article; None if it has none."""
    states = [0] * len(page.blocks)
    content = False
    for place, block in enumerate(page.blocks):
        state = states[block.parent] if block.parent >= 0 else 0
        if given:
            state = int(block.label) if block.label is not None else state
        elif block.tag in ("article", "main"):
            state, content = 1, True
        elif block.tag in ("nav", "aside", "footer", "form") or {"comment", "comments", "ad", "ads"} & set(block.hints):
            state = 0
        states[place] = state
    return states if given or content else None


def counted(source: str, given: bool = False) -> Counter:
    """Counts of (what, state) of one labelled page, empty if the page has no label."""
    page = parse(source)
    states = _labels(page, given)
    found: Counter = Counter()
    if states is None:
        return found
    found[("page", 1)] = 1
    for plain in (False, True):
        for block, state in zip(page.blocks, states):
            found[("state", state)] += 1
            if block.parent >= 0:
                found[(f"under {states[block.parent]} {_top(page.blocks[block.parent])}", state)] += 1
            for f in features(block, plain):
                found[(f, state)] += 1
    return found


@dataclass(frozen=True)
class Model:
    """``follow[top][s][t]``: how likely a block of state t is under one of state s; ``odds`` per feature."""

    follow: list[list[list[float]]]
    odds: dict[str, float]

    @classmethod
    def of(cls, counts: Counter) -> Model:
        total = [counts[("state", s)] + 2.0 for s in (0, 1)]
        follow = []
        for top in (0, 1):
            rows = [[counts[(f"under {s} {top}", t)] + 0.5 for t in (0, 1)] for s in (0, 1)]
            follow.append([[n / sum(row) for n in row] for row in rows])
        names = {name for name, _ in counts if name not in ("page", "state") and not name.startswith("under")}
        odds = {
            name: math.log((counts[(name, 1)] + 0.5) / total[1]) - math.log((counts[(name, 0)] + 0.5) / total[0])
            for name in names
        }
        return cls(follow, odds)

    def marginals(self, page: Page) -> list[float]:
        """The probability of being content for each block, by sum-product over the tree."""
        blocks = page.blocks
        n = len(blocks)
        odds = self.odds
        follow = [self.follow[_top(blocks[b.parent])] if b.parent >= 0 else None for b in blocks]
        # Messages and beliefs as the chance of state 1.
        own = [0.0] * n  # log odds of the block itself and of the messages from its children
        message = [0.5] * n  # to the parent
        for place, block in enumerate(blocks):
            own[place] = sum(odds.get(f, 0.0) for f in features(block))
        for place in range(n - 1, 0, -1):
            (f00, f01), (f10, f11) = follow[place]
            p = _chance(own[place])
            zero, one = f00 * (1 - p) + f01 * p, f10 * (1 - p) + f11 * p
            message[place] = one / (zero + one)
            own[blocks[place].parent] += math.log(one / zero)
        belief = own[:]
        belief[0] = own[0] - 6.0  # a page as a whole is not content
        for place in range(1, n):
            (f00, f01), (f10, f11) = follow[place]
            m = message[place]
            p = _chance(belief[blocks[place].parent] - math.log(m / (1 - m)))
            zero, one = f00 * (1 - p) + f10 * p, f01 * (1 - p) + f11 * p
            belief[place] = own[place] + math.log(one / zero)
        return [_chance(b) for b in belief]


def _chance(odds: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def main_text(source: str | None, model: Model) -> str:
    if not source:
        return ""
    page = parse(source)
    content = model.marginals(page)
    return "\n".join(text for place, text in page.runs if content[place] >= 0.5)


def fit(pages: DataFrame, page_id: str = "page_id", source: str = "html", sample: int = SAMPLE) -> Model:
    """Potentials from at most ``sample`` pages, those with the least hash of their id."""
    some = pages.where(F.col(source).isNotNull()).select(F.col(page_id).alias("id")).orderBy(
        F.xxhash64("id"), "id").limit(sample)
    texts = pages.select(F.col(page_id).alias("id"), F.col(source).alias("source")).join(
        F.broadcast(some.distinct()), "id")  # bounded by ``sample``

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for frame in frames:
            for text in frame["source"].dropna():
                total.update(counted(text))
        yield pd.DataFrame([(f, s, n) for (f, s), n in total.items()], columns=["name", "state", "n"])

    rows = texts.mapInPandas(count, "name string, state int, n long").groupBy("name", "state").agg(F.sum("n").alias("n"))
    counts = Counter({(r["name"], r["state"]): r["n"] for r in rows.collect()})  # a fixed set of features
    weight = max(1, counts[("page", 1)] // _EXAMPLE_SHARE)
    for example in EXAMPLES:
        for key, n in counted(example, given=True).items():
            counts[key] += weight * n
    return Model.of(counts)


def extracted(
    pages: DataFrame, page_id: str = "page_id", source: str = "html", sample: int = SAMPLE, into: str = "_text",
) -> DataFrame:
    """All columns of ``pages`` and ``into``, the main text; no column of ``pages`` may have that name."""
    model = fit(pages, page_id, source, sample)

    @F.pandas_udf("string")
    def text(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s, model) for s in sources], dtype=object)

    return pages.withColumn(into, text(F.coalesce(F.col(source), F.lit(""))))
