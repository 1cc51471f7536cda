"""Main text of a page by the contiguous region of highest score.

A page is a sequence of words and tags. Words score positive, tags negative, and one linear
scan finds the contiguous run with the largest sum. What lies in elements known as menus,
forms and the like scores nothing and is left out of the region. All this is learned from a
bounded set of labelled pages: which elements to leave out by how many of their words belong
to the main text, first scores of tags by how many of them lie outside of it, and these are
mended by a perceptron on the best regions. Usual names of elements and classes judge only
what no labelled page has shown.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meterline.llm.bpe import per_text

# Names of elements and usual words in their classes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "template", "noscript", "svg", "math"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
ASIDE = {"head", "nav", "aside", "footer", "form", "menu", "dialog", "button", "select", "option", "object", "canvas", "audio", "video", "map", "fieldset", "label"}
MAIN = {"article", "main"}
ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "banner", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb",
    "breadcrumbs", "footer", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal",
    "overlay", "newsletter", "subscribe", "signup", "login", "share", "sharing", "social", "comment",
    "comments", "reply", "replies", "respond", "disqus", "related", "recommended", "recommendations",
    "widget", "toolbar", "pagination", "pager", "copyright", "complementary", "contentinfo", "search",
    "alert", "alertdialog",
}
HEADER_WORDS = {"header", "masthead", "banner", "topbar"}  # outside of articles only
NOT_HIDDEN = {"html", "body", "article", "main"}
NEGATING = {"has", "no", "with", "without"}  # what follows in a class does not name the element
CLOSES = {  # an opened element ends an open one of these, looking no further than the stops
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPH_STOPS = {"td", "th", "li", "button", "object", "table"}

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

WORD_SCORE = 1.0
LINK_WORD_SCORE = 0.3
TAG_SCORE = -0.05
TAG_SCORES = {"a": -0.3, "li": -0.2, "div": -0.3, "td": -0.2, "tr": -0.2, "ul": -0.3, "table": -0.3}
LEAST_TAG_SCORE = -50.0
LEAST_PROSE_SCORE = -0.2  # so that no paragraph of one word is lost
PROSE = INLINE | {"p", "br", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "pre", "blockquote"}
EPOCHS = 3
LEARNING_RATE = 0.05
TAG_SUPPORT = 5  # tags that the default score counts as
LEAST_SUPPORT = 20  # words that must be seen in an element before it is judged
MOST_MAIN_SHARE = 0.1  # of them, for it to be left out
LEAST_MAIN_SHARE = 0.5  # of them, for it to stay whatever its name


@dataclass(frozen=True)
class Weights:
    """What labelled pages teach of keys; a key is a name or name.word.

    Scores of tags, elements to leave out, and elements that hold main text. Only keys that no
    labelled page has shown are judged by the usual names, and those only with ``usual``.
    """

    tags: dict[str, float] = field(default_factory=dict)
    aside: frozenset[str] = frozenset()
    main: frozenset[str] = frozenset()
    usual: bool = True


@dataclass(frozen=True)
class Token:
    """A tag (``key``) or a run of text; ``aside`` if it lies in an element to leave out."""

    key: str
    text: str
    block: bool  # whether it parts blocks
    aside: bool
    link: bool  # text inside a link


@dataclass
class Element:
    """An element in the order of the page; ``last`` is the number of the last one within."""

    number: int
    name: str
    keys: tuple[str, ...]
    up: Element | None
    named: bool  # to leave out by its name, or as learned
    worded: bool  # by a word of its class
    in_main: bool  # what is around it, so that no step looks through all that is open
    link: bool
    first: tuple[str, ...]  # its keys that nothing around it has
    hiding: Element | None = None  # the innermost to leave out by name or word, itself included
    closed: bool = False
    last: int = 0
    words: int = 0
    plain: int = 0  # words outside of links and named ones
    named_within: bool = False
    aside: bool = False


def keys_of(name: str, rest: str) -> tuple[str, ...]:
    words: dict[str, None] = {}
    for match in NAMING.finditer(rest) if "=" in rest else ():
        for each in (match[1] or match[2] or match[3] or "").split():
            parts = [word.lower() for word in WORD.findall(each)]
            cut = next((i for i, word in enumerate(parts[:-1]) if word in NEGATING), len(parts))
            words |= dict.fromkeys(parts[:cut])
            if cut < len(parts):
                words["-".join(parts[cut:])] = None
    return (name, *(f"{name}.{word}" for word in words))


def is_named(name: str, keys: tuple[str, ...], in_main: bool, weights: Weights) -> bool:
    if name in NOT_HIDDEN:
        return False
    if not weights.aside.isdisjoint(keys) or name == "head":
        return True
    usual = name in ASIDE or (name == "header" and not in_main)
    return usual and weights.usual and name not in weights.main


def is_worded(name: str, keys: tuple[str, ...], in_main: bool, weights: Weights) -> bool:
    words = {key.partition(".")[2] for key in keys[1:] if key not in weights.main}
    if not weights.usual or name in NOT_HIDDEN - {"article"}:
        return False
    return bool(words & ASIDE_WORDS or (name != "article" and not in_main and words & HEADER_WORDS))


class Page:
    """Reads a page into tokens, with the elements open at each.

    Which elements are left out is known at the end of the page. A word of a class tells so
    only of an element without most of the page's words (links aside), unless the main article
    or element lies beside it; an article whose class says so is left out in such an element,
    in the main article and behind it. The main article (the one of most words) counts even inside an element
    to leave out, if no more words lie outside of all such. Other articles there do not.
    """

    def __init__(self, weights: Weights):
        self.weights = weights
        self.never_closed: set[int] = set()
        self.reset()

    def reset(self) -> None:
        self.open: list[Element] = []
        self.elements: list[Element] = []
        self.around_main: set[int] = set()
        # Places in the open elements by name, of those to leave out, and of the never closed.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.hides: list[int] = []
        self.never: list[int] = []
        self.keys_open: Counter[str] = Counter()

    def marks(self, e: Element) -> list[list[int]]:
        """The lists of places that an element stands in."""
        lists = [self.places[e.name]]
        if e.hiding is e:
            lists.append(self.hides)
            if e.number in self.never_closed:
                lists.append(self.never)
        return lists

    def push(self, e: Element) -> None:
        for places in self.marks(e):
            places.append(len(self.open))
        self.keys_open.update(e.keys)
        self.open.append(e)
        self.elements.append(e)

    def cut(self, at: int) -> None:
        """Leave all elements from a place on; each is left once, so pages take linear time."""
        while len(self.open) > at:
            e = self.open.pop()
            for places in self.marks(e):
                places.pop()
            self.keys_open.subtract(e.keys)

    def last_of(self, names: set[str]) -> int:
        return max((self.places[name][-1] for name in names if self.places[name]), default=-1)

    def pop_to(self, names: set[str], stops: set[str]) -> None:
        at = self.last_of(names)
        if at > self.last_of(stops):
            self.open[at].closed = True
            self.cut(at)

    def start(self, name: str, rest: str) -> tuple[str, ...]:
        if name in CLOSES:
            self.pop_to(*CLOSES[name])
        elif name not in INLINE and name not in VOID:
            self.pop_to({"p"}, PARAGRAPH_STOPS)
        # Main text is not part of a menu that was never closed.
        if name in MAIN:
            hiding = self.open[-1].hiding if self.open else None
            while hiding and hiding.number not in self.around_main:
                self.around_main.add(hiding.number)
                hiding = hiding.up.hiding if hiding.up else None
            self.cut(self.never[0] if self.never else len(self.open))
        elif name == "body":
            self.cut(self.hides[0] if self.hides else len(self.open))
        keys = keys_of(name, rest)
        if name not in VOID and not rest.endswith("/>"):
            up, number = self.inner(), len(self.elements)
            in_main = bool(up and (up.in_main or up.name in MAIN))
            named = is_named(name, keys, in_main, self.weights)
            worded = is_worded(name, keys, in_main, self.weights)
            link = name == "a" or bool(up and up.link)
            first = tuple(k for k in keys if not self.keys_open[k])
            e = Element(number, name, keys, up, named, worded, in_main, link, first, last=number)
            e.hiding = e if named or worded else up.hiding if up else None
            self.push(e)
        return keys

    def end(self, name: str) -> tuple[str, ...]:
        at = self.last_of({name})
        if at < 0:
            return (name,)
        e = self.open[at]
        e.closed = True
        self.cut(at)
        return e.keys

    def tokens(self, page: str) -> list[Token]:
        self.reset()
        parts = list(self.parts(page))
        if never := {i for i in self.around_main if not self.elements[i].closed} - self.never_closed:
            self.never_closed = never
            self.reset()
            parts = list(self.parts(page))
        self.judge(parts)
        self.inners = [e for _, e in parts]
        return [replace(t, aside=True) if not t.aside and e and e.aside else t for t, e in parts]

    def judge(self, parts: list[tuple[Token, Element | None]]) -> None:
        """Tell of each element whether it, or one around it, is left out."""
        if not any(e.named or e.worded for e in self.elements):
            return
        for e in self.elements:
            e.named_within = e.named or bool(e.up and e.up.named_within)
        own, plain, total, loose = Counter(), Counter(), 0, 0  # words right inside each
        for token, e in parts:
            if not token.key:
                n = len(token.text.split())
                if e is None:
                    loose += n
                else:
                    own[e.number] += n
                if not token.link and not (e and e.named_within):
                    total += n
                    if e:
                        plain[e.number] += n
        for e in reversed(self.elements):
            e.words += own[e.number]
            e.plain += plain[e.number]
            if e.up:
                e.up.words += e.words
                e.up.plain += e.plain
                e.up.last = max(e.up.last, e.last)
        best = {}
        for e in self.elements:
            if e.name in MAIN and not e.worded and e.words > (best[e.name].words if e.name in best else 0):
                best[e.name] = e
        article = best.get("article")

        def holds_most(e: Element) -> bool:
            beside = any(m.last < e.number or e.last < m.number for m in best.values())
            return 2 * e.plain > total and not beside

        hides = {e.number for e in self.elements if e.named or (e.worded and e.name != "article" and not holds_most(e))}

        def spread(cleared: set[int]) -> None:
            for e in self.elements:
                within = bool(e.up and e.up.aside)
                if e.name == "article" and e.worded:
                    e.aside = within or bool(article and article.number < e.number)
                else:
                    e.aside = e.number in hides or (within and e.number not in cleared)

        spread(set())
        outside = loose + sum(own[e.number] for e in self.elements if not e.aside)
        if cleared := {m.number for m in best.values() if m.aside and m.words >= outside}:
            spread(cleared)

    def parts(self, page: str) -> Iterator[tuple[Token, Element | None]]:
        """Tokens, each with the innermost element open there."""
        at = 0
        while match := MARKUP.search(page, at):
            if match.start() > at:
                yield self.run(page[at : match.start()]), self.inner()
            at = match.end()
            if match["data"] is not None:
                yield self.run(html.escape(match["data"])), self.inner()
            if not match["name"]:
                continue
            name, block = match["name"].lower(), match["name"].lower() not in INLINE
            if match["end"]:
                was = self.inner()
                yield self.tag(self.end(name), "/", block), was
                continue
            if name in RAW and not match["rest"].endswith("/>"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
                yield self.tag((name,), "", block, True), self.inner()
                continue
            keys = self.start(name, match["rest"])
            yield self.tag(keys, "", block), self.inner()
        if at < len(page):
            yield self.run(page[at:]), self.inner()

    def inner(self) -> Element | None:
        return self.open[-1] if self.open else None

    def tag(self, keys: tuple[str, ...], mark: str, block: bool, aside: bool = False) -> Token:
        known = [k for k in keys if mark + k in self.weights.tags]
        return Token(mark + (known[-1] if known else keys[-1]), "", block, aside, False)

    def run(self, text: str) -> Token:
        link = bool(self.open) and self.open[-1].link
        return Token("", html.unescape(text) if "&" in text else text, False, False, link)


def score(token: Token, weights: Weights) -> float:
    if token.aside:
        return 0.0
    if not token.key:
        return (LINK_WORD_SCORE if token.link else WORD_SCORE) * len(token.text.split())
    known = weights.tags.get(token.key)
    return default_score(token.key) if known is None else known


def default_score(key: str) -> float:
    return TAG_SCORES.get(key.removeprefix("/").partition(".")[0], TAG_SCORE)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum; the first of equals."""
    best = total = 0.0
    start = low = high = 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, low, high = total, start, i + 1
    return low, high


def region_text(tokens: list[Token]) -> str:
    """Blocks without their asides, each with single blanks, joined by a blank."""
    parts = ((" " if t.block else "") if t.key else t.text for t in tokens if t.key or not t.aside)
    return " ".join("".join(parts).split())


def main_text(page: str, weights: Weights) -> str:
    tokens = Page(weights).tokens(page)
    low, high = best_region([score(t, weights) for t in tokens])
    return region_text(tokens[low:high])


def labelled_region(tokens: list[Token], text: str) -> tuple[int, int]:
    """The run of texts found in ``text``, one after the other, that has the most words."""
    whole = " ".join(text.split())
    scores = [0.0] * len(tokens)
    for i, token in enumerate(tokens):
        if not token.key and (run := " ".join(token.text.split())):
            scores[i] = float(len(run.split())) if run in whole else -1e9
    low, high = best_region(scores)
    return low, high


def bounded(key: str, value: float) -> float:
    prose = key.removeprefix("/").partition(".")[0] in PROSE
    return min(TAG_SCORE / 5, max(LEAST_PROSE_SCORE if prose else LEAST_TAG_SCORE, value))


def shares_outside(pages: list[tuple[str, str]], weights: Weights) -> dict[str, float]:
    """First scores of tags: the share of each outside of main texts, drawn to the default."""
    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for page, text in pages:
        tokens = Page(weights).tokens(page)
        low, high = labelled_region(tokens, text)
        for i, token in enumerate(tokens):
            if token.key and not token.aside:
                counts[token.key][low <= i < high] += 1
    return {
        key: bounded(key, (TAG_SUPPORT * default_score(key) - out) / (TAG_SUPPORT + out + main))
        for key, (out, main) in counts.items()
    }


def learn(pages: Iterable[tuple[str, str]], usual: bool = True) -> Weights:
    """Weights from labelled pages, pairs of a page and its main text; none gives the defaults.

    The usual names take no part in learning: classes and elements to leave out, and the scores
    of tags, come from the labels. Without ``usual`` they take none in the extraction either.
    """
    pages = [(p, t) for p, t in pages if p and t]
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for page, text in pages:
        reader = Page(Weights(usual=False))
        tokens = reader.tokens(page)
        low, high = labelled_region(tokens, text)
        words = [[0, 0] for _ in reader.elements]
        for i, (token, e) in enumerate(zip(tokens, reader.inners, strict=True)):
            if not token.key and e:
                words[e.number][low <= i < high] += len(token.text.split())
        for e in reversed(reader.elements):
            for side, n in enumerate(words[e.number]):
                if e.up:
                    words[e.up.number][side] += n
                for key in e.first:
                    seen[key][side] += n
    # Names of general use are not judged, only classes and the elements that pages are made of.
    known = {
        key: main / (out + main)
        for key, (out, main) in seen.items()
        if out + main >= LEAST_SUPPORT and ("." in key or key in ASIDE or key == "header")
    }
    aside = frozenset(key for key, share in known.items() if share <= MOST_MAIN_SHARE)
    shown = frozenset(key for key, share in known.items() if share >= LEAST_MAIN_SHARE)
    weights = Weights({}, aside, shown, usual=False)
    tags = weights.tags
    tags |= shares_outside(pages, weights)
    for _ in range(EPOCHS):
        for page, text in pages:
            tokens = Page(weights).tokens(page)
            wanted = labelled_region(tokens, text)
            found = best_region([score(t, weights) for t in tokens])
            if region_text(tokens[slice(*wanted)]) == region_text(tokens[slice(*found)]):
                continue
            change = Counter(t.key for t in tokens[slice(*wanted)] if t.key and not t.aside)
            change.subtract(t.key for t in tokens[slice(*found)] if t.key and not t.aside)
            for key, n in change.items():
                moved = tags.get(key, default_score(key)) + LEARNING_RATE * n
                tags[key] = bounded(key, moved)
    return replace(weights, usual=usual)


def extract(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """``pages`` with text, the main text of each whole page, and n_chars, its code points.

    A null or empty page, and one without words outside of menus and the like, has an empty
    text. Character references are decoded, white space in a block becomes one blank, blocks
    are joined by one. Pages of any length are scanned once; tags that are never closed or
    never opened do no harm; repeated rows give repeated results.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def work(page: str) -> tuple:
        text = main_text(page, shared.value)
        return text, len(text)

    results = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return per_text(pages, html_col, results, work)
