"""Main text of web pages: flat text blocks, classified by a decision tree over their own and their neighbours' features."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from terraquilt.llm.common import text_of

#: Elements that begin and end a block.
_BLOCKS = frozenset("""
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot
    th thead tr ul
""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page: up to the next end tag, or to the one that belongs to them.
_RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
_NESTED_RAW = frozenset("svg object canvas select button noscript template".split())
#: Of these an element that nothing ends is no more than its tag; others take the rest of the page.
_MAY_STAY_OPEN = frozenset("title button object noscript".split())
#: Which open elements a start tag closes, up to the nearest of the boundaries.
_CLOSES = {
    **{t: (frozenset("p".split()), frozenset("body article aside section div li td th blockquote main form nav header footer".split()))
       for t in _BLOCKS - frozenset("html body caption tbody tfoot thead tr td th li dd dt option optgroup summary legend figcaption".split())},
    "li": (frozenset(["li"]), frozenset("ul ol menu dir nav".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())),
    "th": (frozenset("td th".split()), frozenset("tr table".split())),
}
_MARKUP = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[\"'>]")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
#: Words that say nothing of what a class such as share-buttons or ad-container marks; any other one makes it a weak mark.
_HOLDERS = frozenset("""
    area bar block bottom box btn button buttons card cards cell center col column container content footer group head heading holder icon
    icons inner item items left line link links list message outer page panel post posts right row section site slot space story stories
    strip title top unit wrap wrapper zone
""".split())
#: Elements that are text themselves: a class of several words on one is a weak mark.
_TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: In a class such as has-sidebar, no-comments or ad-free, words that say what the others are not.
_LAYS_OUT = frozenset("has have with no not non without".split())
_LACKS = frozenset("free less".split())

#: Parts of a page that an element stands for, by its name or by the words of its class, id and role.
PARTS = ("menu", "header", "footer", "side", "notice", "advert", "form", "comment", "hidden")
_BY_TAG = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "dialog": "notice",
           "fieldset": "form", "label": "form", "option": "form"}
_BY_WORD = {
    "menu": "nav navbar navigation menu menubar submenu breadcrumb breadcrumbs toc pagination pager tabs skip skiplink sitemap",
    "header": "header masthead topbar banner branding logo siteheader pagetop",
    "footer": "footer colophon copyright siteinfo bottombar contentinfo",
    "side": "sidebar aside side rail widget widgets related recommended recommendations recirc trending popular complementary share sharing social tags",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay newsletter subscribe subscription signup paywall toast disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising adsense adslot adbox adunit sponsor sponsored sponsors promo promoted promotion dfp taboola outbrain",
    "form": "form search searchbox login signin register input",
    "comment": "comment comments commentlist replies reply respond disqus discussion discussions review reviews",
}
_PART_OF = {word: part for part, words in _BY_WORD.items() for word in words.split()}
_MAIN_TAGS = frozenset(("article", "main"))
_MAIN_WORDS = frozenset("article articlebody post story entry main content maincontent".split())


@dataclass(frozen=True, eq=False)
class Mark:
    """Parts that an open element stands for, and the mark around it."""

    parts: frozenset[str]
    above: Mark | None


@dataclass
class Block:
    text: str
    words: int
    link_share: float
    parts: frozenset[str]
    inside: bool  # an article or main element is open
    heading: bool
    listed: bool  # in a list or table
    weak: bool = False  # a class names a part among other things
    mark: Mark | None = None  # the innermost one
    main: int = -1  # the number of the innermost open main element
    around: Mark | None = None  # the innermost mark of that element or of what contains it


@dataclass
class _Open:
    tag: str
    parts: frozenset[str]
    inside: bool
    weak: bool = False
    mark: Mark | None = None
    main: int = -1
    around: Mark | None = None


def _marking(value: str) -> list[str]:
    """The words of a class, id or role that name what the element is; those of has-sidebar, no-comments or ad-free don't."""
    out = []
    for name in value.split():
        words = [w for w in _SPLIT.split(name) if w]
        for i, word in enumerate(words):
            if word in _LAYS_OUT:
                break
            if i + 1 == len(words) or words[i + 1] not in _LACKS:
                out.append(word)
    return out


def _parts(tag: str, attributes: str, inside: bool) -> tuple[set[str], bool, bool]:
    """Parts that an element opens, whether a class marks it weakly, and whether it is a main one.

    A class marks weakly if it has other words than parts and holders (form-factor, review-body), or several words on an
    element that is text itself (a paragraph tags-intro): it may as well say what the text is about.
    """
    parts: set[str] = set()
    weak = False
    main = tag in _MAIN_TAGS
    if tag in _BY_TAG and not (tag == "header" and inside):  # the header of an article is its own
        parts.add(_BY_TAG[tag])
    if attributes and tag not in ("body", "html"):
        for name, value in _NAMES.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                parts.add("hidden")
            elif name in ("class", "id", "role"):
                for one in value.split():
                    words = _marking(one)
                    found = {_PART_OF[w] for w in words if w in _PART_OF}
                    if inside:
                        found.discard("header")
                    others = [w for w in words if w not in _PART_OF and w not in _HOLDERS and len(w) > 2]
                    if found and (others or tag in _TEXTS and len(words) > 1):
                        weak = True
                    else:
                        parts |= found
                words = _marking(value)
                main = main or not parts and any(w in _MAIN_WORDS for w in words) and tag in ("div", "section", "td")
    return parts, weak, main


class _TagEnds:
    """Where tags end: at the first ``>`` outside quotes, or where quotes don't close, at the first one.

    A quote from which no end was found is remembered, so that no part of a page is looked through for
    every tag in it.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.dead: set[int] = set()

    def after(self, at: int) -> int:
        """The place after the tag whose name ends at ``at``; 0 without any."""
        seen, i = [], at
        while found := _STOP.search(self.page, i):
            j, quote = found.start(), found.group()
            if quote == ">":
                return j + 1
            if j in self.dead or j >= self.last[quote]:
                break
            seen.append(j)
            i = self.page.find(quote, j + 1) + 1
        self.dead.update(seen)
        return self.page.find(">", at) + 1


class _RawEnds:
    """Where raw elements end."""

    def __init__(self, page: str):
        self.page = page
        self.pairs: dict[str, dict[int, int]] = {}
        self.open_ended: set[str] = set()

    def close(self, tag: str, start: int, at: int) -> int:
        """The place of the end tag of the element whose tag starts at ``start`` and ends at ``at``; -1 without one."""
        if tag in _NESTED_RAW:
            if tag not in self.pairs:
                self.pairs[tag] = self._paired(tag)
            return self.pairs[tag].get(start, -1)
        if tag in self.open_ended:
            return -1
        found = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(self.page, at)
        if not found:
            self.open_ended.add(tag)
        return found.start() if found else -1

    def _paired(self, tag: str) -> dict[int, int]:
        pairs, opened = {}, []
        for found in re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).finditer(self.page):
            if not found.group(1):
                opened.append(found.start())
            elif opened:
                pairs[opened.pop()] = found.start()
        return pairs


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page in page order, without empty ones.

    Broken markup is read as far as it goes: an end tag closes what is open inside its element, or
    nothing if the element isn't open; unclosed elements end with the page; a comment, declaration or raw element
    without an end takes the rest. The time grows with the length of the page, whatever is in it.
    """
    out: list[Block] = []
    stack: list[_Open] = []
    count: dict[str, int] = {}
    pieces: list[str] = []
    linked = 0
    total = 0
    opened = 0
    tags, raws = _TagEnds(page), _RawEnds(page)

    def flush() -> None:
        nonlocal linked, total
        text = " ".join("".join(pieces).split())
        if text:
            top = stack[-1] if stack else None
            out.append(Block(
                text, len(text.split()), min(1.0, linked / total) if total else 0.0, top.parts if top else frozenset(),
                top.inside if top else False, any(count.get(f"h{i}") for i in range(1, 7)),
                bool(count.get("li") or count.get("td") or count.get("dd")), *((top.weak, top.mark, top.main, top.around) if top else ()),
            ))
        pieces.clear()
        linked = total = 0

    def pop() -> None:
        count[stack.pop().tag] -= 1

    def add(text: str) -> None:
        nonlocal linked, total
        text = html.unescape(text) if "&" in text else text
        pieces.append(text)
        total += len(text)
        linked += len(text) if count.get("a") else 0

    at = 0
    while True:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at:found.start()])
        at = found.end()
        if found.group(2) is None:
            closing = "-->" if found.group() == "<!--" else ">"
            end = page.find(closing, at)
            if end < 0:
                break
            at = end + len(closing)
            continue
        tag = found.group(2).lower()
        end = tags.after(at)
        if not end:
            break
        attributes = page[at:end - 1]
        at = end
        block = tag in _BLOCKS
        if found.group(1):
            if block:
                flush()
            if count.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in _RAW or tag in _NESTED_RAW and not attributes.endswith("/"):
            close = raws.close(tag, found.start(), at)
            if close < 0 and tag not in _MAY_STAY_OPEN:
                break
            if close >= 0:
                at = page.find(">", close) + 1
                if not at:
                    break
            continue
        if block:
            flush()
            closes, bounds = _CLOSES.get(tag, (frozenset(), frozenset()))
            if any(count.get(t) for t in closes):
                depth = len(stack) - 1
                while depth >= 0 and stack[depth].tag not in closes and stack[depth].tag not in bounds:
                    depth -= 1
                if depth >= 0 and stack[depth].tag in closes:
                    while len(stack) > depth:
                        pop()
        elif tag == "br":
            pieces.append(" ")
        if tag in _VOID or attributes.endswith("/") and tag not in _BLOCKS:
            continue
        above = stack[-1] if stack else _Open("", frozenset(), False)
        parts, weak, main = _parts(tag, attributes, above.inside)
        opened += 1
        mark = Mark(frozenset(parts), above.mark) if parts else above.mark
        stack.append(_Open(
            tag, above.parts | parts if parts else above.parts, above.inside or main,
            # what a class around the main element says is of the page, not of a part
            not main and (weak or above.weak), mark, *((opened, mark) if main else (above.main, above.around)),
        ))
        count[tag] = count.get(tag, 0) + 1
    flush()
    _unmark_main(out)
    return out


def _unmark_main(blocks: list[Block]) -> None:
    """Take back the marks of elements that are or contain the page's main element, as of <article class="review">.

    It is the one with most words that nothing within it marks, if it has more than all unmarked
    blocks in main elements or, on a page without those, than all unmarked text outside. Where there are
    some, a comment is no candidate. What is hidden stays so.
    """
    clean = sum(b.words for b in blocks if b.inside and not b.parts)
    words: dict[int, int] = {}
    around: dict[int, Mark] = {}
    for b in blocks:
        if b.inside and b.parts and b.mark is b.around and "hidden" not in b.parts and not (clean and "comment" in b.parts):
            words[b.main] = words.get(b.main, 0) + b.words
            around[b.main] = b.mark
    if not words:
        return
    largest = max(words, key=words.__getitem__)
    if words[largest] <= (clean or sum(b.words for b in blocks if not b.inside and not b.parts and b.link_share < 0.5)):
        return
    left: dict[Mark | None, frozenset[str]] = {None: frozenset()}
    taken = around[largest]
    while taken is not None:
        left[taken], taken = frozenset(), taken.above
    for b in blocks:
        below, mark = [], b.mark
        while mark not in left:
            below.append(mark)
            mark = mark.above
        for inner in reversed(below):
            left[inner] = left[inner.above] | inner.parts
        b.parts = left[b.mark]


#: place: 2 inside a main element, 0 outside of those that the page has, 1 on a page without one.
#: weak: a class names a part among other things.
FEATURES = ("in_part", "weak", "place", "words", "link_share", "words_before", "link_share_before", "words_after", "link_share_after",
            "heading", "listed")


def _has_main(blocks: Sequence[Block]) -> bool:
    """Whether some block is of a main element that isn't a part, as reader comments in articles are."""
    return any(b.inside and not b.parts for b in blocks)


def features_of(blocks: Sequence[Block]) -> np.ndarray:
    """One row a block, in the order of FEATURES; a missing neighbour has no words and no links."""
    n = len(blocks)
    own = np.array([(b.words, b.link_share) for b in blocks], float).reshape(n, 2)
    none = np.zeros((1, 2))
    before, after = np.vstack([none, own[:-1]])[:n], np.vstack([own[1:], none])[:n]
    outside = 0 if _has_main(blocks) else 1
    where = np.array([(bool(b.parts), b.weak, 2 if b.inside else outside) for b in blocks], float).reshape(n, 3)
    form = np.array([(b.heading, b.listed) for b in blocks], float).reshape(n, 2)
    return np.hstack([where, own, before, after, form])


@dataclass
class DecisionTree:
    """Binary splits by least Gini impurity, as nested nodes."""

    keep: bool = False
    feature: int = -1
    value: float = 0.0
    low: DecisionTree | None = field(default=None, repr=False)
    high: DecisionTree | None = field(default=None, repr=False)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, depth: int = 8) -> DecisionTree:
        """Splits at the middle of two values; of equally good ones the first feature's. Stops at pure nodes."""
        node = DecisionTree(bool(y.mean() >= 0.5))
        if depth == 0 or y.min() == y.max():
            return node
        best = (2 * y.mean() * (1 - y.mean()) * len(y) - 1e-9, -1, 0.0)
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for cut in (values[1:] + values[:-1]) / 2:
                sides = (y[x[:, j] <= cut], y[x[:, j] > cut])
                impurity = sum(2 * s.mean() * (1 - s.mean()) * len(s) for s in sides)
                if impurity < best[0] - 1e-9:
                    best = (impurity, j, float(cut))
        if best[1] < 0:
            return node
        node.feature, node.value = best[1:]
        goes = x[:, node.feature] <= node.value
        node.low, node.high = DecisionTree.fit(x[goes], y[goes], depth - 1), DecisionTree.fit(x[~goes], y[~goes], depth - 1)
        return node

    def predict(self, row: Sequence[float]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.value else node.high
        return node.keep


def main_text(page: str, tree: DecisionTree) -> str:
    blocks = blocks_of(page)
    rows = features_of(blocks).tolist()
    return "\n".join(b.text for b, row in zip(blocks, rows) if tree.predict(row))


@lru_cache(maxsize=1)
def trained_tree() -> DecisionTree:
    """The tree fitted on the small labelled table of ``html_examples``; pages with a main element, the usual ones, count fivefold."""
    from terraquilt.llm.html_examples import EXAMPLES

    x, y = [], []
    for page, kept in EXAMPLES:
        blocks = blocks_of(page)
        times = 5 if _has_main(blocks) else 1
        x += [features_of(blocks)] * times
        y += [block.text in kept for block in blocks] * times
    return DecisionTree.fit(np.vstack(x), np.array(y, float))


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text and n_chars (code points) of every page, from the whole html.

    A NULL or empty page, or one without a block of main text, has the empty text. Blocks keep page
    order, one line each; white space inside a block is one space; nothing of a kept block is cut. Repeated
    pages are extracted alike; other columns are left out. No shuffle.
    """
    tree = trained_tree()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, tree) for p in batch.column("_page").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array(list(map(len, texts)), pa.int64()),
            })

    chosen = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), text_of(page).alias("_page"))
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, url)]
    found = chosen.mapInArrow(extract, f"key {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return found.toDF(key, url, "text", "n_chars")
