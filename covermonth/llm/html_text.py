"""Main text of HTML pages from flat blocks.

A page is cut into blocks of text at its block-level tags; nothing of the tree is kept but what
the innermost marked container of a block says: main content, furniture, or neither, and whether a part
of a container's name hints at furniture. Each block
has its word count and link density and those of the blocks before and after. A decision tree, grown on a
small labelled table, says which blocks are main text.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from covermonth.llm.html_pages import LABELLED

# Names of the markup language and of common layouts
BLOCK_TAGS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd",
    "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html",
    "label", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "search",
    "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
RAW_TAGS = ("script", "style", "title", "textarea")  # without an end tag, to the end of the page
SKIPPED_TAGS = {  # from tag to end tag; where that is missing, the tag alone
    "noscript", "template", "svg", "iframe", "object", "select", "canvas", "audio", "video",
    "annotation", "annotation-xml",
}
FURNITURE_TAGS = {
    "nav", "aside", "footer", "form", "button", "dialog", "menu", "fieldset", "select", "label",
}
MAIN_TAGS = {"article", "main"}
FURNITURE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "comment-list", "cookie", "cookies", "cookie-notice",
    "consent", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "alert", "popup", "promo", "promoted", "related",
    "recommended", "share", "sharing", "sidebar", "side-bar", "social", "sponsor", "sponsored",
    "subscribe", "subscription", "toolbar", "widget", "contentinfo", "complementary", "search",
    "discussion", "reactions", "replies", "reply", "respond", "feedback", "disclaimer",
    "copyright", "pagination", "pager", "login", "signup", "register", "paywall", "overlay",
    "gdpr", "adsbygoogle", "taboola", "outbrain",
}
MAIN_NAMES = {
    "content", "main", "article", "article-body", "articlebody", "post", "post-content",
    "post-body", "entry", "entry-content", "story", "story-body", "main-content", "maincontent",
}

# Names of lists whose articles and posts are not the page's own
LISTING_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "comment", "comments",
    "comment-list", "disqus", "promo", "promoted", "related", "recommended", "share", "sharing",
    "social", "sponsor", "sponsored", "discussion", "reactions", "replies", "reply", "respond",
    "adsbygoogle", "taboola", "outbrain",
}
# What an element says of its content
MAIN, NEITHER, NAMED, LISTING, FURNITURE = 1, 0, -1, -2, -3

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTES = re.compile(r"""((?:"[^"]*+"|'[^']*+'|[^'">]++)*+)>""")
_QUOTED = re.compile(r""""[^"]*+"?|'[^']*+'?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW_TAGS}
_UNQUOTED_END = re.compile(r"=[^\s\"'>]*/\Z")  # the slash belongs to the value
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after",
            "context", "outside", "heading", "hint"]
MAX_DEPTH = 5
MIN_LEAF = 2


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    context: int  # 1 main content, -1 furniture, 0 neither
    heading: bool
    hint: int  # 0 none, 1 a part of a name is one of furniture, 2 of a list beside the text

    @property
    def links(self) -> float:
        return self.link_words / self.words


def main_text(page: Column) -> Column:
    """The main text of a page's html: its main blocks in page order, one line each.

    Character references are decoded, white space inside a block is one space. Null, empty and
    textless pages give an empty text. Whole pages are read, of any length; unclosed and stray
    tags are allowed.
    """
    tree = grow(*labelled())
    return F.arrow_udf(lambda pages: pa.array(
        [extract(text or "", tree) for text in pages.to_pylist()], pa.string()), "string")(page)


def extract(text: str, tree: Tree) -> str:
    found = blocks(text)
    if not found:
        return ""
    chosen = tree.predict(features(found))
    return "\n".join(b.text for b, keep in zip(found, chosen, strict=True) if keep)


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    rows, labels = [], []
    for page, marks in LABELLED:
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(found)} blocks, {len(marks)} labels: {page[:80]}")
        rows.append(features(found))
        labels += [mark == "+" for mark in marks]
    return np.concatenate(rows), np.array(labels)


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    own = np.array([[b.words, b.links] for b in found], float)
    none = np.zeros((1, 2))
    # Unmarked blocks of a page that marks its main content lie outside it.
    marked = any(b.context == 1 for b in found)
    context = np.array(
        [[b.context, marked and b.context == 0, b.heading, _weight(b, marked)] for b in found],
        float)
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), context])


def _weight(block: Block, marked: bool) -> int:
    """A hint counts for more outside main content, most on a page that marks its main content."""
    return 2 * block.hint - 1 + (block.context != 1) * (1 + marked) if block.hint else 0


def blocks(page: str) -> list[Block]:
    """Blocks of text of a page, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[int, int]]] = []  # open elements, their context and hint
    parts: list[tuple[str, bool]] = []
    anchors = 0
    heading = False

    def context() -> tuple[int, int]:
        return stack[-1][1] if stack else (NEITHER, 0)

    def flush() -> None:
        if not parts:
            return
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            linked = len("".join(t if a else " " for t, a in parts).split())
            words = len(text.split())
            inner, hint = context()
            found.append(Block(text, words, min(linked, words), max(inner, -1), heading, hint))
        parts.clear()

    at = 0
    for token, end in _visible(page):
        if token.start > at:
            parts.append((html.unescape(page[at:token.start]), anchors > 0))
        at, tag = end, token.tag
        if not tag or tag in RAW_TAGS or tag in SKIPPED_TAGS:
            continue
        if tag == "br":
            parts.append((" ", anchors > 0))
            continue
        if tag == "a":
            anchors = max(0, anchors - 1) if token.close else anchors + 1
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
            anchors = 0
        if token.close:
            if any(name == tag for name, _ in stack):
                # What is still open inside ends with it.
                while stack.pop()[0] != tag:
                    pass
            heading = heading and not block
        elif tag not in VOID_TAGS:  # a slash closes nothing in HTML
            if block and stack and stack[-1][0] in ("p", "li", "td", "th", "tr", "dt", "dd"):
                _close_implied(stack, tag)
            marked = _context(tag, token.attrs, context(), any(n in MAIN_TAGS for n, _ in stack))
            if block or marked != context():
                stack.append((tag, marked))
            if block:
                heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
    if at < len(page):
        parts.append((html.unescape(page[at:]), anchors > 0))
    flush()
    return found


@dataclass
class Token:
    """A tag, or a comment or declaration (without a name)."""

    start: int
    end: int
    tag: str = ""
    close: bool = False
    attrs: str = ""


class _Unclosed:
    """Places that are outside of quotes in a scan that found no end of a tag: a tag that began there
    would have none either."""

    def __init__(self, page: str, at: int) -> None:
        spans = [m.span() for m in _QUOTED.finditer(page, at)]
        self.at = at
        self.starts, self.ends = [s for s, _ in spans], [e for _, e in spans]

    def covers(self, place: int) -> bool:
        k = bisect.bisect_right(self.starts, place) - 1
        return place >= self.at and (k < 0 or place >= self.ends[k])


def _tokens(page: str) -> Iterator[Token]:
    """Tags and comments in order. Each part of the page is read a bounded number of times: a scan to its
    end that fails is remembered, and there are no more of these than kinds of quotes."""
    last = page.rfind(">")
    unclosed: list[_Unclosed] = []
    at = page.find("<")
    while at >= 0:
        token = None
        if m := _COMMENT.match(page, at):
            token = Token(at, m.end())
        elif at > last:
            break
        elif m := not any(u.covers(at) for u in unclosed) and _NAME.match(page, at):
            if rest := _ATTRIBUTES.match(page, m.end()):
                token = Token(at, rest.end(), m[2].lower(), bool(m[1]), rest[1])
            else:
                unclosed.append(_Unclosed(page, m.end()))
        elif page[at + 1] in "!?/":
            token = Token(at, page.index(">", at) + 1)
        if token is None:
            at = page.find("<", at + 1)
            continue
        if token.tag in RAW_TAGS and not token.close and not _self_closed(token.attrs):
            end = _RAW_END[token.tag].search(page, token.end, last + 1)
            token.end = end.end() if end else len(page)
        yield token
        at = page.find("<", token.end)


def _visible(page: str) -> Iterator[tuple[Token, int]]:
    """Tags and comments outside skipped elements, and the end of what each stands for."""
    tokens = list(_tokens(page))
    open_tags: dict[str, list[int]] = {}
    ends: dict[int, int] = {}  # number of a skipped element's tag: of its end tag
    for number, token in enumerate(tokens):
        if token.tag not in SKIPPED_TAGS:
            continue
        if not token.close:
            if not _self_closed(token.attrs):
                open_tags.setdefault(token.tag, []).append(number)
        elif open_tags.get(token.tag):
            ends[open_tags[token.tag].pop()] = number
    number = 0
    while number < len(tokens):
        last = ends.get(number, number)
        yield tokens[number], tokens[last].end
        number = last + 1


def _self_closed(attributes: str) -> bool:
    return attributes.endswith("/") and not _UNQUOTED_END.search(attributes)


def _close_implied(stack: list[tuple[str, tuple[int, int]]], tag: str) -> None:
    """An open paragraph ends at the next block, an item or cell at the next of its kind."""
    if stack[-1][0] == "p":
        stack.pop()
    same = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "dt": {"dt", "dd"},
            "dd": {"dt", "dd"}}.get(tag, set())
    if stack and stack[-1][0] in same:
        stack.pop()
    if tag == "tr" and len(stack) > 1 and stack[-1][0] in ("td", "th") and stack[-2][0] == "tr":
        del stack[-2:]


def _context(
        tag: str, attributes: str, outer: tuple[int, int], in_main: bool) -> tuple[int, int]:
    """What an element says of its content; without a word of its own, what is outside holds.

    Main content may lie in a container that only its name marks: the main element in any, articles
    and main names in those that are no lists of others. A part of a name is a hint and no more.
    """
    context, hint = outer
    if context == FURNITURE or tag in FURNITURE_TAGS:
        return FURNITURE, 0
    names, parts = set(), set()
    if attributes.strip() and tag not in ("html", "body"):
        given = {}
        for m in _ATTRIBUTE.finditer(attributes):
            given[m[1].lower()] = next(g for g in m.groups()[1:] if g is not None)
        names = set(" ".join(given.get(k, "") for k in ("class", "id", "role")).lower().split())
        for name in names:
            if not name.startswith(("with-", "has-", "no-")):
                parts |= set(re.split(r"[_-]+", name))
        if _HIDDEN.search(given.get("style", "")) or given.get("aria-hidden") == "true":
            return FURNITURE, 0
    listing = (names | parts) & LISTING_NAMES
    own = context > LISTING and hint < 2
    if tag == "main" or (names & MAIN_NAMES and own):
        return MAIN, 0
    if names & FURNITURE_NAMES:
        return (LISTING if listing or context == LISTING else NAMED), 0
    if tag == "article" and own and not listing:
        return MAIN, 0
    if tag == "header" and not in_main:
        return min(context, NAMED), hint
    if parts & FURNITURE_NAMES:
        return context, max(hint, 2 if listing else 1)
    return outer


@dataclass
class Tree:
    """A binary decision tree in arrays; leaves have feature -1."""

    feature: list[int]
    limit: list[float]
    low: list[int]
    high: list[int]
    positive: list[bool]

    def predict(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), int)
        feature, limit = np.array(self.feature), np.array(self.limit)
        low, high = np.array(self.low), np.array(self.high)
        while (inner := feature[at] >= 0).any():
            chosen = at[inner]
            below = rows[inner, feature[chosen]] <= limit[chosen]
            at[inner] = np.where(below, low[chosen], high[chosen])
        return np.array(self.positive)[at]


def grow(rows: np.ndarray, labels: np.ndarray) -> Tree:
    """Grow a tree by Gini impurity; of equal cuts the first feature's lowest wins."""
    tree = Tree([], [], [], [], [])

    def node(chosen: np.ndarray, depth: int) -> int:
        here = len(tree.feature)
        tree.feature.append(-1)
        tree.limit.append(0.0)
        tree.low.append(0)
        tree.high.append(0)
        tree.positive.append(bool(labels[chosen].mean() >= 0.5))
        cut = _best_cut(rows[chosen], labels[chosen]) if depth < MAX_DEPTH else None
        if cut:
            tree.feature[here], tree.limit[here] = cut
            below = rows[chosen, cut[0]] <= cut[1]
            tree.low[here] = node(chosen[below], depth + 1)
            tree.high[here] = node(chosen[~below], depth + 1)
        return here

    node(np.arange(len(labels)), 0)
    return tree


def _best_cut(rows: np.ndarray, labels: np.ndarray) -> tuple[int, float] | None:
    total = len(labels)
    share = labels.mean()
    best, found = share * (1 - share) * total - 1e-9, None
    for k in range(rows.shape[1]):
        order = np.argsort(rows[:, k], kind="stable")
        value, ones = rows[order, k], np.cumsum(labels[order])
        count = np.arange(1, total + 1)
        for i in np.flatnonzero(np.diff(value) > 0):
            if count[i] < MIN_LEAF or total - count[i] < MIN_LEAF:
                continue
            left, right = ones[i] / count[i], (ones[-1] - ones[i]) / (total - count[i])
            impurity = left * (1 - left) * count[i] + right * (1 - right) * (total - count[i])
            if impurity < best:
                best, found = impurity, (k, float(value[i] + value[i + 1]) / 2)
    return found
