"""HTML as arrays of nodes: a tolerant reader, and the features of every node."""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from html import unescape

import numpy as np

_TAG = re.compile(
    r"<!--(?:.*?-->|.*)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>",
    re.S)
_HEAD = re.compile(r"<!--(?:.*?-->|.*)|<(/?)([A-Za-z][^\s/>]*+)|<[!?/][^>]*>", re.S)
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_PIECE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_BLANKS = re.compile(r"\s+")
_STOPS = re.compile(r"[.,;:!?。，]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("script style template noscript iframe head title noframes".split())
#: Elements that an open head may hold; any other ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements with drawn or replacement text, nodes of their own within a line; the trees decide on them.
EMBEDDED = frozenset("svg object canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul".split())
_HOLDS_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
#: A start tag that ends an open element of the second kind, up to the third.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr"}, {"table"}), "tfoot": ({"tbody", "thead", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
GROUPS = {name: k for k, names in enumerate((
    "html body", "article", "main", "section", "div", "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl menu dir", "li dt dd",
    "table tbody thead tfoot tr", "td th", "blockquote pre", "figure figcaption", "nav", "header", "footer", "aside",
    "form fieldset label button select option textarea input output legend",
    "svg object canvas audio video")) for name in names.split()}
N_GROUPS = 22  # the last two: inline elements with names, and all others
#: Kinds of words in class, id and role.
WORDS = {word: k for k, words in enumerate((
    "article content post entry story body main text prose read copy page",
    "nav navigation menu navbar breadcrumb breadcrumbs topbar tabs pagination pager toc skip",
    "header masthead branding logo banner hero top site",
    "footer foot bottom copyright legal colophon contentinfo",
    "sidebar aside side rail widget secondary complementary panel column",
    "ad ads advert advertisement advertising sponsor sponsored promo promotion dfp adsense banner affiliate outbrain taboola",
    "cookie cookies consent notice gdpr alert popup modal overlay dialog privacy warning paywall toast message announcement",
    "comment comments reply replies discussion disqus respond thread commentlist feedback reader",
    "share social sharing follow facebook twitter like buttons tools",
    "related recommended recommend more popular trending latest teaser teasers read next also links",
    "form search login signup subscribe newsletter register input field button email",
    "byline author meta date tags tag category info credit caption timestamp published",
)) for word in words.split()}
N_WORDS = 12
BASE = ("chars", "words", "stops", "linked", "tags", "links", "paragraphs", "items", "controls", "images", "blocks", "headings")


@dataclass
class Page:
    """Nodes in document order (a parent before its children) and pieces of text in page order."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    group: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)  # bit k: a word of kind k in its names
    own: list[list[float]] = field(default_factory=list)
    start: list[int] = field(default_factory=list)  # characters of text before the node
    pieces: list[tuple[int, str]] = field(default_factory=list)  # node and text; "\n" ends a block

    def add(self, parent: int, group: int, words: int, at: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.group.append(group)
        self.words.append(words)
        self.own.append([0.0] * len(BASE))
        self.start.append(at)
        return len(self.parent) - 1


def named(attributes: str) -> tuple[int, bool]:
    """Bits of the kinds of words found in class, id and role; whether the element is hidden."""
    bits, hidden = 0, False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            for word in _PIECE.findall(value):
                kind = WORDS.get(word.lower())
                if kind is not None:
                    bits |= 1 << kind
        elif name == "hidden":
            hidden |= value.lower() != "until-found"
        elif name == "style":
            hidden |= bool(_UNSHOWN.search(value))
    return bits, hidden


class _Ends:
    """Where the tags of a page end whose quotes do not pair: found for all tags in one pass from the back."""

    def __init__(self, html: str):
        self._html = html
        marks = [(m.start(), m[0]) for m in _MARK.finditer(html)]
        self._at = [p for p, _ in marks]
        self._end = [-1] * (len(marks) + 1)
        following = {'"': len(marks), "'": len(marks)}
        for i in range(len(marks) - 1, -1, -1):
            p, mark = marks[i]
            if mark == ">":
                self._end[i] = p
            else:  # the quoted part ends at the next such quote
                self._end[i] = self._end[min(following[mark] + 1, len(marks))]
                following[mark] = i

    def after(self, name_end: int) -> int:
        """The ``>`` that ends a tag: outside of its quotes if there is one, else the next; -1 without any."""
        end = self._end[bisect_left(self._at, name_end)]
        return end if end >= 0 else self._html.find(">", name_end)


class _Tags:
    """Comments, declarations and tags of a page, one after the other from any place on.

    Past the last ``>`` nothing but an open comment is markup. The usual pattern reads a tag at a time;
    once it has met a tag whose quotes do not pair, which it finds out only at the end of the page, the
    ends of all further tags are looked up.
    """

    def __init__(self, html: str):
        self._html, self._last, self._ends = html, html.rfind(">") + 1, None

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """The next one: start, end, ``/`` of an end tag, name (empty if no tag), attributes."""
        html, usual = self._html, self._ends is None
        found = (_TAG if usual else _HEAD).search(html, at, self._last)
        if not found:
            start = html.find("<!--", max(at, self._last))
            return None if start < 0 else (start, len(html), "", "", "")
        start, end = found.span()
        if html.startswith("<!--", start) and (end - start < 7 or not html.endswith("-->", 0, end)):
            return start, len(html), "", "", ""  # a comment that never ends
        if usual:
            if found[5] is not None:
                self._ends = _Ends(html)
            return start, end, found[1] or found[4], (found[2] or found[5] or "").lower(), found[3] or found[6] or ""
        if found[2] is None:
            return start, end, "", "", ""
        close = self._ends.after(end)
        return start, close + 1, found[1], found[2].lower(), html[end:close]


def read_page(html: str) -> Page:
    """The nodes and texts of a page. Every input gives a page; broken markup is closed where needed.

    The work grows with the page's length, whatever its markup: tags are found in one pass, and the
    places of open elements are known by name.
    """
    page, at, chars = Page(), 0, 0
    root = page.add(-1, 0, 0, 0)
    stack: list[tuple[str, int, bool]] = [("#", root, False)]  # tag, node, text is shown
    opened: dict[str, list[int]] = {}  # places in the stack, by tag

    def push(tag: str, node: int, shown: bool) -> None:
        opened.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, shown))

    def nearest(tags) -> int:
        """The place of the innermost open element of these; 0 without any."""
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def say(text: str) -> None:
        nonlocal chars
        if stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        if not text or not stack[-1][2] and len(stack) > 1:
            return
        text = _BLANKS.sub(" ", unescape(text) if "&" in text else text)
        node = stack[-1][1]
        page.pieces.append((node, text))
        size = len(text) - text.count(" ")
        if size:
            own = page.own[node]
            own[0] += size
            own[1] += text.count(" ") + 1
            own[2] += len(_STOPS.findall(text))
            if links:
                own[3] += size
            chars += size

    links = foreign = 0  # open links; open svg and math

    def close(down_to: int) -> None:
        nonlocal links, foreign
        while len(stack) > down_to:
            tag = stack.pop()[0]
            opened[tag].pop()
            if tag == "a":
                links -= 1
            elif tag in ("svg", "math"):
                foreign -= 1
            elif tag not in INLINE and tag not in EMBEDDED and not foreign:
                page.pieces.append((0, "\n"))

    tags = _Tags(html)
    while met := tags.after(at):
        start, end, closes, tag, attributes = met
        if start > at:
            say(html[at:start])
        at = end
        if not tag:
            continue
        if closes:
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if stack[-1][0] == "head" and tag not in _IN_HEAD:
            close(len(stack) - 1)
        if foreign and (tag in GROUPS or tag in INLINE and tag not in ("a", "font") or tag in ("br", "hr", "img")) and tag not in EMBEDDED:
            # Elements of HTML end a drawing or formula, unless it holds HTML by rule.
            k = nearest(_HOLDS_HTML | {"svg", "math"})
            if k and stack[k][0] not in _HOLDS_HTML:
                close(k)
        if tag in _CLOSES_P or tag in _ENDS:
            ends, scope = _ENDS.get(tag, ({"p"}, {"td", "th", "li", "table", "button", "article", "section", "div"}))
            while (k := nearest(ends | scope)) and stack[k][0] in ends:
                close(k)
                if tag not in ("tr", "tbody", "tfoot"):
                    break
        node, own = stack[-1][1], page.own[stack[-1][1]]
        if tag in VOID:
            if tag == "br":
                page.pieces.append((node, " "))
            elif tag == "hr":
                page.pieces.append((0, "\n"))
            own[4] += 1
            own[8] += tag == "input"
            own[9] += tag == "img"
            continue
        if tag in SILENT or tag in RAW:
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                own[8] += tag == "textarea"
            elif not attributes.endswith("/"):
                push(tag, node, False)
            continue
        kinds, hidden = named(attributes) if attributes else (0, False)
        shown = (stack[-1][2] or len(stack) == 1) and not hidden
        if foreign and tag not in GROUPS and tag not in INLINE or tag == "math":  # shapes and signs: words apart, no nodes
            page.pieces.append((node, " "))
            if not attributes.endswith("/"):
                foreign += tag == "math"
                push(tag, node, shown)
            continue
        own[4] += 1
        if tag in EMBEDDED:
            node = page.add(node, GROUPS[tag], kinds, chars)
            page.own[node][10] += 1
            if not attributes.endswith("/"):
                foreign += tag == "svg"
                push(tag, node, shown)
            continue
        if tag in INLINE:
            if kinds:
                node = page.add(node, N_GROUPS - 2, kinds, chars)
            if tag == "a":
                own[5] += 1
                links += 1
        else:
            page.pieces.append((0, "\n"))
            node = page.add(node, GROUPS.get(tag, N_GROUPS - 1), kinds, chars)
            own = page.own[node]
            own[10] += 1
            own[6] += tag == "p"
            own[7] += tag in ("li", "dt", "dd")
            own[8] += tag in ("button", "select", "label", "form")
            own[11] += tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        if attributes.endswith("/") and tag in INLINE:
            links -= tag == "a"
            continue
        push(tag, node, shown)
    if at < len(html):
        say(html[at:])
    return page


@dataclass
class Forest:
    """Nodes of many pages in one set of arrays, with their levels for passes up and down."""

    parent: np.ndarray
    first: np.ndarray  # the first node of each page
    levels: list[np.ndarray]
    x: np.ndarray


def forest(pages: list[Page]) -> Forest:
    """Features of all nodes: the node, its names and its ancestors', its subtree, its siblings, its place."""
    sizes = np.array([len(p.parent) for p in pages])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    shift = np.repeat(first, sizes)
    parent = np.concatenate([np.asarray(p.parent) for p in pages])
    top = parent < 0
    parent = np.where(top, np.arange(len(parent)), parent + shift)
    depth = np.concatenate([np.asarray(p.depth) for p in pages])
    group = np.concatenate([np.asarray(p.group) for p in pages])
    bits = np.concatenate([np.asarray(p.words) for p in pages])
    start = np.concatenate([np.asarray(p.start) for p in pages]).astype(float)
    own = np.concatenate([np.asarray(p.own) for p in pages])
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])
    tree = own.copy()
    for nodes in levels[:0:-1]:
        np.add.at(tree, parent[nodes], tree[nodes])
    named = ((bits[:, None] >> np.arange(N_WORDS)) & 1).astype(float)
    kind = (group[:, None] == np.arange(N_GROUPS)).astype(float)
    above_named, above_kind = np.zeros_like(named), np.zeros_like(kind)
    for nodes in levels[1:]:
        up = parent[nodes]
        above_named[nodes] = np.maximum(above_named[up], named[up])
        above_kind[nodes] = np.maximum(above_kind[up], kind[up])
    chars, words = tree[:, 0], np.maximum(tree[:, 1], 1)
    whole, held = np.maximum(chars[np.repeat(first, sizes)], 1), np.maximum(chars, 1)
    up_chars = np.maximum(chars[parent], 1)
    # Siblings: in document order, children of one parent are consecutive after a stable sort.
    by_parent = np.argsort(np.where(top, -1 - np.arange(len(parent)), parent), kind="stable")
    mates = np.bincount(parent[~top], minlength=len(parent))
    place = np.zeros(len(parent))
    sorted_parent = parent[by_parent]
    new = np.concatenate(([True], sorted_parent[1:] != sorted_parent[:-1]))
    run = np.arange(len(parent)) - np.maximum.accumulate(np.where(new, np.arange(len(parent)), 0))
    place[by_parent] = run
    before, after = np.zeros(len(parent)), np.zeros(len(parent))
    same = ~new[1:]
    before[by_parent[1:][same]] = chars[by_parent[:-1][same]]
    after[by_parent[:-1][same]] = chars[by_parent[1:][same]]
    alike = np.bincount(parent * N_GROUPS + group, minlength=len(parent) * N_GROUPS)[parent * N_GROUPS + group]
    n_mates = np.maximum(mates[parent], 1)
    derived = np.stack([
        np.log1p(chars), np.log1p(own[:, 0]), chars / words, tree[:, 2] / words, tree[:, 3] / held, np.log1p(held / (tree[:, 4] + 1)),
        np.log1p(tree[:, 5]), tree[:, 5] / (tree[:, 4] + 1), np.log1p(tree[:, 6]), np.log1p(tree[:, 7]), np.log1p(tree[:, 8]),
        np.log1p(tree[:, 9]), np.log1p(tree[:, 10]), np.log1p(tree[:, 11]), chars / whole, chars / up_chars, start / whole,
        (start + chars) / whole, depth, np.log1p(place), place / n_mates, np.log1p(n_mates), alike / n_mates, np.log1p(before),
        np.log1p(after), np.log1p(whole), words / (tree[:, 10] + 1), tree[:, 2] / (tree[:, 10] + 1),
    ], axis=1)
    # In sum: does anything in the node's own markup, or above it, speak against main text, or for it?
    against, above_against = (n[:, 1:11].sum(axis=1) + k[:, 14:19].sum(axis=1) for n, k in ((named, kind), (above_named, above_kind)))
    above_for = above_kind[:, 1:3].sum(axis=1) + above_named[:, 0]
    derived = np.column_stack([derived, against, above_against, above_for, above_for * (above_against + against == 0)])
    return Forest(parent, first, levels, np.concatenate([derived, kind, above_kind, named, above_named], axis=1))


def decode(chance: np.ndarray, trees: Forest) -> np.ndarray:
    """The most likely set of kept nodes in which no node is kept below one that is dropped.

    Going up, each node weighs dropping its whole subtree against being kept with the best choice for
    every child; going down, the choices are read off. The page itself is always open.
    """
    p = np.clip(chance, 1e-6, 1 - 1e-6)
    drop, keep = np.log1p(-p), np.log(p)
    for nodes in trees.levels[:0:-1]:
        up = trees.parent[nodes]
        np.add.at(keep, up, np.maximum(keep[nodes], drop[nodes]))
        np.add.at(drop, up, drop[nodes])
    kept = keep > drop
    kept[trees.first] = True
    for nodes in trees.levels[1:]:
        kept[nodes] &= kept[trees.parent[nodes]]
    return kept


def text_of(page: Page, kept: np.ndarray) -> str:
    """The kept text: blanks in a block are one space, blocks are joined by two line feeds."""
    blocks, held = [], []
    for node, text in page.pieces:
        if text == "\n":
            if held:
                block = _BLANKS.sub(" ", "".join(held)).strip()
                if block:
                    blocks.append(block)
                held = []
        elif kept[node]:
            held.append(text)
    block = _BLANKS.sub(" ", "".join(held)).strip()
    if block:
        blocks.append(block)
    return "\n\n".join(blocks)
