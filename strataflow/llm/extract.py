"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree."""

from __future__ import annotations

import functools
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.boosting import Trees, boost
from strataflow.llm.chars import chunks
from strataflow.llm.common import fresh, ship
from strataflow.llm.dom import decode, forest, read_page, text_of

TRAINING_PAGES = 600
SEED = 7
MAIN = "\u0001"


class _Writer:
    """Pages of many layouts whose main text is marked, to learn from.

    Words are random syllables, so nothing is learned of any language; what varies is the markup:
    element names, class names or none at all, wrappers, order, lengths, unclosed tags.
    """

    def __init__(self, rng: random.Random):
        self.r = rng
        self.named = rng.random() < 0.75
        self.semantic = rng.random() < 0.7

    def word(self) -> str:
        return "".join(self.r.choice(("ka", "lo", "mi", "ter", "un", "ei", "son", "pra", "de", "vo", "é", "sü")) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        said = self.words(*self.r.choice(((1, 3), (2, 9), (4, 18), (4, 18))))
        return said[0].upper() + said[1:] + self.r.choice(".....!?,")

    def prose(self, low: int, high: int, mark: str) -> str:
        parts = [self.sentence() for _ in range(low if self.r.random() < 0.35 else self.r.randint(low, high))]
        if self.r.random() < 0.25:
            k = self.r.randrange(len(parts))
            parts[k] = self.r.choice(("<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', "<i>{}</i>", "<b>{}")).format(mark + parts[k])
        return mark + " ".join(parts)

    def name(self, *choices: str) -> str:
        if not self.named or self.r.random() < 0.15:
            return "" if self.r.random() < 0.7 else f' class="{self.word()}"'
        attribute = self.r.choice(("class", "class", "id"))
        return f' {attribute}="{self.r.choice(choices)}{self.r.choice(("", "", "-wrap", "_box", "-1", " " + self.word()))}"'

    def tag(self, semantic: str, inner: str, *names: str) -> str:
        kind = semantic if self.semantic and self.r.random() < 0.9 else "div"
        return f"<{kind}{self.name(*names)}>{inner}</{kind}>"

    def link_list(self, low: int, high: int) -> str:
        links = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
        return self.r.choice((" ", " | ", "\n")).join(links)

    def nav(self) -> str:
        return self.tag("nav", self.link_list(3, 10), "nav", "menu", "navbar", "main-menu", "breadcrumb", "topnav")

    def header(self) -> str:
        inner = self.r.choice(("<h1>{}</h1>", "<h2>{}</h2>", '<a href="/">{}</a>', "<p>{}</p>", "<span>{}</span>", "<div>{}</div>")).format(self.words(1, 6))
        if self.r.random() < 0.4:
            inner += f"<p>{self.sentence()}</p>"
        return self.tag("header", inner + (self.nav() if self.r.random() < 0.4 else ""), "header", "masthead", "site-header", "logo", "topbar")

    def footer(self) -> str:
        inner = f"&copy; {self.words(1, 3)} &middot; {self.some(1, 6)}"
        if self.r.random() < 0.4:
            inner = f"<p>{inner}</p>" + self.link_list(2, 6)
        return self.tag("footer", inner, "footer", "site-footer", "bottom", "copyright")

    def some(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def sidebar(self) -> str:
        parts = []
        for _ in range(self.r.randint(1, 3)):
            parts.append(self.r.choice((
                lambda: f"<h3>{self.words(1, 4)}</h3>" + self.link_list(2, 7), lambda: f"<p>{self.some(1, 4)}</p>",
                lambda: f"<div{self.name('widget', 'panel', 'related')}>{self.some(1, 4)}</div>"))())
        return self.tag("aside", "".join(parts), "sidebar", "side", "widget-area", "rail", "secondary")

    def advert(self) -> str:
        inner = self.some(1, 5) if self.r.random() < 0.6 else f'<a href="/buy">{self.sentence()}</a>'
        inner = f"<p>{inner} {self.sentence()}</p>" if self.r.random() < 0.3 else inner
        kind = self.r.choice(("div", "div", "div", "aside", "section", "p", "ins", "span"))
        return f'<{kind}{self.always("ad", "ads", "advert", "sponsored", "promo", "banner-ad", "ad-slot", "adBox", "advertisement")}>{inner}</{kind}>'

    def always(self, *choices: str) -> str:
        return f' {self.r.choice(("class", "class", "id"))}="{self.r.choice(choices)}{self.r.choice(("", "", "-" + self.word()))}"'

    def notice(self) -> str:
        inner = f"<p>{self.some(1, 4)}</p><button>{self.words(1, 2)}</button>" if self.r.random() < 0.5 else self.some(1, 4)
        kind = self.r.choice(("div", "div", "section", "aside", "dialog", "p"))
        return f'<{kind}{self.always("cookie", "cookie-notice", "consent", "notice", "alert", "popup", "gdpr", "modal", "newsletter", "subscribe", "banner")}>{inner}</{kind}>'

    def form(self) -> str:
        inner = "".join(self.r.choice((
            f"<label>{self.words(1, 3)}</label><input name=q>", f"<p>{self.sentence()}</p>", f"<button>{self.words(1, 2)}</button>",
            f"<select><option>{self.word()}</option><option>{self.word()}</option></select>", "<textarea>x y</textarea>")) for _ in range(self.r.randint(1, 4)))
        return f'<form{self.name("search", "signup", "subscribe", "login", "contact")}>{inner}<input type="submit"></form>'

    def comments(self) -> str:
        each = lambda: (
            f'<{kind}{self.name("comment", "reply", "comment-body")}><p>{self.words(1, 2)}</p><p>{" ".join(self.sentence() for _ in range(self.r.randint(1, 4)))}</p></{kind}>')
        kind = self.r.choice(("div", "li", "article", "p", "section"))
        inner = "".join(each() for _ in range(self.r.randint(1, 6)))
        if kind == "li":
            inner = f"<ol>{inner}</ol>"
        if self.r.random() < 0.6:
            inner = f"<h2>{self.words(1, 3)}</h2>" + inner
        outer = self.r.choice(("section", "div", "div", "aside"))
        return f'<{outer}{self.always("comments", "comment-list", "discussion", "replies", "disqus_thread", "reader-comments", "respond")}>{inner}</{outer}>'

    def related(self) -> str:
        return self.tag("aside", f"<h3>{self.words(1, 3)}</h3>{self.link_list(2, 6)}", "related", "recommended", "more", "share", "social", "tags")

    def block(self) -> str:
        kind = self.r.random()
        if kind < 0.66:
            close = "</p>" if self.r.random() < 0.85 else self.r.choice(("<br>", ""))
            return f"<p{self.r.choice(('', '', '', self.name('text', 'lead', 'par')))}>{self.prose(1, 7, MAIN)}{close}"
        if kind < 0.74:
            return f"<h{self.r.choice('234')}>{MAIN}{self.words(2, 8)}</h2>"
        if kind < 0.82:
            return "<ul>" + "".join(f"<li>{self.prose(1, 2, MAIN)}</li>" for _ in range(self.r.randint(2, 6))) + "</ul>"
        if kind < 0.88:
            return f"<blockquote>{self.prose(1, 3, MAIN)}</blockquote>"
        if kind < 0.92:
            return f"<pre>{MAIN}{self.words(3, 30)}</pre>"
        if kind < 0.96:
            return "<table>" + "".join(f"<tr><td>{MAIN}{self.words(1, 3)}</td><td>{MAIN}{self.words(1, 4)}</td></tr>" for _ in range(self.r.randint(2, 4))) + "</table>"
        return f"<div>{self.prose(1, 5, MAIN)}</div>"

    def unseen(self) -> str:
        kind = self.r.choice(("p", "div", "section", "span"))
        return f"<{kind}{self.r.choice((' hidden', ' style="display:none"'))}>{self.some(1, 3)}</{kind}>"

    def embedded(self) -> str:
        """Start and end of an element with text of its own that is no main text; the end may be missing."""
        kind = self.r.choice(("svg", "object", "canvas", "audio", "video"))
        inner = self.r.choice(("", self.words(1, 4), self.sentence()))
        if kind == "svg":
            inner = f"<text>{inner}</text><path d='M0 0'/>" if inner else "<path d='M0 0'>"
        return f"<{kind}{self.name('player', 'media', 'chart')}>{inner}{'' if self.r.random() < 0.3 else f'</{kind}>'}"

    def article(self) -> str:
        n = self.r.choice((0, 0, 1, 1, 2, 3, 4, 6, 10, 20))
        parts = [f"<h1>{MAIN}{self.words(1, 12)}</h1>"] if self.r.random() < 0.8 else []
        if parts and self.r.random() < 0.4:  # a first paragraph that is left open
            parts.append(f"<p><b>{self.prose(1, 3, MAIN)}<br>")
        body = [self.block() for _ in range(max(n, not parts))]
        for extra, often in ((self.advert, 0.3), (self.related, 0.12), (self.notice, 0.1), (self.form, 0.08)):
            if self.r.random() < often:
                body.insert(self.r.randint(0, len(body)), extra())
        for extra, often in ((self.embedded, 0.35), (self.unseen, 0.2)):
            for _ in range(self.r.randint(1, 2) if self.r.random() < often else 0):
                body.insert(self.r.randint(0, len(body)), extra())
        inner = "".join(parts + body)
        if self.r.random() < 0.25:
            inner = f"<div{self.name('content', 'entry-content', 'body', 'text')}>{inner}</div>"
        if self.r.random() < 0.12:
            inner += self.comments()
        return self.tag(self.r.choice(("article", "article", "main", "section")), inner, "article", "post", "content", "entry", "story", "main-content")

    def page(self) -> str:
        head = f"<head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head>"
        before = [f() for f, often in ((self.header, 0.55), (self.nav, 0.75), (self.notice, 0.3), (self.advert, 0.45), (self.form, 0.15), (self.sidebar, 0.15)) if self.r.random() < often]
        after = [f() for f, often in ((self.related, 0.25), (self.comments, 0.4), (self.sidebar, 0.3), (self.advert, 0.2), (self.form, 0.2), (self.notice, 0.2), (self.footer, 0.8)) if self.r.random() < often]
        self.r.shuffle(before)
        if self.r.random() < 0.3:
            self.r.shuffle(after)
        middle = self.article()
        if self.r.random() < 0.35:
            take = [after.pop(0)] if after and self.r.random() < 0.5 else []
            middle = f"<div{self.name('wrapper', 'container', 'page', 'layout', 'main')}>{middle}{''.join(take)}</div>"
        return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}<!-- x -->{middle}{''.join(after)}{'</body></html>' if self.r.random() < 0.9 else ''}"


@functools.cache
def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Trees:
    """Trees fitted to ``pages`` written pages; a node is positive if it holds any main text."""
    rng = random.Random(seed)
    read = [read_page(_Writer(rng).page()) for _ in range(pages)]
    marks = []
    for page in read:
        held = np.zeros(len(page.parent), bool)
        for node, text in page.pieces:
            held[node] |= MAIN in text
        for node in range(len(held) - 1, 0, -1):
            held[page.parent[node]] |= held[node]
        marks.append(held)
    return boost(forest(read).x, np.concatenate(marks).astype(float))


def extract_text(htmls: list[str], model: Trees) -> list[str]:
    pages = [read_page(h) for h in htmls]
    trees = forest(pages)
    kept = decode(model.chance(trees.x), trees)
    ends = [*trees.first[1:], len(kept)]
    return [text_of(p, kept[a:b]) for p, a, b in zip(pages, trees.first, ends, strict=True)]


def extract(pages: DataFrame, html: str = "html", model: Trees | None = None) -> DataFrame:
    """Add ``text``, the main text of the page, empty if there is none.

    Every node of the whole page gets a chance to hold main text from boosted trees over its own
    markup and names, its ancestors', its subtree's densities, its siblings and its place. Decoding
    then picks the most likely choice for the whole tree in which nothing is kept below a dropped
    node. What is not shown is left out ahead of that: scripts, styles, templates, titles, frames,
    ``noscript`` and elements with the attribute ``hidden`` or the style ``display: none``. Text of svg,
    object, canvas, audio and video is for the trees to decide; formulas stay with their block, their
    signs set apart by blanks. Character references are decoded; blanks inside a block become one space; blocks are
    joined by two line feeds.

    Defined cases: null or empty html, and pages without main text, give an empty text; markup may be
    broken anywhere, and text without any markup is one block; repeated rows get equal texts; a column
    ``text`` of the input is replaced, other columns come back unchanged.
    """
    known = ship(pages.sparkSession).sparkContext.broadcast(model or trained())

    @F.arrow_udf("string")
    def main_text(htmls: pa.Array) -> pa.Array:
        return pa.array([t for _, held in chunks(htmls, 1 << 18, 64) for t in extract_text(held, known.value)], pa.string())

    out, kept = fresh("text"), pages.drop("text")
    return kept.withColumn(out, main_text(F.col(f"`{html}`"))).withColumnRenamed(out, "text")
