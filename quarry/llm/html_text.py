"""Main text of web pages: a conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (text between block-level tags). Features of a
block are its ancestors' tags, words of their class, id and role attributes,
and the form of its text. The field is trained on labelled pages (composed
below with known labels, in many layouts) and decoded by Viterbi.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import texts_of, tidied
from quarry.llm.crf import Chain

TRAINING_PAGES = 400

#: Elements of a formula; its text belongs to the block around it.
MATH = frozenset("math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr "
                 "mlabeledtr mtd mstyle mpadded mphantom mspace menclose mfenced merror maction semantics annotation annotation-xml".split())
INLINE = MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg object".split())
#: An opening tag on the left ends an open element on the right (inside the nearest of the last group).
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
_SCOPE = frozenset("ul ol dl table select body html article section div".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<", re.S)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}

#: Attribute words by what they name.
HINTS = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner adsense teaser",
    "notice": "cookie cookies consent notice notices gdpr popup modal alert overlay message warning disclaimer paywall subscribe subscription "
              "newsletter signup",
    "nav": "nav navigation navbar menu menus breadcrumb breadcrumbs pagination pager toc skip tabs toolbar topbar",
    "side": "side sidebar aside rail widget widgets complementary",
    "comments": "comment comments reply replies respond disqus discussion reactions feedback",
    "form": "form login search signin contact",
    "share": "share sharing social follow tags meta byline",
    "related": "related recommended recommendations more popular trending also",
    "footer": "footer foot copyright bottom colophon contentinfo",
    "header": "header head masthead top logo branding",
    "main": "article content main post entry body story text page",
}
_HINT = {w: k for k, words in HINTS.items() for w in words.split()}
_TAGS = ("nav header footer aside form article main section figure table ul ol dl blockquote button select fieldset head "
         "h1 h2 h3 h4 h5 h6 p li pre a title noscript label address dialog menu figcaption details div body").split()
FEATURES = {name: i for i, name in enumerate(
    [f"in:{t}" for t in _TAGS] + [f"hint:{h}" for h in HINTS] + [f"raw:{t}" for t in sorted(RAW)]
    + ["hidden", "article>header", "article>bad", "bare"]
    + [f"words:{k}" for k in range(6)] + [f"links:{k}" for k in range(4)] + ["stop", "copyright", "bar", "first", "bias"])}
_BAD_HINTS = frozenset(HINTS) - {"main"}
_BAD_TAGS = frozenset("nav footer aside form button select fieldset dialog menu".split())


class _Open:
    """The open elements; every step costs the elements it opens or closes, however deep they are nested."""

    def __init__(self):
        self.tags: list[str] = []
        self.masks: list[int] = []          # features of an element and all around it, as bits
        self.inside: list[bool] = []        # whether an article is around or the element itself
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []         # places of elements that are not inline,
        self.walls: list[int] = []          # of those but paragraphs,
        self.scopes: list[int] = []         # and of those that end an implied closing

    def push(self, tag: str, hints: frozenset[str]) -> None:
        mask, inside = (self.masks[-1], self.inside[-1]) if self.tags else (0, False)
        names = {f"in:{tag}"} | {h if h == "hidden" else f"hint:{h}" for h in hints}
        if inside and tag == "header":
            names.add("article>header")
        if inside and (tag in _BAD_TAGS or hints & _BAD_HINTS):
            names.add("article>bad")
        for name in names & FEATURES.keys():
            mask |= 1 << FEATURES[name]
        at = len(self.tags)
        self.tags.append(tag)
        self.masks.append(mask)
        self.inside.append(inside or tag in ("article", "main") or "main" in hints)
        self.places.setdefault(tag, []).append(at)
        for of, places in self._lists(tag):
            if of:
                places.append(at)

    def _lists(self, tag: str):
        block = tag not in INLINE
        return (block, self.blocks), (block and tag != "p", self.walls), (tag in _SCOPE, self.scopes)

    def cut(self, at: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.tags) > at:
            tag = self.tags.pop()
            self.masks.pop()
            self.inside.pop()
            self.places[tag].pop()
            for of, places in self._lists(tag):
                if of:
                    places.pop()

    def end(self, tag: str) -> None:
        """An end tag closes the innermost such element, an inline one only if no block is open in it."""
        places = self.places.get(tag)
        if places and not (tag in INLINE and self.blocks and self.blocks[-1] > places[-1]):
            self.cut(places[-1])

    def make_room(self, tag: str) -> None:
        """A block ends an open paragraph and the inline elements in it, and what its tag implies."""
        closes = _CLOSES.get(tag)
        walls = self.scopes if closes else self.walls
        wall = walls[-1] if walls else -1
        first = [places[k] for t in {"p"} | (closes or set()) if (places := self.places.get(t)) and (k := bisect_right(places, wall)) < len(places)]
        if first:
            self.cut(min(first))


def blocks(page: str) -> list[tuple[str, list[int]]]:
    """(text, active features) of every leaf block with text, in page order."""
    out: list[tuple[str, list[int]]] = []
    open_ = _Open()
    text: list[str] = []
    linked = 0
    raw_tag = ""

    def flush():
        nonlocal linked
        if text:
            plain = " ".join(html.unescape("".join(text)).split())
            if plain:
                around = (open_.masks[-1], open_.inside[-1]) if open_.tags else (0, False)
                out.append((plain, _features(plain, *around, linked, raw_tag, not out)))
            text.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            piece = m[0]
            if piece[:2] in ("<!", "<?"):
                continue
            text.append(piece)
            if open_.places.get("a"):
                linked += len(piece)
            continue
        tag = tag.lower()
        if m[1] or m[4]:   # an end tag
            if tag not in INLINE:
                flush()
            open_.end(tag)
            if tag in MATH and tag != "math" and not page.startswith("</", at):
                text.append(" ")   # neighbours in a formula stay apart
            continue
        attrs = m[3] if m[2] else m[6]
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW:
            if attrs.endswith("/") and tag == "svg":
                continue
            end = _END[tag].search(page, at)
            flush()
            text.append(page[at:end.start() if end else size])
            raw_tag = tag
            flush()
            raw_tag = ""
            at = page.find(">", end.end()) + 1 if end else size
            at = at or size
            continue
        if tag not in INLINE:
            flush()
            open_.make_room(tag)
        if tag in VOID or attrs.endswith("/") and tag in MATH:
            continue
        open_.push(tag, _attributes(attrs) if attrs else frozenset())
    flush()
    return out


def _attributes(attrs: str) -> frozenset[str]:
    found = {_HINT[w] for value in _ATTR.findall(attrs) for w in _WORD.findall(value.lower()) if w in _HINT}
    if _HIDDEN.search(attrs):
        found.add("hidden")
    return frozenset(found)


def _features(plain: str, around: int, inside: bool, linked: int, raw_tag: str, first: bool) -> list[int]:
    names = {"bias"}
    if raw_tag:
        names.add(f"raw:{raw_tag}")
    if not inside:
        names.add("bare")
    n = plain.count(" ") + 1
    names.add(f"words:{0 if n == 1 else 1 if n <= 3 else 2 if n <= 8 else 3 if n <= 20 else 4 if n <= 60 else 5}")
    share = linked / len(plain)
    names.add(f"links:{0 if not linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}")
    if plain[-1] in ".!?:\"'”»":
        names.add("stop")
    if "©" in plain:
        names.add("copyright")
    if "|" in plain or "·" in plain:
        names.add("bar")
    if first:
        names.add("first")
    for name in names:
        around |= 1 << FEATURES[name]
    return [i for i in range(len(FEATURES)) if around >> i & 1]


class _Author:
    """Composes pages whose leaf blocks have known labels: (html, text of the article's blocks)."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.good: list[str] = []

    def words(self, low: int, high: int, stop: bool = True) -> str:
        r = self.rng
        w = ["".join(r.choice("bcdfglmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 5))) for _ in range(r.randint(low, high))]
        if r.random() < 0.1:
            w = [x + r.choice(["***", "$$$", "!!", "", " |"]) for x in w]
        return " ".join(w).capitalize() + ("." if stop else "")

    def pick(self, *options):
        return self.rng.choice(options)

    def mark(self, *names: str) -> str:
        """A class or id attribute with one of the names."""
        return f'{self.pick("class", "class", "id")}="{self.pick("", "site-", "page-", "c-")}{self.pick(*names)}{self.pick("", "", "-box", " col-2")}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{k}">{self.words(1, 3, False)}</a>' for k in range(self.rng.randint(low, high))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if self.rng.random() < 0.7 else " ".join(items)

    def speech(self) -> str:
        """Boilerplate in the words of an article: only its place tells."""
        return self.pick(f"<p>{self.words(1, 30)}</p>", self.words(2, 20), f"<p>{self.words(3, 12)}</p><p>{self.words(3, 40)}</p>")

    def raw(self) -> str:
        """An element that shows no text of the article: only its tag tells."""
        t = self.words(1, 30)
        return self.pick(
            f"<script>var a = '<p>{t}</p>';</script>", f"<style>p{{margin:0}} .{t}{{color:red}}</style>", f"<textarea name=t>{t}</textarea>",
            f"<title>{t}</title>", f"<noscript>{self.pick(t, f'<p>{t}</p>')}</noscript>", f"<template>{self.pick(t, f'<p>{t}</p>')}</template>",
            f"<iframe src=/x>{self.pick(t, f'<p>{t}</p>')}</iframe>", f"<noframes>{self.pick(t, f'<p>{t}</p>')}</noframes>",
            f'<svg viewBox="0 0 9 9">{self.pick("", "<path d=M1/>")}{self.pick("<path d=M2/>", f"<text>{t}</text>", f"<title>{t}</title>", t)}</svg>',
            f"<object data=x>{self.pick(t, f'<p>{t}</p>', '<param name=a value=b>')}</object>")

    def bad(self, inside: bool) -> str:
        options = [
            self.raw, self.raw, self.raw, self.raw,
            lambda: f"<dialog open>{self.speech()}</dialog>",
            lambda: f"<menu><li>{self.words(1, 3, False)}<li>{self.words(1, 3, False)}</menu>",
            lambda: f"<form><fieldset><label>{self.words(1, 3, False)}<input name=n></label>{self.speech()}</fieldset></form>",
            lambda: f'<div {self.mark("login", "signin", "contact", "search")}>{self.speech()}</div>',
            lambda: f"<nav>{self.links(2, 8)}</nav>",
            lambda: f'<div {self.mark("menu", "nav", "navbar", "breadcrumbs", "pagination")}>{self.links(2, 6)}</div>',
            lambda: f"<aside>{self.speech()}{self.links(0, 4)}</aside>",
            lambda: f'<div {self.mark("sidebar", "widget", "rail")}><h3>{self.words(1, 3, False)}</h3>{self.speech()}</div>',
            lambda: f'<div {self.mark("ad", "ads", "advert", "sponsored", "promo", "banner")}>{self.speech()}</div>',
            lambda: f'<div {self.mark("cookie-notice", "notice", "consent", "newsletter", "alert", "popup", "subscribe")}>{self.speech()}</div>',
            lambda: f'<form action="/x"><label>{self.words(1, 2, False)}</label><input name="q"><button>{self.words(1, 1, False)}</button></form>',
            lambda: f'<form><p>{self.words(2, 15)}</p><select><option>{self.words(1, 1, False)}<option>{self.words(1, 2, False)}</select></form>',
            lambda: f'<{(t := self.pick("section", "div"))} {self.mark("comments", "comment-list", "replies", "discussion")}><h2>{self.words(1, 2, False)}</h2>'
                    + "".join(f'<{(u := self.pick("div", "article", "li"))} class="{self.pick("comment", "reply", "item")}">{self.speech()}</{u}>'
                              for _ in range(self.rng.randint(1, 4))) + f"</{t}>",
            lambda: f'<div {self.mark("share", "social", "related", "recommended")}>{self.pick(self.links(1, 5), self.speech())}</div>',
            lambda: f'<div hidden>{self.speech()}</div>',
            lambda: f'<!-- {self.words(1, 9)} -->',
        ]
        if not inside:
            options += [lambda: f"<header>{self.pick('<a href=/>' + self.words(1, 3, False) + '</a>', '<p>' + self.words(1, 8) + '</p>', '<h1>' + self.words(1, 3, False) + '</h1>')}</header>",
                        lambda: f'<div {self.mark("header", "masthead", "topbar", "logo")}>{self.words(1, 6, False)}</div>',
                        lambda: f"<footer>{self.pick('&copy; ', '')}{self.speech()}</footer>",
                        lambda: f'<div {self.mark("footer", "copyright", "bottom")}>&copy; {self.words(1, 9)}</div>',
                        lambda: f"<div>{self.links(2, 6)}</div>",
                        lambda: f"<xmp>{self.words(1, 20)}</xmp>",
                        lambda: f"<address>{self.words(1, 9)}</address>",
                        lambda: f"<details><summary>{self.words(1, 3, False)}</summary>{self.links(1, 4)}</details>"]
        return self.pick(*options)()

    def keep(self, text: str) -> str:
        self.good.append(text)
        return text

    def para(self) -> str:
        t = self.keep(self.words(1, self.pick(2, 8, 40, 90), self.rng.random() < 0.75))
        if self.rng.random() < 0.3:
            first, _, rest = t.partition(" ")
            t = f"{self.pick('<b>', '<a href=/x>', '<i>', '<span class=x>')}{first}{self.pick('</b>', '</a>', '</i>', '</span>', '')} {rest}"
        return self.pick(f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}</p>", f"<p>{t}", f"<p><b>{t}<br>")

    def formula(self) -> str:
        """A paragraph with a formula in it, or a formula alone."""
        a, b, c = (self.words(1, 1, False) for _ in range(3))
        math = f"<math><mrow><mi>{a}</mi><mo>=</mo><msup><mi>{b}</mi><mn>{c}</mn></msup></mrow></math>"
        if self.rng.random() < 0.5:
            self.keep(f"{a} = {b} {c}")
            return math
        before, after = self.words(1, 20, False), self.words(1, 20)
        self.keep(f"{before} {a} = {b} {c} {after}")
        return f"<p>{before} {math} {after}</p>"

    def article(self) -> str:
        parts = [self.formula,
                 lambda: f"<xmp>{self.keep(self.words(1, 20))}</xmp>",
                 lambda: f"<address>{self.keep(self.words(1, 9))}</address>",
                 lambda: f"<details><summary>{self.keep(self.words(1, 5, False))}</summary>{self.para()}</details>",
                 lambda: f"<{(h := self.pick('h4', 'h5', 'h6'))}>{self.keep(self.words(1, 7, False))}</{h}>",
                 lambda: "<ol>" + "".join(f"<li>{self.keep(self.words(1, 12))}</li>" for _ in range(self.rng.randint(1, 5))) + "</ol>",
                 lambda: f"<dl><dt>{self.keep(self.words(1, 3, False))}<dd>{self.keep(self.words(1, 12))}</dl>",
                 lambda: f"<h2>{self.keep(self.words(1, 7, False))}</h2>", *[self.para] * 9,
                 lambda: "<ul>" + "".join(f"<li>{self.keep(self.words(1, 12))}</li>" for _ in range(self.rng.randint(1, 5))) + "</ul>",
                 lambda: f"<blockquote>{self.keep(self.words(3, 20))}</blockquote>",
                 lambda: f"<pre>{self.keep(self.words(3, 9))}</pre>",
                 lambda: f"<p>{self.keep(' '.join(self.words(1, 1, False) + ' |' for _ in range(9)) + ' ' + self.words(1, 1))}</p>",
                 lambda: f"<table><tr><td>{self.keep(self.words(1, 4, False))}</td><td>{self.keep(self.words(1, 4, False))}</td></tr></table>",
                 lambda: f"<figure><img src=x><figcaption>{self.keep(self.words(2, 9))}</figcaption></figure>",
                 lambda: f"<section><h3>{self.keep(self.words(1, 5, False))}</h3>{self.para()}</section>",
                 lambda: f"<div>{self.keep(self.words(4, 50))}</div>"]
        head = f"<h1>{self.keep(self.words(1, 10, False))}</h1>"
        if self.rng.random() < 0.2:
            head = f"<header>{head}</header>"
        body = [head] if self.rng.random() < 0.9 else []
        for _ in range(self.rng.randint(1, 12)):
            body.append(self.pick(*parts)())
            if self.rng.random() < 0.2:
                body.append(self.bad(True))
        if self.rng.random() < 0.2:
            body.append(self.bad(True))
        open_, close = self.pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                                 ("", ""), ("<div>", "</div>"), ("<section>", "</section>"),
                                 (f'<div {self.mark("content", "main", "post-body", "entry-content", "article", "story")}>', "</div>"))
        return open_ + "".join(body) + close

    def page(self) -> tuple[str, list[str]]:
        self.good = []
        before = "".join(self.bad(False) for _ in range(self.pick(0, 0, 1, 2, 3, 4)))
        main = self.article()
        after = "".join(self.bad(False) for _ in range(self.rng.randint(0, 4)))
        head = f"<head><meta charset=utf-8><title>{self.words(1, 8, False)}</title></head>"
        end = self.pick("</body></html>", "</body></html>", "")
        if self.rng.random() < 0.25:
            return before + main + after, self.good
        return f"<!DOCTYPE html><html>{head}<body>{before}{main}{after}{end}", self.good


def labelled_pages(count: int = TRAINING_PAGES, seed: int = 1) -> list[tuple[list[list[int]], list[int]]]:
    """Feature and label sequences of composed pages (a block is looked for if the article holds its text)."""
    author, out = _Author(seed), []
    for _ in range(count):
        page, good = author.page()
        expected = {" ".join(html.unescape(re.sub(r"<[^>]*>", "", g)).split()) for g in good}
        found = blocks(page)
        out.append(([f for _, f in found], [int(t in expected) for t, _ in found]))
    return out


def train(count: int = TRAINING_PAGES, seed: int = 1) -> Chain:
    return Chain(len(FEATURES)).fit(labelled_pages(count, seed))


def main_text(page: str, field: Chain) -> str:
    """The blocks labelled as article text, one line each."""
    found = blocks(page)
    labels = field.decode([f for _, f in found])
    return "\n".join(t for (t, _), y in zip(found, labels, strict=True) if y)


def extract(pages: DataFrame, field: Chain, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text string) for every input row; null, empty and article-less pages have an empty text.

    Pages are read whole; a task holds one Arrow batch.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field)   # about a hundred weights
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches):
        for b in batches:
            texts = [main_text(t.decode(), shared.value) for t in texts_of(b, "html")]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    id_type = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(tidied(run), f"id {id_type}, url string, text string").withColumnsRenamed({"id": id_col, "url": url_col})
