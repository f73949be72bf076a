"""HTML extraction by maximum-scoring subsequence.

A page is read as a sequence of tags and runs of words. Weights come from labelled pages: each
element (its tag, and the words of its class, id and role) has the log-odds that a word under it
is main text, and each tag kind the log-odds that the tag stands inside main text. A run scores
its words times the weight of its place, a tag scores below zero, and one linear scan finds the
contiguous region of the highest sum. Where that region has text of an article or main element, all
other text straight under the same element belongs to it too, so that a short title before a long
notice stays. Runs whose place weighs below zero, such as an advert between paragraphs, are left
out. A name of several parts counts by itself where labelled pages have it, else by its parts, which
say nothing where they disagree.

The work is linear in the page: open elements carry the weights and the container of those around
them, and each end tag pays for what it closes.

Scripts, styles, text areas and titles go up to their end tag, or the end of the page; closed
noscript, template, select, svg and iframe elements go whole. One that is empty by '/>', or never
closed, is a tag like any other. The text of math and object stays.

Character references are decoded in each run of text by itself, so that markup never makes one;
white space inside a block, line breaks
included, becomes one space; blocks are joined by one line feed, empty ones go. Null html is
empty, and a page without words of weight gives an empty text. Rows are independent: repeated rows
repeat their result, an empty table gives an empty one, other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import released, small_batches, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)"""
    r"|<(?=/?[a-zA-Z])[^>]*(?:>|\Z)"
    r"|</?\Z",
    re.S | re.I,
)
#: Elements that go whole where they are closed.
_WHOLE = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("noscript", "template", "select", "svg", "iframe")}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?=$|\s|=)", re.I)
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: Formulas, icons and embedded things stand in a line too.
INLINE |= {"math", "mfrac", "mi", "mn", "mo", "mover", "mroot", "mrow", "ms", "mspace", "msqrt", "mstyle", "msub", "msubsup", "msup", "mtext", "munder", "munderover", "semantics", "annotation", "svg", "object", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: An opening tag of these ends an open one of the same kind.
_ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_CLOSES_P = {"article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}


@lru_cache(maxsize=4096)
def features(tag: str, attributes: str, inside: bool) -> tuple[tuple[str, ...], ...]:
    """The tag, marked where it stands inside an article, and each name with its parts.

    Inline tags say nothing by themselves: links and emphasis are as much part of prose.
    """
    out = [] if tag in INLINE else [("in:" + tag if inside else tag,)]
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            for word in next((v for v in values if v), "").lower().split():
                parts = re.split(r"[-_\d]+", word)
                out.append(tuple(f"={p}" for p in dict.fromkeys((word, *parts)) if p))
        if _HIDDEN.search(attributes) or _BARE_HIDDEN.search(_QUOTED.sub("", attributes)):
            out.append(("=hidden",))
    return tuple(out)


def _events(page: str) -> Iterator[tuple[str, tuple | str]]:
    """("text", raw) and ("tag", (closing, name, attributes)) in page order."""
    last = at = 0
    lacking: set[str] = set()
    while m := _TOKEN.search(page, at):
        if m.start() > last:
            yield "text", page[last : m.start()]
        last = at = max(m.end(), at + 1)
        name = (m[3] or "").lower()
        if name in _WHOLE and not m[2] and not m[0].endswith("/>") and name not in lacking:
            if end := _WHOLE[name].search(page, at):
                last = at = end.end()
                yield "gap", name
                continue
            lacking.add(name)
        if name:
            yield "tag", (bool(m[2]), name, m[4] or "")
        elif m[1] or m[0].startswith("<!--"):
            yield "gap", m[0]
    if last < len(page):
        yield "text", page[last:]


class Element(NamedTuple):
    """An open element, and what it and those around it come to."""

    name: str
    found: tuple[tuple[str, ...], ...]
    #: Where the innermost element that isn't inline stands among the open ones.
    block: int
    inside: bool
    #: Number of the innermost article or main on the page; none: -1.
    container: int
    low: float
    total: float


_PAGE = Element("", (), -1, False, -1, 0.0, 0.0)


class Places:
    """The open elements, by the rules that real pages need."""

    def __init__(self, weigh: Callable[[tuple], float] = lambda found: 0.0):
        self.open: list[Element] = []
        self.count: Counter[str] = Counter()
        self.containers, self.weigh = 0, weigh

    @property
    def top(self) -> Element:
        return self.open[-1] if self.open else _PAGE

    def _close(self, at: int) -> None:
        for x in self.open[at:]:
            self.count[x.name] -= 1
        del self.open[at:]

    def tag(self, closing: bool, name: str, attributes: str) -> None:
        if closing:
            if self.count[name]:
                at = len(self.open) - 1
                while self.open[at].name != name:
                    at -= 1
                self._close(at)
            return
        if name == "body":
            self._close(1 if self.open and self.open[0].name == "html" else 0)
        ends = _ENDS.get(name, ()) or (("p",) if name in _CLOSES_P else ())
        if ends and (at := self.top.block) >= 0 and self.open[at].name in ends:
            self._close(at)
        if name not in VOID and not attributes.rstrip().endswith("/"):
            around = self.top
            found = features(name, attributes, around.inside)
            weight = self.weigh(found)
            container = around.container
            if name in ("article", "main"):
                container, self.containers = self.containers, self.containers + 1
            self.open.append(Element(name, found, around.block if name in INLINE else len(self.open), around.inside or name in ("article", "main"), container, min(around.low, weight), around.total + weight))
            self.count[name] += 1


class Weights:
    """Log-odds of element features, of tags, and of a word without any."""

    def __init__(self, pages: list[list[tuple[str, bool]]], smooth: float = 0.5):
        """pages: pieces of html in order, each with whether its words are main text."""
        words, tags = {True: Counter(), False: Counter()}, {True: Counter(), False: Counter()}
        total, n_tags = Counter(), Counter()
        for pieces in pages:
            places = Places()
            for piece, main in pieces:
                for kind, value in _events(piece):
                    if kind == "tag":
                        places.tag(*value)
                        n_tags[main] += 1
                        tags[main][value[1]] += 1
                    elif kind == "text" and (n := len(value.split())):
                        total[main] += n
                        for f in {f for x in places.open for name in x.found for f in name}:
                            words[main][f] += n
        odds = lambda f: math.log((words[True][f] + smooth) / (total[True] + 1)) - math.log((words[False][f] + smooth) / (total[False] + 1))
        self.feature = {f: odds(f) for f in {*words[True], *words[False]}}
        # A tag is evidence against main text: how much rarer tags are there for each word.
        self.tag = min(-0.05, math.log((n_tags[True] / max(1, total[True]) + 0.01) / (n_tags[False] / max(1, total[False]) + 0.01)) / 4)
        self._element = lru_cache(maxsize=8192)(self._weigh)

    def _weigh(self, found: tuple[tuple[str, ...], ...]) -> float:
        known = [self._name(n) for n in found]
        low = min(known, default=0.0)
        return low if low < -1.5 else sum(known)

    def _name(self, name: tuple[str, ...]) -> float:
        """The name's own weight, or its clearest part's; nothing where parts disagree."""
        if name[0] in self.feature:
            return self.feature[name[0]]
        parts = [self.feature[p] for p in name[1:] if p in self.feature]
        low, high = min(parts, default=0.0), max(parts, default=0.0)
        return 0.0 if low < 0 < high else low if low < 0 else high

    def places(self) -> Places:
        return Places(self._element)

    def place(self, top: Element) -> float:
        """Weight of a word under this element and those around it: a clear sign against counts alone."""
        return top.low if top.low < -1.5 else max(-3.0, min(6.0, 0.1 + top.total))


def extract(page: str | None, weights: Weights) -> tuple[str, tuple[int, int]]:
    """(main text, first and last event of the best region)."""
    if not page:
        return "", (0, 0)
    places, scores, runs, block = weights.places(), [], [], 0
    for kind, value in _events(page):
        if kind == "text":
            n = len(value.split())
            w = weights.place(places.top)
            runs.append((block, entities.unescape(value), w, len(scores), places.top.container))
            scores.append(n * w)
        else:
            if kind == "tag":
                places.tag(*value)
                if value[1] not in INLINE:
                    block += 1
                elif value[1] == "br":
                    runs.append((block, " ", None, len(scores), places.top.container))
            scores.append(weights.tag)
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, begin, end = total, start, i + 1
    seeds = {c for _, text, w, i, c in runs if begin <= i < end and w and w > 0 and c >= 0 and text.strip()}
    blocks: dict[int, list[str]] = {}
    for of, text, w, i, c in runs:
        if (begin <= i < end or c in seeds) and (w is None or w > 0):
            blocks.setdefault(of, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x), (begin, end)


def labelled_pages() -> list[list[tuple[str, bool]]]:
    """Pages of usual layouts, each piece labelled as main text or not."""
    prose = "several plain words that make up a sentence of the story , told at some length and with care ."
    link = '<li><a href="/x">topic</a></li>'
    body = "".join(f"<p>{prose}</p>" for _ in range(6))
    boiler = {
        "nav": ["menu", "navbar", "breadcrumb", "pagination", "pager", "toc"], "header": ["header", "masthead", "site-header", "banner", "topbar"], "footer": ["footer", "site-footer", "copyright", "legal", "colophon"],
        "aside": ["sidebar", "widget", "related", "recommended", "trending", "promo"], "form": ["search", "login", "newsletter", "subscribe", "signup", "contact"],
        "div": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "banner", "cookie", "consent", "notice", "alert", "popup", "modal", "overlay", "share", "social", "hidden", "menu", "sidebar", "footer", "promo", "outbrain", "taboola", "navigation", "skip", "toolbar", "warning", "disclaimer", "gdpr", "cookies", "notification", "nav"],
        "section": ["comments", "comment", "replies", "reply", "responses", "discussion", "disqus", "related", "reviews", "commentlist", "respond"],
    }
    content = ["<article>", "<main>", "<div class='content'>", "<div class='post'>", "<div class='entry article'>", "<div id='story' class='text'>", "<article class='body main'>", "<section>", "<div>"]
    pages = []
    for k, open_tag in enumerate(content * 4):
        close = f"</{re.match(r'<(\w+)', open_tag)[1]}>"
        pick = lambda tag, k=k: boiler[tag][k % len(boiler[tag])]
        page = [("<html><head><meta charset='utf-8'><link rel='x'></head><body>", False), (f"<nav class='{pick('nav')}'><ul>{link * 5}</ul></nav><header class='{pick('header')}'><a href='/'>name of the site</a></header>", False)]
        for name in boiler["div"]:
            page.append((f"<div class='{name}'>{prose[:40]}<a href='/x'>more</a></div>", False))
        page += [(open_tag, True), (f"<header><h1>a title of a few words</h1></header><h2>part</h2>{body}" if k % 2 else f"<h1>a title of a few words</h1>{body}", True)]
        page += [(f"<aside class='{pick('aside')}'><p>{prose[:50]}</p></aside><div class='{pick('div')}'>{prose[:40]}</div>", False)]
        page += [(f"<blockquote>{prose}</blockquote><ul><li>{prose}</li><li>{prose}</li></ul><table><tr><td>{prose}</td></tr></table><h3>part</h3><pre>{prose}</pre>{body}", True), (f"<footer><p>{prose[:50]}</p></footer>", False), (close, True)]
        page += [(f"<section class='{c}' id='{c}'><div class='{c}'><p>{prose[:60]}</p></div></section>", False) for c in boiler["section"]]
        page += [(f"<form class='{f}'><label>name</label><button>send it now</button></form>", False) for f in boiler["form"]]
        page += [(f"<aside class='{a}'><h3>more</h3><ul>{link * 4}</ul></aside>", False) for a in boiler["aside"]]
        page += [(f"<footer class='{pick('footer')}'><p>all rights are kept by the owner</p><ul>{link * 4}</ul></footer></body></html>", False)]
        pages.append(page)
    return pages


_weights: list[Weights] = []


def default_weights() -> Weights:
    """The weights of `labelled_pages`, learned once in a process."""
    if not _weights:
        _weights.append(Weights(labelled_pages()))
    return _weights[0]


@released
def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = default_weights()
    for batch in batches:
        texts = [extract(cell.as_py(), weights)[0] for cell in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of each row."""
    small_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extracted, f"page_id {kind}, url string, text string, n_chars bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


SQL = r"""
WITH a AS (
  SELECT page_id, url, coalesce(regexp_extract(html, '<article[^>]*>(.*?)(?:</article>|$)', 1, 's'), '') AS body FROM pages
), b AS (
  SELECT page_id, url, unnest(string_split(regexp_replace(body, '</?(p|h[1-6]|div|ul|li)[^>]*>', chr(1), 'g'), chr(1))) AS raw, generate_subscripts(string_split(regexp_replace(body, '</?(p|h[1-6]|div|ul|li)[^>]*>', chr(1), 'g'), chr(1)), 1) AS i FROM a
), c AS (
  SELECT page_id, url, i, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(raw, '<br[^>]*>', ' ', 'g'), '<[^>]*(>|$)', '', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS t FROM b
), d AS (SELECT page_id, string_agg(t, chr(10) ORDER BY i) AS text FROM c WHERE t <> '' GROUP BY page_id)
SELECT p.page_id, p.url, coalesce(d.text, '') AS text, CAST(length(coalesce(d.text, '')) AS BIGINT) AS n_chars FROM pages p LEFT JOIN d ON p.page_id = d.page_id
"""
