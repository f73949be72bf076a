"""Parsers of captured pages: regular expressions where they are exact, Arrow batches where not."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.text import collapse

SIGNATURES, DEPTH = 512, 10
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


def anchors(page: Column) -> Column:
    """href of each anchor, in page order."""
    return F.regexp_extract_all(page, F.lit(r'<a href="([^"]*)">'), F.lit(1))


def title(page: Column) -> Column:
    return collapse(F.regexp_extract(page, r"(?s)<title>(.*?)</title>", 1))


def language(page: Column) -> Column:
    return F.regexp_extract(page, r'<html lang="([a-z]+)"', 1)


def tag_counts(pages: DataFrame) -> DataFrame:
    """tag, n: opening tags over all pages."""
    tags = F.regexp_extract_all("html", F.lit(r"<([a-z][a-z0-9]*)"), F.lit(1))
    return pages.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


#: What stands for the signatures beyond the bound of a page, and for elements that lie deeper.
MORE, DEEPER = "(more)", "(deeper)"


class _Shape(HTMLParser):
    """Path of tags and the names of their attributes, content left out; what the bounds leave out is counted as such."""

    def __init__(self):
        super().__init__()
        self.path: list[str] = []
        self.seen: dict[str, int] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if len(self.path) < DEPTH:
            names = ",".join(sorted(k for k, _ in attrs))
            key = "/".join([*self.path, tag]) + (f"[{names}]" if names else "")
        else:
            key = DEEPER
        if key not in self.seen and len(self.seen) >= SIGNATURES and key != DEEPER:
            key = MORE
        self.seen[key] = self.seen.get(key, 0) + 1
        if tag not in VOID:
            self.path.append(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        depth = len(self.path)
        self.handle_starttag(tag, attrs)
        del self.path[depth:]

    def handle_endtag(self, tag: str) -> None:
        if tag in self.path:
            while self.path.pop() != tag:
                pass


def shapes(pages: DataFrame) -> DataFrame:
    """page_id, signature, n: the structural profile of each page."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, html in zip(b["page_id"], b["html"], strict=True):
                rows += [(page_id, k, n) for k, n in shape_of(html).items()]
            yield pd.DataFrame(rows, columns=["page_id", "signature", "n"])

    return pages.select("page_id", "html").mapInPandas(work, "page_id bigint, signature string, n bigint")


def shape_of(page: str | None) -> dict[str, int]:
    """Signatures of one page and how often each occurs."""
    p = _Shape()
    p.feed(page or "")
    return p.seen


def robots(body: Column, url: Column, agent: str = "corpus-reader") -> Column:
    """robots_allowed, robots_denied, or robots_ambiguous where no agent is named."""

    @F.pandas_udf("string")
    def classify(bodies: pd.Series, urls: pd.Series) -> pd.Series:
        out = []
        for text, at in zip(bodies, urls, strict=True):
            if not text or "user-agent:" not in text.lower():
                out.append("robots_ambiguous")
                continue
            rules = RobotFileParser()
            rules.parse(text.splitlines())
            out.append("robots_allowed" if rules.can_fetch(agent, at) else "robots_denied")
        return pd.Series(out)

    return classify(body, url)
