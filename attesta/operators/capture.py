"""Strict readers of captured pages and responses: what isn't of the known shape is named, never guessed.

HTML and XML are read in Arrow batches by the standard library's parsers, JSON by Spark; the rules of
each shape are column expressions over what the parsers give.
"""

from __future__ import annotations

from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.text import collapse
from attesta.operators import policy

# Fixed values of the sitemap protocol.
PROLOGUE = '<?xml version="1.0" encoding="UTF-8"?>'
NAMESPACE = "{http://www.sitemaps.org/schemas/sitemap/0.9}"
_ELEMENT = "array<struct<tag:string,attributes:map<string,string>,text:string>>"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class _Walker(HTMLParser):
    """Elements of some tags with their attributes and all text inside them, in page order."""

    def __init__(self, tags: set[str]):
        super().__init__()
        self.tags, self.found, self.open = tags, [], []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.tags:
            entry = {"tag": tag, "attributes": {k: v or "" for k, v in attrs}, "text": []}
            self.found.append(entry)
            if tag not in _VOID:
                self.open.append(entry)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        for entry in self.open:
            entry["text"].append(data)


def elements(body: Column, *tags: str) -> Column:
    """array of (tag, attributes, text) of the elements of these tags; null for a null body."""

    @F.pandas_udf(_ELEMENT)
    def walk(bodies: pd.Series) -> pd.Series:
        out = []
        for text in bodies:
            w = _Walker(set(tags))
            w.feed(text or "")
            w.close()
            out.append(None if text is None else [{**e, "text": "".join(e["text"])} for e in w.found])
        return pd.Series(out)

    return walk(body)


def sitemap(body: Column) -> Column:
    """struct(state, kind, entries(loc, lastmod)) of a sitemap or sitemap index; entries only where all is well."""

    @F.pandas_udf("state string, kind string, entries array<struct<loc:string,lastmod:string>>")
    def read(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_sitemap(b) for b in bodies], columns=["state", "kind", "entries"])

    return read(body)


def _sitemap(text: str | None) -> tuple[str, str | None, list | None]:
    if text is None or not text.startswith(PROLOGUE):
        return "prologue_not_canonical", None, None
    rest = text[len(PROLOGUE) :]
    if any(mark in rest for mark in ("<!", "<?", "&", "]]>")):
        return "unreviewed_construct", None, None
    try:
        root = ElementTree.fromstring(text)
    except ElementTree.ParseError:
        return "not_well_formed", None, None
    kinds = {f"{NAMESPACE}urlset": ("url", "url"), f"{NAMESPACE}sitemapindex": ("sitemap", "sitemap")}
    if root.tag not in kinds:
        return "root_changed", None, None
    child_tag, kind = kinds[root.tag]
    blank = lambda t: t is None or not t.strip()
    entries = []
    for child in root:
        fields = {leaf.tag.removeprefix(NAMESPACE): leaf.text for leaf in child}
        plain = all(not leaf.attrib and not len(leaf) and leaf.text is not None and blank(leaf.tail) for leaf in child)
        if child.tag != NAMESPACE + child_tag or child.attrib or not blank(child.text) or not blank(child.tail) or len(fields) != len(child) or not set(fields) <= {"loc", "lastmod"} or not plain:
            return "entry_changed", kind, None
        if "loc" not in fields:
            return "loc_missing", kind, None
        entries.append({"loc": fields["loc"], "lastmod": fields.get("lastmod")})
    return "ok", kind, entries


def utc_instant(text: Column) -> Column:
    """Whether a text is an instant that says it is UTC."""
    return policy.closed(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?Z$") & F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")).isNotNull())


def post_pages(responses: DataFrame, per_page: int, keys: list[str]) -> DataFrame:
    """endpoint, page, state, items, declared_total, terminal, next_cursor of each captured page (body, x_total, x_pages)."""
    c = F.col
    items = F.from_json("body", "array<map<string,string>>")
    want = F.array(*(F.lit(k) for k in sorted(keys)))
    rows = responses.withColumn("_i", items)
    n = F.size("_i")
    odd = F.exists("_i", lambda m: ~(F.array_sort(F.map_keys(m)) == want))
    wrong = ((c("x_total") == 0) != (c("x_pages") == 0)) | (c("x_pages") != F.ceil(c("x_total") / per_page))
    state = policy.first_reason([
        (c("_i").isNull(), "not_json"), (F.coalesce(wrong, F.lit(True)), "headers_inconsistent"), (n > per_page, "page_too_long"), ((c("page") > c("x_pages")) & (n > 0), "beyond_pagination"), ((c("page") <= c("x_pages")) & (n == 0), "ended_early"), (odd, "shape_changed"), (F.lit(True), "ok"),
    ])
    last = c("page") >= c("x_pages")
    ok = c("state") == "ok"
    out = rows.withColumn("state", state).withColumn("items", n)
    return out.select("endpoint", "page", "state", F.when(ok, c("items")).alias("items"), F.when(ok, c("x_total")).alias("declared_total"), F.when(ok, last).alias("terminal"), F.when(ok & ~last, F.format_string("page-%03d", (c("page") + 1).cast("int"))).alias("next_cursor"))


def channels(responses: DataFrame) -> DataFrame:
    """handle, state, channel, uploads: a handle is one channel with one playlist of uploads, or nothing."""
    items = F.from_json("body", "items array<struct<id:string,contentDetails:struct<relatedPlaylists:struct<uploads:string>>>>")["items"]
    rows = responses.withColumn("_i", items)
    one = F.col("_i")[0]
    found = F.size("_i") == 1
    state = F.when(F.coalesce(F.size("_i"), F.lit(0)) == 0, "channel_missing").when(~found, "channel_ambiguous").when(one["contentDetails"]["relatedPlaylists"]["uploads"].isNull(), "uploads_missing").otherwise("ok")
    ok = F.col("state") == "ok"
    return rows.withColumn("state", state).select("handle", "state", F.when(ok, one["id"]).alias("channel"), F.when(ok, one["contentDetails"]["relatedPlaylists"]["uploads"]).alias("uploads"))


def uploads(responses: DataFrame) -> DataFrame:
    """playlist, page, videos, cursor_sha (the next cursor is opaque: only its digest is kept), terminal of each captured page."""
    got = F.from_json("body", "items array<struct<contentDetails:struct<videoId:string>>>, nextPageToken string")
    rows = responses.withColumn("_g", got)
    token = F.col("_g.nextPageToken")
    return rows.select("playlist", "page", F.transform("_g.items", lambda i: i.contentDetails.videoId).alias("videos"), F.sha2(token, 256).alias("cursor_sha"), token.isNull().alias("terminal"))


def videos(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """video, state, availability, broadcast_state, duration of each requested id; one that wasn't answered is not found.

    requested: (video); responses: (video, body). The last of private or unlisted, region and age counts.
    """
    shape = "status struct<privacyStatus:string>, contentDetails struct<duration:string,regionRestriction:map<string,array<string>>,contentRating:map<string,string>>, liveStreamingDetails map<string,string>"
    rows = requested.join(responses.select("video", F.from_json("body", shape).alias("v")), "video", "left")
    v, c = F.col("v"), F.col
    region, rating, live = v["contentDetails"]["regionRestriction"], v["contentDetails"]["contentRating"], v["liveStreamingDetails"]
    countries = F.map_values(region)[0]
    region_ok = (F.size(region) == 1) & F.arrays_overlap(F.map_keys(region), F.array(F.lit("allowed"), F.lit("blocked"))) & (F.size(countries) > 0) & F.forall(countries, lambda x: x.rlike("^[A-Z]{2}$"))
    rating_ok = (F.size(F.array_except(F.map_keys(rating), F.array(F.lit("ytRating")))) == 0) & (rating["ytRating"].isNull() | (rating["ytRating"] == "ytAgeRestricted"))
    at = lambda k: F.try_element_at(live, F.lit(k))
    stage = F.when(live.isNull(), "not_live").when(at("actualEndTime").isNotNull(), "completed").when(at("actualStartTime").isNotNull(), "live").when(at("scheduledStartTime").isNotNull(), "upcoming")
    privacy = v["status"]["privacyStatus"]
    state = policy.first_reason([
        (v.isNull(), "not_found"), (~policy.closed(privacy.isin("private", "public", "unlisted")), "privacy_unknown"), (region.isNotNull() & ~policy.closed(region_ok), "region_changed"), (rating.isNotNull() & ~policy.closed(rating_ok), "rating_changed"), (stage.isNull(), "live_unknown"), (F.lit(True), "ok"),
    ])
    availability = F.when(policy.closed(rating["ytRating"] == "ytAgeRestricted"), "age_gated").when(region.isNotNull(), "region_blocked").otherwise(privacy)
    ok = c("state") == "ok"
    return rows.withColumn("state", state).select("video", "state", F.when(ok, availability).when(c("state") == "not_found", "not_found").alias("availability"), F.when(ok, stage).alias("broadcast_state"), F.when(ok, v["contentDetails"]["duration"]).alias("duration"))


def list_fragment(bodies: DataFrame, prefix: str, most: int = 8) -> DataFrame:
    """bodies' rows with state and items (id, title): links under a prefix, at most `most`, ids unique, white space collapsed."""
    links = F.filter(elements(F.col("body"), "a"), lambda e: F.startswith(F.try_element_at(e.attributes, F.lit("href")), F.lit(prefix)))
    items = F.transform(links, lambda e: F.struct(F.substring(e.attributes["href"], len(prefix) + 1, 1000).alias("id"), collapse(e.text).alias("title")))
    rows = bodies.withColumn("items", items)
    ids = F.transform("items", lambda i: i.id)
    state = F.when(F.size("items") == 0, "empty").when(F.size("items") > most, "too_many").when(F.size(F.array_distinct(ids)) != F.size("items"), "ids_repeat").when(F.exists("items", lambda i: ~i.id.rlike("^[0-9]+$") | (i.title == "")), "item_changed").otherwise("ok")
    return rows.withColumn("state", state)


def pdf_links(bodies: DataFrame, host: str, exactly: int = 8, most_title: int = 120) -> DataFrame:
    """bodies' rows with state and files (url, title): just `exactly` links to PDF files, urls absolute and without fragment."""
    href = lambda e: F.coalesce(F.try_element_at(e.attributes, F.lit("href")), F.lit(""))
    bare = lambda e: F.regexp_replace(href(e), "#.*$", "")
    links = F.filter(elements(F.col("body"), "a"), lambda e: F.lower(bare(e)).endswith(".pdf"))
    full = lambda e: F.when(bare(e).startswith("/"), F.concat(F.lit(host), bare(e))).otherwise(bare(e))
    rows = bodies.withColumn("files", F.transform(links, lambda e: F.struct(full(e).alias("url"), F.left(collapse(e.text), F.lit(most_title)).alias("title"))))
    urls = F.transform("files", lambda f: f.url)
    state = F.when(F.size("files") != exactly, "count_changed").when(F.size(F.array_distinct(urls)) != exactly, "urls_repeat").when(F.exists("files", lambda f: ~f.url.startswith(host)), "host_changed").otherwise("ok")
    return rows.withColumn("state", state)


def article(bodies: DataFrame) -> DataFrame:
    """bodies' rows with state, canonical, title, author: head metadata of an article; a name that is given twice is ambiguous."""
    found = bodies.withColumn("_m", elements(F.col("body"), "meta", "link"))
    named = lambda k: F.filter("_m", lambda e: (F.try_element_at(e.attributes, F.lit("property")) == k) | (F.try_element_at(e.attributes, F.lit("name")) == k))
    value = lambda k: collapse(F.try_element_at(F.get(named(k), 0)["attributes"], F.lit("content")))
    link = F.filter("_m", lambda e: F.try_element_at(e.attributes, F.lit("rel")) == "canonical")
    state = F.when(F.size(link) != 1, "canonical_missing").when(F.size(named("og:title")) > 1, "metadata_ambiguous").otherwise("ok")
    ok = state == "ok"
    return found.select(*bodies.columns, state.alias("state"), F.when(ok, F.get(link, 0)["attributes"]["href"]).alias("canonical"), F.when(ok, value("og:title")).alias("title"), F.when(ok, value("author")).alias("author")).drop("body")


def catalogue(bodies: DataFrame) -> DataFrame:
    """bodies' rows with state, ids, next_cursor, next_ordinal: articles with a record id, and where the next page begins."""
    found = bodies.withColumn("_a", elements(F.col("body"), "article")).withColumn("_m", elements(F.col("body"), "meta"))
    ids = F.filter(F.transform("_a", lambda e: F.try_element_at(e.attributes, F.lit("data-record-id"))), lambda x: x.isNotNull())
    meta = lambda k: F.try_element_at(F.get(F.filter("_m", lambda e: F.try_element_at(e.attributes, F.lit("name")) == k), 0)["attributes"], F.lit("content"))
    state = F.when(F.size(F.array_distinct(ids)) != F.size(ids), "ids_repeat").otherwise("ok")
    return found.select(*bodies.columns, state.alias("state"), ids.alias("ids"), meta("next-cursor").alias("next_cursor"), meta("next-ordinal").cast("bigint").alias("next_ordinal")).drop("body")
