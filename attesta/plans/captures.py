"""Readers of captured pages and responses; the twins say what the rules that wrote them put in."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import capture
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.tables import table


def family(spark, d, name):
    return evidence.family(spark, d, name)


@query("parse_rest_json", ctes("cap_rest") + """, s AS (SELECT *, CASE WHEN x_pages <> CAST(ceil(x_total / 4.0) AS BIGINT) OR (x_total = 0) <> (x_pages = 0) THEN 'headers_inconsistent' WHEN page > x_pages THEN 'beyond_pagination' WHEN odd = 1 THEN 'shape_changed' ELSE 'ok' END AS state FROM cap_rest)
  SELECT endpoint, page, state, CASE WHEN state = 'ok' THEN items END AS items, CASE WHEN state = 'ok' THEN x_total END AS declared_total, CASE WHEN state = 'ok' THEN page >= x_pages END AS terminal, CASE WHEN state = 'ok' AND page < x_pages THEN 'page-' || lpad(CAST(page + 1 AS VARCHAR), 3, '0') END AS next_cursor FROM s""")
def parse_rest_json(spark, d):
    """Pages of posts: exact fields, headers that agree with each other and with the page."""
    return capture.post_pages(family(spark, d, "cap_rest"), 4, ["id", "link"]).withColumn("items", F.col("items").cast("bigint"))


@query("parse_sitemap_xml", ctes("cap_entry") + """, s AS (SELECT *, CASE WHEN sitemap % 13 = 6 THEN 'prologue_not_canonical' WHEN sitemap % 19 = 5 AND sitemap % 17 <> 2 THEN 'unreviewed_construct' WHEN sitemap % 11 = 3 THEN 'root_changed' WHEN sitemap % 17 = 2 THEN 'loc_missing' ELSE 'ok' END AS state, CASE WHEN sitemap % 4 = 1 THEN 'sitemap' ELSE 'url' END AS kind FROM cap_entry)
  SELECT DISTINCT sitemap, state, CASE WHEN state IN ('ok', 'loc_missing') THEN kind END AS kind, CASE WHEN state = 'ok' THEN loc END AS loc, CASE WHEN state = 'ok' AND lastmod LIKE '%Z' THEN lastmod END AS modified_at, state = 'ok' AND lastmod IS NOT NULL AND lastmod NOT LIKE '%Z' AS odd_time FROM s""")
def parse_sitemap_xml(spark, d):
    """Sitemaps and sitemap indexes, namespace and entries strict; one that isn't is named and gives no entry."""
    rows = family(spark, d, "cap_sitemap").select("sitemap", capture.sitemap(F.col("body")).alias("s")).select("sitemap", "s.state", "s.kind", F.explode_outer("s.entries").alias("e"))
    good = capture.utc_instant(F.col("e.lastmod"))
    return rows.select("sitemap", "state", "kind", F.col("e.loc").alias("loc"), F.when(good, F.col("e.lastmod")).alias("modified_at"), (F.col("e.lastmod").isNotNull() & ~good).alias("odd_time"))


@query("parse_html_fragment", ctes("cap_list_item") + """, s AS (SELECT list, CASE WHEN count(*) > 8 THEN 'too_many' WHEN count(DISTINCT object) <> count(*) THEN 'ids_repeat' ELSE 'ok' END AS state, count(*) AS n FROM cap_list_item GROUP BY 1)
  SELECT list, state, n, CASE WHEN state = 'ok' THEN CAST(object AS VARCHAR) END AS id, CASE WHEN state = 'ok' THEN trim(regexp_replace(p_name, '\\s+', ' ', 'g')) || CASE WHEN p_partkey % 2 = 0 THEN ' new' ELSE '' END END AS title FROM s LEFT JOIN cap_list_item USING (list) QUALIFY state = 'ok' OR row_number() OVER (PARTITION BY list) = 1""".replace("\\\\s", "\\s"))
def parse_html_fragment(spark, d):
    """Lists of linked objects: at most eight, ids unique, titles collapsed; a list that isn't so is named."""
    rows = capture.list_fragment(family(spark, d, "cap_list"), "/mediaObjects/")
    kept = F.when(F.col("state") == "ok", F.col("items")).otherwise(F.slice("items", 1, 0))
    rows = rows.select("list", "state", F.size("items").cast("bigint").alias("n"), F.explode_outer(kept).alias("i"))
    return rows.select("list", "state", "n", F.col("i.id").alias("id"), F.col("i.title").alias("title"))


@query("parse_html_pdf_links", ctes("cap_pdf_item") + """, s AS (SELECT page, CASE WHEN count(*) <> 8 THEN 'count_changed' ELSE 'ok' END AS state FROM cap_pdf_item GROUP BY 1)
  SELECT page, state, CASE WHEN state = 'ok' THEN 'https://f.example.org/files/' || p_partkey || '.PDF' END AS url FROM s JOIN cap_pdf_item USING (page) QUALIFY state = 'ok' OR row_number() OVER (PARTITION BY page) = 1""")
def parse_html_pdf_links(spark, d):
    """Pages of just eight PDF files, urls absolute and without fragment."""
    rows = capture.pdf_links(family(spark, d, "cap_pdf"), "https://f.example.org")
    kept = F.when(F.col("state") == "ok", F.col("files")).otherwise(F.slice("files", 1, 0))
    return rows.select("page", "state", F.explode_outer(kept).alias("f")).select("page", "state", F.col("f.url").alias("url"))


@query("parse_html_meta", """WITH s AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'canonical_missing' WHEN page_id % 9 = 0 THEN 'metadata_ambiguous' ELSE 'ok' END AS state FROM pages) SELECT page_id, state, CASE WHEN state = 'ok' THEN 'https://s.example.org/p/' || page_id END AS canonical, CASE WHEN state = 'ok' THEN 'Page ' || page_id END AS title, CASE WHEN state = 'ok' THEN 'a' || (page_id % 5) END AS author FROM s""")
def parse_html_meta(spark, d):
    """Canonical address, title and author of an article's head."""
    return capture.article(family(spark, d, "cap_article"))


@query("parse_html_catalogue", """SELECT page_id, CASE WHEN page_id % 6 <> 0 AND page_id = page_id % 10 THEN 'ids_repeat' ELSE 'ok' END AS state, CASE WHEN page_id % 6 = 0 THEN '' ELSE 'r' || page_id || ',' END || 'r' || (page_id % 10) AS ids, CASE WHEN page_id % 2 = 0 THEN 'c' || (page_id + 1) END AS next_cursor, CASE WHEN page_id % 2 = 0 THEN page_id END AS next_ordinal FROM pages""")
def parse_html_catalogue(spark, d):
    """Articles with a record id, and the cursor and ordinal of the next page."""
    return capture.catalogue(family(spark, d, "cap_article")).withColumn("ids", F.array_join("ids", ","))


@query("parse_youtube_channel", "WITH s AS (SELECT c_custkey AS handle, CASE WHEN c_custkey % 11 = 0 THEN 'channel_missing' WHEN c_custkey % 13 = 0 THEN 'channel_ambiguous' ELSE 'ok' END AS state FROM customer) SELECT handle, state, CASE WHEN state = 'ok' THEN 'channel_' || handle END AS channel, CASE WHEN state = 'ok' THEN 'uploads_' || handle END AS uploads FROM s")
def parse_youtube_channel(spark, d):
    """A handle's one channel and its playlist of uploads."""
    return capture.channels(family(spark, d, "cap_channel"))


@query("parse_youtube_uploads", ctes("cap_post") + """, p AS (SELECT endpoint AS playlist, page, post, max(page) OVER (PARTITION BY endpoint) AS last_page FROM cap_post), t AS (SELECT *, page < last_page AND NOT (playlist % 23 = 0 AND page = 1) AS more FROM p)
  SELECT playlist, page, 'video_' || post AS video, CASE WHEN more THEN sha256('token_' || playlist || '_' || (page + 1)) END AS cursor_sha, NOT more AS terminal FROM t""")
def parse_youtube_uploads(spark, d):
    """Videos of each captured page of a playlist, with the digest of the opaque next cursor."""
    pages = capture.uploads(family(spark, d, "cap_upload"))
    return pages.select("playlist", "page", F.explode("videos").alias("video"), "cursor_sha", "terminal")


@query("parse_youtube_videos", """WITH s AS (SELECT c_custkey AS video, CASE WHEN c_custkey % 7 = 0 THEN 'not_found' WHEN c_custkey % 37 = 0 THEN 'privacy_unknown' WHEN c_custkey % 24 = 0 THEN 'region_changed' WHEN c_custkey % 10 = 3 THEN 'live_unknown' ELSE 'ok' END AS state FROM customer)
  SELECT video, state, CASE WHEN state = 'not_found' THEN state WHEN state <> 'ok' THEN NULL WHEN video % 9 = 0 THEN 'age_gated' WHEN video % 8 = 0 THEN 'region_blocked' WHEN video % 5 = 0 THEN 'private' WHEN video % 6 = 0 THEN 'unlisted' ELSE 'public' END AS availability,
  CASE WHEN state <> 'ok' THEN NULL WHEN video % 10 = 0 THEN 'completed' WHEN video % 10 = 1 THEN 'live' WHEN video % 10 = 2 THEN 'upcoming' ELSE 'not_live' END AS broadcast_state, CASE WHEN state = 'ok' THEN 'PT' || (video % 60) || 'M' END AS duration FROM s""")
def parse_youtube_videos(spark, d):
    """Requested ids against the response: availability and broadcast state of each, also of those not answered."""
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("video"))
    return capture.videos(asked, family(spark, d, "cap_video"))


@query("join_requested_response", "SELECT c_custkey AS requested, c_custkey % 7 <> 0 AS answered FROM customer")
def join_requested_response(spark, d):
    """Every requested id, and whether the response has it; an answer that wasn't asked for doesn't appear."""
    asked = table(spark, d, "customer").select(F.col("c_custkey").alias("requested"))
    got = family(spark, d, "cap_video").select(F.col("video").alias("requested"), F.lit(True).alias("a")).distinct()
    return asked.join(got, "requested", "left").select("requested", F.coalesce("a", F.lit(False)).alias("answered"))
