"""Sources: parsers over captured pages and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import parse
from attesta.plans.catalog import query
from attesta.sources import tables
from attesta.sources.tables import table


@query("html_shape_profile")
def html_shape_profile(spark, d):
    return parse.shapes(table(spark, d, "pages")).groupBy("signature").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))


@query("html_tag_histogram", "SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages) GROUP BY 1")
def html_tag_histogram(spark, d):
    return parse.tag_counts(table(spark, d, "pages"))


@query("scan_ledger_point", "SELECT 'job_' || event_id AS record_id, event_type FROM events WHERE event_id = 77")
def scan_ledger_point(spark, d):
    rows = tables.ledger(spark, d).where("record_type = 'job' and record_id = 'job_77'")
    return rows.select("record_id", F.get_json_object("body", "$.event_type").alias("event_type"))
