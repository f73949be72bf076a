"""Filters, projections, search and export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text, times, values
from attesta.operators import policy, search
from attesta.plans.catalog import query
from attesta.sources import evidence, records
from attesta.sources.records import CTES, NOW
from attesta.sources.tables import table

def now():
    """The instant at which queries are asked."""
    return times.at(NOW)


def granted(spark: SparkSession, d: str, docs: DataFrame | None = None) -> DataFrame:
    flds = records.fields(records.documents(spark, d) if docs is None else docs)
    return search.grants(flds, records.policies(flds), records.edges(flds))


def shown(spark: SparkSession, d: str, audience: str = "researcher", operation: str = "search_visibility", docs: DataFrame | None = None) -> DataFrame:
    return search.visible(granted(spark, d, docs), now(), operation, audience)


VISIBLE = "SELECT * FROM granted WHERE list_contains(allowed_operations, '{}') AND list_contains(allowed_audiences, '{}')"
SHOWN = CTES + ", shown AS (" + VISIBLE.format("search_visibility", "researcher") + ")"
RESULTS = SHOWN + """, results AS (
  SELECT document_id, CAST(count(*) FILTER (contains(lower(name || ' ' || value), 'the')) AS BIGINT) AS match_count, count(*) AS visible_fields
  FROM shown WHERE doc_id IN (SELECT doc_id FROM docs WHERE language = 'en') GROUP BY document_id HAVING match_count > 0)"""


@query("filter_structural", CTES + "SELECT doc_id, source_id, period FROM docs WHERE language = 'en' AND period = 'middle' AND medium = 'image' AND selection_state = 'inventory_only'")
def filter_structural(spark, d):
    return policy.structural(records.documents(spark, d), language="en", period="middle", medium="image", selection_state="inventory_only", source_id=None).select("doc_id", "source_id", "period")


@query("filter_rights", CTES + "SELECT field_id, policy_id FROM granted")
def filter_rights(spark, d):
    return granted(spark, d).where(policy.authorised(now()) & policy.evidence_holds(now())).select("field_id", "policy_id")


@query("filter_operation_audience", CTES + "SELECT field_id FROM (" + VISIBLE.format("score_generation", "operator") + ")")
def filter_operation_audience(spark, d):
    return shown(spark, d, "operator", "score_generation").select("field_id")


@query("filter_terms", SHOWN + "SELECT field_id, name FROM shown WHERE contains(lower(name || ' ' || value), 'the') AND contains(lower(name || ' ' || value), 'title')")
def filter_terms(spark, d):
    return shown(spark, d).where(search.term_match(["The", "title", " "])).select("field_id", "name")


@query("project_snippet", SHOWN + """SELECT field_id, length(value) AS value_length, CASE WHEN list_contains(allowed_operations, 'snippet_render') THEN
  CASE WHEN length(trim(regexp_replace(value, '\\s+', ' ', 'g'))) <= 96 THEN trim(regexp_replace(value, '\\s+', ' ', 'g')) ELSE left(trim(regexp_replace(value, '\\s+', ' ', 'g')), 96) || '…' END END AS snippet FROM shown""")
def project_snippet(spark, d):
    return search.snippets(shown(spark, d)).withColumn("value_length", F.col("value_length").cast("bigint"))


@query("project_feature_value", CTES + "SELECT document_id, field_id, CASE WHEN list_contains(allowed_operations, 'score_feature_value') THEN value END AS feature_value FROM (" + VISIBLE.format("score_generation", "operator") + ")")
def project_feature_value(spark, d):
    return search.feature_values(shown(spark, d, "operator", "score_generation"))


def results(spark, d, clusters=False):
    docs = policy.structural(records.documents(spark, d, clusters), language="en")
    return docs, search.matched(shown(spark, d, docs=docs), ["the"])


@query("rank_search", RESULTS + "SELECT document_id, match_count, visible_fields, CAST(row_number() OVER (ORDER BY match_count DESC, visible_fields DESC, document_id) AS INTEGER) AS rank FROM results QUALIFY rank <= 50")
def rank_search(spark, d):
    """Top 50 of the English documents that a researcher may see and that say `the` in one field."""
    return search.rank(results(spark, d)[1], 50)


@query("query_index", SHOWN + "SELECT document_id, string_agg(field_id, ',' ORDER BY field_id) AS field_ids FROM shown GROUP BY document_id")
def query_index(spark, d):
    return shown(spark, d).groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_list("field_id")), ",").alias("field_ids"))


@query("agg_doc_match", RESULTS + "SELECT * FROM results")
def agg_doc_match(spark, d):
    return results(spark, d)[1]


STATE = """, hits AS (SELECT doc_id, string_agg(DISTINCT target_id, ',' ORDER BY target_id) AS target_ids FROM ddims JOIN tgts USING (dimension, value) GROUP BY 1),
  covered AS (SELECT d.doc_id, CASE WHEN target_ids IS NULL THEN 'outside_coverage_targets' WHEN selection_state = 'selected_rich_corpus' THEN 'selected_contribution' ELSE 'unselected_candidate' END AS coverage_state, target_ids FROM docs d LEFT JOIN hits USING (doc_id))"""


@query("agg_facets", RESULTS + STATE + """, r AS (SELECT docs.*, coverage_state FROM docs JOIN results USING (document_id) JOIN covered USING (doc_id)), f AS (
  SELECT unnest(['source_id', 'period', 'selection_state', 'coverage_state', 'cluster_id']) AS facet, unnest([source_id, period, selection_state, coverage_state, cluster_id]) AS value FROM r UNION ALL SELECT 'languages', unnest(languages) FROM r UNION ALL SELECT 'mediums', unnest(mediums) FROM r)
  SELECT *, CAST(row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS INTEGER) AS place FROM (SELECT facet, value, count(*) AS n FROM f WHERE value IS NOT NULL GROUP BY ALL)""")
def agg_facets(spark, d):
    """Seven dimensions over all results; those of arrays count each label."""
    docs, found = results(spark, d, clusters=True)
    every = records.documents(spark, d)
    state = search.coverage_state(every, records.targets(every)).select("doc_id", "coverage_state")
    return search.facets(docs.join(found, "document_id", "left_semi").join(state, "doc_id"))


@query("search_corpus_index", RESULTS + """, ev AS (SELECT document_id, strftime(max(make_timestamp((1767225600 + evidence * 86400) * 1000000)), '%Y-%m-%dT%H:%M:%SZ') AS evidence_at, strftime(min(make_timestamp((1767225600 + evidence_expires * 86400) * 1000000)), '%Y-%m-%dT%H:%M:%SZ') AS evidence_expires_at FROM shown GROUP BY 1)
  SELECT document_id, source_id, period, match_count, visible_fields, evidence_at, evidence_expires_at, count(*) OVER () AS result_count FROM results JOIN ev USING (document_id) JOIN docs USING (document_id)""")
def search_corpus_index(spark, d):
    docs = policy.structural(records.documents(spark, d), language="en")
    at, ends = F.max(times.text(F.col("evidence_at"))).alias("evidence_at"), F.min(times.text(F.col("evidence_expires_at"))).alias("evidence_expires_at")
    found = search.matched(shown(spark, d, docs=docs), ["the"], at, ends)
    # One row: the count of all results, whatever the limit.
    total = found.agg(F.count(F.lit(1)).alias("result_count"))
    return found.join(docs.select("document_id", "source_id", "period"), "document_id").join(F.broadcast(total)).select("document_id", "source_id", "period", "match_count", "visible_fields", "evidence_at", "evidence_expires_at", "result_count")


@query("agg_evidence_scope", SHOWN + "SELECT document_id, max(strftime(make_timestamp((1767225600 + evidence * 86400) * 1000000), '%Y-%m-%dT%H:%M:%SZ')) AS evidence_at, min(strftime(make_timestamp((1767225600 + evidence_expires * 86400) * 1000000), '%Y-%m-%dT%H:%M:%SZ')) AS evidence_expires_at FROM shown GROUP BY 1")
def agg_evidence_scope(spark, d):
    return shown(spark, d).groupBy("document_id").agg(F.max(times.text(F.col("evidence_at"))).alias("evidence_at"), F.min(times.text(F.col("evidence_expires_at"))).alias("evidence_expires_at"))


@query("export_score_features", CTES + ", s AS (" + VISIBLE.format("score_generation", "operator") + ") SELECT document_id, count(*) AS n_features, string_agg(field_id, ',' ORDER BY field_id) AS features, count(*) FILTER (list_contains(allowed_operations, 'score_feature_value')) AS n_values FROM s GROUP BY 1")
def export_score_features(spark, d):
    rows = search.feature_values(shown(spark, d, "operator", "score_generation"))
    return rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_features"), F.array_join(F.array_sort(F.collect_list("field_id")), ",").alias("features"), F.count("feature_value").alias("n_values"))


@query("assert_export_safe", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)(password|passwd|secret|token|api_?key)\s*[:=]\s*\S{8,}') OR regexp_matches(text, 'AKIA[A-Z0-9]{14,}')")
def assert_export_safe(spark, d):
    """Rows that an export must not hold; the expectation is that none is exported."""
    return table(spark, d, "documents").where(text.looks_secret(F.col("text"))).select("doc_id")


@query("join_cluster_members_visible", SHOWN + "SELECT cluster_id, document_id FROM docs WHERE cluster_id IS NOT NULL AND document_id IN (SELECT document_id FROM shown)")
def join_cluster_members_visible(spark, d):
    """Visible members of each cluster, a row each."""
    docs = records.documents(spark, d, clusters=True)
    return search.cluster_members(docs, shown(spark, d, docs=docs))


@query("join_doc_coverage", CTES + STATE + " SELECT * FROM covered")
def join_doc_coverage(spark, d):
    docs = records.documents(spark, d)
    return search.coverage_state(docs, records.targets(docs))


@query("filter_coverage_match", CTES + " SELECT candidate_id, target_id FROM cdims JOIN tgts USING (dimension, value)")
def filter_coverage_match(spark, d):
    """Candidates against targets on six dimensions, arrays label by label."""
    docs = records.documents(spark, d)
    c = records.candidates(docs)
    return search.coverage(c, records.targets(docs)).select(F.concat(F.lit("candidate_"), "doc_id").alias("candidate_id"), "target_id")


@query("project_public_member", CTES + "SELECT document_id, source_id, asset_id FROM docs WHERE cluster_id IS NOT NULL")
def project_public_member(spark, d):
    return records.documents(spark, d, clusters=True).where("cluster_id is not null").select("document_id", "source_id", "asset_id")


@query("filter_url_policy", """SELECT p_partkey AS k, CASE p_partkey % 16 WHEN 0 THEN 'https_required' WHEN 1 THEN 'userinfo_forbidden' WHEN 2 THEN 'fragment_forbidden' WHEN 3 THEN 'host_not_allowed' WHEN 4 THEN 'port_not_allowed' WHEN 5 THEN 'signed_path_forbidden' WHEN 6 THEN 'signed_query_forbidden' WHEN 7 THEN 'signed_query_forbidden'
  WHEN 8 THEN 'invalid_url' WHEN 9 THEN 'ambiguous_url' WHEN 10 THEN 'non_public_host' WHEN 12 THEN 'invalid_url' WHEN 13 THEN 'ambiguous_hostname' ELSE 'allowed' END AS decision FROM part""")
def filter_url_policy(spark, d):
    """Addresses against the policy of inputs: scheme, user, fragment, host, port, and credentials in path or query."""
    reason = values.url_reason(F.col("url"), ["a.example.com", "b.example.com"])
    return evidence.family(spark, d, "val_url").select("k", F.coalesce(reason, F.lit("allowed")).alias("decision"))
