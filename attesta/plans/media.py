"""Derived media: admission, jobs, conflicts and facts of results."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions.hashing import record_id
from attesta.operators import media
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.records import NOW

_V = lambda x: f"list_transform(list_concat(string_split({x}, '.'), ['0', '0', '0', '0'])[1:4], lambda y: CAST(y AS INT))"
_R = lambda x: f"CASE {x} WHEN 'approved' THEN 1 WHEN 'metadata_only' THEN 2 ELSE 3 END"
ADMIT = ctes("dm_profile", "dm_request", "dm_receipt", "dm_rights", "dm_authority", "dm_tombstone") + f""", adm0 AS (SELECT q.doc_id, p.operation, q.p, tool_id, tool_version, c.object_key, c.sha, [CASE WHEN NOT list_contains(tool_ids, tool_id) THEN 'profile:tool_not_allowed' END, CASE WHEN NOT list_contains(tool_classes, tool_class) THEN 'profile:tool_class_not_allowed' END,
  CASE WHEN {_V('tool_version')} < {_V('least_version')} THEN 'profile:tool_version_below_minimum' END, CASE WHEN {_V('tool_version')} > {_V('most_version')} THEN 'profile:tool_version_above_maximum' END, CASE WHEN NOT list_contains(media_types, media_type) THEN 'profile:media_type_not_allowed' END,
  CASE WHEN language_hint IS NULL THEN 'profile:language_hint_required' WHEN NOT list_contains(languages, language_hint) THEN 'profile:language_not_supported' END, CASE WHEN consent_state <> 'granted' AND q_source_id LIKE 'project-native-%' THEN 'consent:required' END, CASE WHEN consent_state = 'withdrawn' THEN 'consent:withdrawn' END,
  CASE WHEN r.doc_id IS NULL THEN 'rights:decision_missing' END, CASE WHEN NOT (eligible AND state = 'approved') THEN 'rights:not_eligible' END, CASE WHEN r.expires_day <= {NOW} THEN 'rights:decision_expired' END, CASE WHEN derivative_policy <> 'operation_specific' THEN 'rights:derivative_prohibited' END, CASE WHEN r_asset_id <> c.asset_id THEN 'rights:asset_mismatch' END, CASE WHEN governance_day <= {NOW} THEN 'rights:governance_expired' END,
  CASE WHEN object_kind <> 'raw' THEN 'input:not_raw_object' END, CASE WHEN verification <> 'verified' THEN 'input:not_verified' END, CASE WHEN byte_size > most_bytes THEN 'bounds:input_too_large' END, CASE WHEN decision = 'blocked' OR most_decision = 'blocked' THEN 'retrieval:blocked' END,
  CASE WHEN a_asset_id <> c.asset_id THEN 'retention:authority_mismatch' END, CASE WHEN legal_hold THEN 'retention:legal_hold' END, CASE WHEN a.expires_day <= {NOW} THEN 'retention:expired' END, CASE WHEN valid_until_day <= {NOW} THEN 'retention:authority_stale' END, CASE WHEN retention_class NOT IN ('project_native_expiring', 'selected_derived') THEN 'retention:class_not_derived' END,
  CASE WHEN t.doc_id IS NOT NULL AND (t.object_key <> c.object_key OR t.sha <> c.sha) THEN 'deletion:authority_key_mismatch' WHEN t.doc_id IS NOT NULL THEN 'deletion:input_tombstoned' END] AS r
  FROM dm_request q JOIN dm_profile p ON q.p = p.p LEFT JOIN dm_receipt c ON c.doc_id = q.doc_id LEFT JOIN dm_rights r ON r.doc_id = q.doc_id LEFT JOIN dm_authority a ON a.doc_id = q.doc_id LEFT JOIN dm_tombstone t ON t.doc_id = q.doc_id),
  adm AS (SELECT * EXCLUDE (r), array_to_string(list_sort(list_filter(r, lambda x: x IS NOT NULL)), ',') AS reasons FROM adm0)"""


def _families(spark, d, *names):
    return [evidence.family(spark, d, n) for n in names]


def admitted(spark, d):
    return media.admission(*_families(spark, d, "dm_request", "dm_profile", "dm_receipt", "dm_rights", "dm_authority", "dm_tombstone"), F.lit(NOW))


@query("eval_admission", ADMIT + " SELECT doc_id, operation, reasons, reasons = '' AS eligible FROM adm")
def eval_admission(spark, d):
    """Every requested transformation against its profile, rights, input, retention and deletions."""
    return admitted(spark, d).select("doc_id", "operation", F.array_join("reasons", ",").alias("reasons"), "eligible")


@query("plan_media_job", ADMIT + " SELECT doc_id, 'derivedjob_' || left(sha256(concat_ws('|', operation, p, tool_id, tool_version, object_key, sha) || chr(10)), 24) AS job_id FROM adm WHERE reasons = ''")
def plan_media_job(spark, d):
    """A job bound to its operation, profile, tool and exact input, for each admitted request."""
    bound = F.concat_ws("|", "operation", F.col("p").cast("string"), "tool_id", "tool_version", "object_key", "sha")
    return admitted(spark, d).where("eligible").select("doc_id", record_id("derivedjob", bound).alias("job_id"))


@query("eval_media_conflicts", ctes("dm_profile", "dm_request", "dm_receipt", "dm_result") + f""", j AS (SELECT q.*, p.*, media_type, decision, sha256(coalesce(text, '')) AS input FROM dm_request q JOIN dm_profile p ON q.p = p.p JOIN dm_receipt c ON c.doc_id = q.doc_id JOIN documents x ON x.doc_id = q.doc_id),
  f AS (SELECT j.doc_id, bool_or(confidence < least_confidence) AS low, bool_or(coalesce(NOT list_contains(languages, detected), true)) AS foreign_, bool_or(NOT (r.tool_version = j.tool_version AND {_V('r.tool_version')} >= {_V('least_version')} AND {_V('r.tool_version')} <= {_V('most_version')})) AS drift, count(DISTINCT output_key) > 1 AS several FROM j JOIN dm_result r ON r.doc_id = j.doc_id GROUP BY 1),
  n AS (SELECT doc_id, count(*) OVER (PARTITION BY operation, input) - 1 AS duplicates FROM j)
  SELECT j.doc_id, duplicates, array_to_string(list_sort(list_filter([CASE WHEN NOT (list_contains(tool_ids, tool_id) AND list_contains(tool_classes, tool_class)) THEN 'tool_not_allowed' END, CASE WHEN NOT ({_V('tool_version')} >= {_V('least_version')} AND {_V('tool_version')} <= {_V('most_version')}) OR coalesce(drift, false) THEN 'tool_version_drift' END,
    CASE WHEN NOT list_contains(media_types, media_type) THEN 'media_type_not_allowed' END, CASE WHEN {_R('decision')} < {_R('most_decision')} THEN 'retrieval_decision_too_permissive' END, CASE WHEN (language_hint IS NOT NULL AND NOT list_contains(languages, language_hint)) OR coalesce(foreign_, false) THEN 'unsupported_language' END,
    CASE WHEN duplicates > 0 THEN 'duplicate_transformation' END, CASE WHEN low THEN 'low_confidence' END, CASE WHEN several THEN 'conflicting_output_receipt' END], lambda x: x IS NOT NULL)), ',') AS conflicts FROM j JOIN n ON n.doc_id = j.doc_id LEFT JOIN f ON f.doc_id = j.doc_id""")
def eval_media_conflicts(spark, d):
    """Jobs whose tool, language, confidence or outputs conflict with their profile, and repeated transformations."""
    q, p, c, r = _families(spark, d, "dm_request", "dm_profile", "dm_receipt", "dm_result")
    text = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("input"))
    jobs = q.join(c.select("doc_id", "media_type", "decision"), "doc_id").join(text, "doc_id")
    out = media.conflicts(jobs, p, r, ["p", "input"])
    return out.select("doc_id", "duplicates", F.array_join("conflicts", ",").alias("conflicts"))


@query("agg_result_facts", ctes("dm_header", "dm_element") + """, s AS (SELECT result, count(*) AS n, min(idx) AS low, max(idx) AS high, count(DISTINCT idx) AS places, sum(words) AS sw, sum(lines) AS sl, count(*) FILTER (observation = 'shot') AS ss, count(*) FILTER (observation = 'event') AS se, bool_or(start_ms >= end_ms) AS still, max(end_ms) AS last_, count(DISTINCT (observation, start_ms, end_ms)) AS spans FROM dm_element GROUP BY 1),
  o AS (SELECT result, bool_or(start_ms < coalesce(b, 0)) AS overlap FROM (SELECT result, start_ms, max(end_ms) OVER (PARTITION BY result ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM dm_element) GROUP BY 1)
  SELECT result, array_to_string(list_sort(list_filter([CASE WHEN NOT (low = 0 AND high = n - 1 AND places = n) THEN 'not_contiguous' END, CASE WHEN kind IN (0, 1) AND words <> sw THEN 'words_disagree' END, CASE WHEN kind = 0 AND lines <> sl THEN 'lines_disagree' END, CASE WHEN kind IN (1, 2) AND elements <> n THEN 'count_disagrees' END, CASE WHEN kind = 2 AND shots <> ss THEN 'shots_disagree' END, CASE WHEN kind = 2 AND events <> se THEN 'events_disagree' END,
    CASE WHEN kind IN (1, 2) AND still THEN 'does_not_advance' END, CASE WHEN kind IN (1, 2) AND last_ > duration_ms THEN 'outside_the_media' END, CASE WHEN kind = 1 AND overlap THEN 'segments_overlap' END, CASE WHEN kind = 2 AND spans <> n THEN 'span_repeated' END], lambda x: x IS NOT NULL)), ',') AS violated FROM dm_header JOIN s USING (result) JOIN o USING (result)""")
def agg_result_facts(spark, d):
    """Headers of results against the sums and counts of what they hold."""
    return media.result_facts(*_families(spark, d, "dm_header", "dm_element")).select("result", F.array_join("violated", ",").alias("violated"))


@query("adjacent_span_check", ctes("dm_header", "dm_element") + """, w AS (SELECT result, idx, start_ms, end_ms, coalesce(lag(end_ms) OVER o, 0) AS b, row_number() OVER o - 1 AS nth FROM dm_element WINDOW o AS (PARTITION BY result ORDER BY idx)),
  x AS (SELECT result, idx, CASE WHEN nth <> idx THEN 'not_contiguous' WHEN start_ms >= end_ms THEN 'does_not_advance' WHEN start_ms < b THEN 'overlaps' WHEN end_ms > duration_ms THEN 'outside_the_media' END AS broken FROM w JOIN dm_header USING (result)) SELECT * FROM x WHERE broken IS NOT NULL""")
def adjacent_span_check(spark, d):
    """Segments out of order, overlapping, or outside the media."""
    header, element = _families(spark, d, "dm_header", "dm_element")
    return media.span_breaks(element, header)
