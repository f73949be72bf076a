"""Asset qualification over layers of authority."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions.hashing import record_id
from attesta.operators import governance, qualification
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.records import NOW

_PASSING = "CASE dimension " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in evidence.DIMENSIONS.items()) + " END"
_NEEDS = " UNION ALL ".join(f"SELECT '{o}' AS operation, '{r}' AS source_operation" for o, rs in qualification.REQUIREMENTS.items() for r in (*rs, "deletion", *(["search_visibility"] if o in ("indexing", "public_retrieval") else [])))
_CONTENT = ", ".join(f"'{o}'" for o in qualification.CONTENT)
LAYERS = ctes("qa_layer", "qa_subject", "qa_fact", "qa_observation", "qa_state", "qa_decision", "qa_asset", "qa_operation", "qa_op_decision") + """, cov AS (SELECT doc_id, subject, 0 AS level FROM qa_asset a JOIN qa_layer l ON a.source_id = l.source_id AND l.endpoint_id IS NULL AND l.asset_id IS NULL
  UNION ALL SELECT doc_id, subject, 1 FROM qa_asset a JOIN qa_layer l ON a.source_id = l.source_id AND a.endpoint_id = l.endpoint_id AND l.asset_id IS NULL UNION ALL SELECT doc_id, subject, 2 FROM qa_asset a JOIN qa_layer l ON a.source_id = l.source_id AND a.endpoint_id = l.endpoint_id AND a.asset_id = l.asset_id),
  comp AS (SELECT a.doc_id, count(level) AS layers, count(DISTINCT level) = 3 AS complete FROM qa_asset a LEFT JOIN cov USING (doc_id) GROUP BY 1)"""
MATRIX = LAYERS + f""", obs AS (SELECT subject, dimension, count(*) AS n, min(state) AS o_state, min(observed_day) AS b, min(expires_day) AS e FROM qa_observation GROUP BY ALL),
  fr AS (SELECT subject, CASE WHEN f.state <> {_PASSING} THEN f.dimension || ':' || f.state WHEN n IS NULL OR n <> 1 OR o_state <> f.state THEN f.dimension || ':evidence_missing_or_conflicting' WHEN b > {NOW} THEN f.dimension || ':evidence_not_yet_effective' WHEN e <= {NOW} THEN f.dimension || ':evidence_expired' END AS r FROM qa_fact f LEFT JOIN obs USING (subject, dimension)),
  dec AS (SELECT subject, operation, state, count(*) AS n, min(decided_day) AS b, min(expires_day) AS e FROM qa_decision GROUP BY ALL),
  sr AS (SELECT s.subject, s.operation, CASE WHEN s.state <> 'approved' THEN 'operation:' || s.state WHEN n IS NULL OR n <> 1 THEN 'operation:decision_missing_or_conflicting' WHEN b > {NOW} THEN 'operation:decision_not_yet_effective' WHEN e <= {NOW} THEN 'operation:decision_expired' END AS r FROM qa_state s LEFT JOIN dec ON dec.subject = s.subject AND dec.operation = s.operation AND dec.state = s.state
    UNION ALL SELECT s.subject, s.operation, fr.r FROM qa_state s JOIN fr USING (subject) UNION ALL SELECT s.subject, s.operation, 'durable_blocker' FROM qa_state s JOIN qa_subject q USING (subject) WHERE q.blocked),
  needs AS ({_NEEDS}), want AS (SELECT doc_id, o.operation, source_operation FROM qa_operation o JOIN needs USING (operation) UNION SELECT doc_id, operation, CASE asset_kind WHEN 'caption' THEN 'caption_retention' ELSE 'prose_retention' END FROM qa_operation JOIN qa_asset USING (doc_id) WHERE operation IN ({_CONTENT}) AND asset_kind IN ('caption', 'prose')),
  d AS (SELECT o.doc_id, o.operation, x.state, x.scope, x.basis, x.authority, x.evidence_ref, x.decided_day, x.expires_day, x.facts_sha AS d_sha, x.retention_class AS d_class, a.* EXCLUDE (doc_id), x.doc_id IS NOT NULL AS there,
    x.scope IS NOT NULL AND x.basis IS NOT NULL AND x.authority IS NOT NULL AND x.evidence_ref IS NOT NULL AND x.decided_day IS NOT NULL AND x.expires_day IS NOT NULL AS whole, o.operation IN ({_CONTENT}) AS content FROM qa_operation o JOIN qa_asset a ON a.doc_id = o.doc_id LEFT JOIN qa_op_decision x ON x.doc_id = o.doc_id AND x.operation = o.operation),
  own AS (SELECT doc_id, operation, unnest([CASE WHEN state <> 'approved' THEN 'decision:' || state WHEN NOT whole THEN 'decision:incomplete' WHEN decided_day >= expires_day THEN 'decision:invalid_window' WHEN decided_day > {NOW} THEN 'decision:not_yet_effective' WHEN expires_day <= {NOW} THEN 'decision:expired' END,
    CASE WHEN basis = 'public_visibility' THEN 'basis:public_visibility' END, CASE WHEN d_sha <> facts_sha THEN 'asset_facts:changed' END, CASE WHEN d_class <> retention_class THEN 'retention:mismatch' END, CASE WHEN content AND access_state <> 'available' THEN 'access:' || access_state END,
    CASE WHEN content AND scope IS DISTINCT FROM 'asset_specific' THEN 'rights:asset_specific_scope_required' END, CASE WHEN content AND coalesce(basis NOT IN ('asset_specific_permission', 'reviewed_lawful_basis'), true) THEN 'rights:affirmative_basis_required' END,
    CASE WHEN content AND coalesce(authority NOT IN ('authorized_licensor', 'copyright_holder', 'legal_reviewer', 'rights_reviewer'), true) THEN 'rights:reviewed_authority_required' END, CASE WHEN operation IN ('ocr', 'transcription', 'video_understanding', 'score_generation') AND derivative_policy <> 'operation_specific' THEN 'derivative:prohibited' END,
    CASE WHEN operation = 'public_retrieval' AND retrieval_policy <> 'public' THEN 'retrieval:not_public' END, CASE WHEN operation = 'raw_storage' AND retention_class = 'inventory_metadata' THEN 'retention:metadata_only' END]) AS r FROM d WHERE there),
  every AS (SELECT doc_id, operation, r FROM own WHERE r IS NOT NULL UNION SELECT w.doc_id, w.operation, 'source:' || w.source_operation || ':' || r FROM want w JOIN cov USING (doc_id) JOIN sr ON sr.subject = cov.subject AND sr.operation = w.source_operation WHERE r IS NOT NULL),
  listed AS (SELECT doc_id, operation, string_agg(r, ',' ORDER BY r) AS reasons FROM every GROUP BY ALL),
  matrix AS (SELECT d.doc_id, d.operation, facts_sha, CASE WHEN NOT there THEN 'pending' WHEN basis = 'public_visibility' THEN 'blocked' WHEN state = 'approved' AND (NOT whole OR decided_day >= expires_day) THEN 'pending' ELSE state END AS state,
    CASE WHEN NOT complete THEN 'authority:layer_missing' WHEN NOT there THEN 'decision:missing' ELSE coalesce(reasons, '') END AS reasons FROM d JOIN comp USING (doc_id) LEFT JOIN listed l ON l.doc_id = d.doc_id AND l.operation = d.operation)"""


def _families(spark, d, *names):
    return [evidence.family(spark, d, n) for n in names]


def covering(spark, d):
    assets, layers = _families(spark, d, "qa_asset", "qa_layer")
    return assets, qualification.layers_of(assets, layers)


def matrix(spark, d):
    assets, cov = covering(spark, d)
    layers = governance.source_operations(*_families(spark, d, "qa_subject", "qa_fact", "qa_observation", "qa_state", "qa_decision"), evidence.DIMENSIONS, F.lit(NOW))
    operations, decisions = _families(spark, d, "qa_operation", "qa_op_decision")
    return qualification.compile_matrix(assets, operations, decisions, cov, layers, F.lit(NOW))


@query("join_governance_layers", LAYERS + " SELECT * FROM comp")
def join_governance_layers(spark, d):
    """The layers of authority over each asset, of which all three levels are required."""
    return qualification.missing_layers(*covering(spark, d))


@query("compile_qualification", MATRIX + " SELECT doc_id, operation, state, reasons FROM matrix")
def compile_qualification(spark, d):
    """Every asset by nine operations, with all reasons against each."""
    return matrix(spark, d).select("doc_id", "operation", "state", F.array_join("reasons", ",").alias("reasons"))


@query("query_qualified_assets", MATRIX + " SELECT operation, doc_id, sha256(facts_sha || '|' || operation) AS qualification FROM matrix WHERE state = 'approved' AND reasons = '' AND doc_id % 67 <> 5")
def query_qualified_assets(spark, d):
    """Assets whose qualification, as issued, is what compiling it anew gives, and eligible; some issued ones have drifted."""
    issued = evidence.family(spark, d, "qa_asset").select("doc_id", F.when(F.col("doc_id") % 67 == 5, F.sha2(F.lit("drift"), 256)).otherwise(F.col("facts_sha")).alias("issued_sha"))
    now = matrix(spark, d).where("eligible").join(issued, "doc_id").where(F.col("issued_sha") == F.col("facts_sha"))
    return now.select("operation", "doc_id", F.sha2(F.concat_ws("|", "facts_sha", "operation"), 256).alias("qualification"))


@query("build_qualified_job", MATRIX + ", ok AS (SELECT * FROM matrix WHERE state = 'approved' AND reasons = '') SELECT o.doc_id, o.operation, 'qualified_job_' || left(sha256(o.operation || '|' || o.doc_id || '|' || o.facts_sha || chr(10)), 24) AS job_id FROM ok o JOIN ok s ON s.doc_id = o.doc_id AND s.operation = 'raw_storage' WHERE o.operation IN ('ocr', 'transcription', 'video_understanding', 'indexing', 'score_generation', 'public_retrieval')")
def build_qualified_job(spark, d):
    """A job for each derived operation that is eligible, where raw storage is too."""
    ok = matrix(spark, d).where("eligible")
    stored = ok.where("operation = 'raw_storage'").select("doc_id")
    jobs = ok.where(F.col("operation").isin(*qualification.DERIVED)).join(stored, "doc_id", "left_semi")
    return jobs.select("doc_id", "operation", record_id("qualified_job", F.concat_ws("|", "operation", F.col("doc_id").cast("string"), "facts_sha")).alias("job_id"))
