"""Governance and project-native decisions over record families with evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import times
from attesta.functions.hashing import record_id
from attesta.operators import governance
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.records import NOW

T = F.lit


def rows(spark, d, *names):
    return [evidence.family(spark, d, n) for n in names]


_PASSING = "CASE dimension " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in evidence.DIMENSIONS.items()) + " END"
SOURCE = ctes("gov_subject", "gov_fact", "gov_observation", "gov_state", "gov_decision") + f""", obs AS (SELECT subject, dimension, count(*) AS n, min(state) AS o_state, min(observed_day) AS b, min(expires_day) AS e FROM gov_observation GROUP BY ALL),
  fr AS (SELECT f.subject, string_agg(CASE WHEN f.state <> {_PASSING} THEN f.dimension || ':' || f.state WHEN n IS NULL OR n <> 1 OR o_state <> f.state THEN f.dimension || ':evidence_missing_or_conflicting'
    WHEN b > {NOW} THEN f.dimension || ':evidence_not_yet_effective' WHEN e <= {NOW} THEN f.dimension || ':evidence_expired' END, ',' ORDER BY place) AS r FROM gov_fact f LEFT JOIN obs USING (subject, dimension) GROUP BY 1),
  dec AS (SELECT subject, operation, state, count(*) AS n, min(decided_day) AS b, min(expires_day) AS e FROM gov_decision GROUP BY ALL),
  src AS (SELECT s.subject, s.operation, concat_ws(',', CASE WHEN blocked THEN 'durable_blocker' END, nullif(r, ''), CASE WHEN s.state <> 'approved' THEN 'operation:' || s.state WHEN n IS NULL OR n <> 1 THEN 'operation:decision_missing_or_conflicting' WHEN b > {NOW} THEN 'operation:decision_not_yet_effective' WHEN e <= {NOW} THEN 'operation:decision_expired' END) AS reasons
    FROM gov_state s JOIN gov_subject USING (subject) LEFT JOIN fr USING (subject) LEFT JOIN dec ON dec.subject = s.subject AND dec.operation = s.operation AND dec.state = s.state)"""


def source_operations(spark, d):
    return governance.source_operations(*rows(spark, d, "gov_subject", "gov_fact", "gov_observation", "gov_state", "gov_decision"), evidence.DIMENSIONS, F.lit(NOW))


@query("eval_source_operation", SOURCE + " SELECT subject, operation, reasons, reasons = '' AS eligible FROM src")
def eval_source_operation(spark, d):
    """Six dimensions of facts against their evidence, and the decision on each of twelve operations."""
    return source_operations(spark, d).select("subject", "operation", F.array_join("reasons", ",").alias("reasons"), "eligible")


LIFE = ctes("pn_consent", "pn_retention", "pn_deletion") + """, life AS (SELECT c.*, r.state AS r_state, r.expires_day AS r_expires, legal_hold, derived_treatment, trigger_state, status, sla_hours,
  r.consent_id = c.consent_id AND d.consent_id = c.consent_id AND r.source_id = c.source_id AND d.source_id = c.source_id AS linked FROM pn_consent c JOIN pn_retention r USING (subject) JOIN pn_deletion d USING (subject))"""
_USE = f"""CASE WHEN NOT linked THEN 'records:not_linked' ELSE concat_ws(',', CASE WHEN state <> 'active' THEN 'consent:' || state END, CASE WHEN decided_day > {NOW} THEN 'consent:not_yet_effective' END, CASE WHEN NOT list_contains(allowed_uses, '{{0}}') THEN 'consent:use_not_allowed' END, {{1}},
  CASE WHEN redaction_required THEN 'redaction:required' END, CASE WHEN expires_day <= {NOW} THEN 'consent:expired' END, CASE WHEN r_state <> 'retain_until' THEN 'retention:' || r_state END, CASE WHEN r_expires <= {NOW} THEN 'retention:expired' END, CASE WHEN trigger_state <> 'none' THEN 'deletion:' || trigger_state END, CASE WHEN status <> 'not_requested' THEN 'deletion_status:' || status END) END"""
_VIEW = _USE.format("search_visibility", "CASE WHEN NOT list_contains(allowed_viewer_roles, 'researcher') THEN 'access:viewer_not_allowed' END")
_PUBLIC = _USE.format("public_retrieval", "CASE WHEN confidentiality <> 'public' THEN 'confidentiality:not_public' END")


def lifecycle(spark, d):
    return governance.lifecycle(*rows(spark, d, "pn_consent", "pn_retention", "pn_deletion"))


@query("eval_project_native_use", LIFE + f" SELECT consent_id, 'search_visibility' AS operation, {_VIEW} AS reasons FROM life UNION ALL SELECT consent_id, 'public_retrieval', {_PUBLIC} FROM life")
def eval_project_native_use(spark, d):
    life = lifecycle(spark, d)
    use = lambda operation, **o: governance.native_use(life, operation, F.lit(NOW), **o).select("consent_id", F.lit(operation).alias("operation"), F.array_join("reasons", ",").alias("reasons"))
    return use("search_visibility", viewer="researcher").unionByName(use("public_retrieval"))


@query("transition_consent", LIFE + f""", t AS (SELECT *, CASE WHEN NOT linked THEN 'records_not_linked' WHEN state <> 'active' THEN 'consent_not_active' WHEN decided_day > {NOW} THEN 'before_decision' WHEN expires_day <= {NOW} THEN 'after_expiry' END AS refused FROM life)
  SELECT consent_id, refused, CASE WHEN refused IS NULL THEN 'revoked' ELSE state END AS state, CASE WHEN refused IS NULL THEN 'consent_revoked' ELSE trigger_state END AS trigger_state, CASE WHEN refused IS NULL THEN strftime(TIMESTAMP '2026-01-01' + to_hours({NOW} * 24 + sla_hours), '%Y-%m-%dT%H:%M:%SZ') END AS due_at,
    CASE WHEN refused IS NOT NULL THEN status WHEN legal_hold THEN 'under_legal_hold_review' ELSE 'pending' END AS status, CASE WHEN refused IS NOT NULL THEN NULL WHEN legal_hold THEN 'review_legal_hold,reindex' WHEN derived_treatment = 'review_on_withdrawal' THEN 'delete_content,review_derivatives,reindex' ELSE 'delete_content,delete_derivatives,reindex' END AS required_work FROM t""")
def transition_consent(spark, d):
    """Every consent revoked at one instant: what changes, what is due, and which may not be revoked."""
    out = governance.withdraw(lifecycle(spark, d), "revoked", F.lit(NOW))
    due = times.text(times.at(NOW) + F.make_dt_interval(F.lit(0), F.col("due_hours")))
    return out.select("consent_id", "refused", "state", "trigger_state", due.alias("due_at"), "status", "required_work")


@query("join_consent_bundle", ctes("pn_contribution", "pn_consent", "pn_retention", "pn_deletion") + """ SELECT contribution_id, CASE WHEN c.consent_id IS NULL THEN 'consent_missing' WHEN r.consent_id <> c.consent_id OR r.source_id <> c.source_id OR r.subject IS NULL THEN 'retention_not_linked' WHEN d.consent_id <> c.consent_id OR d.source_id <> c.source_id OR d.subject IS NULL THEN 'deletion_not_linked'
  WHEN x.purpose_code <> c.purpose_code OR x.notice_version <> c.notice_version THEN 'purpose_or_notice_drift' ELSE 'bound' END AS binding FROM pn_contribution x LEFT JOIN pn_consent c ON c.consent_id = x.consent_id LEFT JOIN pn_retention r ON r.subject = c.subject LEFT JOIN pn_deletion d ON d.subject = c.subject""")
def join_consent_bundle(spark, d):
    """Contribution x consent x retention x deletion, and where the bundle breaks."""
    x, c, r, e = rows(spark, d, "pn_contribution", "pn_consent", "pn_retention", "pn_deletion")
    life = c.select("subject", F.col("consent_id").alias("c"), F.col("source_id").alias("cs"), F.col("purpose_code").alias("cp"), F.col("notice_version").alias("cn"))
    life = life.join(r.select("subject", F.col("consent_id").alias("r"), F.col("source_id").alias("rs")), "subject", "left").join(e.select("subject", F.col("consent_id").alias("e"), F.col("source_id").alias("es")), "subject", "left").drop("subject")
    ok = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    binding = F.when(F.col("c").isNull(), "consent_missing").when(~(ok("r", "c") & ok("rs", "cs")), "retention_not_linked").when(~(ok("e", "c") & ok("es", "cs")), "deletion_not_linked").when(~(ok("purpose_code", "cp") & ok("notice_version", "cn")), "purpose_or_notice_drift").otherwise("bound")
    return x.join(life, x.consent_id == life.c, "left").select("contribution_id", binding.alias("binding"))


_RANK = lambda x: f"CASE {x} WHEN 'public' THEN 1 WHEN 'internal' THEN 2 ELSE 3 END"
OPERATION = ctes("pn_contribution", "pn_consent", "pn_retention", "pn_deletion") + f""", op AS (SELECT contribution_id, x.k, CASE WHEN NOT coalesce(r.consent_id = c.consent_id AND e.consent_id = c.consent_id AND r.source_id = c.source_id AND e.source_id = c.source_id AND x.purpose_code = c.purpose_code AND x.notice_version = c.notice_version, false) THEN 'records:not_bound' ELSE concat_ws(',',
  CASE WHEN c.state <> 'active' THEN 'consent:' || c.state END, CASE WHEN x.consent_state <> c.state THEN 'consent:snapshot_stale' END, CASE WHEN NOT list_contains(c.allowed_uses, 'search_visibility') THEN 'consent:use_not_allowed' END, CASE WHEN NOT list_contains(x.allowed_uses, 'search_visibility') THEN 'contribution:use_not_allowed' END,
  CASE WHEN NOT list_contains(c.allowed_viewer_roles, 'researcher') THEN 'consent:audience_not_allowed' END, CASE WHEN NOT list_contains(x.allowed_audiences, 'researcher') THEN 'audience:not_allowed' END, CASE WHEN c.redaction_required THEN 'redaction:required' END, CASE WHEN c.decided_day > {NOW} THEN 'consent:not_yet_effective' END, CASE WHEN c.expires_day <= {NOW} THEN 'consent:expired' END,
  CASE WHEN r.state <> 'retain_until' THEN 'retention:' || r.state END, CASE WHEN r.expires_day <= {NOW} THEN 'retention:expired' END, CASE WHEN x.retention_expires_day > r.expires_day THEN 'retention:authority_shortened' END, CASE WHEN x.retention_expires_day <= {NOW} THEN 'contribution_retention:expired' END,
  CASE WHEN {_RANK('x.confidentiality')} < {_RANK('c.confidentiality')} THEN 'confidentiality:authority_stricter' END, CASE WHEN trigger_state <> 'none' THEN 'deletion:' || trigger_state END, CASE WHEN status <> 'not_requested' THEN 'deletion_status:' || status END, CASE WHEN withdrawal_state <> 'current' THEN 'withdrawal:' || withdrawal_state END, CASE WHEN deletion_state <> 'active' THEN 'contribution_deletion:' || deletion_state END) END AS reasons
  FROM pn_contribution x LEFT JOIN pn_consent c ON c.consent_id = x.consent_id LEFT JOIN pn_retention r ON r.subject = c.subject LEFT JOIN pn_deletion e ON e.subject = c.subject)"""


@query("eval_project_native_operation", OPERATION + " SELECT contribution_id, reasons, reasons = '' AS eligible FROM op")
def eval_project_native_operation(spark, d):
    """Every contribution, for search by a researcher, against current authority: nineteen reasons."""
    (x,) = rows(spark, d, "pn_contribution")
    out = governance.native_operation(x, lifecycle(spark, d), "search_visibility", "researcher", F.lit(NOW))
    return out.select("contribution_id", F.array_join("reasons", ",").alias("reasons"), "eligible")


INHERIT = ctes("pn_contribution") + f""", x AS (SELECT *, 'derived_' || (k // 4) AS derived FROM pn_contribution), g AS (SELECT derived, count(*) AS n, string_agg(DISTINCT consent_id, ',' ORDER BY consent_id) AS consents, max({_RANK('confidentiality')}) AS strictest, min(retention_expires_day) AS retention_day, count(DISTINCT purpose_code) AS purposes FROM x GROUP BY 1),
  u AS (SELECT derived, string_agg(label, ',' ORDER BY label) AS uses FROM (SELECT derived, label, count(*) AS m FROM (SELECT derived, unnest(allowed_uses) AS label FROM x) GROUP BY ALL) JOIN g USING (derived) WHERE m = n GROUP BY 1), a AS (SELECT derived, string_agg(label, ',' ORDER BY label) AS audiences FROM (SELECT derived, label, count(*) AS m FROM (SELECT derived, unnest(allowed_audiences) AS label FROM x) GROUP BY ALL) JOIN g USING (derived) WHERE m = n GROUP BY 1),
  inh AS (SELECT derived, n, consents, coalesce(uses, '') AS uses, coalesce(audiences, '') AS audiences, CASE strictest WHEN 1 THEN 'public' WHEN 2 THEN 'internal' ELSE 'restricted' END AS confidentiality, retention_day, purposes FROM g LEFT JOIN u USING (derived) LEFT JOIN a USING (derived))"""


def inheritance(spark, d):
    (x,) = rows(spark, d, "pn_contribution")
    out = governance.inherited(x.withColumn("consents", F.array("consent_id")).withColumn("derived", F.concat(F.lit("derived_"), F.floor(F.col("k") / 4))), "derived")
    listed = lambda c: F.array_join(c, ",").alias(c)
    return out.select("derived", "n", listed("consents"), listed("uses"), listed("audiences"), "confidentiality", "retention_day", "purposes")


@query("agg_inherit_contribution", INHERIT + " SELECT * FROM inh")
def agg_inherit_contribution(spark, d):
    """What derived material inherits from its inputs: union, intersections, strictest and least."""
    return inheritance(spark, d)


@query("derive_contribution", INHERIT + """ SELECT derived, CASE WHEN purposes <> 1 THEN 'incompatible_purposes' WHEN uses = '' OR audiences = '' THEN 'no_common_authority' ELSE 'derived' END AS outcome,
  CASE WHEN purposes = 1 AND uses <> '' AND audiences <> '' THEN 'contribution_' || left(sha256(concat_ws('|', derived, consents, uses, audiences, confidentiality, retention_day) || chr(10)), 24) END AS contribution_id FROM inh""")
def derive_contribution(spark, d):
    """The row that derived inputs give, or why they give none."""
    out = inheritance(spark, d)
    outcome = F.when(F.col("purposes") != 1, "incompatible_purposes").when((F.col("uses") == "") | (F.col("audiences") == ""), "no_common_authority").otherwise("derived")
    made = record_id("contribution", F.concat_ws("|", "derived", "consents", "uses", "audiences", "confidentiality", F.col("retention_day").cast("string")))
    return out.select("derived", outcome.alias("outcome"), F.when(outcome == "derived", made).alias("contribution_id"))


@query("filter_transfer_rights", SOURCE + " SELECT subject FROM src WHERE operation IN ('acquisition_eligibility', 'media_acquisition', 'retention') AND reasons = '' GROUP BY 1 HAVING count(*) = 3")
def filter_transfer_rights(spark, d):
    """Subjects whose approval to be transferred is complete: all three operations, each current."""
    ok = source_operations(spark, d).where(F.col("operation").isin("acquisition_eligibility", "media_acquisition", "retention") & F.col("eligible"))
    return ok.groupBy("subject").agg(F.count(F.lit(1)).alias("n")).where("n = 3").select("subject")
