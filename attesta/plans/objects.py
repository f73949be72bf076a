"""Stored objects: receipts against entries and manifests, retention, cleanup and deletion."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import objects
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.records import NOW


def _families(spark, d, *names):
    return [evidence.family(spark, d, n) for n in names]


_DIFFER = ", ".join(f"CASE WHEN r.{n} IS DISTINCT FROM e.{n} THEN '{n}' END" for n in (*objects.MIRRORED, "transformation_id"))


@query("join_receipt_mirror", ctes("obj_entry", "obj_receipt") + f" SELECT entry_id, CASE WHEN r.object_key IS NULL THEN 'receipt_missing' ELSE array_to_string(list_filter([CASE WHEN r.object_kind <> 'derived' THEN 'object_kind' END, CASE WHEN r.verification <> 'verified' THEN 'verification' END, {_DIFFER}], lambda x: x IS NOT NULL), ',') END AS broken FROM obj_entry e LEFT JOIN obj_receipt r ON r.object_key = e.object_key")
def join_receipt_mirror(spark, d):
    """Entries of manifests against the receipts of their keys: nine columns, the kind, the state and the transformation."""
    return objects.mirrored(*_families(spark, d, "obj_entry", "obj_receipt")).withColumn("broken", F.array_join("broken", ","))


_RANK = "CASE decision WHEN 'approved' THEN 1 WHEN 'metadata_only' THEN 2 WHEN 'blocked' THEN 3 ELSE 0 END"


@query("join_manifest_receipts", ctes("obj_manifest", "obj_link", "obj_receipt") + f""", own AS (SELECT receipt_id, count(DISTINCT manifest_id) AS owners FROM obj_link WHERE side = 'output' GROUP BY 1), x AS (SELECT l.*, r.source_id AS r_source, r.object_kind, r.decision, r.rights_sha, owners, m.source_id, m.effective_decision, m.effective_rights, {_RANK} AS rk FROM obj_link l JOIN obj_manifest m USING (manifest_id) LEFT JOIN obj_receipt r ON r.receipt_id = l.receipt_id LEFT JOIN own ON own.receipt_id = l.receipt_id),
  o AS (SELECT manifest_id, bool_or(object_kind IS NULL) AS missing, bool_or(coalesce(r_source <> source_id, false)) AS foreign_, bool_or(coalesce(side = 'output' AND owners > 1, false)) AS shared, max(rk) FILTER (side = 'input') AS strictest, bool_or(coalesce(side = 'output' AND object_kind <> 'derived', false)) AS kind, bool_or(coalesce(side = 'output' AND (decision <> effective_decision OR rights_sha <> effective_rights), false)) AS outs FROM x GROUP BY 1),
  st AS (SELECT x.manifest_id, list_sort(list(DISTINCT rights_sha)) AS rs FROM x JOIN o USING (manifest_id) WHERE side = 'input' AND rk = strictest GROUP BY 1)
  SELECT manifest_id, array_to_string(list_filter([CASE WHEN missing THEN 'receipt_missing' END, CASE WHEN foreign_ THEN 'source_mismatch' END, CASE WHEN shared THEN 'multiple_parents' END, CASE WHEN kind THEN 'transformation_mismatch' END,
    CASE WHEN outs OR NOT coalesce(effective_decision = CASE strictest WHEN 1 THEN 'approved' WHEN 2 THEN 'metadata_only' ELSE 'blocked' END AND effective_rights = CASE WHEN len(rs) = 1 THEN rs[1] ELSE sha256('["' || array_to_string(rs, '","') || '"]' || chr(10)) END, false) THEN 'rights_mismatch' END], lambda y: y IS NOT NULL), ',') AS broken FROM obj_manifest JOIN o USING (manifest_id) LEFT JOIN st USING (manifest_id)""")
def join_manifest_receipts(spark, d):
    """Manifests against the receipts of their inputs and outputs: presence, source, one owner, and the strictest input's rights."""
    m, l, r = _families(spark, d, "obj_manifest", "obj_link", "obj_receipt")
    return objects.manifests(m.drop("doc_id"), l, r).withColumn("broken", F.array_join("broken", ","))


@query("reconcile_receipt", ctes("obj_commit") + """ SELECT doc_id, CASE WHEN artifact <> expected OR ledger <> expected THEN 'receipt_commit_conflict' WHEN head IS NULL THEN 'verified_object_missing' WHEN head <> expected THEN 'immutable_object_conflict' WHEN artifact IS NOT NULL AND ledger IS NOT NULL THEN 'complete' WHEN artifact IS NOT NULL THEN 'write_ledger_from_receipt' WHEN ledger IS NOT NULL THEN 'write_receipt_from_ledger' ELSE 'write_receipt_then_ledger' END AS action FROM obj_commit""")
def reconcile_receipt(spark, d):
    """What a commit that was cut short may still write, or why it is held."""
    return objects.reconciled(*_families(spark, d, "obj_commit"))


RETENTION = ctes("obj_raw", "obj_derived", "obj_authority", "obj_head", "obj_receipt") + f""", b AS (SELECT doc_id, count(*) AS n, min(retention_class) AS low, max(retention_class) AS high FROM obj_derived GROUP BY 1),
  ret AS (SELECT r.doc_id, CASE WHEN a.retention_class IS DISTINCT FROM r.retention_class THEN 'retention_authority_mismatch' WHEN n IS NOT NULL AND (low <> r.retention_class OR high <> r.retention_class) THEN 'retention_lineage_mismatch' WHEN {NOW} < decided_day OR {NOW} > valid_until_day THEN 'retention_authority_stale' WHEN legal_hold THEN 'legal_hold_conflict' WHEN {NOW} < expires_day THEN 'not_due' WHEN cleanup = 'held_for_review' THEN 'awaiting_review' ELSE 'ready_exact_cleanup' END AS state, coalesce(n, 0) + 1 AS targets
  FROM obj_raw r LEFT JOIN obj_authority a USING (doc_id) LEFT JOIN b USING (doc_id))"""


def retained(spark, d):
    return objects.retention(*_families(spark, d, "obj_raw", "obj_derived", "obj_authority"), F.lit(NOW))


@query("retention_state", RETENTION + " SELECT * FROM ret")
def retention_state(spark, d):
    """Roots with what derives from them: refused, held, not due, to review, or ready to be cleaned up."""
    return retained(spark, d)


@query("exact_cleanup", RETENTION + """, x AS (SELECT r.*, h.head_sha, coalesce(h.head_sha <> r.sha, false) AS bad FROM obj_receipt r JOIN ret USING (doc_id) LEFT JOIN obj_head h ON h.object_key = r.object_key WHERE ret.state = 'ready_exact_cleanup'), y AS (SELECT *, bool_or(bad) OVER (PARTITION BY doc_id) AS held FROM x)
  SELECT doc_id, object_key, CASE object_kind WHEN 'raw' THEN 1 ELSE 0 END AS place, CASE WHEN held THEN CASE WHEN bad THEN 'hold_conflict' ELSE 'held_by_preflight' END WHEN head_sha IS NULL THEN 'tombstone_absent' ELSE 'delete_exact_key' END AS step FROM y""")
def exact_cleanup(spark, d):
    """The plan of an exact-key cleanup: nothing is deleted here."""
    due = retained(spark, d).where("state = 'ready_exact_cleanup'").select("doc_id")
    return objects.cleanup(due, *_families(spark, d, "obj_receipt", "obj_head"))


DELETED = ctes("del_trigger", "del_result", "del_entry").replace("WITH ", "WITH RECURSIVE ", 1) + """, hit(trigger_id, result_id) AS (SELECT trigger_id, result_id FROM del_trigger JOIN del_result USING (doc_id) WHERE reason_code <> 'exact_key_deleted' OR input_key LIKE 'raw/%'
  UNION SELECT h.trigger_id, r.result_id FROM hit h JOIN del_result a ON a.result_id = h.result_id JOIN del_result r ON r.input_key = a.output_key)"""


@query("propagate_deletion", DELETED + " SELECT trigger_id, result_id, CASE treatment WHEN 'delete_on_withdrawal' THEN 'delete' ELSE 'review' END AS derived_action FROM hit JOIN del_trigger USING (trigger_id)")
def propagate_deletion(spark, d):
    """Results that each trigger reaches, swept until nothing is new, and what is to be done with them."""
    triggers, results = _families(spark, d, "del_trigger", "del_result")
    action = F.when(F.col("treatment") == "delete_on_withdrawal", "delete").otherwise("review")
    return objects.propagated(triggers, results).join(triggers.select("trigger_id", action.alias("derived_action")), "trigger_id").select("trigger_id", "result_id", "derived_action")


@query("join_deletion_cascade", DELETED + " SELECT kind, entry, e.result_id, CASE WHEN e.result_id NOT IN (SELECT result_id FROM del_result) THEN 'unresolved' WHEN e.result_id IN (SELECT result_id FROM hit) THEN CASE kind WHEN 'index' THEN 'remove_exact_field' ELSE 'remove_export' END ELSE 'kept' END AS outcome FROM del_entry e")
def join_deletion_cascade(spark, d):
    """Index and export entries of the results that go; entries of unknown results are unresolved."""
    triggers, results, entries = _families(spark, d, "del_trigger", "del_result", "del_entry")
    return objects.cascaded(objects.propagated(triggers, results), results, entries)
