"""Receipts, manifests and retention of stored objects; what may be deleted, and what a deletion reaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.operators import lineage, policy

# What an entry mirrors of its receipt, and retrieval decisions from open to closed.
MIRRORED = ("source_id", "asset_id", "object_key", "sha", "byte_size", "media_type", "rights_sha", "retention_class", "decision")
RETRIEVAL = ("approved", "metadata_only", "blocked")


def _listed(rules: list[Column]) -> Column:
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def mirrored(entries: DataFrame, receipts: DataFrame) -> DataFrame:
    """entry_id, broken: how a derived entry differs from the current receipt of its key; none where it is verified."""
    r = receipts.select(*(F.col(c).alias(f"r_{c}") for c in (*MIRRORED, "object_kind", "verification", "transformation_id")))
    c = F.col
    differ = [F.when(~policy.closed(c(f"r_{n}") == c(n)), F.lit(n)) for n in (*MIRRORED, "transformation_id")]
    found = c("r_object_key").isNotNull()
    state = [F.when(c("r_object_kind") != "derived", "object_kind"), F.when(c("r_verification") != "verified", "verification")]
    rows = entries.join(r, entries.object_key == r.r_object_key, "left")
    return rows.select("entry_id", F.when(~found, F.array(F.lit("receipt_missing"))).otherwise(_listed([*state, *differ])).alias("broken"))


def manifests(declared: DataFrame, links: DataFrame, receipts: DataFrame) -> DataFrame:
    """manifest_id, broken: receipts that are missing or of another source, outputs with several owners, rights that aren't the strictest input's.

    links: (manifest_id, side, receipt_id). A manifest's own links are few; what all of them share is counted.
    """
    r = receipts.select("receipt_id", F.col("source_id").alias("r_source"), "object_kind", "decision", "rights_sha")
    owners = links.where("side = 'output'").groupBy("receipt_id").agg(F.count_distinct("manifest_id").alias("owners"))
    rows = links.join(r, "receipt_id", "left").join(owners, "receipt_id", "left").join(declared, "manifest_id")
    c = F.col
    rank = policy.ranked(c("decision"), RETRIEVAL)
    inputs = c("side") == "input"
    of = rows.groupBy("manifest_id").agg(
        F.max(c("object_kind").isNull()).alias("missing"), F.max(policy.closed(c("r_source") != c("source_id"))).alias("foreign"), F.max(policy.closed(~inputs & (c("owners") > 1))).alias("shared"), F.max(F.when(inputs, rank)).alias("strictest"),
        F.max(policy.closed(~inputs & (c("object_kind") != "derived"))).alias("kind"), F.max(policy.closed(~inputs & ((c("decision") != c("effective_decision")) | (c("rights_sha") != c("effective_rights"))))).alias("outputs"),
    )
    # Rights of the inputs that carry the strictest decision: one, or the digest of several.
    strict = rows.where(inputs).join(of.select("manifest_id", "strictest"), "manifest_id").where(rank == c("strictest")).groupBy("manifest_id").agg(F.array_sort(F.collect_set("rights_sha")).alias("rs"))
    rights = F.when(F.size("rs") == 1, c("rs")[0]).otherwise(F.sha2(F.concat(F.to_json("rs"), F.lit("\n")), 256))
    level = F.element_at(F.array(*map(F.lit, RETRIEVAL)), F.greatest("strictest", F.lit(1)).cast("int"))
    broken = _listed([
        F.when(c("missing"), "receipt_missing"), F.when(c("foreign"), "source_mismatch"), F.when(c("shared"), "multiple_parents"), F.when(c("kind"), "transformation_mismatch"),
        F.when(~policy.closed((c("effective_decision") == level) & (c("effective_rights") == rights)) | c("outputs"), "rights_mismatch"),
    ])
    return declared.join(of, "manifest_id", "left").join(strict, "manifest_id", "left").select("manifest_id", F.when(c("missing").isNull(), F.array(F.lit("no_links"))).otherwise(broken).alias("broken"))


def reconciled(commits: DataFrame) -> DataFrame:
    """doc_id, action: what a commit that was cut short may still write, or why it is held.

    commits: (doc_id, expected, artifact, ledger, head), digests of the expected receipt and of what was found.
    """
    c = F.col
    other = lambda x: c(x).isNotNull() & (c(x) != c("expected"))
    action = policy.first_reason([
        (other("artifact") | other("ledger"), "receipt_commit_conflict"), (c("head").isNull(), "verified_object_missing"), (other("head"), "immutable_object_conflict"), (c("artifact").isNotNull() & c("ledger").isNotNull(), "complete"),
        (c("artifact").isNotNull(), "write_ledger_from_receipt"), (c("ledger").isNotNull(), "write_receipt_from_ledger"), (F.lit(True), "write_receipt_then_ledger"),
    ])
    return commits.select("doc_id", action.alias("action"))


def retention(roots: DataFrame, derived: DataFrame, authorities: DataFrame, t: Column) -> DataFrame:
    """doc_id, state, targets of each root and what derives from it: refused where the authority isn't the root's, current and shared."""
    a = authorities.select("doc_id", F.col("retention_class").alias("a_class"), "decided_day", "valid_until_day", "expires_day", "legal_hold", "cleanup")
    below = derived.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("retention_class").alias("low"), F.max("retention_class").alias("high"))
    rows = roots.select("doc_id", "retention_class").join(a, "doc_id", "left").join(below, "doc_id", "left")
    c = F.col
    state = policy.first_reason([
        (c("a_class").isNull() | (c("a_class") != c("retention_class")), "retention_authority_mismatch"), (c("n").isNotNull() & ((c("low") != c("retention_class")) | (c("high") != c("retention_class"))), "retention_lineage_mismatch"),
        ((t < c("decided_day")) | (t > c("valid_until_day")), "retention_authority_stale"), (c("legal_hold"), "legal_hold_conflict"), (t < c("expires_day"), "not_due"), (c("cleanup") == "held_for_review", "awaiting_review"), (F.lit(True), "ready_exact_cleanup"),
    ])
    return rows.select("doc_id", state.alias("state"), (F.coalesce("n", F.lit(0)) + 1).alias("targets"))


def cleanup(due: DataFrame, receipts: DataFrame, heads: DataFrame) -> DataFrame:
    """doc_id, object_key, place, step: the exact keys to delete, derived ones first, after a preflight of all.

    due: (doc_id) with all receipts of a document. An object that changed holds its whole document; one
    that is gone already only leaves its tombstone.
    """
    rows = receipts.join(due, "doc_id", "left_semi").select("doc_id", "object_key", "object_kind", "sha").join(heads, "object_key", "left")
    c = F.col
    conflict = policy.closed(c("head_sha") != c("sha"))
    held = rows.groupBy("doc_id").agg(F.max(conflict).alias("held"))
    step = F.when(c("held"), F.when(conflict, "hold_conflict").otherwise("held_by_preflight")).when(c("head_sha").isNull(), "tombstone_absent").otherwise("delete_exact_key")
    return rows.join(held, "doc_id").select("doc_id", "object_key", F.when(c("object_kind") == "raw", 1).otherwise(0).alias("place"), step.alias("step"))


def propagated(triggers: DataFrame, results: DataFrame) -> DataFrame:
    """trigger_id, result_id: results that an obligation reaches, those made from swept results among them.

    triggers: (trigger_id, doc_id, reason_code); results: (result_id, doc_id, input_key, output_key). A
    withdrawal is of the asset, so all of its results go; an exact key's obligation is of results on
    the raw object alone.
    """
    r = results.select("result_id", "doc_id", "input_key")
    near = triggers.select("trigger_id", "doc_id", "reason_code").join(r, "doc_id")
    near = near.where((F.col("reason_code") != "exact_key_deleted") | F.col("input_key").startswith("raw/"))
    made = results.select(F.col("output_key").alias("k"), F.col("result_id").alias("input"))
    edges = results.join(made, results.input_key == made.k).select(F.col("result_id").alias("node"), "input")
    return lineage.reach(edges, near.select(F.col("result_id").alias("node"), "trigger_id")).select("trigger_id", F.col("node").alias("result_id")).distinct()


def cascaded(affected: DataFrame, results: DataFrame, entries: DataFrame) -> DataFrame:
    """kind, entry, outcome of index and export entries: to remove, kept, or of a result that nobody knows."""
    known = results.select("result_id").distinct().withColumn("known", F.lit(True))
    gone = affected.select("result_id").distinct().withColumn("gone", F.lit(True))
    rows = entries.join(known, "result_id", "left").join(gone, "result_id", "left")
    outcome = F.when(F.col("known").isNull(), "unresolved").when(F.col("gone"), F.when(F.col("kind") == "index", "remove_exact_field").otherwise("remove_export")).otherwise("kept")
    return rows.select("kind", "entry", "result_id", outcome.alias("outcome"))
