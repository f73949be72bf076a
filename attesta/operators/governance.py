"""Decisions over facts, observations, decisions and lifecycle records, each valid for a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.operators import policy

# Confidentiality from open to closed.
CONFIDENTIALITY = ("public", "internal", "restricted")

# What `native_operation` says, with the states that are usual: one bit each, where reasons are moved. At most 63.
USUAL = (
    "records:not_bound", "consent:pending", "consent:revoked", "consent:expired", "consent:missing", "consent:snapshot_stale", "consent:use_not_allowed", "consent:audience_not_allowed", "consent:not_yet_effective", "contribution:use_not_allowed",
    "audience:not_allowed", "confidentiality:not_public", "confidentiality:authority_stricter", "redaction:required", "retention:review", "retention:missing", "retention:expired", "retention:authority_shortened", "contribution_retention:expired",
    "deletion:consent_revoked", "deletion:consent_expired", "deletion:retention_expired", "deletion:missing", "deletion_status:pending", "deletion_status:missing", "withdrawal:withdrawn", "withdrawal:missing", "contribution_deletion:scheduled", "contribution_deletion:missing",
)


def sole(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """keys, n, and the columns of the one row of each key where there is just one; extremes say it without a sort."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(F.min(c).alias(c) for c in columns))


def window_reason(name: Column | str, begins: Column, ends: Column, t: Column, early: str, late: str) -> Column:
    """A reason where t lies before or after a half-open window; null inside."""
    name = F.lit(name) if isinstance(name, str) else name
    return F.when(begins > t, F.concat(name, F.lit(f":{early}"))).when(ends <= t, F.concat(name, F.lit(f":{late}")))


def fact_reasons(facts: DataFrame, observations: DataFrame, passing: dict[str, str], t: Column) -> DataFrame:
    """subject, reasons: in the order of facts' `place`, what keeps each dimension from passing.

    facts: (subject, dimension, place, state); observations: (subject, dimension, state,
    observed_day, expires_day), of which a passing fact needs just one, of its state and current.
    """
    o = sole(observations, ["subject", "dimension"], "state", "observed_day", "expires_day")
    o = o.select("subject", "dimension", "n", F.col("state").alias("o_state"), "observed_day", "expires_day")
    wanted = F.element_at(F.create_map(*(F.lit(x) for pair in passing.items() for x in pair)), F.col("dimension"))
    dim = F.col("dimension")
    found = policy.closed((F.col("n") == 1) & (F.col("o_state") == F.col("state")))
    window = window_reason(dim, F.col("observed_day"), F.col("expires_day"), t, "evidence_not_yet_effective", "evidence_expired")
    reason = F.when(~policy.closed(F.col("state") == wanted), F.concat(dim, F.lit(":"), F.coalesce("state", F.lit("missing")))).when(~found, F.concat(dim, F.lit(":evidence_missing_or_conflicting"))).otherwise(window)
    # One row for each dimension, of which there are a handful.
    rows = facts.join(o, ["subject", "dimension"], "left").select("subject", F.struct("place", reason.alias("reason")).alias("r"))
    kept = F.filter(F.array_sort(F.collect_list("r")), lambda r: r.reason.isNotNull())
    return rows.groupBy("subject").agg(F.transform(kept, lambda r: r.reason).alias("fact_reasons"))


def source_operations(subjects: DataFrame, facts: DataFrame, observations: DataFrame, states: DataFrame, decisions: DataFrame, passing: dict[str, str], t: Column) -> DataFrame:
    """subject, operation, state, reasons, eligible of each operation that a subject declares a state for.

    Reasons: a durable blocker, then each dimension of facts in order, then the operation's own
    state or the one decision that an approved state needs. No reason means eligible.
    """
    of = states.select("subject", "operation", "place", "state").join(sole(decisions, ["subject", "operation", "state"], "decided_day", "expires_day"), ["subject", "operation", "state"], "left")
    window = window_reason("operation", F.col("decided_day"), F.col("expires_day"), t, "decision_not_yet_effective", "decision_expired")
    own = F.when(F.col("state") != "approved", F.concat(F.lit("operation:"), "state")).when(~policy.closed(F.col("n") == 1), "operation:decision_missing_or_conflicting").otherwise(window)
    blocker = F.when(F.coalesce("blocked", F.lit(True)), F.lit("durable_blocker"))
    rows = of.join(subjects.select("subject", "blocked"), "subject", "left").join(fact_reasons(facts, observations, passing, t), "subject", "left")
    no_facts = F.array(F.lit("facts:missing"))
    reasons = F.filter(F.concat(F.array(blocker), F.coalesce("fact_reasons", no_facts), F.array(own)), lambda r: r.isNotNull())
    return rows.select("subject", "operation", "state", reasons.alias("reasons")).withColumn("eligible", F.size("reasons") == 0)


def _listed(rules: list[Column]) -> Column:
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def _state(prefix: str, state: Column, fine: str) -> Column:
    return F.when(~state.eqNullSafe(F.lit(fine)), F.concat(F.lit(f"{prefix}:"), F.coalesce(state, F.lit("missing"))))


def _unless(ok: Column, reason: str) -> Column:
    return F.when(~policy.closed(ok), F.lit(reason))


def lifecycle(consents: DataFrame, retentions: DataFrame, deletions: DataFrame) -> DataFrame:
    """Consents with the retention and deletion record of the subject, all columns prefixed c_, r_, d_, and `linked`."""
    named = lambda df, p: df.select(*(F.col(c).alias(p + c) for c in df.columns))
    c, r, d = named(consents, "c_"), named(retentions, "r_"), named(deletions, "d_")
    rows = c.join(r, F.col("c_subject") == F.col("r_subject"), "left").join(d, F.col("c_subject") == F.col("d_subject"), "left")
    same = lambda name: (F.col(f"r_{name}") == F.col(f"c_{name}")) & (F.col(f"d_{name}") == F.col(f"c_{name}"))
    return rows.withColumn("linked", policy.closed(same("consent_id") & same("source_id")))


def native_use(records: DataFrame, operation: str, t: Column, *, viewer: str | None = None, redacted: bool = False) -> DataFrame:
    """consent_id, reasons, eligible for a later use of a subject's material (rows of `lifecycle`); unlinked records alone say so."""
    c = F.col
    access = _unless(c("c_confidentiality") == "public", "confidentiality:not_public") if operation == "public_retrieval" else _unless(F.array_contains("c_allowed_viewer_roles", viewer) if viewer else F.lit(False), "access:viewer_not_allowed")
    reasons = _listed([
        _state("consent", c("c_state"), "active"), _unless(c("c_decided_day") <= t, "consent:not_yet_effective"), _unless(F.array_contains("c_allowed_uses", operation), "consent:use_not_allowed"), access,
        F.when(F.coalesce("c_redaction_required", F.lit(True)) & F.lit(not redacted), F.lit("redaction:required")), _unless(t < c("c_expires_day"), "consent:expired"),
        _state("retention", c("r_state"), "retain_until"), _unless(t < c("r_expires_day"), "retention:expired"), _state("deletion", c("d_trigger_state"), "none"), _state("deletion_status", c("d_status"), "not_requested"),
    ])
    reasons = F.when(c("linked"), reasons).otherwise(F.array(F.lit("records:not_linked")))
    return records.select(c("c_consent_id").alias("consent_id"), reasons.alias("reasons")).withColumn("eligible", F.size("reasons") == 0)


def withdraw(records: DataFrame, new_state: str, t: Column) -> DataFrame:
    """consent_id, refused, state, trigger_state, due_hours (after t), status, required_work: a consent revoked or expired at t.

    A transition that may not be made leaves the records as they are and names why.
    """
    if new_state not in ("revoked", "expired"):
        raise ValueError("a consent is revoked or expires")
    c = F.col
    refused = policy.first_reason([
        (~c("linked"), "records_not_linked"), (~policy.closed(c("c_state") == "active"), "consent_not_active"), (~policy.closed(c("c_decided_day") <= t), "before_decision"),
        (policy.closed(c("c_expires_day") <= t) if new_state == "revoked" else ~policy.closed(c("c_expires_day") <= t), "after_expiry" if new_state == "revoked" else "before_expiry"),
    ])
    done, held = c("refused").isNull(), policy.closed(c("r_legal_hold"))
    work = F.when(held, "review_legal_hold,reindex").when(c("r_derived_treatment") == "review_on_withdrawal", "delete_content,review_derivatives,reindex").otherwise("delete_content,delete_derivatives,reindex")
    return records.withColumn("refused", refused).select(
        c("c_consent_id").alias("consent_id"), "refused", F.when(done, F.lit(new_state)).otherwise(c("c_state")).alias("state"), F.when(done, F.lit(f"consent_{new_state}")).otherwise(c("d_trigger_state")).alias("trigger_state"),
        F.when(done, c("d_sla_hours")).alias("due_hours"), F.when(done & held, "under_legal_hold_review").when(done, "pending").otherwise(c("d_status")).alias("status"), F.when(done, work).alias("required_work"),
    )


def native_operation(contributions: DataFrame, records: DataFrame, operation: str, audience: str, t: Column, *, redacted: bool = False) -> DataFrame:
    """contribution_id, k, subject, reasons, eligible: a contribution against its subject's current consent, retention and deletion.

    contributions carry the snapshot that was taken when they came in; a stale one is a reason of its own.
    """
    c = F.col
    rank = lambda x: policy.ranked(x, CONFIDENTIALITY)
    open_ = (F.lit(audience == "public") & (c("confidentiality") == "public")) if operation == "public_retrieval" else F.lit(True)
    # What a contribution says by itself is said before the join, so that no label is moved.
    rows = contributions.select(
        "contribution_id", "k", "subject", "consent_id", "purpose_code", "notice_version", "consent_state", "retention_expires_day", "withdrawal_state", "deletion_state",
        F.array_contains("allowed_uses", operation).alias("used"), F.array_contains("allowed_audiences", audience).alias("heard"), policy.closed(open_).alias("open"), rank(c("confidentiality")).alias("rank"),
    )
    rows = rows.join(records, c("consent_id") == c("c_consent_id"), "left")
    reasons = _listed([
        _state("consent", c("c_state"), "active"), _unless(c("consent_state") == c("c_state"), "consent:snapshot_stale"), _unless(F.array_contains("c_allowed_uses", operation), "consent:use_not_allowed"), _unless(c("used"), "contribution:use_not_allowed"),
        _unless(F.array_contains("c_allowed_viewer_roles", audience), "consent:audience_not_allowed"), _unless(c("heard"), "audience:not_allowed"), _unless(c("open"), "confidentiality:not_public"),
        F.when(F.coalesce("c_redaction_required", F.lit(True)) & F.lit(not redacted), F.lit("redaction:required")), _unless(c("c_decided_day") <= t, "consent:not_yet_effective"), _unless(t < c("c_expires_day"), "consent:expired"),
        _state("retention", c("r_state"), "retain_until"), _unless(t < c("r_expires_day"), "retention:expired"), _unless(c("retention_expires_day") <= c("r_expires_day"), "retention:authority_shortened"), _unless(t < c("retention_expires_day"), "contribution_retention:expired"),
        _unless(c("rank") >= rank(c("c_confidentiality")), "confidentiality:authority_stricter"), _state("deletion", c("d_trigger_state"), "none"), _state("deletion_status", c("d_status"), "not_requested"),
        _state("withdrawal", c("withdrawal_state"), "current"), _state("contribution_deletion", c("deletion_state"), "active"),
    ])
    bound = policy.closed(c("linked") & (c("purpose_code") == c("c_purpose_code")) & (c("notice_version") == c("c_notice_version")) & (c("subject") == c("c_subject")))
    reasons = F.when(bound, reasons).otherwise(F.array(F.lit("records:not_bound")))
    return rows.select("contribution_id", "k", "subject", reasons.alias("reasons")).withColumn("eligible", F.size("reasons") == 0)


def packed(reasons: Column, usual: tuple[str, ...] = USUAL) -> tuple[Column, Column]:
    """A set of reasons as bits of a whole number for those that are usual, and the others as texts, null where there are none."""
    bit = F.create_map(*(F.lit(x) for i, r in enumerate(usual) for x in (r, 1 << i)))
    bits = F.aggregate(reasons, F.lit(0).cast("long"), lambda a, r: a.bitwiseOR(F.coalesce(F.element_at(bit, r).cast("long"), F.lit(0).cast("long"))))
    rest = F.filter(reasons, lambda r: ~F.array_contains(F.array(*map(F.lit, usual)), r))
    return bits, F.when(F.size(rest) > 0, rest)


def unpacked(bits: Column, rest: Column, usual: tuple[str, ...] = USUAL) -> Column:
    """The reasons that `packed` was given, in no order."""
    said = F.filter(F.array(*map(F.lit, usual)), lambda _, i: F.call_function("shiftright", bits, i).bitwiseAND(F.lit(1)) == 1)
    return F.concat(said, F.coalesce(rest, F.array().cast("array<string>")))


def inheritance() -> dict[str, Column]:
    """n, consents (union), uses and audiences (in all inputs), confidentiality (the strictest), retention_day (the least), purposes, purpose: aggregates of a group of inputs.

    inputs: (consents, allowed_uses, allowed_audiences, confidentiality, retention_expires_day,
    purpose_code), arrays without repeats. Labels are few, and so are the sets of them; what all
    inputs share is in each set, so that one shuffle says it and no group is gathered row by row.
    """
    n = F.count(F.lit(1))

    def shared(labels: str) -> Column:
        sets = F.collect_set(F.array_sort(labels))
        common = F.array_sort(F.array_compact(F.aggregate(sets, F.element_at(sets, 1), F.array_intersect)))
        # An input without labels shares none.
        return F.when(F.count(labels) == n, common).otherwise(F.array().cast("array<string>"))

    purposes = F.collect_set("purpose_code")
    level = F.element_at(F.array(*map(F.lit, CONFIDENTIALITY)), F.greatest(F.max(policy.ranked(F.col("confidentiality"), CONFIDENTIALITY)), F.lit(1)).cast("int"))
    return {
        "n": n, "consents": F.array_sort(F.array_distinct(F.flatten(F.collect_set("consents")))), "uses": shared("allowed_uses"), "audiences": shared("allowed_audiences"), "confidentiality": level,
        "retention_day": F.min("retention_expires_day"), "purposes": F.size(purposes).cast("long"), "purpose": F.array_min(purposes),
    }


def inherited(inputs: DataFrame, key: str) -> DataFrame:
    """key, and what its inputs give, see `inheritance`."""
    return inputs.groupBy(key).agg(*(c.alias(name) for name, c in inheritance().items()))


def drift_reasons(operation: str, audience: str, t: Column) -> Column:
    """What `drift` says of a derived record beside what its inputs give, the columns of `inheritance` as w_<name>."""
    c = F.col
    sorted_ = lambda x: F.array_sort(c(x))
    return _listed([
        _unless((c("w_purposes") == 1) & (c("purpose_code") == c("w_purpose")), "purpose_drift"), _unless(sorted_("consents") == c("w_consents"), "consent_lineage_drift"), _unless(sorted_("allowed_uses") == c("w_uses"), "use_inheritance_drift"),
        _unless(sorted_("allowed_audiences") == c("w_audiences"), "audience_inheritance_drift"), _unless(c("confidentiality") == c("w_confidentiality"), "confidentiality_drift"), _unless(c("retention_expires_day") == c("w_retention_day"), "retention_drift"),
        _unless(F.array_contains("allowed_uses", operation), "use_not_allowed"), _unless(F.array_contains("allowed_audiences", audience), "audience_not_allowed"),
        _unless(F.lit(operation != "public_retrieval") | (F.lit(audience == "public") & (c("confidentiality") == "public")), "confidentiality_not_public"),
        _unless(t < c("retention_expires_day"), "retention_expired"), _unless(c("withdrawal_state") == "current", "withdrawn"), _unless(c("deletion_state") == "active", "deletion_pending"),
    ])


def drift(derived: DataFrame, inputs: DataFrame, operation: str, audience: str, t: Column) -> DataFrame:
    """node, reasons: where a derived record isn't what its inputs give, or may not be used itself.

    derived: (node, consents, allowed_uses, allowed_audiences, confidentiality, retention_expires_day,
    purpose_code, withdrawal_state, deletion_state); inputs: the records of each node's inputs, keyed by node.
    """
    want = inherited(inputs, "node").select("node", *(F.col(c).alias(f"w_{c}") for c in ("consents", "uses", "audiences", "confidentiality", "retention_day", "purposes", "purpose")))
    return derived.join(want, "node", "left").select("node", drift_reasons(operation, audience, t).alias("reasons"))


def _named(record: Column) -> Column:
    return F.transform(record.reasons, lambda r: F.concat_ws(":", F.lit("input"), record.node, r))


def graph_reasons(own: DataFrame, edges: DataFrame, gathered) -> DataFrame:
    """node, reasons: each node's own reasons (node, reasons) and those of everything that it rests on, named input:<id>:<reason>.

    The reasons of a row travel as one text.
    """
    named = _named(F.struct("node", "reasons"))
    found = gathered(own.where(F.size("reasons") > 0).select("node", F.to_json(named).alias("item")), edges)
    each = F.transform("items", lambda i: F.from_json(i, "array<string>"))
    return found.select("node", F.array_distinct(F.flatten(each)).alias("reasons"))


def layer_reasons(record: Column, layers: int) -> Column:
    """array of (node, reasons): what `graph_reasons` says of a record and of each of those below it, where no record is below two.

    record: struct (node, reasons, below), below being an array of such records, of so many layers;
    those of the last have no `below`.
    """
    beneath = lambda r, left, f: F.flatten(F.transform(r.below, lambda b: f(b, left - 1)))
    held = lambda r, left: F.concat(_named(r), beneath(r, left, held)) if left else _named(r)
    one = F.array(F.struct(record.node.alias("node"), F.array_distinct(held(record, layers)).alias("reasons")))
    return F.concat(one, beneath(record, layers, layer_reasons)) if layers else one
