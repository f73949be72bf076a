"""What an asset may be used for: nine operations, each with a decision of its own and authority from three layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.operators import lineage, policy

# What each operation asks of its source, and what counts as an affirmative decision.
REQUIREMENTS = {
    "metadata_retention": ("metadata_inventory", "retention"), "download": ("acquisition_eligibility", "media_acquisition"), "raw_storage": ("retention",), "ocr": ("derivative_eligibility", "derived_processing"),
    "transcription": ("derivative_eligibility", "derived_processing"), "video_understanding": ("derivative_eligibility", "derived_processing"), "indexing": ("indexing",), "score_generation": ("derivative_eligibility", "derived_processing"), "public_retrieval": ("public_retrieval",),
}
CONTENT = tuple(o for o in REQUIREMENTS if o != "metadata_retention")
DERIVED = ("ocr", "transcription", "video_understanding", "indexing", "score_generation", "public_retrieval")
BASES = ("asset_specific_permission", "reviewed_lawful_basis")
AUTHORITIES = ("authorized_licensor", "copyright_holder", "legal_reviewer", "rights_reviewer")


def layers_of(assets: DataFrame, layers: DataFrame) -> DataFrame:
    """doc_id, subject, level (0 source, 1 endpoint, 2 asset): the layers of authority that cover each asset.

    A layer without an endpoint or asset covers all; each level is an equi-join.
    """
    out = None
    for level, keys in enumerate((["source_id"], ["source_id", "endpoint_id"], ["source_id", "endpoint_id", "asset_id"])):
        empty = [k for k in ("endpoint_id", "asset_id") if k not in keys]
        part = layers
        for k in ("endpoint_id", "asset_id"):
            part = part.where(F.col(k).isNull() if k in empty else F.col(k).isNotNull())
        one = assets.select("doc_id", *keys).join(part.select("subject", *keys), keys).select("doc_id", "subject", F.lit(level).alias("level"))
        out = one if out is None else out.unionByName(one)
    return out


def missing_layers(assets: DataFrame, covering: DataFrame) -> DataFrame:
    """doc_id, layers, complete: complete where all three levels are there."""
    n = covering.groupBy("doc_id").agg(F.count_distinct("level").alias("levels"), F.count(F.lit(1)).alias("layers"))
    return assets.select("doc_id").join(n, "doc_id", "left").select("doc_id", F.coalesce("layers", F.lit(0)).alias("layers"), (F.coalesce("levels", F.lit(0)) == 3).alias("complete"))


def requirements(operation: Column, kind: Column) -> Column:
    """What an operation asks of each layer: its own, deletion, and what the kind of asset adds."""
    own = F.element_at(F.create_map(*(x for o, r in REQUIREMENTS.items() for x in (F.lit(o), F.array(*map(F.lit, r))))), operation)
    content = operation.isin(*CONTENT)
    more = [F.lit("deletion"), F.when(content & (kind == "caption"), "caption_retention"), F.when(content & (kind == "prose"), "prose_retention"), F.when(operation.isin("indexing", "public_retrieval"), "search_visibility")]
    return F.array_distinct(F.concat(own, F.filter(F.array(*more), lambda x: x.isNotNull())))


def decision_reasons(t: Column) -> Column:
    """Reasons from the decision itself, the asset's facts and policies; columns d_... are null where there is none."""
    c = F.col
    fields = [c(f"d_{n}") for n in ("scope", "basis", "authority", "evidence_ref", "decided_day", "expires_day", "facts_sha", "retention_class")]
    full = F.lit(True)
    for f in fields:
        full &= f.isNotNull()
    approved, content = (c("d_state") == "approved") & full, c("operation").isin(*CONTENT)
    unless = lambda ok, reason: F.when(~policy.closed(ok), F.lit(reason))
    rules = [
        F.when(c("d_state") != "approved", F.concat(F.lit("decision:"), "d_state")).when(~full, "decision:incomplete").when(c("d_decided_day") >= c("d_expires_day"), "decision:invalid_window").when(c("d_decided_day") > t, "decision:not_yet_effective").when(c("d_expires_day") <= t, "decision:expired"),
        F.when(c("d_basis") == "public_visibility", "basis:public_visibility"), F.when(c("d_facts_sha") != c("facts_sha"), "asset_facts:changed"), F.when(c("d_retention_class") != c("retention_class"), "retention:mismatch"),
        F.when(content & (c("access_state") != "available"), F.concat(F.lit("access:"), "access_state")), F.when(content, unless(c("d_scope") == "asset_specific", "rights:asset_specific_scope_required")),
        F.when(content, unless(c("d_basis").isin(*BASES), "rights:affirmative_basis_required")), F.when(content, unless(c("d_authority").isin(*AUTHORITIES), "rights:reviewed_authority_required")),
        F.when(c("operation").isin("ocr", "transcription", "video_understanding", "score_generation"), unless(c("derivative_policy") == "operation_specific", "derivative:prohibited")),
        F.when((c("operation") == "public_retrieval"), unless(c("retrieval_policy") == "public", "retrieval:not_public")), F.when((c("operation") == "raw_storage") & (c("retention_class") == "inventory_metadata"), "retention:metadata_only"),
    ]
    return approved, F.filter(F.array(*rules), lambda r: r.isNotNull())


def compile_matrix(assets: DataFrame, operations: DataFrame, decisions: DataFrame, covering: DataFrame, source_operations: DataFrame, t: Column) -> DataFrame:
    """doc_id, operation, state, reasons (sorted), eligible for every asset and operation.

    operations: (doc_id, operation); source_operations: (subject, operation, reasons, eligible) of the
    layers. An asset that lacks a layer has no authority; an operation without a decision has one reason.
    """
    lineage.checkpoints(assets.sparkSession)
    # Of each layer its failing operations: twelve at the most, with a handful of reasons each. Written
    # out, so that Spark can split the assets of a layer that very many have.
    failing = source_operations.where(~F.col("eligible")).groupBy("subject").agg(F.collect_list(F.struct(F.col("operation").alias("source_operation"), "reasons")).alias("failing")).checkpoint()
    told = covering.join(failing, "subject", "left").groupBy("doc_id").agg(F.count_distinct("level").alias("levels"), F.flatten(F.collect_list("failing")).alias("told"))
    d = decisions.select("doc_id", "operation", *(F.col(c).alias(f"d_{c}") for c in decisions.columns if c not in ("doc_id", "operation")))
    of = assets.join(told, "doc_id", "left")
    rows = operations.select("doc_id", "operation").join(d, ["doc_id", "operation"], "left").join(of, "doc_id")
    approved, own = decision_reasons(t)
    none = F.array().cast("array<struct<source_operation:string,reasons:array<string>>>")
    needed = requirements(F.col("operation"), F.col("asset_kind"))
    asked = F.filter(F.coalesce("told", none), lambda x: F.array_contains(needed, x.source_operation))
    from_layers = F.flatten(F.transform(asked, lambda x: F.transform(x.reasons, lambda r: F.concat_ws(":", F.lit("source"), x.source_operation, r))))
    reasons = F.when(~F.coalesce(F.col("levels") == 3, F.lit(False)), F.array(F.lit("authority:layer_missing"))).when(F.col("d_state").isNull(), F.array(F.lit("decision:missing"))).otherwise(F.array_sort(F.array_distinct(F.concat(own, from_layers))))
    state = F.when(F.col("d_state").isNull(), "pending").when(F.col("d_basis") == "public_visibility", "blocked").when((F.col("d_state") == "approved") & (~approved | (F.col("d_decided_day") >= F.col("d_expires_day"))), "pending").otherwise(F.col("d_state"))
    out = rows.select("doc_id", "operation", state.alias("state"), reasons.alias("reasons"), "facts_sha")
    return out.withColumn("eligible", (F.col("state") == "approved") & (F.size("reasons") == 0))
