"""Decision tables: one pass of column expressions each."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.operators import lineage, policy, selection
from attesta.plans.catalog import query
from attesta.plans.search import now
from attesta.sources import records
from attesta.sources.records import CTES



def reasoned(spark, d, docs=None):
    """Candidates with the first gate that each fails; null if it passes all."""
    c = F.col
    approved = lambda name: c(name) != "approved"
    over = lambda name: c(f"{name}_expires_at") <= now()
    reason = policy.first_reason([
        (c("inventory_state") != "observed", F.concat(F.lit("inventory_"), "inventory_state")), (c("retrieval_state") != "available", F.concat(F.lit("retrieval_"), "retrieval_state")),
        (approved("governance_state"), "source_governance_not_approved"), (approved("rights_state"), "rights_not_approved"), (approved("retention_state"), "retention_not_approved"),
        (approved("privacy_state"), "privacy_not_approved"), (approved("transformation_state"), "transformation_not_approved"),
        (over("governance"), "source_governance_expired"), (over("rights"), "rights_expired"), (over("retention"), "retention_expired"), (over("privacy"), "privacy_expired"), (over("transformation"), "transformation_expired"),
        (c("pipeline_proof") & (c("override") != "current"), "proof_requires_review"), (c("unknown_dimension"), "metadata_unresolved"),
    ])
    rows = records.candidates(records.documents(spark, d) if docs is None else docs)
    return selection.overridden(rows, records.overrides(spark, d), now()).withColumn("reason", reason)


@query("first_fail_reason", CTES + "SELECT candidate_id, reason FROM reasons")
def first_fail_reason(spark, d):
    return reasoned(spark, d).select("candidate_id", "reason")


def covered(spark, d):
    """(candidates with reasons, rows (candidate_id, place) in the order of selection)."""
    lineage.checkpoints(spark)
    docs = records.documents(spark, d, clusters=True)
    targets = [r.asDict() for r in records.targets(docs).collect()]
    rows = reasoned(spark, d, docs)
    kept = rows.select("doc_id", "candidate_id", "cluster_id", "quality_rank", "reason", records.dimensions(rows).alias("dims")).checkpoint()
    eligible = kept.where("reason is null")
    wanted = spark.createDataFrame([(t["target_id"], t["dimension"], t["value"]) for t in targets], "target_id string, dimension string, value string")
    matches = eligible.select("candidate_id", F.inline("dims")).join(F.broadcast(wanted), ["dimension", "value"]).select("candidate_id", "target_id")
    # Bounded: a few of each kind of candidate (see `compressed`).
    few = [r.asDict() for r in selection.compressed(eligible.select("candidate_id", "cluster_id", "quality_rank"), matches, sum(t["minimum"] for t in targets)).collect()]
    order = selection.greedy_cover(few, targets)
    return kept.drop("dims"), spark.createDataFrame(list(enumerate(order)), "place bigint, candidate_id string")


@query("greedy_cover")
def greedy_cover(spark, d):
    return covered(spark, d)[1]


@query("eval_selection")
def eval_selection(spark, d):
    """candidate_id, decision, reason of every candidate."""
    rows, order = covered(spark, d)
    picked = rows.join(order, "candidate_id").select("candidate_id", "cluster_id", F.lit(True).alias("picked"))
    clusters = picked.where("cluster_id is not null").select("cluster_id", F.lit(True).alias("represented")).distinct()
    reason = F.coalesce("reason", F.when(F.col("picked"), "selected").when(F.col("represented"), "duplicate_not_representative").otherwise("coverage_not_needed"))
    decision = F.when(F.col("picked"), "include").when(F.col("reason") == "metadata_unresolved", "unresolved").otherwise("exclude")
    return rows.join(picked.drop("cluster_id"), "candidate_id", "left").join(clusters, "cluster_id", "left").select("candidate_id", decision.alias("decision"), reason.alias("reason"))


@query("greedy_balanced_pairs")
def greedy_balanced_pairs(spark, d):
    """Twenty linked pairs of parts of different brands, no part twice."""
    from attesta.operators import relate
    from attesta.plans.joins import catalogue

    c = catalogue(spark, d)
    brand = c.select("record_id", "source_id")
    pairs = relate.token_pairs(c).join(brand.select(F.col("record_id").alias("first"), F.col("source_id").alias("b1")), "first").join(brand.select(F.col("record_id").alias("second"), F.col("source_id").alias("b2")), "second")
    pairs = pairs.select("first", "second", F.concat_ws("|", F.least("b1", "b2"), F.greatest("b1", "b2")).alias("source_pair"), F.col("similarity_milli").alias("similarity"), F.sha2(F.concat_ws("|", "first", "second"), 256).alias("key"))
    # Exact: 20 pairs use 40 members. A pair beyond the best 41 of a member has a better one that is
    # free, and used members block 40 * 41 of what is left, so 1,641 of each pair of sources suffice.
    best = lambda *keys: F.row_number().over(Window.partitionBy("source_pair", *keys).orderBy(F.col("similarity").desc(), "key"))
    top = pairs.withColumns({"r1": best("first"), "r2": best("second")}).where("r1 <= 41 and r2 <= 41").withColumn("r", best()).where("r <= 1641").drop("r", "r1", "r2")
    out = selection.balanced_pairs([r.asDict() for r in top.collect()], 20)
    return spark.createDataFrame([(p["first"], p["second"], p["similarity"]) for p in out], "first bigint, second bigint, similarity_milli bigint")
