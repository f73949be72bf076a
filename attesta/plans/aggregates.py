"""Aggregations over the record families."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.operators import policy, search, summarise
from attesta.plans.catalog import query
from attesta.plans.decisions import reasoned
from attesta.sources import evidence, records
from attesta.sources.evidence import ctes
from attesta.sources.records import CTES, NOW
from attesta.sources.tables import table

COVER = CTES + """,
  cov AS (SELECT t.target_id, t.minimum, count(c.candidate_id) AS observed, count(*) FILTER (c.candidate_id IS NOT NULL AND c.reason IS NULL) AS eligible,
    count(*) FILTER (c.reason = 'metadata_unresolved') AS unresolved, count(*) FILTER (c.reason LIKE '%not_approved' OR c.reason LIKE '%expired') AS blocked, count(*) FILTER (c.reason LIKE 'inventory%' OR c.reason LIKE 'retrieval%') AS unavailable
    FROM tgts t LEFT JOIN cdims d ON t.dimension = d.dimension AND t.value = d.value LEFT JOIN reasons c ON c.candidate_id = d.candidate_id GROUP BY 1, 2)"""


def cover(spark, d):
    docs = records.documents(spark, d)
    r = F.col("reason")
    matched = search.coverage(reasoned(spark, d, docs), records.targets(docs), "reason")
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return matched.groupBy("target_id", "minimum").agg(
        F.count(F.lit(1)).alias("observed"), F.count_if(r.isNull()).alias("eligible"), yes(r == "metadata_unresolved").alias("unresolved"),
        yes(r.endswith("not_approved") | r.endswith("expired")).alias("blocked"), yes(r.startswith("inventory") | r.startswith("retrieval")).alias("unavailable"),
    )


@query("agg_coverage", COVER + " SELECT target_id, observed, eligible, CAST(greatest(0, minimum - eligible) AS BIGINT) AS shortfall, CASE WHEN eligible >= minimum THEN 'met' ELSE 'underrepresented' END AS state FROM cov")
def agg_coverage(spark, d):
    short = summarise.shortfall(F.col("minimum"), F.col("eligible")).cast("bigint")
    return cover(spark, d).select("target_id", "observed", "eligible", short.alias("shortfall"), F.when(short == 0, "met").otherwise("underrepresented").alias("state"))


@query("agg_coverage_gap", COVER + " SELECT target_id, observed - blocked - unavailable - unresolved AS eligible, blocked, unavailable, unresolved, CASE WHEN greatest(0, minimum * 4 - eligible) = 0 THEN 'met' WHEN blocked > 0 THEN 'blocked' WHEN unavailable > 0 THEN 'unavailable' WHEN unresolved > 0 THEN 'unresolved' ELSE 'underrepresented' END AS state FROM cov")
def agg_coverage_gap(spark, d):
    c = cover(spark, d)
    short = summarise.shortfall(F.col("minimum") * 4, F.col("eligible"))
    state = summarise.gap_state(short, F.col("blocked"), F.col("unavailable"), F.col("unresolved"))
    return c.select("target_id", (F.col("observed") - F.col("blocked") - F.col("unavailable") - F.col("unresolved")).alias("eligible"), "blocked", "unavailable", "unresolved", state.alias("state"))


@query("agg_universe_counts", CTES + "SELECT count(*) AS known, count(*) FILTER (reason IS NULL) AS included, count(*) FILTER (reason IS NOT NULL AND reason <> 'metadata_unresolved') AS excluded, count(*) FILTER (reason = 'metadata_unresolved') AS unresolved FROM reasons")
def agg_universe_counts(spark, d):
    r = F.col("reason")
    open_ = F.coalesce(r == "metadata_unresolved", F.lit(False))
    return reasoned(spark, d).agg(F.count(F.lit(1)).alias("known"), F.count_if(r.isNull()).alias("included"), F.count_if(r.isNotNull() & ~open_).alias("excluded"), F.count_if(open_).alias("unresolved"))


REPORTS = """WITH rep AS (SELECT n_name AS source_id, s_suppkey AS endpoint, CASE WHEN s_acctbal < 0 THEN 'blocked' WHEN s_suppkey % 5 = 0 THEN 'bounded_partial' ELSE 'complete_for_observed_endpoint' END AS state, s_suppkey % 29 AS observed,
  CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey % 29 + 3 END AS expected, '2026-01-' || lpad(CAST(s_suppkey % 28 + 1 AS VARCHAR), 2, '0') || 'T00:00:00Z' AS generated_at FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
STATES = ("blocked", "bounded_partial", "complete_for_observed_endpoint")


def reports(spark, d):
    """A completeness report for each supplier, as an endpoint of its nation."""
    k = F.col("s_suppkey")
    state = F.when(F.col("s_acctbal") < 0, "blocked").when(k % 5 == 0, "bounded_partial").otherwise("complete_for_observed_endpoint")
    made = F.concat(F.lit("2026-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("T00:00:00Z"))
    n = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("source_id"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("source_id", k.alias("endpoint"), state.alias("state"), (k % 29).alias("observed"), F.when(k % 6 != 0, k % 29 + 3).alias("expected"), made.alias("generated_at"))


@query("agg_completeness_source", REPORTS + """ SELECT source_id, CAST(sum(observed) AS BIGINT) AS observed, CASE WHEN count(expected) = count(*) THEN CAST(sum(expected) AS BIGINT) END AS expected, CASE WHEN count(expected) = count(*) THEN CAST(sum(greatest(expected - observed, 0)) AS BIGINT) END AS remainder,
  CASE min(CASE state WHEN 'blocked' THEN 1 WHEN 'bounded_partial' THEN 2 ELSE 3 END) WHEN 1 THEN 'blocked' WHEN 2 THEN 'bounded_partial' ELSE 'complete_for_observed_endpoint' END AS state, max(generated_at) AS evidence_at FROM rep GROUP BY 1""")
def agg_completeness_source(spark, d):
    left = F.when(F.col("expected").isNotNull(), F.greatest(F.col("expected") - F.col("observed"), F.lit(0)))
    return reports(spark, d).groupBy("source_id").agg(F.sum("observed").alias("observed"), summarise.strict_sum(F.col("expected")).alias("expected"), summarise.strict_sum(left).alias("remainder"), policy.worst(F.col("state"), STATES).alias("state"), F.max("generated_at").alias("evidence_at"))


@query("worst_state", REPORTS + " SELECT CASE min(CASE state WHEN 'blocked' THEN 1 WHEN 'bounded_partial' THEN 2 ELSE 3 END) WHEN 1 THEN 'blocked' WHEN 2 THEN 'bounded_partial' ELSE 'complete_for_observed_endpoint' END AS state, count(*) AS reports FROM rep")
def worst_state(spark, d):
    return reports(spark, d).agg(policy.worst(F.col("state"), STATES).alias("state"), F.count(F.lit(1)).alias("reports"))


@query("agg_site_inventory", REPORTS + " SELECT state, count(*) AS reports, max(generated_at) AS evidence_at, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources FROM rep GROUP BY 1")
def agg_site_inventory(spark, d):
    return reports(spark, d).groupBy("state").agg(F.count(F.lit(1)).alias("reports"), F.max("generated_at").alias("evidence_at"), summarise.listed(F.col("source_id")).alias("sources"))


@query("agg_index_metrics", CTES + "SELECT (SELECT count(*) FROM docs) AS documents, (SELECT count(*) FROM flds) AS fields, (SELECT count(DISTINCT cluster_id) FROM docs) AS clusters, (SELECT count(*) FROM pols) AS policies, (SELECT count(*) FROM docs WHERE toxic = 1) AS deletions, (SELECT count(*) FROM granted) AS granted")
def agg_index_metrics(spark, d):
    from attesta.plans.search import granted, now

    docs = records.documents(spark, d, clusters=True)
    a = docs.agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("cluster_id").alias("clusters"), F.count_if(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("deletions"))
    b = granted(spark, d, docs).agg(F.count(F.lit(1)).alias("fields"), F.count("policy_id").alias("policies"), F.count_if(policy.authorised(now()) & policy.evidence_holds(now())).alias("granted"))
    return a.join(F.broadcast(b))


@query("agg_selection_metrics", COVER + " SELECT count(*) AS declared, count(*) FILTER (eligible >= minimum) AS met FROM cov")
def agg_selection_metrics(spark, d):
    return cover(spark, d).agg(F.count(F.lit(1)).alias("declared"), F.count_if(F.col("eligible") >= F.col("minimum")).alias("met"))


@query("agg_stable_alias", CTES + "SELECT asset_id, count(*) AS holders, count(DISTINCT source_id) AS sources FROM docs GROUP BY 1 HAVING holders >= 2 AND sources >= 2")
def agg_stable_alias(spark, d):
    return records.documents(spark, d).groupBy("asset_id").agg(F.count(F.lit(1)).alias("holders"), F.count_distinct("source_id").alias("sources")).where("holders >= 2 and sources >= 2")


RANKS = ("approved", "metadata_only", "blocked")


def decision(k):
    return F.when(k % 7 == 0, "blocked").when(k % 3 == 0, "metadata_only").otherwise("approved")


DECISION = "CASE WHEN doc_id % 7 = 0 THEN 'blocked' WHEN doc_id % 3 = 0 THEN 'metadata_only' ELSE 'approved' END"


def strictest():
    return F.element_at(F.array(*map(F.lit, RANKS)), F.max(policy.ranked(F.col("decision"), RANKS)).cast("int"))


STRICTEST = "CASE max(CASE decision WHEN 'approved' THEN 1 WHEN 'metadata_only' THEN 2 ELSE 3 END) WHEN 1 THEN 'approved' WHEN 2 THEN 'metadata_only' ELSE 'blocked' END"


@query("agg_content_cluster", f"SELECT sha256(text) AS sha, {STRICTEST} AS decision, count(DISTINCT doc_id) AS edges FROM (SELECT *, {DECISION} AS decision FROM documents) GROUP BY 1")
def agg_content_cluster(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"), decision(F.col("doc_id")).alias("decision"))
    return docs.groupBy("sha").agg(strictest().alias("decision"), F.count_distinct("doc_id").alias("edges"))


@query("agg_most_restrictive", f"SELECT source, {STRICTEST} AS decision FROM (SELECT *, {DECISION} AS decision FROM documents) GROUP BY 1")
def agg_most_restrictive(spark, d):
    docs = table(spark, d, "documents").select("source", decision(F.col("doc_id")).alias("decision"))
    return docs.groupBy("source").agg(strictest().alias("decision"))


@query("agg_rights_inheritance", f"""WITH x AS (SELECT source, lang, {DECISION} AS decision, 'r' || (doc_id % 4) AS rights FROM documents), m AS (SELECT source, lang, max(CASE decision WHEN 'approved' THEN 1 WHEN 'metadata_only' THEN 2 ELSE 3 END) AS r FROM x GROUP BY ALL),
  s AS (SELECT source, lang, list_sort(list(DISTINCT rights)) AS rs FROM x JOIN m USING (source, lang) WHERE r = CASE decision WHEN 'approved' THEN 1 WHEN 'metadata_only' THEN 2 ELSE 3 END GROUP BY ALL)
  SELECT source, lang, CASE WHEN len(rs) = 1 THEN rs[1] ELSE sha256('["' || array_to_string(rs, '","') || '"]' || chr(10)) END AS effective_rights FROM s""")
def agg_rights_inheritance(spark, d):
    x = table(spark, d, "documents").select("source", "lang", policy.ranked(decision(F.col("doc_id")), RANKS).alias("r"), F.concat(F.lit("r"), F.col("doc_id") % 4).alias("rights"))
    # One pass: rights by rank, then those of the highest.
    by_rank = x.groupBy("source", "lang", "r").agg(F.array_sort(F.collect_set("rights")).alias("rs"))
    top = by_rank.groupBy("source", "lang").agg(F.max_by("rs", "r").alias("rs"))
    return top.select("source", "lang", F.when(F.size("rs") == 1, F.col("rs")[0]).otherwise(F.sha2(F.concat(F.to_json("rs"), F.lit("\n")), 256)).alias("effective_rights"))


@query("agg_quality_histogram", CTES + "SELECT coalesce(reason, 'eligible') AS state, count(*) AS n FROM reasons GROUP BY 1")
def agg_quality_histogram(spark, d):
    return reasoned(spark, d).groupBy(F.coalesce("reason", F.lit("eligible")).alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("agg_retrieval_observed", """WITH c AS (SELECT item_id, lower(split_part(text, ' ', 3)) AS term FROM benchmark), h AS (SELECT item_id, doc_id, quality FROM c JOIN documents ON term <> '' AND contains(lower(text), term) LEFT JOIN labels USING (doc_id))
  SELECT item_id, count(DISTINCT doc_id) AS observed, count(DISTINCT doc_id) FILTER (quality = 0) AS forbidden, CASE WHEN count(DISTINCT doc_id) FILTER (quality = 1) = 0 THEN 'missing' WHEN count(*) FILTER (quality = 0) > 0 THEN 'forbidden' ELSE 'contained' END AS verdict FROM h GROUP BY 1""")
def agg_retrieval_observed(spark, d):
    """Documents whose text holds each case's term, whole words or not, and whether what is shown is what may be."""
    cases = table(spark, d, "benchmark").select(F.col("item_id").alias("case_id"), F.split_part("text", F.lit(" "), F.lit(3)).alias("term"))
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select("doc_id", "quality", "text")
    hits = search.term_hits(docs, "text", cases).select(F.col("case_id").alias("item_id"), "doc_id", "quality")
    one = lambda q: F.count_distinct(F.when(F.col("quality") == q, F.col("doc_id")))
    verdict = F.when(one(1) == 0, "missing").when(one(0) > 0, "forbidden").otherwise("contained")
    return hits.groupBy("item_id").agg(F.count_distinct("doc_id").alias("observed"), one(0).alias("forbidden"), verdict.alias("verdict"))


@query("agg_duplicate_hash", CTES + ", n AS (SELECT text_sha, count(DISTINCT document_id) AS holders, min(document_id) AS class_id FROM docs GROUP BY 1 HAVING holders >= 2) SELECT document_id, text_sha, holders, class_id FROM docs JOIN n USING (text_sha)")
def agg_duplicate_hash(spark, d):
    """Documents of one content: a row for each member, with the number of holders and the least of them."""
    docs = records.documents(spark, d).select("document_id", "text_sha")
    n = docs.groupBy("text_sha").agg(F.count_distinct("document_id").alias("holders"), F.min("document_id").alias("class_id")).where("holders >= 2")
    return docs.join(n, "text_sha").select("document_id", "text_sha", "holders", "class_id")


@query("agg_progress", ctes("prog_asset", "prog_job", "prog_lease", "prog_evidence") + f""", s AS (SELECT state, count(*) AS n FROM prog_asset GROUP BY 1), l AS (SELECT CASE WHEN NOT released THEN CASE WHEN expires_day <= {NOW} THEN 'expired' ELSE 'active' END WHEN reason = 'expired' THEN 'expired' END AS k FROM prog_lease)
  SELECT 'state' AS section, state AS key, n FROM s UNION ALL SELECT 'retry', retry_state, count(*) FROM prog_job GROUP BY 2 UNION ALL SELECT 'lease', k, count(*) FROM l WHERE k IS NOT NULL GROUP BY 2 UNION ALL SELECT 'evidence', link, count(*) FROM prog_evidence GROUP BY 2
  UNION ALL SELECT 'next_action', CASE WHEN EXISTS (SELECT 1 FROM s WHERE state = 'blocked') THEN 'resolve current blockers' WHEN EXISTS (SELECT 1 FROM l WHERE k = 'active') THEN 'allow active leases to finish or checkpoint' WHEN EXISTS (SELECT 1 FROM prog_job WHERE retry_state <> 'exhausted') THEN 'claim the next capability-compatible job' ELSE 'advance the earliest asset through its next verified gate' END, 1""")
def agg_progress(spark, d):
    """Where a ledger stands: states, retries, leases, evidence, and the next safe action."""
    f = lambda n: evidence.family(spark, d, n)
    return summarise.progress(f("prog_asset"), f("prog_job"), f("prog_lease"), f("prog_evidence"), F.lit(NOW))


# Findings by the action that they ask for, the most urgent first.
ACTIONS = ("propagate_deletion", "review_rights", "resolve_metadata", "review_duplicate", "close_coverage_gap")
FOUND = COVER + """, f AS (SELECT 'review_rights' AS action, reason AS blocker, source_id, document_id AS ref FROM reasons WHERE reason LIKE 'rights%' UNION ALL SELECT 'resolve_metadata', reason, source_id, document_id FROM reasons WHERE reason = 'metadata_unresolved'
  UNION ALL SELECT 'review_duplicate', 'duplicate_content', source_id, document_id FROM docs WHERE cluster_id IS NOT NULL UNION ALL SELECT 'propagate_deletion', 'deletion_event', source_id, document_id FROM docs WHERE toxic = 1
  UNION ALL SELECT 'close_coverage_gap', CASE WHEN blocked > 0 THEN 'blocked' WHEN unavailable > 0 THEN 'unavailable' WHEN unresolved > 0 THEN 'unresolved' ELSE 'underrepresented' END, 'corpus', target_id FROM cov WHERE eligible < minimum),
  r AS (SELECT CASE action WHEN 'propagate_deletion' THEN 1 WHEN 'review_rights' THEN 2 WHEN 'resolve_metadata' THEN 3 WHEN 'review_duplicate' THEN 4 ELSE 5 END AS priority, action, blocker, source_id, array_to_string(list_sort(list(DISTINCT ref))[1:64], ',') AS refs, count(DISTINCT ref) AS n, count(DISTINCT ref) > 64 AS truncated FROM f GROUP BY ALL)"""


def recommended(spark, d):
    """priority, action, blocker, source_id, refs, n, truncated: five kinds of findings by what they ask for."""
    docs = records.documents(spark, d, clusters=True)
    reasons = reasoned(spark, d, docs)
    part = lambda df, action, blocker, source=F.col("source_id"), ref=F.col("document_id"): df.select(F.lit(action).alias("action"), blocker.alias("blocker"), source.alias("source_id"), ref.alias("ref"))
    c = cover(spark, d)
    gap = summarise.gap_state(summarise.shortfall(F.col("minimum"), F.col("eligible")), F.col("blocked"), F.col("unavailable"), F.col("unresolved"))
    found = part(reasons.where("reason like 'rights%'"), "review_rights", F.col("reason")).unionByName(part(reasons.where("reason = 'metadata_unresolved'"), "resolve_metadata", F.col("reason")))
    found = found.unionByName(part(docs.where("cluster_id is not null"), "review_duplicate", F.lit("duplicate_content"))).unionByName(part(docs.where("toxic = 1"), "propagate_deletion", F.lit("deletion_event")))
    found = found.unionByName(part(c.where("eligible < minimum"), "close_coverage_gap", gap, F.lit("corpus"), F.col("target_id")))
    out = summarise.first_refs(found, ["action", "blocker", "source_id"], "ref")
    return out.withColumn("priority", policy.ranked(F.col("action"), ACTIONS).cast("int"))


@query("agg_recommendations", FOUND + " SELECT * FROM r")
def agg_recommendations(spark, d):
    return recommended(spark, d).select("priority", "action", "blocker", "source_id", "refs", "n", "truncated")


@query("recommendation_order", FOUND + " SELECT priority, action, blocker, source_id, CAST(row_number() OVER (ORDER BY priority, action, source_id, blocker) AS INTEGER) AS place FROM r")
def recommendation_order(spark, d):
    """Recommendations in the order of their urgency: a row for each action, blocker and source by now."""
    place = F.row_number().over(Window.orderBy("priority", "action", "source_id", "blocker"))
    return recommended(spark, d).select("priority", "action", "blocker", "source_id", place.alias("place"))
