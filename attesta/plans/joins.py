"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.functions import text
from attesta.operators import relate, selection
from attesta.plans.catalog import query
from attesta.plans.search import granted, now
from attesta.sources import records
from attesta.sources.records import CTES
from attesta.sources.tables import table


@query("join_field_edge_policy", CTES + "SELECT field_id, edge_id, policy_id FROM auth WHERE policy_id IS NOT NULL")
def join_field_edge_policy(spark, d):
    return granted(spark, d).where("policy_id is not null").select("field_id", "edge_id", "policy_id")


@query("join_current_authority", CTES + "SELECT e_field_id AS field_id FROM edgs WHERE edge_sha IS NOT DISTINCT FROM current_edge_sha")
def join_current_authority(spark, d):
    e = records.edges(records.fields(records.documents(spark, d)))
    snapshot = e.select(F.col("e_field_id").alias("field_id"), F.col("edge_sha").alias("sha"))
    return relate.current_equals(snapshot, e.select(F.col("e_field_id").alias("field_id"), F.col("current_edge_sha").alias("sha")), "field_id", "sha").select("field_id")


@query("join_grants_prefetch", CTES + "SELECT field_id, coalesce(policy_id, '') AS policy_id, coalesce(array_to_string(allowed_operations, ','), '') AS operations FROM auth")
def join_grants_prefetch(spark, d):
    return granted(spark, d).select("field_id", F.coalesce("policy_id", F.lit("")).alias("policy_id"), F.coalesce(F.array_join("allowed_operations", ","), F.lit("")).alias("operations"))


@query("join_cand_target", CTES + " SELECT candidate_id, target_id, priority, minimum FROM cdims JOIN tgts USING (dimension, value)")
def join_cand_target(spark, d):
    docs = records.documents(spark, d)
    c = records.candidates(docs)
    rows = c.select("candidate_id", F.inline(records.dimensions(c))).join(records.targets(docs), ["dimension", "value"])
    return rows.select("candidate_id", "target_id", F.col("priority").cast("bigint").alias("priority"), F.col("minimum").cast("bigint").alias("minimum"))


WIDE = CTES + """, wide AS (SELECT doc_id, max(value) FILTER (name = 'title' AND doc_id % 7 <> 3) AS title, max(value) FILTER (name = 'language' AND doc_id % 11 <> 5) AS language, max(value) FILTER (name = 'origin') AS origin FROM flds GROUP BY 1),
  pairs AS (SELECT a.doc_id, coalesce((a.title = b.title)::INT, 0) + coalesce((a.language = b.language)::INT, 0) + coalesce((a.origin = b.origin)::INT, 0) AS matched, coalesce((a.title <> b.title)::INT, 0) + coalesce((a.language <> b.language)::INT, 0) + coalesce((a.origin <> b.origin)::INT, 0) AS unequal FROM wide a JOIN wide b ON a.doc_id <> b.doc_id),
  counted AS (SELECT doc_id, count(*) FILTER (matched > 1 AND unequal = 0) AS likely_high, count(*) FILTER (matched = 1 AND unequal = 0) AS likely_medium, count(*) FILTER (matched > 0 AND unequal > 0) AS conflicting FROM pairs GROUP BY 1)"""


def partners(spark, d):
    flds = records.fields(records.documents(spark, d))
    n = F.col("doc_id")
    value = lambda name, known=F.lit(True): F.max(F.when((F.col("name") == name) & known, F.col("value"))).alias(name)
    return relate.partners(flds.groupBy("doc_id").agg(value("title", n % 7 != 3), value("language", n % 11 != 5), value("origin")), "doc_id", ["title", "language", "origin"])


@query("join_pairwise_field_hash", WIDE + ", c AS (SELECT min(doc_id) AS class_id, title, language, origin FROM wide GROUP BY ALL) SELECT counted.*, class_id FROM counted JOIN wide USING (doc_id) JOIN c ON c.title IS NOT DISTINCT FROM wide.title AND c.language IS NOT DISTINCT FROM wide.language AND c.origin IS NOT DISTINCT FROM wide.origin")
def join_pairwise_field_hash(spark, d):
    """How many other documents agree on all shared fields, or on some but not all; and the class of equal fields."""
    return partners(spark, d)


@query("agg_metadata_dup_class", WIDE + """ SELECT doc_id, 'likely_metadata_duplicate' AS finding_class, 'high' AS confidence, likely_high AS partners FROM counted WHERE likely_high > 0 UNION ALL SELECT doc_id, 'likely_metadata_duplicate', 'medium', likely_medium FROM counted WHERE likely_medium > 0
  UNION ALL SELECT doc_id, 'conflicting_duplicate', 'medium', conflicting FROM counted WHERE conflicting > 0""")
def agg_metadata_dup_class(spark, d):
    """Findings of each class and confidence, with the number of partners; a likely one doesn't hide a conflicting one."""
    one = lambda name, grade, c: F.when(F.col(c) > 0, F.struct(F.lit(name).alias("finding_class"), F.lit(grade).alias("confidence"), F.col(c).alias("partners")))
    found = F.array(one("likely_metadata_duplicate", "high", "likely_high"), one("likely_metadata_duplicate", "medium", "likely_medium"), one("conflicting_duplicate", "medium", "conflicting"))
    return partners(spark, d).select("doc_id", F.inline(F.filter(found, lambda x: x.isNotNull())))


TOKENS = """WITH r AS (SELECT p_partkey AS record_id, p_brand AS source_id, list_sort(list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type || ' x' || (p_partkey % 90)), '[\\p{L}\\p{N}_]+'))) AS tokens FROM part),
  p AS (SELECT record_id, source_id, unnest(tokens) AS token FROM r), rare AS (SELECT token FROM p WHERE length(token) > 1 GROUP BY 1 HAVING count(*) <= 100),
  k AS (SELECT p.* FROM p JOIN rare USING (token)), c AS (SELECT DISTINCT a.record_id AS first, b.record_id AS second FROM k a JOIN k b ON a.token = b.token AND a.record_id < b.record_id AND a.source_id <> b.source_id),
  s AS (SELECT first, second, CAST(round_even(1000.0 * len(list_intersect(x.tokens, y.tokens)) / len(list_distinct(x.tokens || y.tokens)), 0) AS BIGINT) AS similarity_milli FROM c JOIN r x ON x.record_id = first JOIN r y ON y.record_id = second)"""


def catalogue(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("record_id"), F.col("p_brand").alias("source_id"), text.tokens(F.concat_ws(" ", "p_name", "p_type", F.concat(F.lit("x"), F.col("p_partkey") % 90))).alias("tokens"))


@query("join_token_inverted", TOKENS + " SELECT * FROM s WHERE similarity_milli >= 200")
def join_token_inverted(spark, d):
    return relate.token_pairs(catalogue(spark, d))


@query("join_page_count", CTES + "SELECT text_sha, CAST(max(n_chars) AS BIGINT) AS n_chars, count(*) AS holders, count(DISTINCT n_chars) = 1 AS consistent FROM docs GROUP BY 1")
def join_page_count(spark, d):
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("text_sha"), "n_chars")
    return docs.groupBy("text_sha").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("holders"), (F.min("n_chars") == F.max("n_chars")).alias("consistent"))


@query("join_override", CTES + """ SELECT c.candidate_id, CASE WHEN o.candidate_id IS NULL THEN 'missing' WHEN o.candidate_sha <> c.candidate_sha OR o.source_id <> c.source_id OR o.asset_id <> c.asset_id THEN 'not_bound' WHEN o.state <> 'approved' THEN o.state WHEN decided > 150 THEN 'not_yet_effective' WHEN expires <= 150 THEN 'expired' ELSE 'current' END AS override FROM cands c LEFT JOIN overrides o USING (candidate_id) WHERE pipeline_proof""")
def join_override(spark, d):
    """Proof candidates with what their review override is worth: it binds the candidate's exact content, source and asset."""
    c = records.candidates(records.documents(spark, d)).where("pipeline_proof")
    return selection.overridden(c, records.overrides(spark, d), now()).select("candidate_id", "override")


CAPABLE = "WITH w AS (SELECT user_id, list(DISTINCT event_type) AS held FROM events GROUP BY 1), j AS (SELECT event_id AS job_id, list_distinct([event_type, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END]) AS required FROM events)"


def capable(spark, d):
    """(workers, jobs, sets that fit); jobs and workers meet through their distinct sets."""
    e = table(spark, d, "events")
    workers = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("held"))
    need = F.array_sort(F.array_distinct(F.array("event_type", F.when(F.col("event_id") % 3 == 0, "view").otherwise(F.col("event_type")))))
    jobs = e.select(F.col("event_id").alias("job_id"), need.alias("required"))
    return workers, jobs, relate.capable(jobs.select("required").distinct(), workers.select("held").distinct())


@query("join_capability", CAPABLE + " SELECT job_id, count(*) AS workers FROM j JOIN w ON list_has_all(held, required) GROUP BY 1")
def join_capability(spark, d):
    workers, jobs, fit = capable(spark, d)
    n = workers.groupBy("held").agg(F.count(F.lit(1)).alias("n"))
    return jobs.join(fit.join(n, "held").groupBy("required").agg(F.sum("n").alias("workers")), "required").select("job_id", "workers")


@query("claim_next_job", CAPABLE + " SELECT user_id, min(job_id) AS job_id FROM j JOIN w ON list_has_all(held, required) GROUP BY 1")
def claim_next_job(spark, d):
    workers, jobs, fit = capable(spark, d)
    first = jobs.groupBy("required").agg(F.min("job_id").alias("job_id"))
    return workers.join(fit.join(first, "required").groupBy("held").agg(F.min("job_id").alias("job_id")), "held").select("user_id", "job_id")


@query("join_job_duplicates", "SELECT a.l_orderkey, a.l_linenumber, count(*) AS twins FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey AND a.l_quantity = b.l_quantity AND a.l_returnflag = b.l_returnflag AND (a.l_orderkey <> b.l_orderkey OR a.l_linenumber <> b.l_linenumber) GROUP BY ALL")
def join_job_duplicates(spark, d):
    sign = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *sign)
    # Counts of a signature say how many others have it: no pairs are made.
    counts = l.groupBy(*sign).agg((F.count(F.lit(1)) - 1).alias("twins")).where("twins > 0")
    return l.join(counts, sign).select("l_orderkey", "l_linenumber", "twins")


GENERATIONS = "WITH p AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 0), c AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN sha256('new') ELSE sha256(text) END AS h FROM documents WHERE doc_id % 13 <> 0)"


def generations(spark, d):
    docs = table(spark, d, "documents")
    h = F.sha2("text", 256)
    return docs.where("doc_id % 10 <> 0").select("doc_id", h.alias("h")), docs.where("doc_id % 13 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, F.sha2(F.lit("new"), 256)).otherwise(h).alias("h"))


@query("join_index_generation", GENERATIONS + " SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'added' WHEN c.doc_id IS NULL THEN 'removed' WHEN p.h = c.h THEN 'unchanged' ELSE 'changed' END AS change FROM p FULL JOIN c ON p.doc_id = c.doc_id")
def join_index_generation(spark, d):
    return relate.generation_diff(*generations(spark, d), "doc_id", "h")


@query("set_upserted_documents", GENERATIONS + " SELECT c.doc_id FROM c LEFT JOIN p USING (doc_id) WHERE p.h IS DISTINCT FROM c.h")
def set_upserted_documents(spark, d):
    return relate.generation_diff(*generations(spark, d), "doc_id", "h").where("change in ('added', 'changed')").select("doc_id")


@query("set_removed_documents", GENERATIONS + " SELECT doc_id FROM p WHERE doc_id NOT IN (SELECT doc_id FROM c)")
def set_removed_documents(spark, d):
    p, c = generations(spark, d)
    return p.join(c, "doc_id", "left_anti").select("doc_id")


@query("set_superseded_fields", CTES + "SELECT doc_id, field_id FROM flds WHERE doc_id % 10 <> 0 EXCEPT SELECT doc_id, field_id FROM flds WHERE k % 13 <> 0")
def set_superseded_fields(spark, d):
    f = records.fields(records.documents(spark, d))
    return f.where("doc_id % 10 <> 0").select("doc_id", "field_id").subtract(f.where("k % 13 <> 0").select("doc_id", "field_id"))


@query("set_orphan_check", CTES + "SELECT field_id, policy_id FROM flds FULL JOIN pols ON field_id = p_field_id WHERE field_id IS NULL OR policy_id IS NULL")
def set_orphan_check(spark, d):
    f = records.fields(records.documents(spark, d))
    p = records.policies(f)
    return f.join(p, f.field_id == p.p_field_id, "full_outer").where("field_id is null or policy_id is null").select("field_id", "policy_id")


@query("set_intersection_uses", "SELECT l_orderkey, string_agg(f, ',' ORDER BY f) AS uses FROM (SELECT l_orderkey, l_returnflag AS f, count(DISTINCT l_linestatus) AS n FROM lineitem GROUP BY 1, 2) x JOIN (SELECT l_orderkey, count(DISTINCT l_linestatus) AS total FROM lineitem GROUP BY 1) y USING (l_orderkey) WHERE n = total GROUP BY 1")
def set_intersection_uses(spark, d):
    sets = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linestatus").agg(F.collect_set("l_returnflag").alias("uses"))
    common = sets.groupBy("l_orderkey").agg(F.collect_list("uses").alias("all"))
    both = F.aggregate(F.slice("all", 2, 99), F.col("all")[0], F.array_intersect)
    return common.select("l_orderkey", F.array_join(F.array_sort(both), ",").alias("uses")).where("uses <> ''")


@query("set_projected_count", "SELECT (SELECT count(*) FROM documents WHERE doc_id % 2 = 0) + (SELECT count(*) FROM (SELECT doc_id FROM documents WHERE doc_id % 3 = 0 EXCEPT SELECT doc_id FROM documents WHERE doc_id % 2 = 0)) AS projected")
def set_projected_count(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    stored = docs.where("doc_id % 2 = 0")
    new = docs.where("doc_id % 3 = 0").distinct().join(stored, "doc_id", "left_anti")
    return stored.unionByName(new).agg(F.count(F.lit(1)).alias("projected"))


@query("topk_hash_rank", "SELECT doc_id, lang, place FROM (SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY sha256('d' || doc_id), 'd' || doc_id) AS INTEGER) AS place FROM documents) WHERE place <= 20")
def topk_hash_rank(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return relate.hash_ranked(docs, "lang", F.concat(F.lit("d"), "doc_id"), 20).select("doc_id", "lang", "place")


@query("set_union_findings", CTES + "SELECT 'rights' AS finding, count(*) AS n FROM reasons WHERE reason LIKE 'rights%' UNION ALL SELECT 'toxic', count(*) FROM docs WHERE toxic = 1 UNION ALL SELECT 'cluster', count(*) FROM docs WHERE cluster_id IS NOT NULL")
def set_union_findings(spark, d):
    from attesta.plans.decisions import reasoned

    docs = records.documents(spark, d, clusters=True)
    n = F.count(F.lit(1)).alias("n")
    parts = [(("rights"), reasoned(spark, d).where("reason like 'rights%'")), ("toxic", docs.where("toxic = 1")), ("cluster", docs.where("cluster_id is not null"))]
    frames = [df.agg(n).select(F.lit(name).alias("finding"), "n") for name, df in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("join_cand_decision", CTES + "SELECT candidate_id, CASE WHEN reason IS NULL THEN 'include' WHEN reason = 'metadata_unresolved' THEN 'unresolved' ELSE 'exclude' END AS decision FROM reasons")
def join_cand_decision(spark, d):
    """Candidates with their decisions; every candidate has one."""
    from attesta.plans.decisions import reasoned

    docs = records.documents(spark, d)
    r = F.col("reason")
    decided = reasoned(spark, d, docs).select("candidate_id", F.when(r.isNull(), "include").when(r == "metadata_unresolved", "unresolved").otherwise("exclude").alias("decision"))
    return records.candidates(docs).select("candidate_id").join(decided, "candidate_id", "left")


UPSERT = "WITH s AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 10 <> 0), i AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN sha256('new') ELSE sha256(text) END AS h FROM documents WHERE doc_id % 13 <> 0)"


@query("sink_ledger_upsert", UPSERT + " SELECT i.doc_id, CASE WHEN s.doc_id IS NULL THEN 'insert' ELSE 'conflict' END AS effect FROM i LEFT JOIN s USING (doc_id) WHERE s.doc_id IS NULL OR s.h <> i.h")
def sink_ledger_upsert(spark, d):
    stored, incoming = generations(spark, d)
    new, conflicts = relate.upsert(stored, incoming, "doc_id", "h")
    return new.select("doc_id", F.lit("insert").alias("effect")).unionByName(conflicts.select("doc_id", F.lit("conflict").alias("effect")))


@query("sink_canonical_json", """SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS body FROM orders""")
def sink_canonical_json(spark, d):
    from attesta.sources.sinks import as_canonical

    return as_canonical(table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_custkey"), "o_orderkey")


@query("project_allowlist_serialize", "SELECT c_custkey, c_mktsegment FROM customer")
def project_allowlist_serialize(spark, d):
    """Only declared columns leave, whatever else the table grows."""
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment")
