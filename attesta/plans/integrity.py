"""Quality and integrity checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.functions import times
from attesta.operators import expect, policy, relate, search
from attesta.plans.aggregates import FOUND
from attesta.plans.catalog import query
from attesta.plans.joins import GENERATIONS, generations
from attesta.plans.search import STATE, granted, now, shown
from attesta.sources import evidence, records
from attesta.sources.evidence import ctes
from attesta.sources.records import CTES
from attesta.sources.tables import table


@query("build_snapshot", CTES + "SELECT document_id, count(*) AS fields FROM auth WHERE edge_sha = current_edge_sha AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY 1")
def build_snapshot(spark, d):
    gone = table(spark, d, "labels").where("toxic = 1").select("doc_id")
    return granted(spark, d).where("edge_sha = current_edge_sha").join(gone, "doc_id", "left_anti").groupBy("document_id").agg(F.count(F.lit(1)).alias("fields"))


@query("build_corpus_index", CTES + "SELECT document_id, selection_state, period, (SELECT count(*) FROM flds f WHERE f.document_id = docs.document_id) AS fields, coalesce(cluster_id, '') AS cluster_id FROM docs WHERE selection_state <> 'excluded'")
def build_corpus_index(spark, d):
    docs = records.documents(spark, d, clusters=True).where("selection_state <> 'excluded'")
    n = records.fields(docs).groupBy("document_id").agg(F.count(F.lit(1)).alias("fields"))
    return docs.join(n, "document_id").select("document_id", "selection_state", "period", "fields", F.coalesce("cluster_id", F.lit("")).alias("cluster_id"))


@query("qc_metadata_normalization", CTES + "SELECT document_id, CASE WHEN max(CASE WHEN value IS NULL OR value = '' THEN 1 ELSE 0 END) = 1 THEN 'fail' WHEN max(CASE WHEN name = 'title' AND length(value) < 10 THEN 1 ELSE 0 END) = 1 THEN 'unresolved' ELSE 'pass' END AS state FROM flds GROUP BY 1")
def qc_metadata_normalization(spark, d):
    empty = F.max(F.coalesce(F.col("value") == "", F.lit(True)))
    short = F.max(F.coalesce((F.col("name") == "title") & (F.length("value") < 10), F.lit(False)))
    return records.fields(records.documents(spark, d)).groupBy("document_id").agg(F.when(empty, "fail").when(short, "unresolved").otherwise("pass").alias("state"))


@query("qc_provenance_completeness", CTES + "SELECT document_id, count(*) FILTER (edge_sha = current_edge_sha) = count(*) AS complete FROM auth GROUP BY 1")
def qc_provenance_completeness(spark, d):
    return granted(spark, d).groupBy("document_id").agg(F.every(F.col("edge_sha") == F.col("current_edge_sha")).alias("complete"))


@query("qc_rights_freshness", CTES + "SELECT field_id, CASE WHEN policy_id IS NULL OR rights_state <> 'approved' OR p_rights_sha <> rights_sha THEN 'blocked' WHEN decided > 150 THEN 'unknown' WHEN 150 >= expires OR 150 >= p_evidence_expires OR 150 >= evidence_expires THEN 'fail' ELSE 'pass' END AS state FROM auth")
def qc_rights_freshness(spark, d):
    c = F.col
    blocked = c("policy_id").isNull() | (c("rights_state") != "approved") | (c("p_rights_sha") != c("rights_sha"))
    stale = (c("expires_at") <= now()) | (c("p_evidence_expires_at") <= now()) | (c("evidence_expires_at") <= now())
    return granted(spark, d).select("field_id", F.when(blocked, "blocked").when(c("decided_at") > now(), "unknown").when(stale, "fail").otherwise("pass").alias("state"))


@query("qc_retention_readiness", CTES + "SELECT document_id, bool_and(coalesce(retention_state = 'retain', false)) AS ready FROM auth GROUP BY 1")
def qc_retention_readiness(spark, d):
    return granted(spark, d).groupBy("document_id").agg(F.every(policy.closed(F.col("retention_state") == "retain")).alias("ready"))


@query("qc_deletion_propagation", CTES + "SELECT l.doc_id, count(f.field_id) > 0 AS still_indexed FROM labels l LEFT JOIN flds f ON f.doc_id = l.doc_id WHERE l.toxic = 1 GROUP BY 1")
def qc_deletion_propagation(spark, d):
    f = records.fields(records.documents(spark, d)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "labels").where("toxic = 1").select("doc_id").distinct().join(f, "doc_id", "left").select("doc_id", F.col("n").isNotNull().alias("still_indexed"))


@query("eval_retrieval_case", CTES + """, t AS (SELECT item_id, lower(split_part(text, ' ', 2)) AS term FROM benchmark), seen AS (SELECT item_id, field_id, policy_id FROM t JOIN (SELECT * FROM granted WHERE list_contains(allowed_operations, 'search_visibility') AND list_contains(allowed_audiences, 'researcher')) ON term <> '' AND contains(lower(name || ' ' || value), term)),
  want AS (SELECT item_id, field_id FROM t JOIN flds ON term <> '' AND name = 'title' AND contains(lower(value), term)), x AS (SELECT coalesce(a.item_id, b.item_id) AS item_id, a.field_id IS NOT NULL AS seen, b.field_id IS NOT NULL AS wanted FROM seen a FULL JOIN want b ON a.item_id = b.item_id AND a.field_id = b.field_id)
  SELECT item_id, count(x.item_id) FILTER (seen) AS found, count(x.item_id) FILTER (wanted AND NOT seen) AS missing, count(x.item_id) FILTER (seen AND NOT wanted) AS unexpected, CASE WHEN count(x.item_id) FILTER (seen) = 0 THEN 'empty' WHEN count(x.item_id) FILTER (seen AND NOT wanted) > 0 THEN 'unexpected' WHEN count(x.item_id) FILTER (wanted AND NOT seen) > 0 THEN 'partial' ELSE 'pass' END AS verdict FROM t LEFT JOIN x USING (item_id) GROUP BY 1""")
def eval_retrieval_case(spark, d):
    """Each case searched as a researcher sees it: what is found against the titles that hold the term."""
    cases = table(spark, d, "benchmark").select(F.col("item_id").alias("case_id"), F.split_part("text", F.lit(" "), F.lit(2)).alias("term"))
    flds = records.fields(records.documents(spark, d))
    visible = shown(spark, d).select("field_id", F.concat_ws(" ", "name", "value").alias("t"))
    seen = search.term_hits(visible, "t", cases).select("case_id", "field_id", F.lit(1).alias("w"))
    wanted = search.term_hits(flds.where("name = 'title'").select("field_id", "value"), "value", cases).select("case_id", "field_id", F.lit(2).alias("w"))
    each = seen.unionByName(wanted).groupBy("case_id", "field_id").agg(F.sum("w").alias("w"))
    n = lambda *w: F.count_if(F.col("w").isin(*w))
    found = each.groupBy("case_id").agg(n(1, 3).alias("found"), n(2).alias("missing"), n(1).alias("unexpected"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    rows = cases.select("case_id").join(found, "case_id", "left").select(F.col("case_id").alias("item_id"), zero("found"), zero("missing"), zero("unexpected"))
    return rows.withColumn("verdict", F.when(F.col("found") == 0, "empty").when(F.col("unexpected") > 0, "unexpected").when(F.col("missing") > 0, "partial").otherwise("pass"))


@query("page_slot")
def page_slot(spark, d):
    """A 256-bit digest modulo the page count, digit by digit."""
    from attesta.functions.hashing import mod_of_hex

    pages = (F.col("n_chars") / 500).cast("bigint") + 1
    return table(spark, d, "documents").select("doc_id", (F.lit(1) + mod_of_hex(F.sha2(F.concat(F.lit("asset_"), "doc_id"), 256), pages)).alias("page"))


@query("contiguous_index_check", "SELECT conv_id, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY 1")
def contiguous_index_check(spark, d):
    return expect.contiguous(table(spark, d, "conversations"), ["conv_id"], "turn", 0)


@query("monotonic_checkpoint", "SELECT user_id, count(*) AS backwards FROM (SELECT user_id, value < lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b GROUP BY 1")
def monotonic_checkpoint(spark, d):
    e = table(spark, d, "events").withColumn("b", F.col("value") < F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id")))
    return e.where("b").groupBy("user_id").agg(F.count(F.lit(1)).alias("backwards"))


@query("ordinal_bind", "SELECT doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS ordinal FROM documents")
def ordinal_bind(spark, d):
    return table(spark, d, "documents").select("doc_id", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")).alias("ordinal"))


@query("scalar_sla_due", "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 24 HOURS, '%Y-%m-%dT%H:%M:%SZ') AS due FROM orders")
def scalar_sla_due(spark, d):
    return table(spark, d, "orders").select("o_orderkey", times.text(F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).alias("due"))


@query("sort_canonical", "SELECT doc_id, CAST(row_number() OVER (ORDER BY 'index_document_' || doc_id, doc_id) AS INTEGER) AS place FROM documents")
def sort_canonical(spark, d):
    """Every record with its place in the canonical order, numbered by ranges: no list holds them all."""
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("index_document_"), "doc_id").alias("id"))
    return search.numbered(docs, (F.col("id"), F.col("doc_id")), "place").select("doc_id", "place")


_BROKEN = """SELECT violated AS "check", field_id AS subject FROM (SELECT field_id, unnest([CASE WHEN policy_id IS NULL THEN 'policy_missing' END, CASE WHEN edge_sha <> value_sha THEN 'edge_value' END, CASE WHEN needs_consent AND consent_sha IS NULL THEN 'consent_missing' END, CASE WHEN evidence >= evidence_expires THEN 'evidence_window' END, CASE WHEN value IS NULL OR value = '' THEN 'value_empty' END,
  CASE WHEN policy_id IS NOT NULL AND p_rights_sha <> rights_sha THEN 'policy_rights' END, CASE WHEN policy_id IS NOT NULL AND decided >= expires THEN 'policy_window' END, CASE WHEN edge_sha <> current_edge_sha THEN 'edge_not_current' END, CASE WHEN policy_id IS NOT NULL AND p_evidence_expires > evidence_expires THEN 'policy_outlives_evidence' END]) AS violated FROM auth) WHERE violated IS NOT NULL"""


@query("validate_snapshot", CTES + _BROKEN + """ UNION ALL SELECT 'identity_repeats:' || k, id FROM (SELECT 'document' AS k, document_id AS id FROM docs UNION ALL SELECT 'field', field_id FROM flds UNION ALL SELECT 'edge', edge_id FROM edgs UNION ALL SELECT 'policy', policy_id FROM pols) GROUP BY k, id HAVING count(*) > 1
  UNION ALL SELECT 'edge_orphan', e_field_id FROM edgs WHERE e_field_id NOT IN (SELECT field_id FROM flds) UNION ALL SELECT 'policy_orphan', p_field_id FROM pols WHERE p_field_id NOT IN (SELECT field_id FROM flds) UNION ALL SELECT 'cluster_of_one', cluster_id FROM docs WHERE cluster_id IS NOT NULL GROUP BY 2 HAVING count(*) < 2
  UNION ALL SELECT 'event_not_replayed', document_id FROM docs WHERE toxic = 1""")
def validate_snapshot(spark, d):
    """Everything that a snapshot must not have, one row for each violation: fields, identities, orphans, clusters, events."""
    docs = records.documents(spark, d, clusters=True)
    flds = records.fields(docs)
    edges, policies = records.edges(flds), records.policies(flds)
    c = F.col
    has = c("policy_id").isNull()
    rules = [
        (c("policy_id").isNotNull(), "policy_missing"), (c("edge_sha") == c("value_sha"), "edge_value"), (~policy.needs_consent() | c("consent_sha").isNotNull(), "consent_missing"), (c("evidence_at") < c("evidence_expires_at"), "evidence_window"), (c("value") != "", "value_empty"),
        (has | (c("p_rights_sha") == c("rights_sha")), "policy_rights"), (has | (c("decided_at") < c("expires_at")), "policy_window"), (c("edge_sha") == c("current_edge_sha"), "edge_not_current"), (has | (c("p_evidence_expires_at") <= c("evidence_expires_at")), "policy_outlives_evidence"),
    ]
    out = expect.violations(search.grants(flds, policies, edges), "field_id", rules).select(c("violated").alias("check"), c("field_id").alias("subject"))
    add = lambda df, check, subject: df.select(F.lit(check).alias("check"), c(subject).alias("subject"))
    for name, df, key in (("document", docs, "document_id"), ("field", flds, "field_id"), ("edge", edges, "edge_id"), ("policy", policies, "policy_id")):
        out = out.unionByName(add(expect.duplicates(df, key), f"identity_repeats:{name}", key))
    for name, df, key in (("edge_orphan", edges, "e_field_id"), ("policy_orphan", policies, "p_field_id")):
        out = out.unionByName(add(df.join(flds.select(c("field_id").alias(key)), key, "left_anti"), name, key))
    single = docs.where("cluster_id is not null").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n < 2")
    return out.unionByName(add(single, "cluster_of_one", "cluster_id")).unionByName(add(docs.where("toxic = 1"), "event_not_replayed", "document_id"))


ENTRIES = """, built AS (SELECT d.doc_id, d.document_id, coverage_state, coalesce(cluster_id, '') AS cluster_id, 3 AS fields FROM docs d JOIN covered USING (doc_id) WHERE selection_state <> 'excluded'), entries AS (SELECT doc_id, document_id, CASE WHEN doc_id % 89 = 2 THEN 'stale' ELSE coverage_state END AS coverage_state, CASE WHEN doc_id % 97 = 3 THEN 'duplicate_cluster_x' ELSE cluster_id END AS cluster_id, fields + CASE WHEN doc_id % 101 = 4 THEN 1 ELSE 0 END AS fields FROM built WHERE doc_id % 103 <> 5 UNION ALL SELECT doc_id, document_id, 'stale', '', 3 FROM docs WHERE selection_state = 'excluded' AND doc_id % 19 = 1)"""


@query("validate_corpus_index", CTES + STATE + ENTRIES + """ SELECT coalesce(b.document_id, e.document_id) AS document_id, CASE WHEN e.document_id IS NULL THEN 'entry_missing' WHEN b.document_id IS NULL THEN 'entry_unexpected' WHEN e.fields <> b.fields THEN 'fields' WHEN e.cluster_id <> b.cluster_id THEN 'cluster' WHEN e.coverage_state <> b.coverage_state THEN 'coverage' ELSE 'ok' END AS verdict FROM built b FULL JOIN entries e ON b.document_id = e.document_id""")
def validate_corpus_index(spark, d):
    """Index entries, some of them stale, against what the documents give anew."""
    docs = records.documents(spark, d, clusters=True)
    n = F.col("doc_id")
    state = search.coverage_state(docs, records.targets(docs)).select("doc_id", "coverage_state")
    kept = docs.where("selection_state <> 'excluded'").join(state, "doc_id")
    fields = records.fields(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("fields"))
    built = kept.join(fields, "doc_id").select("doc_id", "document_id", "coverage_state", F.coalesce("cluster_id", F.lit("")).alias("cluster_id"), "fields")
    entries = built.where(n % 103 != 5).select("document_id", F.when(n % 89 == 2, "stale").otherwise(F.col("coverage_state")).alias("e_state"), F.when(n % 97 == 3, "duplicate_cluster_x").otherwise(F.col("cluster_id")).alias("e_cluster"), (F.col("fields") + F.when(n % 101 == 4, 1).otherwise(0)).alias("e_fields"))
    extra = docs.where((F.col("selection_state") == "excluded") & (n % 19 == 1)).select("document_id", F.lit("stale").alias("e_state"), F.lit("").alias("e_cluster"), F.lit(3).cast("bigint").alias("e_fields"))
    rows = built.join(entries.unionByName(extra), "document_id", "full_outer")
    verdict = F.when(F.col("e_fields").isNull(), "entry_missing").when(F.col("fields").isNull(), "entry_unexpected").when(F.col("e_fields") != F.col("fields"), "fields").when(F.col("e_cluster") != F.col("cluster_id"), "cluster").when(F.col("e_state") != F.col("coverage_state"), "coverage").otherwise("ok")
    return rows.select("document_id", verdict.alias("verdict"))


@query("qc_index_consistency", GENERATIONS + " SELECT p.doc_id, CASE WHEN c.doc_id IS NULL THEN 'removed_without_event' ELSE 'superseded_without_event' END AS finding FROM p LEFT JOIN c USING (doc_id) WHERE (c.doc_id IS NULL OR c.h <> p.h) AND p.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def qc_index_consistency(spark, d):
    """What went or changed between generations without an event that says so."""
    events = table(spark, d, "labels").where("toxic = 1").select("doc_id")
    change = relate.generation_diff(*generations(spark, d), "doc_id", "h").where("change in ('removed', 'changed')")
    return change.join(events, "doc_id", "left_anti").select("doc_id", F.when(F.col("change") == "removed", "removed_without_event").otherwise("superseded_without_event").alias("finding"))


@query("validate_contributions", ctes("pn_target", "pn_contribution") + " SELECT kind, target, count(DISTINCT node) AS owners FROM pn_target GROUP BY 1, 2 HAVING owners > 1 UNION ALL SELECT 'contribution', contribution_id, count(*) FROM pn_contribution GROUP BY 2 HAVING count(*) > 1")
def validate_contributions(spark, d):
    """Content that several records claim, and identities that repeat."""
    owned = evidence.family(spark, d, "pn_target").groupBy("kind", "target").agg(F.count_distinct("node").alias("owners")).where("owners > 1")
    ids = expect.duplicates(evidence.family(spark, d, "pn_contribution"), "contribution_id").select(F.lit("contribution").alias("kind"), F.col("contribution_id").alias("target"), F.col("n").alias("owners"))
    return owned.unionByName(ids)


@query("eval_run", FOUND + """, m AS (SELECT 'documents' AS metric, count(*) AS n FROM docs UNION ALL SELECT 'granted', count(*) FROM granted UNION ALL SELECT 'excluded', count(*) FROM reasons WHERE reason IS NOT NULL UNION ALL SELECT 'clusters', count(DISTINCT cluster_id) FROM docs UNION ALL SELECT 'targets', count(*) FROM cov UNION ALL SELECT 'targets_met', count(*) FROM cov WHERE eligible >= minimum
  UNION ALL SELECT 'recommendations', count(*) FROM r UNION ALL SELECT 'findings', CAST(sum(n) AS BIGINT) FROM r) SELECT metric, n, (SELECT sha256(string_agg(metric || '=' || n, ',' ORDER BY metric)) FROM m) AS run_sha FROM m""")
def eval_run(spark, d):
    """An evaluation's figures, and the digest that binds them."""
    from attesta.plans.aggregates import cover, recommended
    from attesta.plans.decisions import reasoned

    docs = records.documents(spark, d, clusters=True)
    n = F.count(F.lit(1)).alias("n")
    c, found = cover(spark, d), recommended(spark, d)
    parts = {
        "documents": docs.agg(n), "granted": granted(spark, d, docs).where(policy.authorised(now()) & policy.evidence_holds(now())).agg(n), "excluded": reasoned(spark, d, docs).where("reason is not null").agg(n), "clusters": docs.agg(F.count_distinct("cluster_id").alias("n")),
        "targets": c.agg(n), "targets_met": c.where("eligible >= minimum").agg(n), "recommendations": found.agg(n), "findings": found.agg(F.sum("n").alias("n")),
    }
    out = None
    for name, df in parts.items():
        df = df.select(F.lit(name).alias("metric"), "n")
        out = df if out is None else out.unionByName(df)
    # Eight rows.
    bound = out.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "metric", F.col("n").cast("string")))), ","), 256).alias("run_sha"))
    return out.join(F.broadcast(bound))


@query("compile_pilot_freeze")
def compile_pilot_freeze(spark, d):
    """A pilot as frozen: a quota of each language with page slots, linked pairs, and control pairs; ids bind what they stand for."""
    from attesta.functions.hashing import mod_of_hex, record_id
    from attesta.plans import operations
    from attesta.plans.decisions import greedy_balanced_pairs

    s = relate.hash_ranked(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "lang", F.concat(F.lit("asset_"), "doc_id"), 30)
    slot = F.lit(1) + mod_of_hex(F.sha2(F.concat(F.lit("asset_"), "doc_id"), 256), F.greatest(F.lit(1).cast("bigint"), F.col("n_chars") / 500).cast("bigint"))
    none = F.lit(None).cast("bigint")
    out = s.select(F.lit("sample").alias("section"), F.col("lang").alias("stratum"), F.col("place").cast("int").alias("place"), F.col("doc_id").alias("first"), none.alias("second"), slot.cast("bigint").alias("page_slot"), record_id("pilot", F.concat_ws("|", F.lit("sample"), "place", "doc_id")).alias("pilot_id"))
    for name, pairs in (("linked", greedy_balanced_pairs(spark, d).select("first", "second")), ("control", operations.join_anti_token(spark, d))):
        # A few dozen pairs, in the order of their ids.
        placed = pairs.withColumn("place", F.row_number().over(Window.orderBy("first", "second")))
        out = out.unionByName(placed.select(F.lit(name).alias("section"), F.lit(None).cast("string").alias("stratum"), "place", "first", "second", none.alias("page_slot"), record_id("pilot", F.concat_ws("|", F.lit(name), "place", "first", "second")).alias("pilot_id")))
    return out
