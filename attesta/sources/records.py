"""Record families derived from the tables, by rules that SQL can repeat exactly.

`CTES` holds the same rules for DuckDB: each query's twin may start with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.functions import times
from attesta.sources.tables import table

#: The day at which queries are asked.
NOW = 150


def _some(*labels: Column) -> Column:
    """The labels that are there, as an array."""
    return F.filter(F.array(*labels), lambda x: x.isNotNull())


def dimensions(rows: DataFrame) -> Column:
    """array of (dimension, value) of a document or candidate: single labels, and each label of an array."""
    of = {"source": "source_id", "period": "period", "language": "languages", "medium": "mediums", "topic": "topics", "performance_context": "performance_contexts"}
    pair = lambda name: lambda value: F.struct(F.lit(name).alias("dimension"), value.alias("value"))
    parts = []
    for name, c in of.items():
        if c in rows.columns:
            each = F.array(F.col(c)) if rows.schema[c].dataType.typeName() == "string" else F.coalesce(c, F.array().cast("array<string>"))
            parts.append(F.transform(each, pair(name)))
    return F.filter(F.concat(*parts), lambda x: x.value.isNotNull())


def documents(spark: SparkSession, d: str, clusters: bool = False) -> DataFrame:
    """Index documents, with the duplicate cluster of texts held twice where it is asked for.

    Clusters take a shuffle of all digests, which a query that doesn't name them is spared.
    """
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    rows = docs.join(labels, "doc_id", "left").withColumn("text_sha", F.sha2("text", 256))
    n = F.col("doc_id")
    out = rows.select(
        "doc_id", F.concat(F.lit("index_document_"), n).alias("document_id"), F.col("source").alias("source_id"), F.concat(F.lit("asset_"), n % 690).alias("asset_id"), F.col("lang").alias("language"),
        F.when(F.col("n_chars") < 1000, "early").when(F.col("n_chars") < 4000, "middle").otherwise("late").alias("period"),
        F.when(n % 3 == 0, "text").when(n % 3 == 1, "image").otherwise("video").alias("medium"), _some(F.col("lang"), F.when(n % 6 == 0, "mul")).alias("languages"),
        _some(F.when(n % 3 == 0, "text").when(n % 3 == 1, "image").otherwise("video"), F.when(n % 10 == 1, "sound")).alias("mediums"),
        F.when(F.col("quality") == 1, "selected_rich_corpus").when(F.col("quality") == 0, "excluded").otherwise("inventory_only").alias("selection_state"),
        "quality", "toxic", "text", "n_chars", "text_sha",
    )
    if not clusters:
        return out
    copies = out.groupBy("text_sha").agg(F.count(F.lit(1)).alias("copies"))
    cluster = F.when(F.col("copies") > 1, F.concat(F.lit("duplicate_cluster_"), F.left("text_sha", F.lit(24))))
    return out.join(copies, "text_sha").withColumn("cluster_id", cluster).drop("copies")


def fields(docs: DataFrame) -> DataFrame:
    """Three fields of each document: title, language, origin."""
    n = F.col("doc_id")
    one = lambda i, name, value: F.struct(F.lit(i).alias("idx"), F.lit(name).alias("name"), value.alias("value"))
    title = F.left(F.split_part("text", F.lit("\n"), F.lit(1)), F.lit(80))
    rows = docs.select("doc_id", "document_id", "source_id", F.inline(F.array(one(0, "title", title), one(1, "language", F.col("language")), one(2, "origin", F.col("source_id")))))
    return rows.select(
        "doc_id", "document_id", "source_id", "idx", "name", "value", (n * 3 + F.col("idx")).alias("k"), F.concat(F.lit("field_"), "name", F.lit("_"), n).alias("field_id"),
        F.when(n % 11 == 0, "project_native").when(n % 5 == 0, "derived").otherwise("public_source").alias("origin_class"), F.when(n % 13 == 0, "project_private").otherwise("public").alias("visibility_class"),
        F.sha2(F.concat(F.lit("rights_"), n % 50), 256).alias("rights_sha"), F.when((n % 11 == 0) | (n % 13 == 0), F.sha2(F.concat(F.lit("consent_"), n), 256)).alias("consent_sha"),
        F.sha2(F.concat("value", F.lit("\n")), 256).alias("value_sha"),
    )


def policies(flds: DataFrame) -> DataFrame:
    """The current visibility policy of most fields; some have none, some have drifted."""
    k, n = F.col("k"), F.col("doc_id")
    ops = F.when(k % 3 == 0, F.array(F.lit("search_visibility"), F.lit("snippet_render"))).when(k % 3 == 1, F.array(F.lit("search_visibility"), F.lit("score_generation")))
    audiences = F.when(n % 4 == 0, F.array(F.lit("operator"))).when(n % 4 == 1, F.array(F.lit("operator"), F.lit("researcher"))).when(n % 4 == 2, F.array(F.lit("researcher")))
    return flds.where(k % 17 != 3).select(
        F.col("field_id").alias("p_field_id"), F.col("document_id").alias("p_document_id"), F.concat(F.lit("policy_"), k).alias("policy_id"),
        F.when(k % 10 == 7, "blocked").when(k % 10 == 8, "unknown").otherwise("approved").alias("rights_state"),
        F.when(k % 19 == 4, F.sha2(F.lit("drift"), 256)).otherwise(F.col("rights_sha")).alias("p_rights_sha"), F.col("consent_sha").alias("p_consent_sha"),
        F.when(F.col("consent_sha").isNull(), "not_required").when(k % 4 == 0, "revoked").otherwise("approved").alias("consent_state"),
        F.when(k % 23 == 5, "delete").otherwise("retain").alias("retention_state"),
        ops.otherwise(F.array(*map(F.lit, ("search_visibility", "snippet_render", "score_generation", "score_feature_value")))).alias("allowed_operations"),
        audiences.otherwise(F.array(F.lit("public"), F.lit("researcher"))).alias("allowed_audiences"),
        times.day(n % 200).alias("decided_at"), times.day(n % 200 + 120).alias("expires_at"), times.day(n % 200 + 150).alias("p_evidence_expires_at"),
    )


def edges(flds: DataFrame) -> DataFrame:
    """The provenance edge of each field as indexed, and the digest that is current."""
    k, n = F.col("k"), F.col("doc_id")
    return flds.select(
        F.col("field_id").alias("e_field_id"), F.concat(F.lit("edge_"), k).alias("edge_id"), F.col("value_sha").alias("edge_sha"),
        F.when(k % 31 == 7, F.sha2(F.lit("changed"), 256)).otherwise(F.col("value_sha")).alias("current_edge_sha"),
        times.day(n % 200 - 10).alias("evidence_at"), times.day(n % 200 + F.when(k % 29 == 0, 140).otherwise(160)).alias("evidence_expires_at"),
    )


def targets(docs: DataFrame) -> DataFrame:
    """Coverage targets: every observed value of the six dimensions of candidates; a few dozen rows."""
    c = candidates(docs)
    seen = c.select(F.inline(dimensions(c))).distinct()
    rank = F.row_number().over(Window.orderBy("dimension", "value"))
    return seen.withColumn("priority", (rank % 5 + 1).cast("int")).select(F.concat(F.lit("coverage_target_"), "dimension", F.lit("_"), "value").alias("target_id"), "dimension", "value", (F.lit(5) + F.col("priority") * 3).alias("minimum"), "priority")


def candidates(docs: DataFrame) -> DataFrame:
    """Selection candidates: gate states and expiries from the document's number."""
    n = F.col("doc_id")
    gate = lambda m, r: F.when(n % m == r, "unknown").otherwise("approved")
    return docs.select(
        "doc_id", F.concat(F.lit("candidate_"), n).alias("candidate_id"), "document_id", "source_id", "asset_id", "language", "period", "medium", "languages", "mediums",
        F.array(F.concat(F.lit("topic_"), n % 4), F.concat(F.lit("topic_"), n % 3 + 4)).alias("topics"), F.filter(F.array(F.when(n % 2 == 0, "stage"), F.when(n % 5 == 0, "broadcast"), F.when(n % 9 == 0, "score")), lambda x: x.isNotNull()).alias("performance_contexts"), F.sha2(F.concat_ws("|", F.lit("candidate"), n, "source_id"), 256).alias("candidate_sha"), *(["cluster_id"] if "cluster_id" in docs.columns else []), "toxic",
        F.when(n % 41 == 0, "missing").otherwise("observed").alias("inventory_state"), F.when(n % 37 == 0, "restricted").otherwise("available").alias("retrieval_state"),
        gate(29, 1).alias("governance_state"), gate(23, 2).alias("rights_state"), gate(19, 3).alias("retention_state"), F.when(F.col("toxic") == 1, "unknown").otherwise("approved").alias("privacy_state"), gate(31, 4).alias("transformation_state"),
        times.day(n % 400 + 30).alias("governance_expires_at"), times.day(n % 500 + 60).alias("rights_expires_at"), times.day(n % 450 + 140).alias("retention_expires_at"), times.day(n % 470 + 141).alias("privacy_expires_at"), times.day(n % 490 + 142).alias("transformation_expires_at"),
        (n % 43 == 5).alias("pipeline_proof"), (n % 47 == 6).alias("unknown_dimension"),
        F.when(n % 4 == 0, 3).when(n % 4 == 1, 2).otherwise(1).alias("quality_rank"),
    )


def overrides(spark: SparkSession, d: str) -> DataFrame:
    """Review overrides of proof candidates: some stale, some of other content, some not approved."""
    n = F.col("doc_id")
    docs = table(spark, d, "documents").where(n % 43 == 5)
    return docs.where(n % 172 != 5).select(
        F.concat(F.lit("candidate_"), n).alias("candidate_id"), F.when(n % 5 == 0, F.sha2(F.lit("old"), 256)).otherwise(F.sha2(F.concat_ws("|", F.lit("candidate"), n, "source"), 256)).alias("candidate_sha"), F.col("source").alias("source_id"), F.concat(F.lit("asset_"), n % 690).alias("asset_id"),
        F.when(n % 7 == 0, "revoked").otherwise("approved").alias("state"), times.day(n % 155).alias("decided_at"), times.day(n % 200 + 130).alias("expires_at"),
    )


def turns(spark: SparkSession, d: str) -> DataFrame:
    """Lineage edges: each turn of a conversation takes the turn before as its input."""
    c = table(spark, d, "conversations").select("conv_id", "turn")
    node = lambda t: F.concat_ws("_", F.lit("turn"), "conv_id", t)
    before = c.select(F.col("conv_id").alias("c"), (F.col("turn") + 1).alias("t"))
    return c.join(before, (c.conv_id == F.col("c")) & (c.turn == F.col("t"))).select(node(F.col("turn")).alias("node"), node(F.col("turn") - 1).alias("input"), "conv_id", "turn")


CTES = """
WITH RECURSIVE doc0 AS (
  SELECT d.*, l.quality, l.toxic, sha256(d.text) AS text_sha FROM documents d LEFT JOIN labels l USING (doc_id)
), docs AS (
  SELECT doc_id, 'index_document_' || doc_id AS document_id, source AS source_id, 'asset_' || (doc_id % 690) AS asset_id, lang AS language,
    CASE WHEN n_chars < 1000 THEN 'early' WHEN n_chars < 4000 THEN 'middle' ELSE 'late' END AS period,
    CASE doc_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image' ELSE 'video' END AS medium, list_filter([lang, CASE WHEN doc_id % 6 = 0 THEN 'mul' END], lambda x: x IS NOT NULL) AS languages,
    list_filter([CASE doc_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image' ELSE 'video' END, CASE WHEN doc_id % 10 = 1 THEN 'sound' END], lambda x: x IS NOT NULL) AS mediums,
    CASE quality WHEN 1 THEN 'selected_rich_corpus' WHEN 0 THEN 'excluded' ELSE 'inventory_only' END AS selection_state,
    CASE WHEN count(*) OVER (PARTITION BY text_sha) > 1 THEN 'duplicate_cluster_' || left(text_sha, 24) END AS cluster_id, quality, toxic, text, n_chars, text_sha
  FROM doc0
), flds0 AS (
  SELECT doc_id, document_id, source_id, 0 AS idx, 'title' AS name, left(split_part(text, chr(10), 1), 80) AS value FROM docs
  UNION ALL SELECT doc_id, document_id, source_id, 1, 'language', language FROM docs
  UNION ALL SELECT doc_id, document_id, source_id, 2, 'origin', source_id FROM docs
), flds AS (
  SELECT *, doc_id * 3 + idx AS k, 'field_' || name || '_' || doc_id AS field_id,
    CASE WHEN doc_id % 11 = 0 THEN 'project_native' WHEN doc_id % 5 = 0 THEN 'derived' ELSE 'public_source' END AS origin_class,
    CASE WHEN doc_id % 13 = 0 THEN 'project_private' ELSE 'public' END AS visibility_class,
    sha256('rights_' || (doc_id % 50)) AS rights_sha, CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN sha256('consent_' || doc_id) END AS consent_sha,
    sha256(value || chr(10)) AS value_sha FROM flds0
), pols AS (
  SELECT field_id AS p_field_id, document_id AS p_document_id, 'policy_' || k AS policy_id,
    CASE k % 10 WHEN 7 THEN 'blocked' WHEN 8 THEN 'unknown' ELSE 'approved' END AS rights_state,
    CASE WHEN k % 19 = 4 THEN sha256('drift') ELSE rights_sha END AS p_rights_sha, consent_sha AS p_consent_sha,
    CASE WHEN consent_sha IS NULL THEN 'not_required' WHEN k % 4 = 0 THEN 'revoked' ELSE 'approved' END AS consent_state,
    CASE WHEN k % 23 = 5 THEN 'delete' ELSE 'retain' END AS retention_state,
    CASE k % 3 WHEN 0 THEN ['search_visibility', 'snippet_render'] WHEN 1 THEN ['search_visibility', 'score_generation'] ELSE ['search_visibility', 'snippet_render', 'score_generation', 'score_feature_value'] END AS allowed_operations,
    CASE doc_id % 4 WHEN 0 THEN ['operator'] WHEN 1 THEN ['operator', 'researcher'] WHEN 2 THEN ['researcher'] ELSE ['public', 'researcher'] END AS allowed_audiences,
    doc_id % 200 AS decided, doc_id % 200 + 120 AS expires, doc_id % 200 + 150 AS p_evidence_expires FROM flds WHERE k % 17 <> 3
), edgs AS (
  SELECT field_id AS e_field_id, 'edge_' || k AS edge_id, value_sha AS edge_sha, CASE WHEN k % 31 = 7 THEN sha256('changed') ELSE value_sha END AS current_edge_sha,
    doc_id % 200 - 10 AS evidence, doc_id % 200 + CASE WHEN k % 29 = 0 THEN 140 ELSE 160 END AS evidence_expires FROM flds
), auth AS (
  SELECT f.*, p.*, e.*, (origin_class = 'project_native' OR visibility_class = 'project_private' OR source_id LIKE 'project-native-%') AS needs_consent
  FROM flds f JOIN edgs e ON f.field_id = e.e_field_id LEFT JOIN pols p ON f.field_id = p.p_field_id
), granted AS (
  SELECT * FROM auth WHERE coalesce(p_document_id = document_id AND p_rights_sha = rights_sha AND p_consent_sha IS NOT DISTINCT FROM consent_sha AND rights_state = 'approved' AND retention_state = 'retain'
    AND CASE WHEN needs_consent THEN consent_sha IS NOT NULL AND consent_state = 'approved' ELSE consent_state IN ('approved', 'not_required') END
    AND NOT (needs_consent AND list_contains(allowed_audiences, 'public')) AND decided <= 150 AND 150 < expires AND 150 < p_evidence_expires
    AND edge_sha = current_edge_sha AND p_evidence_expires <= evidence_expires AND evidence <= 150, false)
), cands AS (
  SELECT doc_id, 'candidate_' || doc_id AS candidate_id, document_id, source_id, asset_id, language, period, medium, languages, mediums, ['topic_' || (doc_id % 4), 'topic_' || (doc_id % 3 + 4)] AS topics, cluster_id, toxic,
    list_filter([CASE WHEN doc_id % 2 = 0 THEN 'stage' END, CASE WHEN doc_id % 5 = 0 THEN 'broadcast' END, CASE WHEN doc_id % 9 = 0 THEN 'score' END], lambda x: x IS NOT NULL) AS performance_contexts, sha256('candidate|' || doc_id || '|' || source_id) AS candidate_sha,
    CASE WHEN doc_id % 41 = 0 THEN 'missing' ELSE 'observed' END AS inventory_state, CASE WHEN doc_id % 37 = 0 THEN 'restricted' ELSE 'available' END AS retrieval_state,
    CASE WHEN doc_id % 29 = 1 THEN 'unknown' ELSE 'approved' END AS governance_state, CASE WHEN doc_id % 23 = 2 THEN 'unknown' ELSE 'approved' END AS rights_state,
    CASE WHEN doc_id % 19 = 3 THEN 'unknown' ELSE 'approved' END AS retention_state, CASE WHEN toxic = 1 THEN 'unknown' ELSE 'approved' END AS privacy_state, CASE WHEN doc_id % 31 = 4 THEN 'unknown' ELSE 'approved' END AS transformation_state,
    doc_id % 400 + 30 AS governance_expires, doc_id % 500 + 60 AS rights_expires, doc_id % 450 + 140 AS retention_expires, doc_id % 470 + 141 AS privacy_expires, doc_id % 490 + 142 AS transformation_expires, doc_id % 43 = 5 AS pipeline_proof, doc_id % 47 = 6 AS unknown_dimension,
    CASE doc_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS quality_rank FROM docs
), ddims AS (
  SELECT doc_id, 'source' AS dimension, source_id AS value FROM docs WHERE source_id IS NOT NULL UNION ALL SELECT doc_id, 'period', period FROM docs WHERE period IS NOT NULL UNION ALL SELECT doc_id, 'language', unnest(languages) FROM docs UNION ALL SELECT doc_id, 'medium', unnest(mediums) FROM docs
), cdims AS (
  SELECT doc_id, 'candidate_' || doc_id AS candidate_id, dimension, value FROM ddims UNION ALL SELECT doc_id, candidate_id, 'topic', unnest(topics) FROM cands UNION ALL SELECT doc_id, candidate_id, 'performance_context', unnest(performance_contexts) FROM cands
), tgts AS (
  SELECT 'coverage_target_' || dimension || '_' || value AS target_id, dimension, value, 5 + (row_number() OVER (ORDER BY dimension, value) % 5 + 1) * 3 AS minimum, row_number() OVER (ORDER BY dimension, value) % 5 + 1 AS priority FROM (SELECT DISTINCT dimension, value FROM cdims)
), overrides AS (
  SELECT 'candidate_' || doc_id AS candidate_id, CASE WHEN doc_id % 5 = 0 THEN sha256('old') ELSE sha256('candidate|' || doc_id || '|' || source) END AS candidate_sha, source AS source_id, 'asset_' || (doc_id % 690) AS asset_id, CASE WHEN doc_id % 7 = 0 THEN 'revoked' ELSE 'approved' END AS state, doc_id % 155 AS decided, doc_id % 200 + 130 AS expires
  FROM documents WHERE doc_id % 43 = 5 AND doc_id % 172 <> 5
), reasons AS (
  SELECT c.*, CASE WHEN inventory_state <> 'observed' THEN 'inventory_' || inventory_state WHEN retrieval_state <> 'available' THEN 'retrieval_' || retrieval_state
    WHEN governance_state <> 'approved' THEN 'source_governance_not_approved' WHEN rights_state <> 'approved' THEN 'rights_not_approved' WHEN retention_state <> 'approved' THEN 'retention_not_approved'
    WHEN privacy_state <> 'approved' THEN 'privacy_not_approved' WHEN transformation_state <> 'approved' THEN 'transformation_not_approved' WHEN governance_expires <= 150 THEN 'source_governance_expired'
    WHEN rights_expires <= 150 THEN 'rights_expired' WHEN retention_expires <= 150 THEN 'retention_expired' WHEN privacy_expires <= 150 THEN 'privacy_expired' WHEN transformation_expires <= 150 THEN 'transformation_expired'
    WHEN pipeline_proof AND o.candidate_id IS NULL THEN 'proof_requires_review' WHEN unknown_dimension THEN 'metadata_unresolved' END AS reason
  FROM cands c LEFT JOIN overrides o ON o.candidate_id = c.candidate_id AND o.candidate_sha = c.candidate_sha AND o.source_id = c.source_id AND o.asset_id = c.asset_id AND o.state = 'approved' AND decided <= 150 AND 150 < expires
), turns AS (
  SELECT 'turn_' || a.conv_id || '_' || a.turn AS node, 'turn_' || a.conv_id || '_' || (a.turn - 1) AS input, a.conv_id, a.turn FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
)
"""
