"""Artifacts: strict reads of JSON documents, writes that never clobber, registries and reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.operators import lineage, policy
from attesta.plans.catalog import query
from attesta.sources import evidence, sinks, tables
from attesta.sources.evidence import ctes
from attesta.sources.tables import table


def folder(spark) -> str:
    """A new folder in the shared checkpoint folder."""
    lineage.checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/artifacts-{uuid.uuid4().hex}"


def document(spark, at: str, rows, name: str):
    """One JSON document of a small table, written by Spark: {"<name>": [rows]}."""
    key = rows.columns[0]
    whole = rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias(name)).select(F.to_json(F.struct(name), {"ignoreNullFields": "false"}).alias("value"))
    whole.coalesce(1).write.text(f"{at}/{name}-{key}")
    return f"{at}/{name}-{key}"


NATION = T.ArrayType(T.StructType([T.StructField("n_nationkey", T.LongType()), T.StructField("n_name", T.StringType()), T.StructField("n_regionkey", T.LongType())]))
REGION = T.ArrayType(T.StructType([T.StructField("r_regionkey", T.LongType()), T.StructField("r_name", T.StringType())]))


def _nations(spark, d):
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


@query("scan_json_artifact", "SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def scan_json_artifact(spark, d):
    """One document of a bounded size, by its known schema."""
    at = document(spark, folder(spark), _nations(spark, d), "nations")
    return tables.json_artifact(spark, at, T.StructType([T.StructField("nations", NATION)])).select(F.inline("nations"))


@query("scan_authority_bundle", "SELECT 'nations' AS record_array, CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation UNION ALL SELECT 'regions', CAST(r_regionkey AS BIGINT), r_name FROM region")
def scan_authority_bundle(spark, d):
    """A document of several record arrays, each a table of its own; an array that isn't known is refused."""
    at = folder(spark)
    regions = table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("r_regionkey"), "r_name")
    both = _nations(spark, d).agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("nations")).join(F.broadcast(regions.agg(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("regions"))))
    both.select(F.to_json(F.struct("nations", "regions")).alias("value")).coalesce(1).write.text(at)
    parts = tables.bundle(tables.json_artifact(spark, at, T.StructType([T.StructField("nations", NATION), T.StructField("regions", REGION)])), ["nations", "regions"])
    one = lambda name, key, label: parts[name].select(F.lit(name).alias("record_array"), F.col(key).alias("id"), F.col(label).alias("name"))
    return one("nations", "n_nationkey", "n_name").unionByName(one("regions", "r_regionkey", "r_name"))


@query("scan_pilot_inputs", """SELECT m AS manifest, sha256('{"' || m || '":[' || body || ']}' || chr(10)) AS sha FROM (SELECT 'regions' AS m, string_agg('{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}', ',' ORDER BY r_regionkey) AS body FROM region UNION ALL SELECT 'nations', string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) FROM nation)""")
def scan_pilot_inputs(spark, d):
    """The digest of each input manifest, over its bytes."""
    at = folder(spark)
    document(spark, at, table(spark, d, "region").select("r_regionkey", "r_name"), "regions")
    document(spark, at, table(spark, d, "nation").select("n_nationkey", "n_name"), "nations")
    found = tables.digests(spark, [f"{at}/*/part-*"]).where("length > 0")
    return found.select(F.regexp_extract("path", "/(regions|nations)-[a-z_]+/part-", 1).alias("manifest"), "sha")


@query("sink_no_clobber", "SELECT * FROM (VALUES ('first', 'written'), ('again', 'identical'), ('other', 'refused')) AS t(attempt, outcome)")
def sink_no_clobber(spark, d):
    """A table written where nothing was, met again as it is, and refused over other rows."""
    at, rows = folder(spark), table(spark, d, "customer").select("c_custkey", "c_name")
    out = [("first", sinks.write_once(rows, at)), ("again", sinks.write_once(rows.repartition(3), at))]
    try:
        out.append(("other", sinks.write_once(rows.where("c_custkey > 1"), at)))
    except ValueError:
        out.append(("other", "refused"))
    return spark.createDataFrame(out, "attempt string, outcome string")


@query("sink_atomic_manifest", "SELECT o_orderstatus AS status, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def sink_atomic_manifest(spark, d):
    """A manifest that appears whole or not at all: written under the commit protocol, then read."""
    at = folder(spark)
    sinks.write_new(table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").cast("bigint").alias("keys")), at)
    return spark.read.parquet(at)


@query("sink_markdown_report", """WITH c AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1), l AS (SELECT '| ' || p || ' | ' || n || ' |' AS line, p FROM c) SELECT CAST(row_number() OVER (ORDER BY k, p) AS INTEGER) AS place, line FROM (SELECT 0 AS k, '' AS p, '# Orders' AS line UNION ALL SELECT 1, '', '' UNION ALL SELECT 2, '', '| priority | orders |' UNION ALL SELECT 3, '', '|---|---|' UNION ALL SELECT 4, p, line FROM l)""")
def sink_markdown_report(spark, d):
    """A report of a small histogram, line by line."""
    counts = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("orders"))
    lines = sinks.markdown("Orders", counts).rstrip("\n").split("\n")
    return spark.createDataFrame(list(enumerate(lines, 1)), "place int, line string")


REGISTRY = "WITH r AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 0 THEN 'Bad Name' ELSE 'source-' || s_suppkey END AS source_id, CASE WHEN s_suppkey % 7 = 0 THEN 'http://' ELSE 'https://' END || 's' || s_nationkey || '.example.org/' AS base_url, CASE WHEN s_suppkey % 5 = 0 THEN 'paused' WHEN s_suppkey % 8 = 0 THEN 'strange' ELSE 'active' END AS state FROM supplier)"


def registry(spark, d):
    """A registry's bodies as captured: one JSON record each, some of them not as they should be."""
    k = F.col("s_suppkey")
    name = F.when(k % 9 == 0, "Bad Name").otherwise(F.concat(F.lit("source-"), k))
    url = F.concat(F.when(k % 7 == 0, "http://").otherwise("https://"), F.lit("s"), "s_nationkey", F.lit(".example.org/"))
    state = F.when(k % 5 == 0, "paused").when(k % 8 == 0, "strange").otherwise("active")
    body = F.to_json(F.struct(name.alias("source_id"), url.alias("base_url"), state.alias("state"), F.when(k % 11 == 0, "x").alias("extra")))
    return table(spark, d, "supplier").select(k.alias("k"), body.alias("body"))


@query("scan_registry", REGISTRY + " SELECT k, source_id, array_to_string(list_filter([CASE WHEN k % 11 = 0 THEN 'fields' END, CASE WHEN NOT regexp_matches(source_id, '^[a-z][a-z0-9-]{2,63}$') THEN 'source_id' END, CASE WHEN base_url NOT LIKE 'https://%' THEN 'base_url' END, CASE WHEN state NOT IN ('active', 'paused') THEN 'state' END], lambda x: x IS NOT NULL), ',') AS broken FROM r")
def scan_registry(spark, d):
    """Registry records: exact fields, and each value by its rule."""
    m = F.from_json("body", "map<string,string>")
    rows = registry(spark, d).withColumn("m", m)
    at = lambda n: F.try_element_at("m", F.lit(n))
    rules = [(F.array_sort(F.map_keys("m")) == F.array(*map(F.lit, ("base_url", "source_id", "state"))), "fields"), (at("source_id").rlike("^[a-z][a-z0-9-]{2,63}$"), "source_id"), (at("base_url").startswith("https://"), "base_url"), (at("state").isin("active", "paused"), "state")]
    broken = F.filter(F.array(*(F.when(~policy.closed(ok), F.lit(n)) for ok, n in rules)), lambda x: x.isNotNull())
    return rows.select("k", at("source_id").alias("source_id"), F.array_join(broken, ",").alias("broken"))


@query("scan_governance", ctes("gov_subject", "gov_fact", "gov_observation", "gov_state", "gov_decision") + """, f AS (SELECT subject, count(DISTINCT dimension) AS dims, count(*) AS n FROM gov_fact GROUP BY 1), o AS (SELECT subject, count(*) AS obs FROM gov_observation GROUP BY 1), s AS (SELECT subject, count(DISTINCT operation) AS ops, count(*) FILTER (state = 'approved') AS approved FROM gov_state GROUP BY 1), d AS (SELECT subject, count(*) AS decs, count(*) FILTER (decided_day >= expires_day) AS inverted FROM gov_decision GROUP BY 1)
  SELECT subject, CASE WHEN dims <> 6 OR n <> 6 THEN 'facts_incomplete' WHEN ops <> 12 THEN 'operations_incomplete' WHEN coalesce(inverted, 0) > 0 THEN 'window_inverted' ELSE 'valid' END AS state, coalesce(obs, 0) AS observations, approved FROM gov_subject LEFT JOIN f USING (subject) LEFT JOIN o USING (subject) LEFT JOIN s USING (subject) LEFT JOIN d USING (subject)""")
def scan_governance(spark, d):
    """Governance records as loaded: all dimensions and operations, windows the right way round."""
    subject, fact, observation, state, decision = (evidence.family(spark, d, n) for n in ("gov_subject", "gov_fact", "gov_observation", "gov_state", "gov_decision"))
    c = F.col
    rows = subject.select("subject").join(fact.groupBy("subject").agg(F.count_distinct("dimension").alias("dims"), F.count(F.lit(1)).alias("n")), "subject", "left").join(observation.groupBy("subject").agg(F.count(F.lit(1)).alias("obs")), "subject", "left")
    rows = rows.join(state.groupBy("subject").agg(F.count_distinct("operation").alias("ops"), F.count_if(c("state") == "approved").alias("approved")), "subject", "left").join(decision.groupBy("subject").agg(F.count_if(c("decided_day") >= c("expires_day")).alias("inverted")), "subject", "left")
    verdict = F.when(~policy.closed((c("dims") == 6) & (c("n") == 6)), "facts_incomplete").when(~policy.closed(c("ops") == 12), "operations_incomplete").when(c("inverted") > 0, "window_inverted").otherwise("valid")
    return rows.select("subject", verdict.alias("state"), F.coalesce("obs", F.lit(0)).alias("observations"), "approved")


@query("validate_registry_migration", "WITH a AS (SELECT s_suppkey AS endpoint, 'h' || s_nationkey AS host, s_suppkey % 4 AS source FROM supplier WHERE s_suppkey % 13 <> 0), b AS (SELECT s_suppkey AS endpoint, 'h' || CASE WHEN s_suppkey % 11 = 0 THEN 99 ELSE s_nationkey END AS host, CASE WHEN s_suppkey % 17 = 0 THEN 9 ELSE s_suppkey % 4 END AS source FROM supplier WHERE s_suppkey % 9 <> 0) SELECT coalesce(a.endpoint, b.endpoint) AS endpoint, CASE WHEN b.endpoint IS NULL THEN 'removed' WHEN a.endpoint IS NULL THEN 'added' WHEN a.source <> b.source THEN 'rebound' WHEN a.host <> b.host THEN 'moved' ELSE 'kept' END AS change, b.endpoint IS NOT NULL AND (a.endpoint IS NULL OR (a.source = b.source AND a.host = b.host)) AS compatible FROM a FULL JOIN b ON a.endpoint = b.endpoint")
def validate_registry_migration(spark, d):
    """Two versions of a registry: what is there may stay or be joined by more, but not go, move or change its source."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    a = s.where(k % 13 != 0).select(k.alias("a"), F.concat(F.lit("h"), "s_nationkey").alias("ah"), (k % 4).alias("asrc"))
    b = s.where(k % 9 != 0).select(k.alias("b"), F.concat(F.lit("h"), F.when(k % 11 == 0, 99).otherwise(F.col("s_nationkey"))).alias("bh"), F.when(k % 17 == 0, 9).otherwise(k % 4).alias("bsrc"))
    c = F.col
    change = F.when(c("b").isNull(), "removed").when(c("a").isNull(), "added").when(c("asrc") != c("bsrc"), "rebound").when(c("ah") != c("bh"), "moved").otherwise("kept")
    rows = a.join(b, c("a") == c("b"), "full_outer").select(F.coalesce("a", "b").alias("endpoint"), change.alias("change"))
    return rows.withColumn("compatible", c("change").isin("added", "kept"))
