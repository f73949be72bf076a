"""Runs, quotas, routes, gates and the other records of operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from attesta.functions import text
from attesta.operators import parse, policy, relate, selection, states
from attesta.plans.catalog import query
from attesta.plans.folds import PAGED, UNITS, discovered
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.records import NOW
from attesta.sources.tables import table


def _families(spark, d, *names):
    return [evidence.family(spark, d, n) for n in names]


@query("agg_run_manifest_outcome", ctes("ops_lane", "ops_run") + """, s AS (SELECT run, bool_and(status = 'passed') AS passed, bool_or(status = 'failed') AS failed FROM ops_lane GROUP BY 1)
  SELECT run, outcome, CASE WHEN passed IS NULL THEN 'no_lane' WHEN passed THEN CASE WHEN outcome = 'succeeded' THEN 'consistent' ELSE 'must_succeed' END WHEN failed THEN CASE WHEN outcome = 'failed_closed' THEN 'consistent' ELSE 'must_fail_closed' END WHEN outcome IN ('held_by_billing', 'skipped_not_run', 'blocked_on_human') THEN 'consistent' ELSE 'must_not_claim_success' END AS verdict FROM ops_run LEFT JOIN s USING (run)""")
def agg_run_manifest_outcome(spark, d):
    """Outcomes that run manifests claim against the states of their lanes."""
    lanes, runs = _families(spark, d, "ops_lane", "ops_run")
    c = F.col
    s = lanes.groupBy("run").agg(F.every(c("status") == "passed").alias("passed"), F.some(c("status") == "failed").alias("failed"))
    says = lambda *ok: c("outcome").isin(*ok)
    verdict = F.when(c("passed").isNull(), "no_lane").when(c("passed"), F.when(says("succeeded"), "consistent").otherwise("must_succeed")).when(c("failed"), F.when(says("failed_closed"), "consistent").otherwise("must_fail_closed"))
    verdict = verdict.otherwise(F.when(says("held_by_billing", "skipped_not_run", "blocked_on_human"), "consistent").otherwise("must_not_claim_success"))
    return runs.join(s, "run", "left").select("run", "outcome", verdict.alias("verdict"))


@query("agg_quota", f"""WITH r AS (SELECT *, {UNITS} AS cost, sum({UNITS}) OVER (PARTITION BY user_id ORDER BY event_id) AS used FROM events)
  SELECT user_id, CAST(coalesce(sum(cost) FILTER (used <= 60), 0) AS BIGINT) AS consumed, count(*) FILTER (used <= 60 AND event_type = 'purchase') AS channels_list, count(*) FILTER (used <= 60 AND event_type = 'view') AS videos_list, count(*) FILTER (used <= 60 AND event_type NOT IN ('purchase', 'view')) AS playlist_items_list, count(*) FILTER (used > 60) AS refused FROM r GROUP BY 1""")
def agg_quota(spark, d):
    """Units that each run consumed before its cap stopped it, and calls by method."""
    e = F.col("event_type")
    units = F.when(e == "purchase", 5).when(e == "view", 1).otherwise(2)
    rows = states.running(table(spark, d, "events").withColumn("cost", units), "user_id", "event_id", F.col("cost"), 60)
    n = lambda cond: F.count_if(F.col("within") & cond)
    return rows.groupBy("user_id").agg(F.coalesce(F.sum(F.when(F.col("within"), F.col("cost"))), F.lit(0)).cast("bigint").alias("consumed"), n(e == "purchase").alias("channels_list"), n(e == "view").alias("videos_list"), n(~e.isin("purchase", "view")).alias("playlist_items_list"), F.count_if(~F.col("within")).alias("refused"))


@query("agg_dup_occurrence", ctes("run_page") + ", n AS (SELECT *, row_number() OVER (PARTITION BY run, record ORDER BY page, post) AS nth, row_number() OVER (PARTITION BY run, record, page ORDER BY post) AS here, min(page) OVER (PARTITION BY run, record) AS first_page FROM run_page) SELECT run, page, record, CAST(here - CASE WHEN page = first_page THEN 1 ELSE 0 END AS INTEGER) AS occurrence_index FROM n WHERE nth > 1")
def agg_dup_occurrence(spark, d):
    """Every time that a run sees a record again: the page, and how often on that page."""
    (rows,) = _families(spark, d, "run_page")
    key = Window.partitionBy("run", "record")
    rows = rows.withColumn("nth", F.row_number().over(key.orderBy("page", "post"))).withColumn("here", F.row_number().over(Window.partitionBy("run", "record", "page").orderBy("post"))).withColumn("first_page", F.min("page").over(key))
    return rows.where("nth > 1").select("run", "page", "record", (F.col("here") - F.when(F.col("page") == F.col("first_page"), 1).otherwise(0)).alias("occurrence_index"))


@query("join_blocker_work", ctes("ops_work", "ops_blocker") + " SELECT item, EXISTS (SELECT 1 FROM ops_blocker b WHERE (scope = 'source_id' AND subject = source_id) OR (scope = 'endpoint_id' AND subject = endpoint_id) OR (scope = 'asset_id' AND subject = asset_id) OR (scope = 'lane' AND subject = lane)) AS held FROM ops_work")
def join_blocker_work(spark, d):
    """Queued work that a blocker holds, by the source, endpoint, asset or lane that it is in."""
    return relate.held_work(*_families(spark, d, "ops_work", "ops_blocker"), ["source_id", "endpoint_id", "asset_id", "lane"]).select("item", "held")


@query("join_catalogue_manifest", ctes("cat_record", "cat_presence") + " SELECT c.record_id, c.kind, CASE WHEN c.kind = 'video' THEN CASE WHEN p.status = 'present' THEN 'linked' ELSE 'dropped' END WHEN p.record_id IS NULL OR p.status <> 'present' THEN 'not_bound' WHEN p.objects <> 1 THEN 'object_count' WHEN p.size <> c.size THEN 'size_differs' ELSE 'linked' END AS outcome FROM cat_record c LEFT JOIN cat_presence p USING (record_id)")
def join_catalogue_manifest(spark, d):
    """Catalogue records against the manifest of what is stored: a video without one is dropped, a PDF must bind one object of its size."""
    c, p = _families(spark, d, "cat_record", "cat_presence")
    p = p.select("record_id", "status", "objects", F.col("size").alias("p_size"))
    here = policy.closed(F.col("status") == "present")
    outcome = F.when(F.col("kind") == "video", F.when(here, "linked").otherwise("dropped")).when(~here, "not_bound").when(F.col("objects") != 1, "object_count").when(F.col("p_size") != F.col("size"), "size_differs").otherwise("linked")
    return c.join(p, "record_id", "left").select("record_id", "kind", outcome.alias("outcome"))


_TOKENS = "list_filter(list_sort(list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+'))), lambda t: length(t) > 1)"


def _variants(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("record_id"), F.col("p_brand").alias("source_id"), F.array(text.tokens(F.concat_ws(" ", "p_name", F.concat(F.lit("x"), F.col("p_partkey") % 90))), text.tokens(F.concat_ws(" ", "p_type", F.concat(F.lit("y"), F.col("p_partkey") % 70)))).alias("variants"))


@query("set_multi_label_jaccard", f"""WITH r AS (SELECT p_partkey AS record_id, p_brand AS source_id, [{_TOKENS.format("p_name || ' x' || (p_partkey % 90)")}, {_TOKENS.format("p_type || ' y' || (p_partkey % 70)")}] AS variants FROM part),
  t AS (SELECT DISTINCT record_id, source_id, unnest(flatten(variants)) AS token FROM r), rare AS (SELECT token FROM t GROUP BY 1 HAVING count(*) <= 100), k AS (SELECT t.* FROM t JOIN rare USING (token)),
  c AS (SELECT DISTINCT a.record_id AS first, b.record_id AS second FROM k a JOIN k b ON a.token = b.token AND a.record_id < b.record_id AND a.source_id <> b.source_id), u AS (SELECT record_id, unnest(variants) AS v FROM r)
  SELECT first, second, CAST(round_even(max(1000.0 * len(list_intersect(x.v, y.v)) / len(list_distinct(x.v || y.v))), 0) AS BIGINT) AS similarity_milli FROM c JOIN u x ON x.record_id = first JOIN u y ON y.record_id = second GROUP BY ALL""")
def set_multi_label_jaccard(spark, d):
    """Pairs of records of different sources by the two of their titles that are most alike."""
    return relate.variant_pairs(_variants(spark, d))


@query("set_exact_completion", ctes("pn_target", "pn_removed") + """, e AS (SELECT DISTINCT * FROM pn_target), o AS (SELECT DISTINCT * FROM pn_removed), x AS (SELECT coalesce(e.node, o.node) AS node, coalesce(e.kind, o.kind) AS kind, o.node IS NULL AS missing, e.node IS NULL AS unexpected FROM e FULL JOIN o ON e.node = o.node AND e.kind = o.kind AND e.target = o.target)
  SELECT node, kind, count(*) FILTER (missing) AS missing, count(*) FILTER (unexpected) AS unexpected, count(*) FILTER (missing OR unexpected) = 0 AS exact FROM x GROUP BY 1, 2""")
def set_exact_completion(spark, d):
    """Whether what was found done is just what was asked for, kind by kind."""
    return relate.exact_sets(*_families(spark, d, "pn_target", "pn_removed"), ["node", "kind"], "target")


@query("join_derived_object", ctes("obj_derived", "obj_entry") + """, e AS (SELECT DISTINCT doc_id, source_id, asset_id, transformation_id FROM obj_entry), n AS (SELECT source_id, asset_id, count(DISTINCT doc_id) AS docs FROM e GROUP BY ALL)
  SELECT e.doc_id, e.transformation_id, CASE WHEN docs <> 1 THEN 'asset_ambiguous' WHEN NOT EXISTS (SELECT 1 FROM obj_derived o WHERE o.source_id = e.source_id AND o.asset_id = e.asset_id) THEN 'object_missing' WHEN NOT EXISTS (SELECT 1 FROM obj_derived o WHERE o.source_id = e.source_id AND o.asset_id = e.asset_id AND o.transformation_id = e.transformation_id) THEN 'transformation_unbound' ELSE 'bound' END AS binding FROM e JOIN n USING (source_id, asset_id)""")
def join_derived_object(spark, d):
    """Documents and transformations against derived objects: one document for each asset, and the transformation is the object's."""
    objects, entries = _families(spark, d, "obj_derived", "obj_entry")
    e = entries.select("doc_id", "source_id", "asset_id", "transformation_id").distinct()
    n = e.groupBy("source_id", "asset_id").agg(F.count_distinct("doc_id").alias("docs"))
    at = objects.select("source_id", "asset_id").distinct().withColumn("there", F.lit(True))
    of = objects.select("source_id", "asset_id", "transformation_id").distinct().withColumn("same", F.lit(True))
    rows = e.join(n, ["source_id", "asset_id"]).join(at, ["source_id", "asset_id"], "left").join(of, ["source_id", "asset_id", "transformation_id"], "left")
    binding = F.when(F.col("docs") != 1, "asset_ambiguous").when(F.col("there").isNull(), "object_missing").when(F.col("same").isNull(), "transformation_unbound").otherwise("bound")
    return rows.select("doc_id", "transformation_id", binding.alias("binding"))


@query("qc_derived_confidence", ctes("obj_receipt", "obj_entry") + """, x AS (SELECT e.doc_id, e.entry_id, r.receipt_id IS NOT NULL AS there, coalesce(r.object_kind = 'derived' AND r.verification = 'verified' AND r.transformation_id = e.transformation_id AND r.sha = e.sha, false) AS ok FROM obj_entry e LEFT JOIN obj_receipt r ON r.object_key = e.object_key)
  SELECT doc_id, CASE WHEN NOT bool_and(there) THEN 'unknown' WHEN bool_and(ok) THEN 'pass' ELSE 'fail' END AS state, count(*) FILTER (NOT ok) AS unbound FROM x GROUP BY 1""")
def qc_derived_confidence(spark, d):
    """Documents whose every derived entry is bound by a verified object of its transformation and content."""
    receipts, entries = _families(spark, d, "obj_receipt", "obj_entry")
    r = receipts.select("object_key", "receipt_id", "object_kind", "verification", F.col("transformation_id").alias("t"), F.col("sha").alias("s"))
    c = F.col
    ok = policy.closed((c("object_kind") == "derived") & (c("verification") == "verified") & (c("t") == c("transformation_id")) & (c("s") == c("sha")))
    rows = entries.join(r, "object_key", "left").select("doc_id", c("receipt_id").isNotNull().alias("there"), ok.alias("ok"))
    return rows.groupBy("doc_id").agg(F.when(~F.every("there"), "unknown").when(F.every("ok"), "pass").otherwise("fail").alias("state"), F.count_if(~c("ok")).alias("unbound"))


@query("route_attempt", ctes("att_vm", "att_laptop") + """ SELECT v.attempt, CASE WHEN l.attempt IS NOT NULL AND l.plan <> v.plan THEN 'laptop_receipt_contract_changed' WHEN (v.state = 'complete' OR NOT v.fallback) AND l.attempt IS NOT NULL THEN 'laptop_attempt_not_authorized' WHEN v.state = 'complete' THEN 'complete_on_vm' WHEN NOT v.fallback THEN 'hold_vm_blocker' WHEN l.attempt IS NULL THEN 'queue_trusted_laptop_exact_plan' WHEN l.state = 'complete' THEN 'resume_vm_from_laptop_receipt' ELSE 'hold_laptop_blocker' END AS action FROM att_vm v LEFT JOIN att_laptop l USING (attempt)""")
def route_attempt(spark, d):
    """The one next lane of each attempt that began on the VM; receipts that don't fit together stop it."""
    vm, laptop = _families(spark, d, "att_vm", "att_laptop")
    lap = laptop.select("attempt", F.col("state").alias("l_state"), F.col("plan").alias("l_plan"))
    c = F.col
    there, done = c("l_state").isNotNull(), c("state") == "complete"
    action = policy.first_reason([
        (there & (c("l_plan") != c("plan")), "laptop_receipt_contract_changed"), (there & (done | ~c("fallback")), "laptop_attempt_not_authorized"), (done, "complete_on_vm"), (~c("fallback"), "hold_vm_blocker"),
        (~there, "queue_trusted_laptop_exact_plan"), (c("l_state") == "complete", "resume_vm_from_laptop_receipt"), (F.lit(True), "hold_laptop_blocker"),
    ])
    return vm.join(lap, "attempt", "left").select("attempt", action.alias("action"))


@query("inventory_verdict", PAGED + """, declared AS (SELECT run, CASE WHEN run % 5 = 0 THEN NULL WHEN run % 7 = 2 THEN count(DISTINCT record) + 2 ELSE count(DISTINCT record) END AS total FROM run_page GROUP BY 1)
  SELECT run, CASE WHEN reason IN ('page_bound', 'record_bound') THEN 'bounded_partial' WHEN reason <> 'terminal_page' THEN 'blocked' WHEN total IS NULL OR total <> uniq THEN 'blocked' ELSE 'complete' END AS verdict, CASE WHEN reason <> 'terminal_page' THEN reason WHEN total IS NULL THEN 'declared_total_missing' WHEN total <> uniq THEN 'declared_total_mismatch' ELSE 'terminal_page' END AS reason FROM verdict JOIN declared USING (run)""")
def inventory_verdict(spark, d):
    """Runs whose last page was reached against the total that the endpoint declares: the one isn't the other."""
    v = states.verdicts(discovered(spark, d), "run", "page", 4)
    (pages,) = _families(spark, d, "run_page")
    c = F.col
    total = F.when(c("run") % 5 == 0, F.lit(None)).when(c("run") % 7 == 2, c("n") + 2).otherwise(c("n"))
    declared = pages.groupBy("run").agg(F.count_distinct("record").alias("n")).select("run", total.cast("bigint").alias("total"))
    end = c("stop_reason") == "terminal_page"
    reason = F.when(~end, c("stop_reason")).when(c("total").isNull(), "declared_total_missing").when(c("total") != c("unique"), "declared_total_mismatch").otherwise("terminal_page")
    verdict = F.when(c("stop_reason").isin("page_bound", "record_bound"), "bounded_partial").when(end & policy.closed(c("total") == c("unique")), "complete").otherwise("blocked")
    return v.join(declared, "run").select("run", verdict.alias("verdict"), reason.alias("reason"))


@query("operator_gate", ctes("gate_blocker", "gate_token", "gate_decision") + f""" SELECT b.blocker, CASE WHEN t.blocker IS NULL THEN 'blocked' WHEN t.subject_sha <> b.subject_sha THEN 'token_not_bound' WHEN t.expires_day <= {NOW} THEN 'token_expired' WHEN x.blocker IS NULL THEN 'awaiting_decision' WHEN x.role <> 'role_' || (b.blocker % 4) OR x.role = 'role_3' THEN 'role_not_allowed' WHEN x.decided_day > {NOW} THEN 'decision_not_yet_effective' WHEN x.decision <> 'approved' THEN 'rejected' ELSE 'resumed' END AS gate FROM gate_blocker b LEFT JOIN gate_token t USING (blocker) LEFT JOIN gate_decision x USING (blocker)""")
def operator_gate(spark, d):
    """Blockers through their resume token and the decision on it: bound, current, by an allowed role, approved."""
    b, t, x = _families(spark, d, "gate_blocker", "gate_token", "gate_decision")
    c = F.col
    rows = b.join(t.select("blocker", c("subject_sha").alias("t_sha"), "expires_day"), "blocker", "left").join(x, "blocker", "left")
    gate = policy.first_reason([
        (c("t_sha").isNull(), "blocked"), (c("t_sha") != c("subject_sha"), "token_not_bound"), (c("expires_day") <= NOW, "token_expired"), (c("decision").isNull(), "awaiting_decision"), (~policy.closed(c("role").isin("role_0", "role_1", "role_2")), "role_not_allowed"),
        (c("decided_day") > NOW, "decision_not_yet_effective"), (c("decision") != "approved", "rejected"), (F.lit(True), "resumed"),
    ])
    return rows.select("blocker", gate.alias("gate"))


@query("classify_robots", "SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'robots_denied' WHEN 1 THEN 'robots_allowed' WHEN 3 THEN 'robots_allowed' WHEN 4 THEN 'robots_denied' ELSE 'robots_ambiguous' END AS verdict FROM pages")
def classify_robots(spark, d):
    """Bodies of robots files written by rules, against the pages that they are about."""
    (rows,) = _families(spark, d, "rob_body")
    return rows.select("page_id", parse.robots(F.col("body"), F.col("url")).alias("verdict"))


@query("join_asof_robots", """WITH o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type = 'view'), q AS (SELECT DISTINCT user_id, CAST(json_extract(props, '$.k') AS BIGINT) % 5 AS k FROM events WHERE event_type = 'signup')
  SELECT o.user_id, o.event_id, CASE WHEN ts > TIMESTAMP '2024-01-30' THEN 'observed_later' WHEN ts + INTERVAL 24 HOURS < TIMESTAMP '2024-01-30' THEN 'stale' WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 3 = 0 THEN 'not_allowed' WHEN q.k IS NULL THEN 'request_missing' ELSE 'allowed' END AS verdict FROM o LEFT JOIN q ON q.user_id = o.user_id AND q.k = CAST(json_extract(o.props, '$.k') AS BIGINT) % 5 WHERE r = 1""")
def join_asof_robots(spark, d):
    """The latest observation by sequence, not by time: 24 hours old at most, allowed, and of a request that is on record."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = table(spark, d, "events").withColumn("k", k)
    last = relate.latest(e.where("event_type = 'view'").select("user_id", "event_id", "ts", "k"), ["user_id"], F.col("event_id"))
    asked = e.where("event_type = 'signup'").select(F.col("user_id").alias("u"), (F.col("k") % 5).alias("q")).distinct()
    t = F.lit("2024-01-30").cast("timestamp")
    rows = last.join(asked, (last.user_id == asked.u) & (last.k % 5 == asked.q), "left")
    verdict = F.when(F.col("ts") > t, "observed_later").when(F.col("ts") + F.make_dt_interval(F.lit(1)) < t, "stale").when(F.col("k") % 3 == 0, "not_allowed").when(F.col("q").isNull(), "request_missing").otherwise("allowed")
    return rows.select("user_id", "event_id", verdict.alias("verdict"))


@query("scan_ledger_receipts", ctes("obj_receipt", "obj_manifest") + """ SELECT 'receipt_by_key' AS lookup, receipt_id AS record_id, object_key AS detail FROM obj_receipt WHERE object_key LIKE 'raw/src1/%' UNION ALL SELECT 'receipts_of_asset', receipt_id, object_kind FROM obj_receipt WHERE source_id = 'src2' UNION ALL SELECT 'object_by_sha', receipt_id, sha FROM obj_receipt WHERE left(sha, 1) = 'a' UNION ALL SELECT 'derivation_manifests', manifest_id, effective_decision FROM obj_manifest WHERE source_id = 'src3'""")
def scan_ledger_receipts(spark, d):
    """Lookups of the ledger: receipts by key, of a source's assets, by digest, and manifests; each a filter that a file scan can push."""
    r, m = _families(spark, d, "obj_receipt", "obj_manifest")
    look = lambda df, name, key, detail: df.select(F.lit(name).alias("lookup"), F.col(key).alias("record_id"), F.col(detail).alias("detail"))
    out = look(r.where(F.col("object_key").startswith("raw/src1/")), "receipt_by_key", "receipt_id", "object_key").unionByName(look(r.where("source_id = 'src2'"), "receipts_of_asset", "receipt_id", "object_kind"))
    return out.unionByName(look(r.where(F.col("sha").startswith("a")), "object_by_sha", "receipt_id", "sha")).unionByName(look(m.where("source_id = 'src3'"), "derivation_manifests", "manifest_id", "effective_decision"))


_SAFE = "NOT coalesce(regexp_matches(text, '(?i)(password|passwd|secret|token|api_?key)\\s*[:=]\\s*\\S{8,}') OR regexp_matches(text, 'AKIA[A-Z0-9]{14,}'), false)"


def fixture(spark, d):
    """(record_type, record_id, parent, state) of every safe document as a fixture: source, asset, rights, job, evidence."""
    n = F.col("doc_id")
    safe = table(spark, d, "documents").where(~text.looks_secret(F.col("text"))).select("doc_id", "source")
    row = lambda kind, parent, state: F.struct(F.lit(kind).alias("record_type"), F.concat(F.lit(kind + "_"), n).alias("record_id"), parent.alias("parent"), F.lit(state).alias("state"))
    asset = F.concat(F.lit("asset_"), n)
    rows = safe.select(F.inline(F.array(row("asset", F.col("source"), "discovered"), row("rights", asset, "unknown"), row("job", asset, "queued"), row("evidence", asset, "recorded"))))
    none = F.lit(None).cast("string")
    sources = safe.where("source is not null").select(F.lit("source").alias("record_type"), F.col("source").alias("record_id"), none.alias("parent"), F.lit("registered").alias("state")).distinct()
    return rows.unionByName(sources)


FIXTURE = f"""WITH ok AS (SELECT doc_id, source FROM documents WHERE {_SAFE}), fix AS (SELECT 'asset' AS record_type, 'asset_' || doc_id AS record_id, source AS parent, 'discovered' AS state FROM ok UNION ALL SELECT 'rights', 'rights_' || doc_id, 'asset_' || doc_id, 'unknown' FROM ok UNION ALL SELECT 'job', 'job_' || doc_id, 'asset_' || doc_id, 'queued' FROM ok UNION ALL SELECT 'evidence', 'evidence_' || doc_id, 'asset_' || doc_id, 'recorded' FROM ok UNION ALL SELECT DISTINCT 'source', source, NULL, 'registered' FROM ok WHERE source IS NOT NULL)"""


@query("scan_fixture", FIXTURE + " SELECT * FROM fix")
def scan_fixture(spark, d):
    """A fixture's five kinds of records; what looks like a credential is refused whole."""
    return fixture(spark, d)


@query("agg_fixture_manifest", FIXTURE + " SELECT record_type, state, count(*) AS n, count(DISTINCT parent) AS parents FROM fix GROUP BY 1, 2")
def agg_fixture_manifest(spark, d):
    """Counts of a fixture's records by type and state, and of what they refer to."""
    return fixture(spark, d).groupBy("record_type", "state").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("parent").alias("parents"))


#: Sources whose records are paired as negative controls, and how many pairs of each two.
CONTROLS, CONTROL_PAIRS = [("Brand#11", "Brand#12"), ("Brand#11", "Brand#13"), ("Brand#12", "Brand#13")], 10


def _titles(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("record_id"), F.col("p_brand").alias("source_id"), text.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("tokens"))


@query("join_anti_token")
def join_anti_token(spark, d):
    """Negative controls: pairs of records of two sources without a token in common."""
    pairs = selection.control_pairs(_titles(spark, d), CONTROLS, CONTROL_PAIRS)
    return spark.createDataFrame(pairs, "first bigint, second bigint")
