"""Stateful operators, as folds over the event log, and their streaming form."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta.operators import relate, states
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.evidence import ctes
from attesta.sources.tables import table


@query("state_latest", "SELECT user_id, arg_max(event_type, event_id) AS state, max(event_id) AS at FROM events GROUP BY 1")
def state_latest(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("state"), F.col("event_id").alias("at"))
    return relate.latest(e, ["user_id"], F.col("at"))


MOVES = {"view": ["click", "view"], "click": ["purchase", "view"], "purchase": ["view"]}


UNITS = "CASE event_type WHEN 'purchase' THEN 5 WHEN 'view' THEN 1 ELSE 2 END"


@query("state_quota", f"SELECT event_id, CAST(sum({UNITS}) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS used, sum({UNITS}) OVER (PARTITION BY user_id ORDER BY event_id) <= 100 AS within FROM events")
def state_quota(spark, d):
    units = F.when(F.col("event_type") == "purchase", 5).when(F.col("event_type") == "view", 1).otherwise(2)
    return states.running(table(spark, d, "events"), "user_id", "event_id", units, 100).select("event_id", "used", "within")


@query("state_rate_limit", "SELECT event_id, CAST(epoch(date_trunc('second', ts)) - epoch(date_trunc('second', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS gap_s FROM events")
def state_rate_limit(spark, d):
    return states.gaps(table(spark, d, "events"), "user_id", "ts", "event_id").select("event_id", "gap_s")


@query("stream_loop_detect", "SELECT event_id, row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k') ORDER BY event_id) > 1 AS looped FROM events")
def stream_loop_detect(spark, d):
    return states.loops(table(spark, d, "events"), "user_id", "event_id", F.get_json_object("props", "$.k")).select("event_id", "looped")


@query("stream_dedup", "SELECT user_id, event_type, min(event_id) AS first_id, count(DISTINCT props) > 1 AS changed FROM events GROUP BY 1, 2")
def stream_dedup(spark, d):
    """The batch form: first occurrence of each record, and whether its payload ever changed."""
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_id"), (F.count_distinct("props") > 1).alias("changed"))


_MOVES = " OR ".join(f"(now = '{a}' AND event_type IN ({', '.join(repr(t) for t in to)}))" for a, to in MOVES.items())


@query("state_asset_fsm", f"""WITH RECURSIVE e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS nth FROM events),
  r(user_id, nth, now, rejected) AS (SELECT DISTINCT user_id, CAST(0 AS BIGINT), 'view', CAST(0 AS BIGINT) FROM events UNION ALL SELECT r.user_id, e.nth, CASE WHEN {_MOVES} THEN event_type ELSE now END, rejected + CASE WHEN {_MOVES} THEN 0 ELSE 1 END FROM r JOIN e ON e.user_id = r.user_id AND e.nth = r.nth + 1)
  SELECT user_id, arg_max(now, nth) AS final, max(rejected) AS rejected FROM r GROUP BY 1""")
def state_asset_fsm(spark, d):
    return states.folded(table(spark, d, "events"), "user_id", "event_id", "event_type", MOVES, "view", stretch=1000)


_HOLDS = "(status = 'leased' AND beat + 172800 > e.at)"
_MINE = f"({_HOLDS} AND owner = e.worker)"


@query("state_job_lease", ctes("lease_op").replace("WITH ", "WITH RECURSIVE ", 1) + f""", o AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY event_id) AS nth FROM lease_op),
  r(job, nth, status, owner, token, beat, rejected) AS (SELECT DISTINCT job, CAST(0 AS BIGINT), 'queued', CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM lease_op UNION ALL
    SELECT r.job, e.nth, CASE WHEN op = 'claim' AND status <> 'complete' AND NOT {_HOLDS} THEN 'leased' WHEN op = 'complete' AND {_MINE} THEN 'complete' WHEN op IN ('fail', 'release') AND {_MINE} THEN 'queued' ELSE status END,
      CASE WHEN op = 'claim' AND status <> 'complete' AND NOT coalesce({_HOLDS}, false) THEN e.worker WHEN op IN ('fail', 'release') AND {_MINE} THEN NULL ELSE owner END, token + CASE WHEN op = 'claim' AND status <> 'complete' AND NOT coalesce({_HOLDS}, false) THEN 1 ELSE 0 END,
      CASE WHEN op = 'claim' AND status <> 'complete' AND NOT coalesce({_HOLDS}, false) THEN e.at WHEN op IN ('fail', 'release') AND {_MINE} THEN NULL WHEN op IN ('heartbeat', 'complete') AND {_MINE} THEN e.at ELSE beat END,
      rejected + CASE WHEN (op = 'claim' AND status <> 'complete' AND NOT coalesce({_HOLDS}, false)) OR (op <> 'claim' AND coalesce({_MINE}, false)) THEN 0 ELSE 1 END FROM r JOIN o e ON e.job = r.job AND e.nth = r.nth + 1)
  SELECT job, arg_max(status, nth) AS status, max_by(owner, nth) FILTER (nth = last) AS owner, max(token) AS token, max(rejected) AS rejected, coalesce(bool_or(nth = last AND status = 'leased' AND beat + 172800 <= 2592000), false) AS expired FROM (SELECT *, max(nth) OVER (PARTITION BY job) AS last FROM r) GROUP BY 1""".replace("NOT (status = 'leased' AND beat + 172800 > e.at) THEN 'leased'", "NOT coalesce((status = 'leased' AND beat + 172800 > e.at), false) THEN 'leased'"))
def state_job_lease(spark, d):
    """Jobs after all operations on their leases: owner, fencing token, rejected operations, and whether the lease lapsed."""
    return states.leases(evidence.family(spark, d, "lease_op"), "job", "event_id", 172_800, 2_592_000)


@query("state_retry", """WITH a AS (SELECT *, coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM events), b AS (SELECT *, row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) AS attempt FROM a),
  c AS (SELECT *, least(greatest(0.5 * pow(2, attempt - 1), CASE WHEN event_id % 5 = 0 THEN 20.0 ELSE 0.0 END), 32.0) AS delay FROM b) SELECT event_id, CAST(attempt AS INTEGER) AS attempt, delay, sum(delay) OVER (PARTITION BY user_id, run ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= 60 AS permitted FROM c""")
def state_retry(spark, d):
    """Attempts since the last success with their delays, the server's own among them, and whether the budget allows them."""
    out = states.retries(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "purchase", F.when(F.col("event_id") % 5 == 0, 20.0), 0.5, 32.0, 60.0)
    return out.select("event_id", "attempt", "delay", "permitted")


@query("stream_idempotent_op", "WITH e AS (SELECT event_id, event_type, user_id % 50 AS operation, CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS request, value FROM events), f AS (SELECT *, first_value(request) OVER w AS bound, first_value(value) OVER w AS stored, row_number() OVER w AS nth FROM e WINDOW w AS (PARTITION BY event_type, operation ORDER BY event_id)) SELECT event_id, CASE WHEN nth = 1 THEN 'stored' WHEN request = bound THEN 'replayed' ELSE 'conflict' END AS outcome, CASE WHEN nth = 1 OR request = bound THEN stored END AS result FROM f")
def stream_idempotent_op(spark, d):
    """An operation id is bound to its first request: a replay gets the stored result, another request is a conflict."""
    e = table(spark, d, "events").select("event_id", "event_type", (F.col("user_id") % 50).alias("operation"), (F.get_json_object("props", "$.k").cast("bigint") % 3).alias("request"), "value")
    # The first of each operation is one aggregate; it goes back to its operation's rows by a join that Spark may split.
    first = e.groupBy("event_type", "operation").agg(F.min(F.struct("event_id", "request", "value")).alias("f"))
    same = F.col("request") == F.col("f.request")
    outcome = F.when(F.col("event_id") == F.col("f.event_id"), "stored").when(same, "replayed").otherwise("conflict")
    return e.join(first, ["event_type", "operation"]).select("event_id", outcome.alias("outcome"), F.when(same, F.col("f.value")).alias("result"))


@query("stream_late_authority", ctes("authority") + """, x AS (SELECT event_id, event_id * 260 AS s, event_id * 260 + CAST(json_extract(props, '$.k') AS BIGINT) * 600 AS e, expires_s FROM events JOIN authority USING (user_id)) SELECT event_id, CASE WHEN expires_s <= s THEN 'expired_before' WHEN expires_s <= e THEN 'voided' ELSE 'held' END AS outcome FROM x""")
def stream_late_authority(spark, d):
    """Requests against their authority: one that expires while a request is under way voids it."""
    e = table(spark, d, "events").select("event_id", "user_id", (F.col("event_id") * 260).alias("s"), (F.col("event_id") * 260 + F.get_json_object("props", "$.k").cast("bigint") * 600).alias("e"))
    rows = e.join(evidence.family(spark, d, "authority"), "user_id")
    return rows.select("event_id", F.when(F.col("expires_s") <= F.col("s"), "expired_before").when(F.col("expires_s") <= F.col("e"), "voided").otherwise("held").alias("outcome"))


@query("stream_reservation", """WITH r AS (SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, ts FROM events WHERE event_type IN ('view', 'signup')), s AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, max(event_id) AS settled FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL)
  SELECT event_id, CASE WHEN settled > event_id THEN 'settled' WHEN ts + INTERVAL 1 DAY <= TIMESTAMP '2024-01-30' THEN 'request_interrupted' ELSE 'in_flight' END AS state FROM r LEFT JOIN s USING (user_id, k)""")
def stream_reservation(spark, d):
    """Requests that were reserved ahead: settled later, stale and so interrupted, or still under way."""
    k = F.get_json_object("props", "$.k").cast("bigint") % 10
    e = table(spark, d, "events").withColumn("k", k)
    settled = e.where(F.col("event_type").isin("click", "purchase")).groupBy("user_id", "k").agg(F.max("event_id").alias("settled"))
    now = F.lit("2024-01-30").cast("timestamp")
    state = F.when(F.col("settled") > F.col("event_id"), "settled").when(F.col("ts") + F.make_dt_interval(F.lit(1)) <= now, "request_interrupted").otherwise("in_flight")
    return e.where(F.col("event_type").isin("view", "signup")).join(settled, ["user_id", "k"], "left").select("event_id", state.alias("state"))


PAGED = ctes("run_page") + """, f AS (SELECT run, page, count(*) AS new FROM (SELECT run, record, min(page) AS page FROM run_page GROUP BY ALL) GROUP BY ALL), p AS (SELECT run, page, count(*) AS records, min(cursor) AS cursor FROM run_page GROUP BY ALL),
  q AS (SELECT p.*, coalesce(new, 0) AS new, row_number() OVER (PARTITION BY run, cursor ORDER BY page) > 1 AS seen FROM p LEFT JOIN f USING (run, page)),
  s AS (SELECT *, row_number() OVER o AS nth, coalesce(sum(records) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS had, bool_or(seen) OVER o AS looped, CAST(sum(new) OVER o AS BIGINT) AS uniq, CAST(sum(records - new) OVER o AS BIGINT) AS dups FROM q WINDOW o AS (PARTITION BY run ORDER BY page)),
  disc AS (SELECT *, nth <= 4 AND had < 14 AND NOT looped AS committed FROM s),
  v AS (SELECT run, count(*) FILTER (committed) AS pages, max(uniq) FILTER (committed) AS uniq, max(dups) FILTER (committed) AS dups, min(page) FILTER (NOT committed) AS held, arg_min(looped, page) FILTER (NOT committed) AS held_loop FROM disc GROUP BY 1),
  verdict AS (SELECT run, pages, uniq, dups, held, CASE WHEN held IS NULL THEN 'terminal_page' WHEN held_loop THEN 'cursor_loop' WHEN pages >= 4 THEN 'page_bound' ELSE 'record_bound' END AS reason FROM v)"""


def discovered(spark, d):
    return states.discovery(evidence.family(spark, d, "run_page"), "run", "page", "record", "cursor", 4, 14)


@query("stream_paged_discovery", PAGED + """ SELECT run, pages, uniq AS "unique", dups AS duplicates, reason AS stop_reason, CASE reason WHEN 'terminal_page' THEN 'complete_for_observed_endpoint' WHEN 'cursor_loop' THEN 'blocked' ELSE 'bounded_partial' END AS state, CASE WHEN reason IN ('page_bound', 'record_bound') THEN held END AS resume_page FROM verdict""")
def stream_paged_discovery(spark, d):
    """Runs over recorded pages under budgets: what was committed, why each stopped, and where it would resume."""
    return states.verdicts(discovered(spark, d), "run", "page", 4)


@query("stream_checkpoint", PAGED + " SELECT run, page AS sequence, uniq AS observed_unique, dups AS duplicate_records, sha256(cursor) AS cursor_sha FROM disc WHERE committed")
def stream_checkpoint(spark, d):
    """The checkpoint that each committed page leaves: counts so far and the digest of its cursor, in one row."""
    return discovered(spark, d).where("committed").select("run", F.col("page").alias("sequence"), F.col("unique").alias("observed_unique"), F.col("duplicates").alias("duplicate_records"), F.sha2("_cursor", 256).alias("cursor_sha"))


@query("stream_conformance", PAGED + " SELECT run, count(*) AS checkpoints, sha256(string_agg(page || '|' || uniq || '|' || dups || '|' || cursor, ',' ORDER BY page)) AS signature FROM disc WHERE committed GROUP BY 1")
def stream_conformance(spark, d):
    """Each run's chain of checkpoints, signed: a replay that conforms gives the same digest. Runs commit a bounded number of pages."""
    c = discovered(spark, d).where("committed").select("run", "page", F.concat_ws("|", F.col("page").cast("string"), F.col("unique").cast("string"), F.col("duplicates").cast("string"), "_cursor").alias("line"))
    chain = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "line"))), lambda x: x.line), ",")
    return c.groupBy("run").agg(F.count(F.lit(1)).alias("checkpoints"), F.sha2(chain, 256).alias("signature"))
