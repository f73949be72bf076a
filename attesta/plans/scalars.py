"""Scalar functions over columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions import hashing, text, times, values
from attesta.plans.catalog import query
from attesta.sources import evidence
from attesta.sources.tables import table


@query("scalar_snippet", r"SELECT doc_id, CASE WHEN length(trim(regexp_replace(text, '\s+', ' ', 'g'))) <= 96 THEN trim(regexp_replace(text, '\s+', ' ', 'g')) ELSE left(trim(regexp_replace(text, '\s+', ' ', 'g')), 96) || '…' END AS snippet FROM documents")
def scalar_snippet(spark, d):
    return table(spark, d, "documents").select("doc_id", text.snippet(F.col("text")).alias("snippet"))


@query("scalar_casefold")
def scalar_casefold(spark, d):
    """Exact folding in Arrow batches: no built-in does it."""
    return table(spark, d, "documents").select("doc_id", F.sha2(text.casefold("text"), 256).alias("folded_sha256"))


@query("scalar_nfkc")
def scalar_nfkc(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.nfkc("text"), 256).alias("nfkc_sha256"), text.is_nfc("text").alias("is_nfc"))


@query("normalize_source_id", r"SELECT p_partkey, regexp_replace(lower(trim(p_type)), '[\s_]+', '-', 'g') AS source_key FROM part")
def normalize_source_id(spark, d):
    return table(spark, d, "part").select("p_partkey", text.source_key(F.col("p_type")).alias("source_key"))


@query("scalar_object_key", "SELECT o_orderkey, 'raw/' || o_custkey || '/' || left(sha256(CAST(o_orderkey AS VARCHAR)), 16) AS object_key, 'raw' AS kind FROM orders")
def scalar_object_key(spark, d):
    key = F.concat_ws("/", F.lit("raw"), "o_custkey", F.left(F.sha2(F.col("o_orderkey").cast("string"), 256), F.lit(16)))
    return table(spark, d, "orders").select("o_orderkey", key.alias("object_key"), F.split_part(key, F.lit("/"), F.lit(1)).alias("kind"))


@query("scalar_value_digest", "SELECT doc_id, sha256(text || chr(10)) AS digest FROM documents")
def scalar_value_digest(spark, d):
    return table(spark, d, "documents").select("doc_id", hashing.value_digest(F.col("text")).alias("digest"))


@query("scalar_canonical_json", """SELECT l_orderkey, l_linenumber, sha256('{"flag":"' || l_returnflag || '","line":' || l_linenumber || ',"note":null,"order":' || l_orderkey || '}' || chr(10)) AS digest FROM lineitem""")
def scalar_canonical_json(spark, d):
    c = F.col
    row = {"order": (c("l_orderkey"), T.LongType()), "line": (c("l_linenumber"), T.IntegerType()), "flag": (c("l_returnflag"), T.StringType()), "note": (F.lit(None).cast("string"), T.StringType())}
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", hashing.value_digest(hashing.canonical_json(row)).alias("digest"))


@query("scalar_utc_text", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events")
def scalar_utc_text(spark, d):
    return table(spark, d, "events").select("event_id", times.text(F.col("ts")).alias("at"))


@query("scalar_iso_parse", "SELECT event_id, event_id % 3 <> 0 AS parsed FROM events")
def scalar_iso_parse(spark, d):
    """Text without a zone isn't an instant."""
    raw = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(times.text(F.col("ts")))
    return table(spark, d, "events").select("event_id", times.parse(raw).isNotNull().alias("parsed"))


@query("scalar_least_expiry", "SELECT o_orderkey, strftime(least(o_orderdate + INTERVAL 30 DAYS, TIMESTAMP '1998-01-01', o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER))), '%Y-%m-%d') AS expires FROM orders")
def scalar_least_expiry(spark, d):
    o = F.col("o_orderdate")
    least = F.least(o + F.make_dt_interval(F.lit(30)), F.lit("1998-01-01").cast("timestamp"), o + F.make_dt_interval((F.col("o_orderkey") % 60).cast("int")))
    return table(spark, d, "orders").select("o_orderkey", F.date_format(least, "yyyy-MM-dd").alias("expires"))


@query("scalar_ceil_pages", "SELECT c_custkey, CAST(ceil(count(o_orderkey) / 10.0) AS BIGINT) AS pages FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def scalar_ceil_pages(spark, d):
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", F.ceil(F.coalesce("n", F.lit(0)) / 10).alias("pages"))


@query("scalar_milli_round", "SELECT s_suppkey, CAST(round_even(1000.0 * (s_suppkey % 17) / 16, 0) AS BIGINT) AS milli FROM supplier")
def scalar_milli_round(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.bround(F.lit(1000.0) * (F.col("s_suppkey") % 17) / 16, 0).cast("bigint").alias("milli"))


@query("scalar_backoff", "SELECT event_id, least(greatest(0.5 * pow(2, event_id % 8), CASE WHEN event_id % 5 = 0 THEN 20.0 ELSE 0.0 END), 32.0) AS delay FROM events")
def scalar_backoff(spark, d):
    n = F.col("event_id")
    return table(spark, d, "events").select("event_id", times.backoff(F.lit(0.5), n % 8 + 1, F.when(n % 5 == 0, 20.0), F.lit(32.0)).alias("delay"))


@query("scalar_remainder", "SELECT s_suppkey, CASE WHEN s_suppkey % 6 <> 0 THEN greatest(30 - s_suppkey, 0) END AS remainder FROM supplier")
def scalar_remainder(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select("s_suppkey", F.when(k % 6 != 0, F.greatest(F.lit(30) - k, F.lit(0))).alias("remainder"))


@query("scalar_identifier", "SELECT doc_id, regexp_matches(source, '^[a-z][a-z0-9]{2,31}$') AS valid FROM documents")
def scalar_identifier(spark, d):
    return table(spark, d, "documents").select("doc_id", F.col("source").rlike("^[a-z][a-z0-9]{2,31}$").alias("valid"))


HOSTS = ["a.example.com", "b.example.com"]


@query("canonicalize_url", """SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'https://xn--bcher-kva.example/p/' || p_partkey WHEN 1 THEN 'https://a.example.com/?q=' || p_partkey ELSE 'http://a.example.com:8080/X/' || p_partkey END AS url FROM part""")
def canonicalize_url(spark, d):
    """Addresses in one form: lower case and ASCII host, no default port, a path at least."""
    k = F.col("p_partkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("HTTPS://Bücher.example:443/p/"), k)).when(k % 3 == 1, F.concat(F.lit("https://A.Example.com?q="), k)).otherwise(F.concat(F.lit("http://a.example.com:8080/X/"), k))
    return table(spark, d, "part").select(k.alias("k"), values.canonical_url(raw).alias("url"))


@query("scalar_secret_like", "SELECT p_partkey AS k, p_partkey % 12 IN (4, 5, 6) AS secret_like FROM part")
def scalar_secret_like(spark, d):
    """Announced credentials, raw ones of known families, and signed tokens by their decoded header."""
    return evidence.family(spark, d, "val_text").select("k", text.secret_like(F.col("t")).alias("secret_like"))


@query("scalar_safe_text", "SELECT p_partkey AS k, p_partkey % 12 IN (0, 4, 5, 6, 7, 9, 11) AS portable FROM part")
def scalar_safe_text(spark, d):
    """Texts of safe characters without absolute or climbing paths."""
    return evidence.family(spark, d, "val_text").select("k", text.portable(F.col("t")).alias("portable"))


@query("scalar_sanitize", """SELECT k, CASE k % 12 WHEN 1 THEN 'see [REDACTED]' WHEN 8 THEN 'write to [REDACTED] now' WHEN 9 THEN 'by [REDACTED]' ELSE t END AS note, '[REDACTED]' AS api_token, 'https://a.example.com/p?x=1&signature=[REDACTED]' AS link, CASE k % 12 WHEN 8 THEN 'write to [REDACTED] now' WHEN 1 THEN 'see [REDACTED]' WHEN 9 THEN 'by [REDACTED]' ELSE t END AS listed, '[REDACTED]' AS hidden FROM (""" + evidence.ctes("val_text") + """ SELECT * FROM val_text)""")
def scalar_sanitize(spark, d):
    """A nested record with private names, signed addresses, paths, mail addresses and accounts masked, at every depth."""
    t = F.col("t")
    link = F.concat(F.lit("https://a.example.com/p?x=1&signature="), F.sha2(t, 256))
    row = F.struct(t.alias("note"), F.struct(F.col("k").cast("string").alias("api_token"), F.array(F.struct(t.alias("text"))).alias("parts"), F.create_map(F.lit("Client Secret"), t, F.lit("link"), link).alias("more")).alias("inner"))
    rows = evidence.family(spark, d, "val_text").select("k", row.alias("r"))
    clean = rows.select("k", text.sanitized(F.col("r"), rows.schema["r"].dataType).alias("r"))
    return clean.select("k", "r.note", "r.inner.api_token", F.col("r.inner.more")["link"].alias("link"), F.col("r.inner.parts")[0]["text"].alias("listed"), F.col("r.inner.more")["Client Secret"].alias("hidden"))


@query("scalar_version", "SELECT n_nationkey, array_to_string([n_nationkey // 10, n_nationkey % 10, 3, 0], '.') AS version, [n_nationkey // 10, n_nationkey % 10, 3, 0] >= [0, 9, 3, 0] AND [n_nationkey // 10, n_nationkey % 10, 3, 0] <= [2, 1, 0, 0] AS within FROM nation")
def scalar_version(spark, d):
    """Versions as numbers, padded, and whether they lie within two bounds: 0.10 is after 0.9."""
    raw = F.concat_ws(".", (F.col("n_nationkey") / 10).cast("int"), F.col("n_nationkey") % 10, F.lit("3"))
    key = text.version_key(raw)
    within = (key >= text.version_key(F.lit("0.9.3"))) & (key <= text.version_key(F.lit("2.1")))
    return table(spark, d, "nation").select("n_nationkey", F.array_join(key.cast("array<string>"), ".").alias("version"), within.alias("within"))


@query("scalar_sorted_unique", """WITH l AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS flags, list(l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey) AS st FROM lineitem GROUP BY 1)
  SELECT l_orderkey, list_sort(list_distinct(flags)) = flags AS sorted_unique, len(list_filter(flags, lambda x: NOT list_contains(['A', 'R'], x))) = 0 AS returned_only, list_has_any(st, ['F']) AS some_filled FROM l""")
def scalar_sorted_unique(spark, d):
    """Arrays that are sets in order, arrays within another, arrays that overlap; an order's lines are few."""
    key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    l = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(key)).alias("x"))
    flags, st = F.transform("x", lambda r: r.l_returnflag), F.transform("x", lambda r: r.l_linestatus)
    return l.select("l_orderkey", values.sorted_unique(flags).alias("sorted_unique"), values.subset(flags, F.array(F.lit("A"), F.lit("R"))).alias("returned_only"), F.arrays_overlap(st, F.array(F.lit("F"))).alias("some_filled"))


@query("scalar_map_contract", "SELECT p_partkey AS k, CASE p_partkey % 7 WHEN 0 THEN 'year' WHEN 1 THEN 'enum' WHEN 2 THEN 'timestamp' WHEN 3 THEN 'duration' WHEN 4 THEN 'url' WHEN 5 THEN 'bounded_text' ELSE 'positive_integer' END AS kind, p_partkey % 2 = 0 AS valid FROM part")
def scalar_map_contract(spark, d):
    """Metadata values against the contract of their declared kind: seven kinds."""
    return evidence.family(spark, d, "val_meta").select("k", "kind", values.of_kind(F.col("kind"), F.col("value"), ["video", "image"]).alias("valid"))


@query("scalar_retry_after", "SELECT event_id, CASE event_id % 6 WHEN 0 THEN CASE WHEN event_id % 900 <= 600 THEN CAST(event_id % 900 AS DOUBLE) END WHEN 3 THEN CASE WHEN event_id % 10 * 60 + 30 <= 600 THEN CAST(event_id % 10 * 60 + 30 AS DOUBLE) END END AS wait FROM events")
def scalar_retry_after(spark, d):
    """Server delays as seconds or HTTP dates; a past, garbled or too long one asks nothing."""
    now = F.lit("2026-06-01 00:00:00").cast("timestamp")
    return evidence.family(spark, d, "val_retry").select("event_id", values.retry_after(F.col("header"), now, 600.0).alias("wait"))
