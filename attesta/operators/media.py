"""Derived media: admission of a transformation, conflicts of its results, and what its facts must add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.operators import policy

# Retrieval decisions from open to closed, and the classes that a derivative may be retained under.
RETRIEVAL = ("approved", "metadata_only", "blocked")
DERIVED_CLASSES = ("project_native_expiring", "selected_derived")


def version(text: Column) -> Column:
    """Up to four numbers, padded with zeros, that compare in order; a suffix after - or + is left out."""
    parts = F.transform(F.split(F.regexp_extract(text, r"^[0-9]+(?:\.[0-9]+)*", 0), r"\."), lambda p: p.cast("int"))
    return F.slice(F.concat(parts, F.array_repeat(F.lit(0), 4)), 1, 4)


def _unless(ok: Column, reason: str) -> Column:
    return F.when(~policy.closed(ok), F.lit(reason))


def _sorted(rules: list[Column]) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.array(*rules), lambda r: r.isNotNull())))


def admission(requests: DataFrame, profiles: DataFrame, receipts: DataFrame, rights: DataFrame, authorities: DataFrame, tombstones: DataFrame, t: Column) -> DataFrame:
    """doc_id, operation, reasons (sorted), eligible of each requested transformation; nothing that is missing admits.

    profiles: one row for each kind of transformation, known by p; a handful, so they are broadcast.
    """
    d = rights.select("doc_id", F.col("state").alias("r_state"), "eligible", F.col("expires_day").alias("r_expires"), "derivative_policy", "r_asset_id", "governance_day", F.lit(True).alias("r_there"))
    a = authorities.select("doc_id", "a_asset_id", "legal_hold", F.col("expires_day").alias("a_expires"), "valid_until_day")
    gone = tombstones.select("doc_id", F.col("object_key").alias("t_key"), F.col("sha").alias("t_sha"))
    p = profiles.select(*(F.col(c).alias(f"p_{c}" if c != "p" else c) for c in profiles.columns))
    rows = requests.join(F.broadcast(p), "p").join(receipts, "doc_id", "left").join(d, "doc_id", "left").join(a, "doc_id", "left").join(gone, "doc_id", "left")
    c = F.col
    there = c("r_there").isNotNull()
    strictest = F.greatest(policy.ranked(c("decision"), RETRIEVAL), policy.ranked(c("p_most_decision"), RETRIEVAL))
    reasons = _sorted([
        _unless(F.array_contains("p_tool_ids", c("tool_id")), "profile:tool_not_allowed"), _unless(F.array_contains("p_tool_classes", c("tool_class")), "profile:tool_class_not_allowed"),
        F.when(version(c("tool_version")) < version(c("p_least_version")), "profile:tool_version_below_minimum"), F.when(version(c("tool_version")) > version(c("p_most_version")), "profile:tool_version_above_maximum"),
        _unless(F.array_contains("p_media_types", c("media_type")), "profile:media_type_not_allowed"), F.when(c("language_hint").isNull(), "profile:language_hint_required").when(~F.array_contains("p_languages", c("language_hint")), "profile:language_not_supported"),
        F.when((c("consent_state") != "granted") & c("q_source_id").startswith("project-native-"), "consent:required"), F.when(c("consent_state") == "withdrawn", "consent:withdrawn"),
        F.when(~there, "rights:decision_missing"), F.when(there, _unless(c("eligible") & (c("r_state") == "approved"), "rights:not_eligible")), F.when(there, _unless(c("r_expires") > t, "rights:decision_expired")),
        F.when(there, _unless(c("derivative_policy") == "operation_specific", "rights:derivative_prohibited")), F.when(there, _unless(c("r_asset_id") == c("asset_id"), "rights:asset_mismatch")), F.when(there, _unless(c("governance_day") > t, "rights:governance_expired")),
        _unless(c("object_kind") == "raw", "input:not_raw_object"), _unless(c("verification") == "verified", "input:not_verified"), _unless(c("byte_size") <= c("p_most_bytes"), "bounds:input_too_large"),
        _unless((strictest > 0) & (strictest < len(RETRIEVAL)), "retrieval:blocked"), _unless(c("a_asset_id") == c("asset_id"), "retention:authority_mismatch"), _unless(~c("legal_hold"), "retention:legal_hold"), _unless(c("a_expires") > t, "retention:expired"),
        _unless(c("valid_until_day") > t, "retention:authority_stale"), _unless(c("p_retention_class").isin(*DERIVED_CLASSES), "retention:class_not_derived"),
        F.when(c("t_key").isNotNull() & ~policy.closed((c("t_key") == c("object_key")) & (c("t_sha") == c("sha"))), "deletion:authority_key_mismatch").when(c("t_key").isNotNull(), "deletion:input_tombstoned"),
    ])
    out = rows.select("doc_id", c("p_operation").alias("operation"), "p", "tool_id", "tool_version", "object_key", "sha", reasons.alias("reasons"))
    return out.withColumn("eligible", F.size("reasons") == 0)


def conflicts(jobs: DataFrame, profiles: DataFrame, results: DataFrame, signature: list[str]) -> DataFrame:
    """doc_id, duplicates (other jobs with the same signature), conflicts (sorted) of each job.

    jobs: (doc_id, p, tool_id, tool_class, tool_version, media_type, language_hint, decision,
    signature columns). Duplicates are counted for each signature; no pair of jobs is made.
    """
    p = F.broadcast(profiles.select(*(F.col(c).alias(f"p_{c}" if c != "p" else c) for c in profiles.columns)))
    c = F.col
    with_profile = jobs.join(p, "p")
    within = lambda v: (version(v) >= version(c("p_least_version"))) & (version(v) <= version(c("p_most_version")))
    r = results.select("doc_id", "output_key", "confidence", "detected", c("tool_version").alias("used"))
    seen = with_profile.select("doc_id", "tool_version", "p_least_version", "p_most_version", "p_languages", "p_least_confidence").join(r, "doc_id")
    found = seen.groupBy("doc_id").agg(
        F.max(c("confidence") < c("p_least_confidence")).alias("low"), F.max(~policy.closed(F.array_contains("p_languages", c("detected")))).alias("foreign"),
        F.max(~policy.closed((c("used") == c("tool_version")) & within(c("used")))).alias("drift"), (F.min("output_key") != F.max("output_key")).alias("several"),
    )
    same = jobs.groupBy(*signature).agg((F.count(F.lit(1)) - 1).alias("duplicates"))
    rows = with_profile.join(found, "doc_id", "left").join(same, signature)
    rank = lambda x: policy.ranked(x, RETRIEVAL)
    listed = _sorted([
        _unless(F.array_contains("p_tool_ids", c("tool_id")) & F.array_contains("p_tool_classes", c("tool_class")), "tool_not_allowed"), F.when(~policy.closed(within(c("tool_version"))) | F.coalesce("drift", F.lit(False)), "tool_version_drift"),
        _unless(F.array_contains("p_media_types", c("media_type")), "media_type_not_allowed"), F.when(rank(c("decision")) < rank(c("p_most_decision")), "retrieval_decision_too_permissive"),
        F.when((c("language_hint").isNotNull() & ~policy.closed(F.array_contains("p_languages", c("language_hint")))) | F.coalesce("foreign", F.lit(False)), "unsupported_language"),
        F.when(c("duplicates") > 0, "duplicate_transformation"), F.when(F.coalesce("low", F.lit(False)), "low_confidence"), F.when(F.coalesce("several", F.lit(False)), "conflicting_output_receipt"),
    ])
    return rows.select("doc_id", "duplicates", listed.alias("conflicts"))


def result_facts(headers: DataFrame, elements: DataFrame) -> DataFrame:
    """result, violated (sorted): where a result's header disagrees with its pages, segments or observations.

    kind 0: pages (words, lines); 1: transcript segments (count, words, time); 2: video observations
    (count, shots, events, time, no span twice). Counts and sums say most of it before the shuffle;
    only the order in time of a transcript's segments takes a window, over one result each.
    """
    c = F.col
    sums = elements.groupBy("result").agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high"), F.count_distinct("idx").alias("places"), F.sum("words").alias("s_words"), F.sum("lines").alias("s_lines"), F.count_if(c("observation") == "shot").alias("s_shots"),
        F.count_if(c("observation") == "event").alias("s_events"), F.max(c("start_ms") >= c("end_ms")).alias("still"), F.max("end_ms").alias("last"), F.count_distinct("observation", "start_ms", "end_ms").alias("spans"),
    )
    before = F.max("end_ms").over(Window.partitionBy("result").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
    overlap = elements.where("kind = 1").select("result", (c("start_ms") < F.coalesce(before, F.lit(0))).alias("o")).groupBy("result").agg(F.max("o").alias("overlap"))
    rows = headers.join(sums, "result", "left").join(overlap, "result", "left")
    kind = lambda *ks: c("kind").isin(*ks)
    listed = _sorted([
        _unless((c("low") == 0) & (c("high") == c("n") - 1) & (c("places") == c("n")), "not_contiguous"), F.when(kind(0, 1), _unless(c("words") == c("s_words"), "words_disagree")), F.when(kind(0), _unless(c("lines") == c("s_lines"), "lines_disagree")),
        F.when(kind(1, 2), _unless(c("elements") == c("n"), "count_disagrees")), F.when(kind(2), _unless(c("shots") == c("s_shots"), "shots_disagree")), F.when(kind(2), _unless(c("events") == c("s_events"), "events_disagree")),
        F.when(kind(1, 2), _unless(~c("still"), "does_not_advance")), F.when(kind(1, 2), _unless(c("last") <= c("duration_ms"), "outside_the_media")), F.when(kind(1), _unless(~c("overlap"), "segments_overlap")), F.when(kind(2), _unless(c("spans") == c("n"), "span_repeated")),
    ])
    return rows.select("result", listed.alias("violated"))


def span_breaks(elements: DataFrame, headers: DataFrame) -> DataFrame:
    """result, idx, broken: segments that begin before the one before ends, don't advance, or leave the media.

    Segments of the same idx stand in the order of time, so that the outcome is one, however rows come in.
    """
    order = Window.partitionBy("result").orderBy("idx", "start_ms", "end_ms")
    rows = elements.select("result", "idx", "start_ms", "end_ms").withColumn("before", F.coalesce(F.lag("end_ms").over(order), F.lit(0))).withColumn("nth", F.row_number().over(order) - 1)
    rows = rows.join(headers.select("result", "duration_ms"), "result", "left")
    c = F.col
    broken = policy.first_reason([(c("nth") != c("idx"), "not_contiguous"), (c("start_ms") >= c("end_ms"), "does_not_advance"), (c("start_ms") < c("before"), "overlaps"), (~policy.closed(c("end_ms") <= c("duration_ms")), "outside_the_media")])
    return rows.select("result", "idx", broken.alias("broken")).where("broken is not null")
