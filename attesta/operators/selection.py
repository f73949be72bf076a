"""Greedy weighted cover of coverage targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.operators import policy


def overridden(candidates: DataFrame, overrides: DataFrame, t: Column) -> DataFrame:
    """Candidates with `override`: current, or why their review override counts for nothing."""
    o = overrides.select(*(F.col(c).alias(f"o_{c}") for c in overrides.columns))
    c = F.col
    bound = policy.closed((c("o_candidate_sha") == c("candidate_sha")) & (c("o_source_id") == c("source_id")) & (c("o_asset_id") == c("asset_id")))
    worth = policy.first_reason([
        (c("o_candidate_id").isNull(), "missing"), (~bound, "not_bound"), (~policy.closed(c("o_state") == "approved"), F.coalesce("o_state", F.lit("unknown"))), (~policy.closed(c("o_decided_at") <= t), "not_yet_effective"), (~policy.closed(t < c("o_expires_at")), "expired"), (F.lit(True), "current"),
    ])
    return candidates.join(o, candidates.candidate_id == o.o_candidate_id, "left").withColumn("override", worth).drop(*o.columns)


def compressed(eligible: DataFrame, matches: DataFrame, rounds: int) -> DataFrame:
    """The candidates that the greedy cover could ever pick.

    eligible: (candidate_id, cluster_id, quality_rank); matches: (candidate_id, target_id, minimum);
    rounds: the sum of the targets' minimums, which bounds the picks, as each serves an unmet target.
    Candidates with the same targets and quality are interchangeable but for their ids and clusters.
    A pick takes at most one cluster away, so of each kind the first candidate of each of the first
    `rounds` + 1 clusters in id order suffices; one without a cluster is a cluster of its own.
    """
    kinds = matches.groupBy("candidate_id").agg(F.array_sort(F.collect_set("target_id")).alias("targets"))
    rows = eligible.join(kinds, "candidate_id").withColumn("_own", F.coalesce("cluster_id", "candidate_id"))
    first = rows.groupBy("targets", "quality_rank", "_own").agg(F.min(F.struct("candidate_id", "cluster_id")).alias("c")).select("targets", "quality_rank", "c.*")
    place = F.row_number().over(Window.partitionBy("targets", "quality_rank").orderBy("candidate_id"))
    return first.withColumn("place", place).where(F.col("place") <= rounds + 1).drop("place")


def greedy_cover(candidates: list[dict], targets: list[dict]) -> list[str]:
    """Ids in the order of selection, over a bounded list (see `compressed`).

    Each round takes the candidate with the most urgent unmet target, then the most unmet targets,
    then the best quality, then the least id; the rest of its cluster goes.
    """
    need = {t["target_id"]: t["minimum"] for t in targets}
    urgency = {t["target_id"]: t["priority"] for t in targets}
    left = {c["candidate_id"]: c for c in candidates}
    picked: list[str] = []
    while True:
        best = None
        for c in left.values():
            serves = [t for t in c["targets"] if need.get(t, 0) > 0]
            if serves:
                key = (min(urgency[t] for t in serves), -len(serves), -c["quality_rank"], c["candidate_id"])
                if best is None or key < best[0]:
                    best = (key, c, serves)
        if best is None:
            return picked
        _, chosen, serves = best
        picked.append(chosen["candidate_id"])
        del left[chosen["candidate_id"]]
        if chosen["cluster_id"] is not None:
            left = {k: c for k, c in left.items() if c["cluster_id"] != chosen["cluster_id"]}
        for t in serves:
            need[t] -= 1


def balanced_pairs(pairs: list[dict], count: int) -> list[dict]:
    """The best pair of each pair of sources, then the best of the rest; no member twice.

    pairs: (first, second, source_pair, similarity, key), ranked and bounded by the caller.
    """
    order = sorted(pairs, key=lambda p: (-p["similarity"], p["key"]))
    used: set = set()
    out: list[dict] = []

    def accept(p: dict) -> bool:
        if {p["first"], p["second"]} & used:
            return False
        used.update((p["first"], p["second"]))
        out.append(p)
        return True

    for source_pair in sorted({p["source_pair"] for p in pairs}):
        if len(out) < count:
            any(p["source_pair"] == source_pair and accept(p) for p in order)
    for p in order:
        if len(out) >= count:
            break
        if p not in out:
            accept(p)
    return out


def control_pairs(records: DataFrame, source_pairs: list[tuple[str, str]], count: int, start: int = 64) -> list[tuple]:
    """(first, second): up to `count` pairs of records of each pair of sources that share no token, no record twice.

    records: (record_id, source_id, tokens). In each source records come in the order of a digest of
    source and id; each in turn takes the first of the other source that is free and shares nothing.
    Only the beginning of that order is fetched. Where a record finds no partner in it although there
    are more, twice as many are fetched and the pair of sources is begun anew, so the pairs are those
    of the whole order.
    """
    ordered = records.withColumn("_h", F.sha2(F.concat_ws("|", "source_id", F.col("record_id").cast("string")), 256))
    sizes = {r["source_id"]: r["count"] for r in ordered.where(F.col("source_id").isin(*{s for p in source_pairs for s in p})).groupBy("source_id").count().collect()}
    held: dict[str, list] = {}

    def first(source: str, n: int) -> list:
        if len(held.get(source, ())) < min(n, sizes.get(source, 0)):
            held[source] = ordered.where(F.col("source_id") == source).orderBy("_h", "record_id").limit(n).collect()
        return held.get(source, [])[:n]

    out = []
    for a, b in source_pairs:
        n = start
        while True:
            left, right = first(a, n), first(b, n)
            used, pairs, short = set(), [], False
            for x in left:
                if len(pairs) == count:
                    break
                partner = next((y for y in right if y["record_id"] not in used and not set(x["tokens"]) & set(y["tokens"])), None)
                if partner is not None:
                    used.add(partner["record_id"])
                    pairs.append((x["record_id"], partner["record_id"]))
                elif len(right) < sizes.get(b, 0):
                    short = True
                    break
            if short or (len(pairs) < count and len(left) < sizes.get(a, 0)):
                n *= 2
                continue
            out += pairs
            break
    return out
