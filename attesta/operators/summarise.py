"""Aggregates whose null and precedence rules matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def strict_sum(c: Column) -> Column:
    """The sum if every value is known, else unknown."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def listed(c: Column, most: int | None = None) -> Column:
    """Distinct values in order, comma-joined, the first `most` of them."""
    values = F.array_sort(F.collect_set(c))
    return F.array_join(values if most is None else F.slice(values, 1, most), ",")


def shortfall(minimum: Column, have: Column) -> Column:
    return F.greatest(F.lit(0), minimum - have)


def gap_state(short: Column, blocked: Column, unavailable: Column, unresolved: Column) -> Column:
    """met > blocked > unavailable > unresolved > underrepresented."""
    return F.when(short == 0, "met").when(blocked > 0, "blocked").when(unavailable > 0, "unavailable").when(unresolved > 0, "unresolved").otherwise("underrepresented")


def occurrences(df: DataFrame, keys: list[str]) -> DataFrame:
    """key columns, total: how often each key occurs beyond its first time."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("duplicates"))


def first_refs(findings: DataFrame, keys: list[str], ref: str, most: int = 64) -> DataFrame:
    """keys, refs (the first `most` distinct ones in order, comma-joined), n (all distinct ones), truncated.

    Only the first of each group are gathered: ranks drop the rest before they are shuffled.
    """
    distinct = findings.select(*keys, ref).distinct()
    n = distinct.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(ref))
    few = distinct.withColumn("_p", place).where(F.col("_p") <= most).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(ref)), ",").alias("refs"))
    return n.join(few, keys).withColumn("truncated", F.col("n") > most)


def progress(assets: DataFrame, jobs: DataFrame, leases: DataFrame, evidence: DataFrame, t: Column) -> DataFrame:
    """section, key, n: assets by state, jobs by retry state, leases held or lapsed, evidence links, and what is to be done next.

    assets: (state); jobs: (retry_state); leases: (expires_day, released, reason); evidence: (link).
    """
    c = F.col
    count = lambda df, section, key: df.groupBy(key.cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(section).alias("section"), "key", "n")
    lease = F.when(~c("released"), F.when(c("expires_day") <= t, "expired").otherwise("active")).when(c("reason") == "expired", "expired")
    held = leases.withColumn("_l", lease).where("_l is not null")
    rows = count(assets, "state", c("state")).unionByName(count(jobs, "retry", c("retry_state"))).unionByName(count(held, "lease", c("_l"))).unionByName(count(evidence, "evidence", c("link")))
    has = lambda section, key=None: F.max(((c("section") == section) & (F.lit(True) if key is None else c("key") == key)).cast("int")) == 1
    open_jobs = F.max(((c("section") == "retry") & (c("key") != "exhausted")).cast("int")) == 1
    unfinished = F.max(((c("section") == "state") & (c("key") != "indexed")).cast("int")) == 1
    action = F.when(has("state", "blocked"), "resolve current blockers").when(has("lease", "active"), "allow active leases to finish or checkpoint").when(open_jobs, "claim the next capability-compatible job")
    action = action.when(has("state") & ~unfinished, "no action; all assets are indexed").when(has("state"), "advance the earliest asset through its next verified gate").otherwise("discover a source and create the first asset")
    # A handful of rows beside the links, which the decision doesn't look at.
    small = rows.where("section <> 'evidence'").agg(action.alias("key")).select(F.lit("next_action").alias("section"), "key", F.lit(1).cast("bigint").alias("n"))
    return rows.unionByName(small)
