"""Rights-filtered search: authority first, then match, rank, facets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions.text import snippet
from attesta.operators import lineage, policy
from attesta.sources import records

FACETS = ("source_id", "period", "selection_state", "coverage_state", "cluster_id", "languages", "mediums")


def grants(fields: DataFrame, policies: DataFrame, edges: DataFrame) -> DataFrame:
    """Every field with its edge and its policy, if it has one; nothing is filtered yet."""
    return fields.join(edges, fields.field_id == edges.e_field_id).join(policies, fields.field_id == policies.p_field_id, "left")


def visible(granted: DataFrame, t: Column, operation: str, audience: str) -> DataFrame:
    """Fields that the audience may use for the operation at t."""
    return granted.where(policy.authorised(t) & policy.evidence_holds(t) & policy.permits(operation, audience))


def term_match(terms: list[str]) -> Column:
    """All terms in the one field, whose name counts as text; blank terms are dropped."""
    wanted = [t.casefold() for t in terms if t.strip()]
    text = F.lower(F.concat_ws(" ", "name", "value"))
    out = F.lit(bool(wanted))
    for t in wanted:
        out &= text.contains(t)
    return policy.closed(out)


def matched(shown: DataFrame, terms: list[str], *more: Column) -> DataFrame:
    """document_id, match_count, visible_fields and more aggregates; with terms only documents that match."""
    out = shown.withColumn("hit", term_match(terms)).groupBy("document_id").agg(F.count_if("hit").alias("match_count"), F.count(F.lit(1)).alias("visible_fields"), *more)
    return out.where("match_count > 0") if any(t.strip() for t in terms) else out


def rank(results: DataFrame, limit: int | None = None) -> DataFrame:
    """Ranks over all results before the limit; with a limit the sort keeps that many rows only."""
    if limit is not None and limit < 0:
        raise ValueError("a limit is not negative")
    order = (F.col("match_count").desc(), F.col("visible_fields").desc(), F.col("document_id"))
    if limit is None:
        return numbered(results, order, "rank")
    top = results.orderBy(*order).limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def numbered(rows: DataFrame, order: tuple[Column, ...], name: str) -> DataFrame:
    """All rows with their place from 1: sorted by ranges, numbered in each, and moved on by the ranges before.

    What reaches the driver is a count for each range, of which there are as many as shuffle partitions.
    """
    spark = rows.sparkSession
    lineage.checkpoints(spark)
    placed = rows.orderBy(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).checkpoint()
    before, ranges = 0, []
    for p, n in sorted(map(tuple, placed.groupBy("_p").count().collect())):
        ranges.append((p, before))
        before += n
    moved = placed.join(F.broadcast(spark.createDataFrame(ranges, "_p int, _before long")), "_p")
    return moved.withColumn(name, (F.col("_before") + F.col("_i") + 1).cast("int")).drop("_p", "_i", "_before")


def facets(results: DataFrame, names: tuple[str, ...] = FACETS) -> DataFrame:
    """facet, value, n, place over all results: nulls have none, arrays count each label, most first, then by value.

    Of `names`, those that the frame has: a cluster or coverage costs a join that not every query wants.
    """
    none = F.array().cast("array<struct<facet:string,value:string>>")
    pair = lambda n: lambda v: F.struct(F.lit(n).alias("facet"), v.alias("value"))
    parts = []
    for n in (n for n in names if n in results.columns):
        single = results.schema[n].dataType.typeName() == "string"
        parts.append(F.array(pair(n)(F.col(n))) if single else F.coalesce(F.transform(n, pair(n)), none))
    counted = results.select(F.inline(F.concat(*parts))).where("value is not null").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))
    # One row for each label by now.
    return counted.withColumn("place", F.row_number().over(Window.partitionBy("facet").orderBy(F.col("n").desc(), "value")))


def coverage(documents: DataFrame, targets: DataFrame, *more: str) -> DataFrame:
    """doc_id, more, dimension, value and the target's columns: documents or candidates against targets through all dimensions that they have."""
    return documents.select("doc_id", *more, F.inline(records.dimensions(documents))).join(targets, ["dimension", "value"])


def coverage_state(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, coverage_state, target_ids: what a document contributes to; targets are few, so are those of one document."""
    hits = coverage(documents, targets).groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias("target_ids"))
    state = F.when(F.col("target_ids").isNull(), "outside_coverage_targets").when(F.col("selection_state") == "selected_rich_corpus", "selected_contribution").otherwise("unselected_candidate")
    return documents.select("doc_id", "selection_state").join(hits, "doc_id", "left").select("doc_id", state.alias("coverage_state"), "target_ids")


def cluster_members(documents: DataFrame, shown_ids: DataFrame) -> DataFrame:
    """Visible members of each duplicate cluster: no hidden document is named."""
    return documents.where("cluster_id is not null").join(shown_ids, "document_id", "left_semi").select("cluster_id", "document_id")


def snippets(shown: DataFrame) -> DataFrame:
    """field_id, value_length, snippet where the very policy that shows the field grants one."""
    may = policy.closed(F.array_contains("allowed_operations", "snippet_render"))
    return shown.select("field_id", F.length("value").alias("value_length"), F.when(may, snippet(F.col("value"))).alias("snippet"))


def feature_values(shown: DataFrame, longest: int = 128) -> DataFrame:
    """field_id, value where granted; a longer value stops the export."""
    may = policy.closed(F.array_contains("allowed_operations", "score_feature_value"))
    value = F.when(F.length("value") > longest, F.raise_error(F.lit("a feature value is too long")).cast("string")).otherwise(F.col("value"))
    return shown.select("document_id", "field_id", F.when(may, value).alias("feature_value"))


def export(shown: DataFrame, *, sources: list[str] | None = None, limit: int | None = None, longest: int = 128) -> DataFrame:
    """document_id, field_id, feature_value of an export: of some sources only, and of the first `limit` documents by id."""
    if limit is not None and limit < 0:
        raise ValueError("a limit is not negative")
    rows = shown if sources is None else shown.where(F.col("source_id").isin(*sources))
    if limit is not None:
        rows = rows.join(rows.select("document_id").distinct().orderBy("document_id").limit(limit), "document_id", "left_semi")
    return feature_values(rows, longest)


def term_hits(texts: DataFrame, text: str, cases: DataFrame, block: int = 500) -> DataFrame:
    """texts' rows with case_id, for each case whose term occurs in the text, as a substring of both lower-cased.

    cases: (case_id, term), told to all tasks `block` terms at a time; every block reads the texts once.
    """
    spark = texts.sparkSession
    lower = F.lower(F.col(text))
    rows = cases.where("term is not null and term <> ''").select(F.col("case_id"), F.lower("term").alias("term"), F.pmod(F.xxhash64("case_id", "term"), F.lit(1 << 20)).alias("_h"))
    blocks = max(1, -(-rows.count() // block))
    out = None
    for k in range(blocks):
        few = [(r["case_id"], r["term"]) for r in rows.where(F.col("_h") % blocks == k).collect()]
        told = F.broadcast(spark.createDataFrame([(0, few)], f"_k int, _cases array<struct<case_id:{cases.schema['case_id'].dataType.simpleString()},term:string>>"))
        held = texts.withColumn("_t", lower).withColumn("_k", F.lit(0)).join(told, "_k")
        one = held.withColumn("_hit", F.explode(F.filter("_cases", lambda c: F.contains(F.col("_t"), c.term)))).withColumn("case_id", F.col("_hit.case_id")).drop("_t", "_k", "_cases", "_hit")
        out = one if out is None else out.unionByName(one)
    return out
