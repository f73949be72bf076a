"""Fail-closed predicates and reason lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import times


def closed(condition: Column) -> Column:
    """Unknown is no."""
    return F.coalesce(condition, F.lit(False))


def structural(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Conjunction of equalities; None asks nothing. An array column must contain the value."""
    for name, value in wanted.items():
        if value is not None:
            array = df.schema[name].dataType.typeName() == "array"
            df = df.where(F.array_contains(name, value) if array else F.col(name) == value)
    return df


def needs_consent() -> Column:
    return F.col("source_id").startswith("project-native-") | (F.col("origin_class") == "project_native") | (F.col("visibility_class") == "project_private")


def authorised(t: Column) -> Column:
    """A field may be seen under its current policy at t; every clause must hold and be known."""
    private = needs_consent()
    consent = F.when(private, F.col("consent_sha").isNotNull() & (F.col("consent_state") == "approved")).otherwise(F.col("consent_state").isin("approved", "not_required"))
    return closed(
        (F.col("p_document_id") == F.col("document_id"))
        & (F.col("p_rights_sha") == F.col("rights_sha"))
        & F.col("p_consent_sha").eqNullSafe(F.col("consent_sha"))
        & (F.col("rights_state") == "approved")
        & (F.col("retention_state") == "retain")
        & consent
        & ~(private & F.array_contains("allowed_audiences", "public"))
        & times.valid(F.col("decided_at"), F.col("expires_at"), t)
        & (t < F.col("p_evidence_expires_at"))
    )


def evidence_holds(t: Column) -> Column:
    """The edge is as indexed, its evidence began and outlives the policy's."""
    return closed((F.col("edge_sha") == F.col("current_edge_sha")) & (F.col("p_evidence_expires_at") <= F.col("evidence_expires_at")) & (F.col("evidence_at") <= t))


def permits(operation: str, audience: str) -> Column:
    return closed(F.array_contains("allowed_operations", operation) & F.array_contains("allowed_audiences", audience))


def first_reason(rules: Sequence[tuple[Column, str | Column]]) -> Column:
    """The reason of the first rule that fires, in order; null if none does."""
    return F.coalesce(*(F.when(closed(c), r if isinstance(r, Column) else F.lit(r)) for c, r in rules))


def all_reasons(rules: Sequence[tuple[Column, str]]) -> Column:
    """Reasons of all rules that fire, in order; a rule whose condition is unknown fires."""
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(r)) for c, r in rules)), lambda r: r.isNotNull())


def ranked(state: Column, order: Sequence[str]) -> Column:
    """Position of a state in an order of precedence; unknown states come first."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), state), F.lit(0)), F.lit(0))


def worst(state: Column, order: Sequence[str]) -> Column:
    """Aggregate: the state that comes first in the order."""
    return F.element_at(F.array(*map(F.lit, order)), F.greatest(F.min(ranked(state, order)), F.lit(1)).cast("int"))
