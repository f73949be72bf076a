"""All queries over the reference's own operators, by the operator's id."""

from __future__ import annotations

from attesta.plans import aggregates, artifacts, captures, decisions, folds, governance, integrity, joins, lineage, media, objects, operations, parsing, qualification, scalars, search  # noqa: F401
from attesta.plans.catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
