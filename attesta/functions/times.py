"""Instants: explicit, in UTC, half-open unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = 1767225600  # 2026-01-01T00:00:00Z
ISO = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?(Z|[+-]\d\d:\d\d)$"


def day(n: Column) -> Column:
    """The instant n days after the start of 2026."""
    return F.timestamp_seconds(F.lit(EPOCH) + n.cast("bigint") * 86400)


def at(day_number: int) -> Column:
    return F.timestamp_seconds(F.lit(EPOCH + day_number * 86400))


def parse(c: Column) -> Column:
    """An instant from text that names its zone; else null."""
    return F.when(c.rlike(ISO), F.try_to_timestamp(c))


def text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def valid(begin: Column, end: Column, t: Column) -> Column:
    """begin <= t < end; null bounds are never valid."""
    return F.coalesce((begin <= t) & (t < end), F.lit(False))


def backoff(base: Column, attempt: Column, server: Column, cap: Column) -> Column:
    """Doubling delay, the server's wish if longer, within a cap."""
    return F.least(F.greatest(base * F.pow(F.lit(2.0), attempt - 1), F.coalesce(server, F.lit(0.0))), cap)
