"""Digests and canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_digest(c: Column) -> Column:
    """SHA-256 of a text and a line feed."""
    return F.sha2(F.concat(c, F.lit("\n")), 256)


def _sorted(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*(_sorted(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _sorted(x, kind.elementType))
    return c


def canonical_json(columns: dict[str, tuple[Column, T.DataType]]) -> Column:
    """JSON with keys in order at every level, nulls kept, no white space."""
    row = F.struct(*(_sorted(c, kind).alias(name) for name, (c, kind) in sorted(columns.items())))
    return F.to_json(row, {"ignoreNullFields": "false"})


def record_id(prefix: str, payload: Column) -> Column:
    """prefix_ and the first 24 hex digits of the payload's digest."""
    return F.concat(F.lit(prefix + "_"), F.left(value_digest(payload), F.lit(24)))


def mod_of_hex(digest: Column, modulus: Column) -> Column:
    """A hex digest of any length as an integer, modulo a small number, digit by digit."""
    digits = F.transform(F.split(digest, ""), lambda x: F.coalesce(F.conv(x, 16, 10).cast("bigint"), F.lit(0).cast("bigint")))
    return F.aggregate(digits, F.lit(0).cast("bigint"), lambda acc, x: F.pmod(acc * 16 + x, modulus))
