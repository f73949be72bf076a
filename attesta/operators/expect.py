"""Expectations: frames of violations that must be empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def violations(df: DataFrame, key: str, rules: Sequence[tuple[Column, str]]) -> DataFrame:
    """key, violated: a row for each rule that doesn't hold; unknown doesn't hold."""
    broken = F.filter(F.array(*(F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in rules)), lambda x: x.isNotNull())
    return df.select(key, F.explode(broken).alias("violated"))


def require_empty(found: DataFrame, message: str) -> None:
    """Raise with a few examples if there is a violation."""
    few = found.limit(5).collect()
    if few:
        raise ValueError(f"{message}: {[r.asDict() for r in few]}")


def contiguous(df: DataFrame, keys: list[str], index: str, first: int = 1) -> DataFrame:
    """Groups whose indexes aren't first, first + 1, ... : counts and extremes say it without a sort."""
    n, low, high = F.count(F.lit(1)), F.min(index), F.max(index)
    return df.groupBy(*keys).agg(((low == first) & (high == n + first - 1) & (F.count_distinct(index) == n)).alias("contiguous"))
