"""Every query with a DuckDB twin gives the twin's rows on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from attesta.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else str(v) if v is not None else None


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_twin(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    found = duck.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    cols = sorted(df.columns)
    assert sorted(names) == cols
    twin = sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in found.fetchall())
    assert sorted(repr([plain(r[c]) for c in cols]) for r in df.collect()) == twin


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
