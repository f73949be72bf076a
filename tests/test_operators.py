"""Operators on small fixtures: null rules, determinism, no leaks, brute force."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from attesta.functions import hashing, text, times
from attesta.operators import expect, lineage, policy, relate, search, selection, states, summarise
from attesta.plans import search as plans
from attesta.sources import records, sinks, tables


def test_unknown_is_not_visible(spark):
    df = spark.createDataFrame([(["a", None],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(policy.closed(F.array_contains("x", "b"))).collect()] == [False, False]


def test_half_open_validity(spark):
    df = spark.range(3).select(times.valid(times.day(F.lit(0)), times.day(F.lit(2)), times.day(F.col("id"))).alias("v"))
    assert [r.v for r in df.collect()] == [True, True, False]


def test_first_reason_is_ordered(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (None, None)], "a int, b int")
    got = df.select(policy.first_reason([(F.col("a") == 2, "two"), (F.col("b") == 5, "five")]).alias("r"), policy.all_reasons([(F.col("a") == 2, "two")]).alias("all")).collect()
    assert [r.r for r in got] == [None, "two", None]
    assert [r["all"] for r in got] == [[], ["two"], ["two"]]


def test_hidden_rows_change_nothing(spark, sf):
    """Facets over all rows equal those over the visible documents alone."""
    docs = records.documents(spark, sf)
    shown = plans.shown(spark, sf, docs=docs)
    with_hidden = search.facets(docs.join(shown, "document_id", "left_semi"))
    alone = docs.join(shown, "document_id", "left_semi")
    flds = records.fields(alone)
    again = search.visible(search.grants(flds, records.policies(flds), records.edges(flds)), plans.now(), "search_visibility", "researcher")
    assert sorted(map(tuple, search.facets(alone.join(again, "document_id", "left_semi")).collect())) == sorted(map(tuple, with_hidden.collect()))


def test_same_rows_for_any_partitioning(spark, sf):
    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(tuple, plans.rank_search(spark, sf).collect()))

    a, b = rows("3"), rows("7")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_terms(spark):
    df = spark.createDataFrame([("title", "The Sea"), ("title", None), ("note", "sea")], "name string, value string")
    hit = lambda *t: [r[0] for r in df.select(search.term_match(list(t))).collect()]
    assert hit("SEA", "title") == [True, False, False]
    assert hit(" ") == [False, False, False]


def test_limits(spark):
    df = spark.createDataFrame([("a", 1, 3), ("b", 2, 1), ("c", 1, 4)], "document_id string, match_count int, visible_fields int")
    assert [r.document_id for r in search.rank(df).orderBy("rank").collect()] == ["b", "c", "a"]
    assert search.rank(df, 0).count() == 0
    with pytest.raises(ValueError):
        search.rank(df, -1)


def test_long_feature_value_stops_the_export(spark):
    df = spark.createDataFrame([("d", "f", "x" * 129, ["score_feature_value"])], "document_id string, field_id string, value string, allowed_operations array<string>")
    with pytest.raises(Exception, match="too long"):
        search.feature_values(df).collect()


def test_exports_have_a_scope_and_a_limit(spark):
    rows = [(f"d{i}", "s1" if i % 2 else "s2", f"f{i}{k}", "v", ["score_feature_value"]) for i in range(4) for k in range(2)]
    df = spark.createDataFrame(rows, "document_id string, source_id string, field_id string, value string, allowed_operations array<string>")
    assert sorted({r.document_id for r in search.export(df, sources=["s1"]).collect()}) == ["d1", "d3"]
    assert sorted({r.document_id for r in search.export(df, limit=3).collect()}) == ["d0", "d1", "d2"] and search.export(df, limit=0).count() == 0
    with pytest.raises(ValueError):
        search.export(df, limit=-1)


def test_text_functions(spark):
    df = spark.createDataFrame([("Straße  ΣΑΣ　x",)], "t string")
    r = df.select(text.casefold("t").alias("c"), text.collapse(F.col("t")).alias("w"), text.nfkc(F.lit("ﬁ")).alias("n"), text.snippet(F.lit("a" * 97)).alias("s")).first()
    assert r.c == "Straße  ΣΑΣ　x".casefold() and r.w == "Straße ΣΑΣ x" and r.n == "fi" and r.s == "a" * 96 + "…"


def test_digest_modulus(spark):
    d = hashlib.sha256(b"asset").hexdigest()
    got = spark.range(1, 50).select("id", hashing.mod_of_hex(F.lit(d), F.col("id")).alias("m")).collect()
    assert all(r.m == int(d, 16) % r.id for r in got)


def test_strict_sum(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None)], "k string, v int")
    assert dict(df.groupBy("k").agg(summarise.strict_sum(F.col("v")).alias("s")).collect()) == {"a": 3, "b": None}


def test_current_equals_is_null_safe(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (4, "z")], "k int, h string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "n")], "k int, h string")
    assert sorted(r.k for r in relate.current_equals(a, b, "k", "h").collect()) == [1, 2]


def test_upsert(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, h string")
    b = spark.createDataFrame([(1, "x"), (2, "n"), (3, "z")], "k int, h string")
    new, bad = relate.upsert(a, b, "k", "h")
    assert [r.k for r in new.collect()] == [3] and [r.k for r in bad.collect()] == [2]


def test_token_pairs_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, f"s{i % 3}", sorted({rng.choice(["aa", "bb", "cc", "dd", "ee", "f"]) for _ in range(3)})) for i in range(25)]
    got = {(r.first, r.second): r.similarity_milli for r in relate.token_pairs(spark.createDataFrame(rows, "record_id long, source_id string, tokens array<string>"), 100, 200).collect()}
    want = {}
    for (i, s, a), (j, t, b) in itertools.combinations(rows, 2):
        if s != t and {x for x in set(a) & set(b) if len(x) > 1}:
            m = round(1000 * len(set(a) & set(b)) / len(set(a) | set(b)))
            if m >= 200:
                want[i, j] = m
    assert got == want


def greedy(cands, targets):
    """The cover without compression."""
    need = {t["target_id"]: t["minimum"] for t in targets}
    pr = {t["target_id"]: t["priority"] for t in targets}
    left, out = list(cands), []
    while True:
        best = [((min(pr[t] for t in s), -len(s), -c["quality_rank"], c["candidate_id"]), c, s) for c in left if (s := [t for t in c["targets"] if need[t] > 0])]
        if not best:
            return out
        _, c, s = min(best, key=lambda x: x[0])
        out.append(c["candidate_id"])
        left = [x for x in left if x is not c and (c["cluster_id"] is None or x["cluster_id"] != c["cluster_id"])]
        for t in s:
            need[t] -= 1


def test_greedy_cover_against_brute_force(spark):
    rng = random.Random(5)
    for _ in range(3):
        targets = [{"target_id": f"t{i}", "minimum": rng.randint(1, 4), "priority": rng.randint(1, 3)} for i in range(4)]
        cands = [{"candidate_id": f"c{i:03}", "cluster_id": rng.choice([None, None, "k1", "k2"]), "quality_rank": rng.randint(1, 2), "targets": rng.sample([t["target_id"] for t in targets], rng.randint(1, 3))} for i in range(40)]
        least = {t["target_id"]: t["minimum"] for t in targets}
        el = spark.createDataFrame([(c["candidate_id"], c["cluster_id"], c["quality_rank"]) for c in cands], "candidate_id string, cluster_id string, quality_rank int")
        ma = spark.createDataFrame([(c["candidate_id"], t, least[t]) for c in cands for t in c["targets"]], "candidate_id string, target_id string, minimum int")
        few = [r.asDict() for r in selection.compressed(el, ma, 20).collect()]
        assert selection.greedy_cover(few, targets) == greedy(cands, targets)


def test_closure_and_cycles(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x")], "node string, input string")
    assert lineage.closure(e).where("node = 'd'").count() == 3
    assert sorted(r.node for r in lineage.cyclic(e).collect()) == ["x", "y"]


def test_steps_wait_for_all_inputs(spark):
    s = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = lineage.and_reach(s([("a",), ("b",)], "item string"), s([(1, "a"), (1, "b"), (2, "c"), (2, "z"), (3, "c")], "step int, item string"), s([(1, "c"), (2, "d"), (3, "e")], "step int, item string"))
    assert {r.item: r["round"] for r in got.collect()} == {"a": 0, "b": 0, "c": 1, "e": 2}


def test_fold(spark):
    e = spark.createDataFrame([("k", 1, "click"), ("k", 2, "view"), ("k", 3, "purchase"), ("k", 4, "click")], "user string, o int, s string")
    r = states.folded(e, "user", "o", "s", {"view": ["click"], "click": ["view", "purchase"], "purchase": []}, "view").first()
    assert (r.final, r.rejected) == ("click", 1)


def test_expectations(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, None)], "k int, v int")
    assert [r.k for r in expect.duplicates(df, "k").collect()] == [1]
    assert sorted(map(tuple, expect.violations(df, "k", [(F.col("v") > 2, "small")]).collect())) == [(1, "small"), (2, "small")]
    with pytest.raises(ValueError):
        expect.require_empty(df, "rows")


def test_artifacts_and_sinks(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.json").write_text('{"rows": [{"id": "x", "n": 1}], "more": []}')
    row = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())]))
    doc = tables.json_artifact(spark, str(tmp_path / "a.json"), T.StructType([T.StructField("rows", row), T.StructField("more", row)]))
    parts = tables.bundle(doc, ["rows", "more"])
    assert [tuple(r) for r in parts["rows"].collect()] == [("x", 1)] and parts["more"].count() == 0
    with pytest.raises(ValueError):
        tables.bundle(doc, ["rows"])
    df = spark.createDataFrame([(2, "b", None), (1, "ä", 1)], "z int, a string, m int")
    sinks.write_canonical(df, "z", str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).orderBy(F.get_json_object("value", "$.z")).collect()] == ['{"a":"ä","m":1,"z":1}', '{"a":"b","m":null,"z":2}']
    with pytest.raises(Exception):
        sinks.write_canonical(df, "z", str(tmp_path / "out"))
    assert "| 1 | ä | 1 |" in sinks.markdown("t", df)
