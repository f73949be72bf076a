"""Decision, lineage, state and linkage operators against brute force and hand cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from attesta.functions import text, values
from attesta.operators import capture, governance, lineage, media, parse, relate, search, selection, states, summarise
from attesta.plans import decisions, joins, registry
from attesta.sources import records, sinks


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- governance ---


def test_source_operations_need_evidence(spark):
    passing = {"a": "ok", "b": "ok"}
    subjects = frame(spark, [(1, False), (2, False), (3, None)], "subject long, blocked boolean")
    facts = frame(spark, [(s, d, p, "ok") for s in (1, 2, 3) for p, d in enumerate("ab")] + [], "subject long, dimension string, place int, state string")
    seen = frame(spark, [(1, "a", "ok", 0, 9), (1, "b", "ok", 0, 9), (2, "a", "ok", 0, 5), (2, "b", "ok", 6, 9), (3, "a", "ok", 0, 9), (3, "a", "ok", 0, 9), (3, "b", None, 0, 9)], "subject long, dimension string, state string, observed_day int, expires_day int")
    ops = frame(spark, [(s, "read", 1, "approved") for s in (1, 2, 3)], "subject long, operation string, place int, state string")
    decided = frame(spark, [(1, "read", "approved", 5, 6), (2, "read", "approved", 0, 5)], "subject long, operation string, state string, decided_day int, expires_day int")
    got = {r.subject: (r.reasons, r.eligible) for r in governance.source_operations(subjects, facts, seen, ops, decided, passing, F.lit(5)).collect()}
    assert got[1] == ([], True)
    assert got[2][0] == ["a:evidence_expired", "b:evidence_not_yet_effective", "operation:decision_expired"]
    assert got[3][0] == ["durable_blocker", "a:evidence_missing_or_conflicting", "b:evidence_missing_or_conflicting", "operation:decision_missing_or_conflicting"]


def test_inheritance_is_union_intersection_and_strictest(spark):
    rows = [("x", ["c2"], ["r", "w"], ["o"], "public", 9, "p"), ("x", ["c1", "c2"], ["w"], ["o", "q"], "internal", 7, "p"), ("y", ["c3"], ["r"], [], "restricted", 1, "p")]
    df = frame(spark, rows, "k string, consents array<string>, allowed_uses array<string>, allowed_audiences array<string>, confidentiality string, retention_expires_day int, purpose_code string")
    got = {r.k: r for r in governance.inherited(df, "k").collect()}
    assert (got["x"].consents, got["x"].uses, got["x"].audiences, got["x"].confidentiality, got["x"].retention_day) == (["c1", "c2"], ["w"], ["o"], "internal", 7)
    assert got["y"].audiences == [] and got["y"].confidentiality == "restricted"


def test_versions_compare_as_numbers(spark):
    v = lambda x: media.version(F.lit(x))
    r = spark.range(1).select((v("2.10") > v("2.9.9")).alias("a"), (v("1") == v("1.0.0.0")).alias("b"), (v("1.2-rc1") < v("1.2.1")).alias("c")).first()
    assert tuple(r) == (True, True, True)


def test_segments_of_one_index_stand_in_the_order_of_time(spark):
    rows = [(7, 0, 0, 900), (7, 2, 2000, 2900), (7, 2, 1000, 1900), (7, 3, 3000, 3900)]
    headers = frame(spark, [(7, 4000)], "result long, duration_ms long")
    for given in (rows, rows[::-1]):
        got = media.span_breaks(frame(spark, given, "result long, idx int, start_ms long, end_ms long").coalesce(1), headers)
        assert [tuple(r) for r in got.collect()] == [(7, 2, "not_contiguous")]


# --- lineage ---


def test_reach_and_cycles(spark):
    e = frame(spark, [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("y", "x"), ("z", "x"), (None, "a")], "node string, input string")
    assert sorted(r.node for r in lineage.reach(e, frame(spark, [("b",), ("x",), ("b",)], "node string")).collect()) == ["b", "c", "d", "x", "y", "z"]
    assert sorted(r.node for r in lineage.cyclic(e).collect()) == ["x", "y", "z"]


def test_steps_against_brute_force(spark):
    rng = random.Random(4)
    inputs = [(s, rng.randrange(30)) for s in range(40) for _ in range(2)]
    outputs = [(s, rng.randrange(30)) for s in range(40)]
    reached, r = {i: 0 for i in range(0, 30, 4)}, 0
    while True:
        r += 1
        new = {o for s, o in outputs if all(i in reached for t, i in inputs if t == s)} - set(reached)
        if not new:
            break
        reached |= dict.fromkeys(new, r)
    got = lineage.and_reach(frame(spark, [(i,) for i in range(0, 30, 4)], "item int"), frame(spark, inputs, "step int, item int"), frame(spark, outputs, "step int, item int"))
    assert {x["item"]: x["round"] for x in got.collect()} == reached


# --- states ---


def test_machine_over_stretches(spark):
    rng = random.Random(7)
    moves = {"a": ["b", "c"], "b": ["a"], "c": ["c", "a"]}
    events = [(k, n, rng.choice("abcz")) for n in range(200) for k in (n % 3,)]
    want = {}
    for k, _, s in events:
        now, bad = want.get(k, ("a", 0))
        want[k] = (s, bad) if s in moves.get(now, []) else (now, bad + 1)
    df = frame(spark, events, "k long, o long, s string")
    for stretch in (1, 7, 1000):
        assert {r.k: (r.final, r.rejected) for r in states.folded(df, "k", "o", "s", moves, "a", stretch).collect()} == want


def test_leases_fence_out_former_owners(spark):
    rows = [(1, 1, "claim", 7, 0), (1, 2, "claim", 8, 5), (1, 3, "claim", 8, 20), (1, 4, "heartbeat", 7, 21), (1, 5, "complete", 8, 22), (1, 6, "claim", 9, 90), (2, 1, "heartbeat", 1, 0), (3, 1, "claim", 1, 0), (3, 2, "release", 1, 1), (4, 1, "claim", 1, 0)]
    got = {r.job: tuple(r)[1:] for r in states.leases(frame(spark, rows, "job long, o long, op string, worker long, at long"), "job", "o", 10, 50).collect()}
    assert got == {1: ("complete", 8, 2, 3, False), 2: ("queued", None, 0, 1, False), 3: ("queued", None, 1, 0, False), 4: ("leased", 1, 1, 0, True)}


# --- linkage ---


def test_partners_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(i, *(rng.choice(["x", "y", None]) for _ in range(3))) for i in range(60)]
    got = {r.k: (r.likely_high, r.likely_medium, r.conflicting) for r in relate.partners(frame(spark, rows, "k long, a string, b string, c string"), "k", ["a", "b", "c"]).collect()}
    want = {r[0]: [0, 0, 0] for r in rows}
    for x, y in itertools.permutations(rows, 2):
        both = [(p, q) for p, q in zip(x[1:], y[1:], strict=True) if p is not None and q is not None]
        same = sum(p == q for p, q in both)
        if same:
            want[x[0]][2 if same < len(both) else 0 if same > 1 else 1] += 1
    assert got == {k: tuple(v) for k, v in want.items()}


def test_control_pairs_are_those_of_the_whole_order(spark):
    rng = random.Random(9)
    recs = [(i, f"s{i % 2}", sorted({rng.choice("abcdefg") for _ in range(3)})) for i in range(120)]
    key = lambda r: hashlib.sha256(f"{r[1]}|{r[0]}".encode()).hexdigest()
    left, right = (sorted((r for r in recs if r[1] == s), key=key) for s in ("s0", "s1"))
    used, want = set(), []
    for x in left:
        if len(want) < 15 and (y := next((y for y in right if y[0] not in used and not set(x[2]) & set(y[2])), None)):
            used.add(y[0])
            want.append((x[0], y[0]))
    df = frame(spark, recs, "record_id long, source_id string, tokens array<string>")
    assert selection.control_pairs(df, [("s0", "s1")], 15, start=2) == want == selection.control_pairs(df, [("s0", "s1")], 15, start=500)


def test_variants_by_their_best_two(spark):
    df = frame(spark, [(1, "s", [["aa", "bb"], ["cc"]]), (2, "t", [["cc", "dd"], ["aa", "bb"]]), (3, "t", [["zz"], []])], "record_id long, source_id string, variants array<array<string>>")
    assert [tuple(r) for r in relate.variant_pairs(df).collect()] == [(1, 2, 1000)]


# --- search and sums ---


def test_terms_are_substrings(spark):
    docs = frame(spark, [(1, "The theatre, as is"), (2, "sea\nside"), (3, None)], "id long, t string")
    cases = frame(spark, [(10, "EA"), (11, "as i"), (12, ""), (13, None), (14, "a\ns")], "case_id long, term string")
    assert sorted((r.case_id, r.id) for r in search.term_hits(docs, "t", cases, block=2).collect()) == [(10, 1), (10, 2), (11, 1), (14, 2)]


def test_places_without_a_limit(spark):
    rows = [(f"d{i}", i % 7, i % 3) for i in range(300)]
    df = frame(spark, rows, "document_id string, match_count int, visible_fields int").repartition(5)
    got = {r.document_id: r["rank"] for r in search.rank(df).collect()}
    assert got == {d: n for n, (d, *_) in enumerate(sorted(rows, key=lambda r: (-r[1], -r[2], r[0])), 1)}


def test_references_are_cut_and_marked(spark):
    df = frame(spark, [("a", f"r{i:03}") for i in range(70)] + [("b", "x"), ("b", "x")], "k string, ref string")
    got = {r.k: (r.refs, r.n, r.truncated) for r in summarise.first_refs(df, ["k"], "ref").collect()}
    assert got["b"] == ("x", 1, False) and got["a"] == (",".join(f"r{i:03}" for i in range(64)), 70, True)


def test_facets_of_what_a_frame_has(spark):
    df = frame(spark, [("s", ["en", "de"]), ("s", ["en"]), (None, None)], "source_id string, languages array<string>")
    assert sorted(map(tuple, search.facets(df).collect())) == [("languages", "de", 1, 2), ("languages", "en", 2, 1), ("source_id", "s", 2, 1)]


# --- captures and values ---


def test_shapes_mark_what_they_leave_out():
    deep = "<div>" * 12 + "<br><p x=1></p>" + "</div>" * 12 + "<p></p>"
    got = parse.shape_of(deep)
    assert got[parse.DEEPER] == 2 + 2 and got["p"] == 1 and got["/".join(["div"] * 10)] == 1
    many = parse.shape_of("".join(f"<i a{k}=1></i>" for k in range(600)))
    assert len(many) == parse.SIGNATURES + 1 and many[parse.MORE] == 600 - parse.SIGNATURES
    assert parse.shape_of("<ul><li>a<br/>b<li>c</ul><p>")["p"] == 1 and parse.shape_of(None) == {}


def test_strict_sitemaps():
    good = capture.PROLOGUE + '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>https://a/b</loc></url></urlset>'
    assert capture._sitemap(good) == ("ok", "url", [{"loc": "https://a/b", "lastmod": None}])
    for text_, state in ((None, "prologue_not_canonical"), (good.replace("</urlset>", ""), "not_well_formed"), (good.replace("<loc>", "<loc x='1'>"), "entry_changed"), (good.replace("https", "&amp;"), "unreviewed_construct"), (good.replace("<url>", "<url>text"), "entry_changed")):
        assert capture._sitemap(text_)[0] == state


def test_values_of_no_kind_and_null(spark):
    df = frame(spark, [("year", None), ("other", "x"), (None, "x")], "k string, v string")
    assert [r[0] for r in df.select(values.of_kind(F.col("k"), F.col("v"), ["x"])).collect()] == [False] * 3
    r = spark.range(1).select(values.url_reason(F.lit(None).cast("string"), ["a"]).alias("u"), values.retry_after(F.lit(None).cast("string"), F.current_timestamp(), 9.0).alias("w"), text.secret_like(F.lit(None).cast("string")).alias("s"), text.portable(F.lit(None).cast("string")).alias("p")).first()
    assert tuple(r) == ("invalid_url", None, True, False)


def test_masking_walks_every_depth(spark):
    df = frame(spark, [(({"a": [{"password": 5, "note": "me@x.org"}], "b": {"Api Key": "k", "x": "/home/me/f"}}),)], "r struct<a:array<struct<password:int,note:string>>,b:map<string,string>>")
    got = df.select(text.sanitized(F.col("r"), df.schema["r"].dataType).alias("r")).first().r
    assert got.a[0].password is None and got.a[0].note == "[REDACTED]" and got.b == {"Api Key": "[REDACTED]", "x": "[REDACTED]"}


def test_writes_never_clobber(spark, tmp_path):
    a = frame(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert sinks.write_once(a, str(tmp_path / "t")) == "written" and sinks.write_once(a.orderBy(F.desc("k")), str(tmp_path / "t")) == "identical"
    with pytest.raises(ValueError):
        sinks.write_once(a.where("k = 1"), str(tmp_path / "t"))
    with pytest.raises(ValueError):
        sinks.markdown("t", spark.range(1001))


# --- queries without a twin ---


def test_selection_by_brute_force(spark, sf):
    docs = records.documents(spark, sf, clusters=True)
    rows = decisions.reasoned(spark, sf, docs)
    cands = [r.asDict() for r in rows.select("candidate_id", "cluster_id", "quality_rank", "reason", records.dimensions(rows).alias("dims")).collect()]
    targets = [r.asDict() for r in records.targets(docs).collect()]
    of = {(t["dimension"], t["value"]): t["target_id"] for t in targets}
    for c in cands:
        c["targets"] = [of[x["dimension"], x["value"]] for x in c["dims"]]
    from tests.test_operators import greedy

    order = greedy([c for c in cands if c["reason"] is None], targets)
    assert [r.candidate_id for r in decisions.greedy_cover(spark, sf).orderBy("place").collect()] == order
    clusters = {c["cluster_id"] for c in cands if c["candidate_id"] in order and c["cluster_id"]}
    want = {c["candidate_id"]: c["reason"] or ("selected" if c["candidate_id"] in order else "duplicate_not_representative" if c["cluster_id"] in clusters else "coverage_not_needed") for c in cands}
    assert {r.candidate_id: r.reason for r in decisions.eval_selection(spark, sf).collect()} == want


def test_balanced_pairs_by_brute_force(spark, sf):
    recs = {r.record_id: r for r in joins.catalogue(spark, sf).collect()}
    pairs = []
    for r in relate.token_pairs(joins.catalogue(spark, sf)).collect():
        s = sorted((recs[r.first].source_id, recs[r.second].source_id))
        pairs.append({"first": r.first, "second": r.second, "source_pair": "|".join(s), "similarity": r.similarity_milli, "key": hashlib.sha256(f"{r.first}|{r.second}".encode()).hexdigest()})
    want = [(p["first"], p["second"], p["similarity"]) for p in selection.balanced_pairs(pairs, 20)]
    assert sorted(map(tuple, decisions.greedy_balanced_pairs(spark, sf).collect())) == sorted(want)


def test_text_queries_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {r.doc_id: r.folded_sha256 for r in registry.QUERIES["scalar_casefold"](spark, sf).collect()} == {d.doc_id: sha(d.text.casefold()) for d in docs}
    got = {r.doc_id: (r.nfkc_sha256, r.is_nfc) for r in registry.QUERIES["scalar_nfkc"](spark, sf).collect()}
    assert got == {d.doc_id: (sha(unicodedata.normalize("NFKC", d.text)), unicodedata.is_normalized("NFC", d.text)) for d in docs}


def test_slots_by_brute_force(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    key = lambda i: hashlib.sha256(f"asset_{i}".encode()).hexdigest()
    whole = registry.QUERIES["compile_pilot_freeze"](spark, sf).collect()
    got = [r for r in whole if r.section == "sample"]
    pairs = lambda name: sorted((r.first, r.second) for r in whole if r.section == name)
    assert pairs("linked") == sorted((r.first, r.second) for r in decisions.greedy_balanced_pairs(spark, sf).collect()) and pairs("control")
    assert len({r.pilot_id for r in whole}) == len(whole)
    by = {}
    for i, r in docs.items():
        by.setdefault(r.lang, []).append(i)
    want = {i: place for ids in by.values() for place, i in enumerate(sorted(ids, key=lambda i: (key(i), f"asset_{i}"))[:30], 1)}
    assert {r.first: r.place for r in got} == want
    assert all(r.page_slot == 1 + int(key(r.first), 16) % max(1, docs[r.first].n_chars // 500) for r in got)
    slots = registry.QUERIES["page_slot"](spark, sf)
    assert slots.count() == len(docs)


def test_shape_profile_by_brute_force(spark, sf):
    total = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        for k, n in parse.shape_of(r.html).items():
            total[k] = total.get(k, 0) + n
    assert {r.signature: r.n for r in registry.QUERIES["html_shape_profile"](spark, sf).collect()} == total


def test_control_query_pairs_share_nothing(spark, sf):
    from attesta.plans import operations

    tokens = {r.record_id: set(r.tokens) for r in operations._titles(spark, sf).collect()}
    got = operations.join_anti_token(spark, sf).collect()
    assert got and all(not tokens[r.first] & tokens[r.second] for r in got)
