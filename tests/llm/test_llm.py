"""The training-data operators: brute force, round trips, held-out accuracy, and odd inputs."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import chat_format, components, decontaminate, entry, exact_dedup, jaccard_join, language_id, main_text, quality_rules, secrets, sentencepieces, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def frame(spark, rows, extra=True):
    """doc_id, text and the other columns of documents; extra columns have names that operators use."""
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("id", "h", "n", "name", "key", "doc", "spans", "score", "t", "a", "b")}) if extra else df


@pytest.fixture(scope="module")
def real(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def odd(real):
    """Null, empty and long texts, ties, near copies, a null id."""
    long = " ".join(t for _, t in real[:60])
    base = real[3][1]
    return [(1000, None), (1001, ""), (1002, " "), (1003, long), (1004, long + " end"), (1005, base), (1006, base), (1007, base + " tail"), (1008, "one two"), (1009, "one two"), (1010, "日本語 テキスト"), (1011, "\n\n"), (1012, "x" * 70), (1013, "y" + "x" * 70)]


# --- 8 ---


def test_exact_dedup(spark, real):
    rows = real + odd(real) + [(1008, "one two")]
    got = exact_dedup.exact_dedup(frame(spark, rows), block_chars=64, hot_rows=2).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), sha(t or "")) for i, t in rows)
    assert sorted(map(tuple, got)) == want


def test_exact_dedup_tells_lengths_apart(spark):
    rows = [(1, "ab"), (2, "abab"), (3, "abababab"), (4, "abab"), (5, "ba"), (6, "")]
    got = {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(frame(spark, rows), block_chars=2).collect()}
    assert got == {1: 1, 2: 4, 3: 3, 4: 4, 5: 5, 6: 6}


def test_exact_dedup_null_id_and_empty_table(spark):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame(spark, [(None, "a"), (7, "a")])).collect()}
    assert got == {None: (7, 2, False), 7: (7, 2, True)}
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


# --- 5 ---


def test_jaccard_join(spark, real):
    rows = real + odd(real)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(frame(spark, rows)).collect()}
    assert got == jaccard_join.brute_force(rows)


def test_jaccard_join_in_blocks(spark):
    """A large group of near copies, dealt in many blocks and buckets."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[: rng.randint(0, 5)] + [f"v{rng.randint(0, 40)}"] + base[5:])) for i in range(150)] + [(500 + i, " ".join(rng.choices(base, k=40))) for i in range(30)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(frame(spark, rows), bucket_rows=20, block_rows=30).collect()}
    assert got == jaccard_join.brute_force(rows)
    kept = jaccard_join.keep_one(frame(spark, rows, extra=False))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in got.values()})


def test_jaccard_join_odd_inputs(spark):
    assert jaccard_join.jaccard_join(frame(spark, [])).count() == 0
    got = sorted(map(tuple, jaccard_join.jaccard_join(frame(spark, [(None, "a b c d e f"), (1, None), (2, "q r s t u"), (2, "q r s t u")])).collect()), key=repr)
    assert got == sorted([(None, None, 0, None), (1, 1, 0, 1), (2, 2, 1, 2), (2, 2, 1, 2)], key=repr)


def test_jaccard_join_of_ids_with_several_texts(spark):
    words = lambda c: [f"{c}{i}" for i in range(40)]
    a, b = " ".join(words("a")), " ".join(words("b"))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (5, a.upper()), (5, a.upper())]
    got = sorted(map(tuple, jaccard_join.jaccard_join(frame(spark, rows)).collect()))
    assert got == [(1, 1, 1, 1), (1, 1, 3, 1), (2, 1, 3, 2), (3, 1, 1, 3), (5, 1, 3, 1), (5, 1, 3, 1)]
    assert sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(frame(spark, rows, extra=False)).collect()) == [(1, a), (1, b)]
    more = [(0, b + " z"), *rows]
    assert sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(frame(spark, more, extra=False)).collect()) == [(0, b + " z"), (1, a)]
    named = frame(spark, rows).withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert sorted(map(tuple, jaccard_join.jaccard_join(named).collect())) == [(f"d{i}", f"d{c}", n, f"d{o}") for i, c, n, o in got]


def test_jaccard_join_of_texts_that_differ_in_signs_only(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, ", ".join(words) + "!!"), (3, "; ".join(words[:-1])), (4, " - ".join(words).upper()), (5, "... ".join(words[1:]))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(frame(spark, rows)).collect()}
    assert got == jaccard_join.brute_force(rows) and got[1] == (1, 4)


def test_pruning_keeps_what_may_be_alike():
    least = jaccard_join.least_matches((16, 128), 0.8, 1e-5)
    assert least[16] < 0.8 * 16 and 75 < least[128] < 0.8 * 128


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(e).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- 3 ---


def test_suffix_dedup(spark, real):
    rows = real + odd(real)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()}
    assert got == suffix_dedup.brute_force(rows)


def test_suffix_dedup_over_many_groups(spark, monkeypatch):
    """Passages that many documents share, near copies and repeated ids, dealt to groups of few texts."""
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", 3000)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefg ", k=n))
    shared, base = text(170), text(400)
    rows = [(i, text(rng.randint(0, 300)) + shared[rng.randint(0, 60) :] + text(rng.randint(0, 200))) for i in range(120)]
    rows += [(200 + i, base[: 40 * i] + "#" + base[40 * i :]) for i in range(10)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()}
    assert got == suffix_dedup.brute_force(rows)
    twice = suffix_dedup.suffix_dedup(frame(spark, [(1, base[:100]), (5, "x" + base[:200]), (5, "y" + base[20:250]), (5, "x" + base[:200]), (9, base)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in twice) == [(1, 0), (5, 80), (5, 100), (5, 100), (9, 250)]


def test_suffix_dedup_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 500)
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdef ", k=400))
    texts = [("".join(rng.choices("abc ", k=3000)) + passage + "".join(rng.choices("abc ", k=900))).encode() for _ in range(3)]
    for t in texts:
        data, borders = np.frombuffer(t, np.uint8), np.array([0, len(t)])
        whole = suffix_dedup.Blocks(data, borders, 50)
        seen = np.zeros(len(t), bool)
        for part, at, _, offset in suffix_dedup.pieces(data, borders, 50):
            x = suffix_dedup.Blocks(part, at, 50)
            for lo, hi in zip(x.lo + offset, x.hi + offset, strict=True):
                assert not seen[lo : hi + 1].any()
                seen[lo : hi + 1] = True
        assert seen.sum() == (whole.hi - whole.lo + 1).sum() == len(t) - 49


def test_suffix_dedup_odd_inputs(spark):
    assert suffix_dedup.suffix_dedup(frame(spark, [])).count() == 0
    t = "".join(chr(97 + (i * i) % 23) for i in range(60))
    got = {(r.doc_id, r.n_removed) for r in suffix_dedup.suffix_dedup(frame(spark, [(None, t), (1, t), (1, t), (2, t[:50]), (3, t[:49]), (4, None)])).collect()}
    assert got == {(None, 0), (1, 60), (2, 50), (3, 0), (4, 0)}


# --- 6 ---


def test_decontaminate(spark, sf, real):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()] + [(900, "one two"), (901, None), (902, ""), (903, "ONE, two!")]
    rows = real + odd(real) + [(2000, "Xx " + items[0][1].upper() + " yy")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    shown = lambda df: {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in df.collect()}
    want = decontaminate.brute_force(rows, items)
    one = decontaminate.scan(frame(spark, rows), bench)
    assert shown(one) == {k: v[:3] for k, v in want.items()}
    assert shown(decontaminate.scan(frame(spark, rows), bench, most_windows=300)) == shown(one)
    clean = {r.doc_id for r in decontaminate.remove_documents(frame(spark, rows, extra=False), bench).collect()}
    assert clean == {k for k, v in want.items() if not v[4]}
    assert clean == {r.doc_id for r in decontaminate.remove_documents(frame(spark, rows, extra=False), bench, most_windows=300).collect()}


def test_decontaminate_is_alike_at_every_size(spark):
    """Repeated ids with other texts of as many words, equal rows, null ids, null items, one long item."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = [(k, " ".join(word() for _ in range(20))) for k in range(30)] + [(None, " ".join(word() for _ in range(15))), (7, "x1 x2 x3"), (50, " ".join(word() for _ in range(9000)))]
    plain = lambda n: " ".join(word() for _ in range(n))
    long = items[-1][1].split()
    rows = [(1, items[0][1] + " " + items[1][1]), (1, plain(40)), (2, plain(12)), (2, plain(12)), (None, items[2][1]), (None, plain(20)), (3, items[-3][1] + " tail"), (4, None), (5, "x1 x2 x3"), (5, "x1 x2 x3")]
    rows += [(6, " ".join(long[4090:4110])), (7, " ".join([*items[3][1].split()[:14], "zz", *items[4][1].split()[:13], *items[5][1].split()])), (8, plain(500) + " " + items[6][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    flat = lambda df: sorted((repr(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), tuple(map(tuple, r.spans))) for r in df.collect())
    one, many = (decontaminate.scan(frame(spark, rows), bench, most_windows=m) for m in (2_000_000, 900))
    assert flat(one) == flat(many) == flat(decontaminate.scan(frame(spark, rows), bench, most_bytes=2000))
    want = sorted((repr(d), *decontaminate.brute_force([(d, t)], items)[d][:3]) for d, t in rows)
    assert [(i, w, h, len(x)) for i, w, h, x, _ in flat(one)] == want
    kept = [sorted(map(repr, decontaminate.remove_documents(frame(spark, rows, extra=False), bench, most_windows=m).collect())) for m in (2_000_000, 900)]
    assert kept[0] == kept[1]
    wide = frame(spark, rows, extra=False).withColumns({c: F.lit("clash") for c in ("_id", "_key", "key", "times", "n_hit")})
    assert decontaminate.remove_documents(wide, bench, most_windows=900).count() == len(kept[0])
    assert len(kept[0]) == sum(not decontaminate.brute_force([(d, t)], items)[d][4] for d, t in rows)


def test_decontaminate_odd_inputs(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[1:3] for r in decontaminate.scan(frame(spark, [(1, "a b"), (2, None)]), bench).orderBy("doc_id").collect()] == [(2, 0), (0, 0)]
    assert decontaminate.scan(frame(spark, []), bench).count() == 0
    assert decontaminate.cut_spans("ab, CD ef", [{"byte": 4, "end": 6}]) == "ab,  ef"
    assert decontaminate.cut_spans(None, []) is None


# --- 4 ---


def test_secrets(spark, real):
    hexes = [f"{i:040x}" for i in range(1 << 100, (1 << 100) + 3)]
    rows = [(i, t, "s1") for i, t in real + odd(real)]
    rows += [(3000, f"é🙂 Token = '{hexes[0]}' x", "s1"), (3001, f"API_KEY:{hexes[1]}, secret: short", "s1"), (3002, f"again {hexes[1]}", "s2"), (3003, "AKIA" + "A" * 30 + " AKIAB token: password: abcdefghijklmn", None), (3004, "password=" + "a." * 4000 + " pwd", "s3"), (3005, " ".join(f"token={h}" for h in hexes * 300), "s4")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in ("key", "base", "values", "owner", "t", "m0")})
    got = secrets.scan(df, F.col("source"), F.concat_ws("/", "source", F.lit("r"))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        assert [(s.start, s.kind, s.end) for s in by[i].base] == sorted(by[i].base) == secrets.brute_force(t) or sorted((s.start, s.kind, s.end) for s in by[i].base) == secrets.brute_force(t)
    assert (by[3000].n_live, by[3000].n_example) == (0, 1)  # its value is in s4 too
    assert by[3002].n_live == 0 and by[3002].n_example == 1
    assert by[3004].n_live == 1
    assert by[1000].base == [] and secrets.scan(df.limit(0), F.col("source"), F.col("source")).count() == 0


def test_secrets_ownership(spark):
    """Which values are live, against brute force: one owner with few repositories, with many, several owners."""
    rng = random.Random(5)
    values = [f"{rng.getrandbits(80):020x}" for _ in range(8)]
    rows = [(i, "".join(f"token={v}; " for v in rng.sample(values, 2)) + f"pad {i}", rng.choice(["o1", "o1", "o2", None]), rng.choice(["r1", "r2", "r3", None])) for i in range(14)]
    rows += [(50 + k, f"x {hex(1 << 90 | 7)[2:]}", "o9", f"q{k}") for k in range(3)] + [(60 + k, f"x {hex(1 << 90 | 9)[2:]}", "o9", f"q{k}") for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, repo string").withColumn("owned", F.lit("clash"))
    got = {r.doc_id: r for r in secrets.scan(df, F.col("source"), F.col("repo")).collect()}
    want = secrets.brute_force_live([r[1:] for r in rows])
    assert {r[0]: {(s.start, s.end) for s in got[r[0]]["all"] if s.kind == 3} for r in rows} == {r[0]: w for r, w in zip(rows, want, strict=True)}
    assert got[50].n_live == 0 and got[60].n_live == 1 and [o.n_repositories for o in got[50].owned] == [3]


def test_secrets_in_a_text_of_very_many_matches(spark):
    import time

    text = "é " + "0123456789abcdef " * 200_000
    began = time.time()
    (r,) = secrets.candidates(spark.createDataFrame([(1, text)], "doc_id long, text string"), F.lit("o"), F.lit("r")).collect()
    assert time.time() - began < 60 and len(r.base) == 200_000
    assert [(s.start, s.end) for s in r.base[-2:]] == [(2 + 17 * k, 2 + 17 * k + 16) for k in (199_998, 199_999)]


def test_secrets_repeated_rows(spark):
    df = spark.createDataFrame([(1, "token=abcdefabcdefabcd9", "s")] * 2, "doc_id long, text string, source string")
    got = secrets.scan(df, F.col("source"), F.col("source")).collect()
    assert len(got) == 2 and all(r.n_live == 1 and len(r["all"]) == 3 for r in got)


# --- 2 ---


def test_sentencepiece(real):
    c = sentencepieces.codec(sentencepieces.default_model())
    texts = [t for _, t in real + odd(real)] + ["  lead", "trail  ", " ", "▁a▁ b", "a\n b", "\n", "<s></s>", "🙂 🙂", "\x00a"]
    for text, (ids, back) in zip(texts, c.encode(texts), strict=True):
        want = [*c.library.encode(text or ""), c.end]
        assert ids == want and back == c.library.decode(want)
        spans = c.spans(text, ids)
        raw = (text or "").encode()
        assert len(spans) == len(ids) - 1
        # Spans follow each other and cover every byte.
        assert [a for a, _ in spans[1:]] == [b for _, b in spans[:-1]] and (not spans or (spans[0][0], spans[-1][1]) == (0, len(raw)))
        for i, (a, b) in zip(ids, spans, strict=False):
            piece = c.library.id_to_piece(i)
            assert piece.startswith("<0x") or raw[a:b].decode().replace(" ", "▁") == (piece[1:] if a == 0 and piece.startswith("▁") and not raw[a:b].startswith((b" ", "▁".encode())) or (a == 0 and len(piece) > len(raw[a:b].decode())) else piece)


def test_sentencepiece_store_that_empties(real, monkeypatch):
    monkeypatch.setattr(sentencepieces, "KEPT_SEGMENTS", 300)
    monkeypatch.setattr(sentencepieces, "BATCH_CHARS", 2000)
    c = sentencepieces.Codec(sentencepieces.default_model())
    texts = [t for _, t in real[:40]]
    assert [ids for ids, _ in c.encode(texts)] == [[*c.library.encode(t), c.end] for t in texts]


def test_sentencepiece_offsets_against_the_library(tmp_path):
    """Byte spans of every piece, by the 32k model and by one with an NFKC character map."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    plain = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = plain.serialized_normalizer_spec if isinstance(plain.serialized_normalizer_spec, bytes) else plain.serialized_normalizer_spec()
    rule, proto = pb.NormalizerSpec(), pb.ModelProto()
    rule.ParseFromString(spec)
    with open(sentencepieces.default_model(), "rb") as f:
        proto.ParseFromString(f.read())
    texts = ["ＡＢ ﬁ ①é x", "  lead  two ", "", "ｶﾞ ㍿ …x", "á b\u00a0c\td", "日本語 🙂", " ", "x ", "plain words, twice  over\n\nnew"]
    models = [sentencepieces.default_model()]
    for trims in (False, True):
        proto.normalizer_spec.precompiled_charsmap = rule.precompiled_charsmap
        proto.normalizer_spec.remove_extra_whitespaces = trims
        models.append(str(tmp_path / f"{trims}.model"))
        with open(models[-1], "wb") as f:
            f.write(proto.SerializeToString())
    for model in models:
        c = sentencepieces.Codec(model)
        for text, (ids, _) in zip(texts, c.encode(texts), strict=True):
            theirs = c.library.encode(text, return_type="proto").pieces
            assert ids[:-1] == [p.id for p in theirs]
            # Pieces of single bytes have each their byte here, where a character isn't mapped.
            plain = [k for k, p in enumerate(theirs) if not p.piece.startswith("<0x")]
            spans = c.spans(text, ids)
            assert [text.encode()[slice(*spans[k])].decode() for k in plain] == [theirs[k].surface for k in plain]


def test_character_map():
    import sentencepiece

    plain = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = plain.serialized_normalizer_spec if isinstance(plain.serialized_normalizer_spec, bytes) else plain.serialized_normalizer_spec()
    from sentencepiece import sentencepiece_model_pb2 as pb

    rule = pb.NormalizerSpec()
    rule.ParseFromString(spec)
    m = sentencepieces.CharacterMap(rule.precompiled_charsmap)
    text = "ＡＢ ﬁ ①é x"
    out, source = m.apply(text.encode())
    assert out.decode() == "AB fi 1é x"
    assert len(source) == len(out) + 1 and source[0] == 0 and source[1] == 3 and source[-1] == len(text.encode())


def test_sentencepiece_frames(spark):
    df = frame(spark, [(1, None), (2, "ab c"), (2, "ab c")])
    rows = sentencepieces.digests(df, sentencepieces.default_model()).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows][0] == 1 and rows[0].ids_sha256 == sha("2") and rows[0].decoded_sha256 == sha("")
    assert rows[1] == rows[2] and rows[1].decoded_sha256 == sha("ab c")
    full = sentencepieces.encode(df, sentencepieces.default_model()).where("doc_id = 2").first()
    assert full.decoded == "ab c" and len(full.spans) == len(full.ids) - 1
    assert sentencepieces.digests(frame(spark, []), sentencepieces.default_model()).count() == 0


def test_sentencepiece_digests_are_aligned(monkeypatch):
    import pyarrow as pa

    model = sentencepieces.default_model()
    c, seen = sentencepieces.codec(model), []
    texts = ["ab  é\n🙂", None, "", " lead"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], ["doc_id", "text"])
    normalise = c.normalise
    monkeypatch.setattr(c, "normalise", lambda t: seen.append(t) or normalise(t))
    (out,) = sentencepieces._digests(iter([batch]), model)
    assert seen == [t or "" for t in texts]
    assert out.column(4)[2].as_py() == hashlib.sha256(b"").hexdigest() and out.column(4)[3].as_py() == hashlib.sha256(np.array(c.spans(" lead", next(c.encode([" lead"]))[0]), "<i8").tobytes()).hexdigest()
    assert out.column(1).to_pylist() == [len(c.spans(t, ids)) + 1 for t, (ids, _) in zip(texts, c.encode(texts), strict=True)]
    monkeypatch.setattr(c, "normalise", lambda t: normalise(t + "x"))
    with pytest.raises(ValueError):
        list(sentencepieces._digests(iter([batch]), model))


# --- 9 ---


def test_escaping_is_reversible():
    rng = random.Random(4)
    for _ in range(500):
        t = "".join(rng.choices("<|\\ab>\n", k=rng.randint(0, 12)))
        assert chat_format.unescape(chat_format.escape(t)) == t and "<|" not in chat_format.escape(t)
        assert chat_format._role_in(chat_format._role_out(t)) == t and "\n" not in chat_format._role_out(t)


def test_chat_digests(spark):
    rows = [(1, 1, "assistant", "b <|im_end|>\n"), (1, 0, "user", None), (1, 2, None, "x"), (1, 2, None, "x"), (2, 0, "assistant", ""), (None, 0, "assistant", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("nth", F.lit("clash"))
    got = {r.conv_id: r for r in chat_format.digests(df).collect()}
    assert got[1].n_turns == 4 and got[1].turns_sha256 == sha("user\n\nassistant\nb <|im_end|>\n\n\nx\n\nx\n")
    assert got[1].loss_chars == 13 and got[1].loss_sha256 == sha("b <|im_end|>\n")
    assert got[2].n_turns == 1 and got[2].loss_chars == 0 and got[None].loss_chars == 1
    assert chat_format.digests(df.limit(0)).count() == 0


def test_chat_parts(spark):
    parts = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
    df = spark.createDataFrame([(1, 0, "user", [("text", "see <|image:0|>", None, None), ("image", None, "u1", 2), ("audio", None, "u2", 3)]), (1, 1, "assistant", [("text", "ok", None, None), ("document", None, "u3", None), ("text", "bye", None, None)])], f"conv_id long, turn long, role string, parts {parts}")
    rows = chat_format.format_chats(df).orderBy("nth").collect()
    assert [(a.n, a.kind, a.ref, a.tokens) for r in rows for a in r.attachments] == [(0, "image", "u1", 512), (1, "audio", "u2", 75), (2, "document", "u3", 512)]
    out = "".join(r.formatted for r in rows)
    assert [out[s.begin : s.end] for r in rows for s in r.loss] == ["ok", "bye"]
    assert chat_format.read_back(out) == [("user", "see <|image:0|>"), ("assistant", "okbye")]
    assert chat_format.digests(df).first().attachment_tokens == 1099


def test_chat_odd_parts(spark):
    parts = "array<struct<kind:string,text:string,ref:string,units:bigint>>"
    rows = [(1, 0, "assistant", [None, ("video", "lost", "v", 3), (None, "a", None, None), ("text", None, None, None), ("other", None, None, None), ("image", None, None, -2)]), (1, 1, "user", None), (1, 2, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {parts}")
    turns = chat_format.format_chats(df).orderBy("nth").collect()
    assert [(a.n, a.kind, a.ref, a.tokens) for a in turns[0].attachments] == [(0, "video", "v", 0), (1, "other", None, 0), (2, "image", None, 256)]
    out = "".join(r.formatted for r in turns)
    assert chat_format.read_back(out) == [("assistant", "a"), ("user", ""), ("user", "")]
    assert [out[s.begin : s.end] for r in turns for s in r.loss] == ["a"]


# --- 10 ---


def test_automaton_matches_greedy_parse():
    rng = random.Random(6)
    sample = rng.choices(range(4), k=300)
    text = "".join(map(str, sample))
    a = language_id.SuffixAutomaton(sample, 5)
    for _ in range(30):
        probe = rng.choices(range(5), k=60)
        n, at = 0, 0
        while at < len(probe):
            size = 1
            while at + size < len(probe) and "".join(map(str, probe[at : at + size + 1])) in text:
                size += 1
            at += size
            n += 1
        assert a.walk(np.array([probe], np.int32).T)[0].sum() == n
    assert a.walk(np.full((3, 1), 5, np.int32))[0].sum() == 0


def test_language_pieces_are_parsed_as_whole_texts(real, monkeypatch):
    """Predictions by brute force, with pieces shorter than phrases, about as long, and longer."""
    by_lang = {"en": real[0][1] + real[1][1], "xx": real[2][1][::-1] + " wabe dako " * 20, "zz": "ababababababababab ab " * 30}
    texts = [t for _, t in real[:40] + odd(real)[4:]] + ["ab" * 400 + "c", "wabe dako wabe", real[0][1][:300] + real[2][1][::-1][:300], None, "", "7"]
    want = [language_id.brute_force(by_lang, t) for t in texts]
    for size in (3, 17, 256):
        monkeypatch.setattr(language_id, "PIECE", size)
        got = language_id.Model(by_lang).predict(texts)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want])


def test_language_query_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    samples = language_id.learn(docs, sample_chars=3000, sample_rows=8)
    got = {r.doc_id: r for r in language_id.identify(docs, samples).collect()}
    for d in docs.select("doc_id", "text").collect()[::9]:
        lang, score = language_id.brute_force(samples, d.text and d.text[:4000])
        if len(d.text or "") <= 4000:
            assert got[d.doc_id].lang_pred == lang and abs(got[d.doc_id].score - score) < 1e-9


def test_language_rejects(spark):
    samples = {"en": "the cat and the dog sat on the mat with a hat " * 5, "fr": "le chat et le chien sont sur le tapis " * 5}
    df = frame(spark, [(1, "the cat and the dog"), (2, "le chat et le chien"), (3, "xq zvw qqk jzx wvk"), (4, "123"), (None, "the hat")], extra=False)
    kept = lambda **o: sorted(r.doc_id or -1 for r in language_id.keep_known(df, samples, **o).collect())
    assert language_id.keep_known(frame(spark, [(1, "x"), (2, "qx")], extra=False), samples).count() == 2
    assert kept() == [-1, 1, 2] and kept(most_rate=1.0) == [-1, 1, 2, 3]
    assert kept(languages={"fr"}) == [2] and kept(least_score=1.1) == []
    assert language_id.keep_known(df, {}).count() == 4


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    got = language_id.identify(docs, language_id.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(language_id.held_out()).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_with_only_short_or_long_texts(spark):
    words = {"aa": "tak mok lap", "bb": "dre vin zul", "cc": "qor pex hyb"}
    text = lambda lang, n, i: " ".join(random.Random(i).choices(words[lang].split(), k=n))
    rows = [(i, text(lang, n, i), lang) for lang, n, start in (("aa", 80, 0), ("bb", 8, 100), ("cc", 7000, 200)) for i in range(start, start + 40)]
    docs = spark.createDataFrame([*rows, (300, None, "dd"), (301, "", "dd"), (303, "12 34", "dd")], "doc_id long, text string, lang string")
    samples = language_id.learn(docs)
    assert sorted(samples) == ["aa", "bb", "cc"]
    assert len(samples["bb"]) > 500 and len(samples["cc"]) == 24_000
    got = language_id.identify(docs, samples).join(docs.select("doc_id", "lang"), "doc_id").where("lang <> 'dd'").collect()
    assert all(r.lang_pred == r.lang for r in got)
    short = docs.where("lang = 'bb'")
    assert language_id.keep_known(short, language_id.learn(short)).count() == 40
    few = language_id.learn(short, sample_rows=1)["bb"]
    assert 200 <= len(few.replace("\n", "")) < 240
    assert language_id.learn(docs.where("lang <> 'cc'"), sample_rows=1)["aa"] in {t for _, t, lang in rows if lang == "aa"}


def test_language_ignores_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("text", F.when(language_id.held_out(), "zzz").otherwise(F.col("text"))).withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang")))
    assert language_id.learn(docs) == language_id.learn(other)
    assert zlib.crc32(b"5") % 3 == spark.range(1).select(F.crc32(F.lit("5")) % 3).first()[0]


def test_language_odd_inputs(spark):
    samples = {"en": "the cat and the dog", "fr": "le chat et le chien"}
    df = frame(spark, [(1, None), (2, "12 !?"), (3, "the dog"), (4, ""), (None, "le chien"), (3, "the dog")])
    got = sorted(((r.doc_id, r.lang_pred) for r in language_id.identify(df, samples).collect()), key=repr)
    assert got == sorted([(1, "und"), (2, "und"), (3, "en"), (4, "und"), (None, "fr"), (3, "en")], key=repr)
    assert [r.lang_pred for r in language_id.identify(df, {}).collect()] == ["und"] * 6
    assert language_id.identify(frame(spark, []), samples).count() == 0 and language_id.learn(frame(spark, [])) == {}
    assert sorted(r.doc_id or -1 for r in language_id.keep_known(frame(spark, [(1, None), (2, "the"), (None, "chat")], extra=False), samples).collect()) == [-1, 2]


# --- 7 ---


def test_quality(spark):
    d = "/root/testdata/sf0.01"
    got = quality_rules.query(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)


def test_quality_rules_compile_to_what_they_mean(spark):
    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality_rules.STATS)))
    y = ((x[:, 2] < 0.5) & (x[:, 4] > 0.3)).astype(float)
    b0, rules = quality_rules.fit(x, y)
    want = 1 / (1 + np.exp(-(b0 + sum(w * quality_rules.holds(r, x) for r, w in rules))))
    assert ((want > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame(x[:50].tolist(), ", ".join(f"{s} double" for s in quality_rules.STATS))
    assert np.allclose([r[0] for r in df.select(quality_rules.compiled((b0, rules))).collect()], want[:50])


def test_quality_statistics(spark, real):
    rows = real + odd(real) + [(3000, "ÀÉß Öl! A|B\n\nx, y. 12 12 12 " + "w" * 30)]
    got = {r.doc_id: r[1:] for r in quality_rules.measure(frame(spark, rows)).collect()}
    for i, t in rows:
        assert np.allclose(got[i], quality_rules.brute_force(t), rtol=1e-12), i


def test_quality_score_is_the_model_over_the_statistics(spark, sf):
    """The query's scores, from rules and statistics by brute force."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    b0, rules = quality_rules.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r.doc_id: r for r in quality_rules.query(spark, sf).collect()}
    for d in docs.select("doc_id", "text").collect():
        x = np.array([quality_rules.brute_force(d.text)])
        want = 1 / (1 + np.exp(-(b0 + sum(w * bool(quality_rules.holds(r, x)[0]) for r, w in rules))))
        assert abs(got[d.doc_id].score - want) < 1e-9 and got[d.doc_id].predicted == int(want >= 0.3) and got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)


def test_quality_odd_inputs(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = frame(spark, [(1, None), (2, ""), (3, "a b c. " * 5000), (None, "x"), (2, "")])
    assert [r.score for r in quality_rules.score(df, quality_rules.learn(df, labels)).collect()] == [0.5] * 5
    assert quality_rules.score(frame(spark, []), (0.0, [])).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    assert quality_rules.learn(df, one)[1] == []
    twice = quality_rules.learn(frame(spark, [(1, "a"), (1, "b b"), (2, "c, d")] * 3), spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int"))
    assert quality_rules.learn(frame(spark, [(1, "a"), (2, "c, d")]), spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")) == twice
    s = quality_rules.statistics(np.frombuffer("AB ab ab!\nÄx".encode(), np.uint8), np.array([0, 13]))[0]
    got = dict(zip(quality_rules.STATS, s, strict=True))
    assert got["n_words"] == 4 and got["upper_share"] == 3 / 8 and got["repeat_share"] == 2 / 4 and got["bang_share"] == 1 / 4


# --- 1 ---


def test_extraction_of_usual_layouts():
    w = main_text.default_weights()
    words = "Some words of the story that goes on for a while"
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>if (a < b) "</p>";</script></head><body>
    <header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><div class="cookie-notice">We use cookies on this site</div>
    <article><h1>Head &amp; line</h1><p>{words} <b>one</b>,
      <a href="x">linked</a> &lt;two&gt;.</p><div class="ad">Buy this now please</div><p>Short.</p><aside class="related"><p>Other stories to read</p></aside><ul><li>{words} three.</li></ul><!-- gone --></article>
    <section class="comments"><h2>Comments</h2><div class="comment"><p>{words} I disagree with all of this</p></div></section><form><label>Mail</label><input name=q></form><footer><p>Rights kept</p></footer></body></html>"""
    text, _ = main_text.extract(page, w)
    assert text == f"Head & line\n{words} one, linked <two>.\nShort.\n{words} three."
    assert main_text.extract(None, w)[0] == main_text.extract("", w)[0] == main_text.extract("<nav>Only a menu</nav>", w)[0] == ""
    plain = f"<body><div id='menu'><a href='/'>a</a> <a href='/b'>b</a></div><h1>Title</h1><p>{words}.</p><p>{words} too.</p><div class='footer'>end of it</div>"
    assert main_text.extract(plain, w)[0] == f"Title\n{words}.\n{words} too."


def test_main_text_foreign_elements():
    w = main_text.default_weights()
    get = lambda inner: main_text.extract(f"<article><p>Some plain words here {inner} and more of them</p><p>The end</p></article>", w)[0]
    rest = "and more of them\nThe end"
    for empty in ("<svg class='i'/>", "<svg a='>' />", "<math/>", "<svg class='i'><path d='M0'/><text>gone</text></svg>", "<svg class='i'>", "<iframe src='x'>", "<select-box></select-box>", "<object data='x'></object>"):
        assert get(empty).replace("here\n", "here ").replace("\nand", " and") == f"Some plain words here {rest}", empty
    assert get("<svg class='i'/>") == get("<svg class='i'></svg>") == f"Some plain words here {rest}"
    assert get("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>") == f"Some plain words here x=2 {rest}"
    assert get("<object data='x'>fallback</object>") == f"Some plain words here fallback {rest}"
    assert get("<script>never ends") == "Some plain words here"


def test_main_text_beside_long_boilerplate():
    w = main_text.default_weights()
    words = "Plain words make up the story that is told here at length , with care . " * 4
    notice = "<div class='ad'>" + "buy this now and save a lot of money today " * 6 + "</div>"
    body = words.strip()
    assert main_text.extract(f"<article><h1>Short title</h1>{notice}<p>{words}</p></article>", w)[0] == f"Short title\n{body}"
    assert main_text.extract(f"<main><p>{words}</p>{notice}<p>The<br>end.</p></main>", w)[0] == f"{body}\nThe end."
    page = f"<main><article><h1>One</h1>{notice}<p>{words}</p></article>{notice}<article><p>Other teaser</p></article></main>"
    assert main_text.extract(page, w)[0] == f"One\n{body}"


def test_main_text_references_are_decoded_run_by_run():
    w = main_text.default_weights()
    get = lambda inner: main_text.extract(f"<article><p>Some plain words {inner} here</p></article>", w)[0]
    assert get("&am<b>p;</b>") == "Some plain words &amp; here" and get("&amp;lt; &lt;b&gt;") == "Some plain words &lt; <b> here"
    assert get("&eacute;<i>&#233;</i>&nbsp;x") == "Some plain words éé x here"


def test_main_text_names_that_disagree():
    w = main_text.default_weights()
    prose = "Plain words make up the story that is told here at length , with care ."
    assert main_text.extract(f"<article><h1>Head</h1><section class='banner-story'><p>{prose}</p></section><p>{prose}</p></article>", w)[0] == f"Head\n{prose}\n{prose}"
    assert main_text.extract(f"<article><p>{prose}</p><div class='cookie-notice'>We use cookies</div><p>{prose}</p></article>", w)[0] == f"{prose}\n{prose}"


@pytest.mark.parametrize("unit", ["<div>a ", "<b>a ", "<svg>a ", "<p><button><b>a <div></div>", "<html><body>a ", "<li><b>x</i>", "</div>a ", "<a x=\">"])
def test_main_text_of_deep_pages_is_linear(unit):
    import time

    w = main_text.default_weights()
    began = time.time()
    main_text.extract(f"<article><p>Some words that stay here.</p>{unit * 50_000}</article>", w)
    assert time.time() - began < 15


def test_extraction_of_cut_pages():
    w = main_text.default_weights()
    assert main_text.extract("<article><p>Some words here now</p><p>and mo", w)[0] == "Some words here now\nand mo"
    assert main_text.extract("<article><p>Some words here now</p><foot", w)[0] == "Some words here now"
    assert main_text.extract("<article><p>Some words here now</p><!-- never ends <p>x</p>", w)[0] == "Some words here now"


def test_extraction_frames(spark):
    df = spark.createDataFrame([(1, None, None), (2, "u", "<article><p>é b c d</p></article>"), (2, "u", "<article><p>é b c d</p></article>")], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted(map(tuple, main_text.extract_pages(df).collect()), key=repr) == sorted([(1, None, "", 0), (2, "u", "é b c d", 7), (2, "u", "é b c d", 7)], key=repr)
    assert main_text.extract_pages(df.limit(0)).count() == 0


# --- all ---


def test_entry_registers_the_queries():
    import __spark_entry__ as e

    assert {n.split("_")[0] for n in entry.QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(entry.QUERIES) | {"pipeline"} <= set(e.queries())
    assert set(entry.ORACLE_SQL) <= set(entry.QUERIES)


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_twin(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = entry.QUERIES[name](spark, sf)
    found = con.execute(entry.ORACLE_SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in found.fetchall())
