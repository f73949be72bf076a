"""Secret scans with corpus-wide ownership, DataFrame functions only.

Base candidates are matches of three patterns. Each candidate's value is hashed, and the hashes
are counted over the whole corpus by distinct repository and owner: a value of `example_owners`
owners or `example_repositories` repositories is a widely copied example; any other stays close to
its owner and looks live, and its exact span is added as kind `live`. Counting runs over distinct
(hash, owner, repository) rows that map-side combines have thinned, so a value in a third of all
documents costs a row for each task, owner and repository; the join that brings the verdict back
has one row for each value on its small side, so that Spark splits the other where it is skewed.

Positions are code points. `split` gives the text between matches, so the lengths of both, summed
up, place every match; sums run in stretches of matches, so that a text with very many costs in
proportion. Null text is empty; a null owner or repository counts as one of that name; repeated
rows each give their row and count once as owners; an empty table gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import ensure_checkpoint_dir, table

# The patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "live")
LEAST_VALUE = 12


#: Matches whose places are summed up in one go.
STRETCH = 256


def _bound(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(sizes: Column) -> Column:
    """Sums of the values before each one: array<int> in stretches, then stretches moved on by what is before them."""

    def stretch(part: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct((acc.at + x).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out"))
        return F.aggregate(part, begin, step)

    def moved(parts: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        step = lambda acc, p: F.struct((acc.at + p.at).alias("at"), F.concat(acc.out, F.array(F.transform(p.out, lambda x: x + acc.at))).alias("out"))
        return F.flatten(F.aggregate(parts, begin, step, lambda acc: acc.out))

    cut = lambda whole: F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / STRETCH).cast("int")), lambda k: stretch(F.slice(whole, k * STRETCH + 1, F.lit(STRETCH))))
    return _bound(sizes, lambda whole: _bound(cut(whole), moved))


def _starts(text: Column, pattern: str, matches: Column) -> Column:
    """Where each match begins: what is before it, plus the gap before it; one more, for the text's end."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    whole = lambda g: F.zip_with(g, matches, lambda gap, m: gap + F.coalesce(F.length(m), F.lit(0)))
    return _bound(gaps, lambda g: F.zip_with(_running(whole(g)), g, lambda before, gap: before + gap))


def _located(kind: int, text: Column, pattern: str, matches: Column) -> Column:
    """array of (start, kind, end, value) of a pattern's matches."""
    value = (lambda m: F.regexp_extract(m, pattern, 2)) if kind == 0 else (lambda m: m)
    row = lambda m, at: F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + F.length(m)).alias("end"), value(m).alias("value"))
    found = F.zip_with(matches, F.slice(_starts(text, pattern, matches), 1, F.greatest(F.size(matches), F.lit(1))), row)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(F.size(matches) > 0, found).otherwise(empty)


def _shown(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of start and kind."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s.kind + 1)
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", name(s), s.start.cast("string"), s.end.cast("string"))), ",")


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """doc_id, owner, repository, spans (base), values (hash, start, end of each candidate's value)."""
    rows = docs.select("doc_id", owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    patterns = (ASSIGN, ACCESS, HEX)
    for k, p in enumerate(patterns):
        rows = rows.withColumn(f"m{k}", F.regexp_extract_all("t", F.lit(p), F.lit(0)))
    found = F.concat(*(_located(k, F.col("t"), p, F.col(f"m{k}")) for k, p in enumerate(patterns)))
    rows = rows.select("doc_id", "owner", "repository", F.when(F.size("m0") + F.size("m1") + F.size("m2") > 0, F.filter(found, lambda s: F.length(s.value) >= LEAST_VALUE)).alias("found"))
    base = F.transform("found", lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    values = F.transform("found", lambda s: F.struct(F.sha2(s.value, 256).alias("hash"), (s.end - F.length(s.value)).alias("start"), s.end.alias("end")))
    none = "array<struct<start:int,kind:int,end:int>>"
    return rows.select("doc_id", "owner", "repository", F.coalesce(base, F.array().cast(none)).alias("base"), F.coalesce(values, F.array().cast("array<struct<hash:string,start:int,end:int>>")).alias("values"))


def ownership(found: DataFrame, *, example_owners: int = 2, example_repositories: int = 3) -> DataFrame:
    """hash, n_owners, n_repositories, live: of every candidate value in the corpus."""
    rows = found.select(F.explode("values.hash").alias("hash"), F.coalesce("owner", F.lit("\0")).alias("owner"), F.coalesce("repository", F.lit("\0")).alias("repository")).distinct()
    by_owner = rows.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    counted = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))
    return counted.withColumn("live", (F.col("n_owners") < example_owners) & (F.col("n_repositories") < example_repositories))


def scan(docs: DataFrame, owner: Column, repository: Column, *, example_owners: int = 2, example_repositories: int = 3) -> DataFrame:
    """doc_id, base, all (spans with `live` ones), n_live, n_example, owned for each row.

    owned: start, end, n_owners, n_repositories and live of each candidate value.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    # Texts are scanned once; what is kept of them is a few spans.
    found = candidates(docs, owner, repository).checkpoint()
    held = found.where(F.size("values") > 0).withColumn("key", F.xxhash64(_shown(F.col("base")), "values"))
    counts = ownership(found, example_owners=example_owners, example_repositories=example_repositories)
    # Equal rows of one doc_id hold equal values: they are judged once and joined to each.
    values = held.select("doc_id", "key", F.explode("values").alias("v")).distinct()
    judged = values.join(counts, values.v.hash == counts.hash).select("doc_id", "key", F.struct("v.start", "v.end", "n_owners", "n_repositories", "live").alias("o"))
    of = judged.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("o")).alias("owned"))
    of = of.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "owned")
    live = F.transform(F.filter("owned", lambda o: o.live), lambda o: F.struct(o.start.alias("start"), F.lit(3).alias("kind"), o.end.alias("end")))
    none = "array<struct<start:int,end:int,n_owners:bigint,n_repositories:bigint,live:boolean>>"
    rows = found.where(F.size("values") == 0).select("doc_id", "base", F.array().cast(none).alias("owned"))
    rows = rows.unionByName(held.join(of, held.doc_id.eqNullSafe(of.d) & (held.key == of.k)).select("doc_id", "base", F.col("owned").cast(none).alias("owned")))
    n_live = F.size(F.filter("owned", lambda o: o.live)).cast("bigint")
    return rows.select("doc_id", "base", F.concat("base", F.array_distinct(live)).alias("all"), n_live.alias("n_live"), (F.size("owned") - n_live).alias("n_example"), "owned")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Owner: the source; repository: the source's documents of one language."""
    found = scan(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("bigint")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_shown(F.col("base")), 256).alias("base_sha256"), _shown(F.col("all")).alias("spans"), "n_live", "n_example"
    )


def brute_force_live(rows: list[tuple], example_owners: int = 2, example_repositories: int = 3) -> list[set[tuple[int, int]]]:
    """Spans of live values of each (text, owner, repository)."""
    values, places = [], {}
    for text, owner, repository in rows:
        mine = []
        for kind, pattern in enumerate((ASSIGN, r"AKIA[A-Z0-9]+", r"[0-9a-f]+")):
            for m in re.finditer(pattern, text or "", re.A):
                v = m[2] if kind == 0 else m[0]
                if len(v) >= (12, 18, 16)[kind]:
                    mine.append((v, m.end() - len(v), m.end()))
                    places.setdefault(v, set()).add((owner, repository))
        values.append(mine)
    live = {v for v, at in places.items() if len({o for o, _ in at}) < example_owners and len(at) < example_repositories}
    return [{(a, b) for v, a, b in mine if v in live} for mine in values]


def brute_force(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, in order."""
    text, out = text or "", []
    for kind, (pattern, least) in enumerate(((ASSIGN, 12), (r"AKIA[A-Z0-9]+", 18), (r"[0-9a-f]+", 16))):
        for m in re.finditer(pattern, text, re.A):
            if len(m[2] if kind == 0 else m[0]) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)
