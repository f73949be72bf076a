"""Joins that the record families need beyond a plain equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exactly_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left whose keys match one row of right, no more and no less."""
    counted = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    return left.join(right, keys).join(counted, keys, "left_semi")


def current_equals(snapshot: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """Snapshot rows whose current record is the same, null-safe; a missing one is not."""
    now = current.select(F.col(key).alias("_k"), F.col(digest).alias("_d"), F.lit(True).alias("_there"))
    return snapshot.join(now, snapshot[key] == F.col("_k"), "left").where(F.col("_there") & F.col(digest).eqNullSafe(F.col("_d"))).drop("_k", "_d", "_there")


def contains_all(required: Column, held: Column) -> Column:
    """Every required element is held."""
    return F.coalesce(F.size(F.array_except(required, held)) == 0, F.lit(False))


def wildcard(layer: Column, value: Column) -> Column:
    """A layer without a value covers all."""
    return layer.isNull() | (layer == value)


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key; a max of a struct combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*(c.alias(f"_o{i}") for i, c in enumerate(order)), *rest)
    return df.groupBy(*keys).agg(F.max(row).alias("_r")).select(*keys, *(F.col("_r")[c].alias(c) for c in rest))


def generation_diff(previous: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """key, change: added, removed, changed or unchanged between two generations."""
    p = previous.select(F.col(key).alias("pk"), F.col(digest).alias("pd"))
    c = current.select(F.col(key).alias("ck"), F.col(digest).alias("cd"))
    change = F.when(F.col("pk").isNull(), "added").when(F.col("ck").isNull(), "removed").when(F.col("pd").eqNullSafe(F.col("cd")), "unchanged").otherwise("changed")
    return p.join(c, F.col("pk") == F.col("ck"), "full_outer").select(F.coalesce("ck", "pk").alias(key), change.alias("change"))


def partners(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, likely_high, likely_medium, conflicting, class_id: how other rows compare on the fields that both have.

    likely: all shared fields agree, more than one of them (high) or just one (medium); conflicting:
    some agree and some don't. class_id: the least key with the same fields, null-safe. No pair is
    made: for each subset of fields the rows that share its values are counted by which fields they
    have, and inclusion and exclusion over the subsets gives the rows that share one at least.
    """
    every = range(1, 1 << len(fields))
    names = lambda mask: [f for i, f in enumerate(fields) if mask >> i & 1]
    has = sum((F.when(F.col(f).isNotNull(), F.lit(1 << i)).otherwise(0) for i, f in enumerate(fields)), F.lit(0))
    rows = rows.withColumn("_has", has)
    same = [F.col(f) for f in fields]
    classes = rows.groupBy(*(F.coalesce(c, F.lit("\0")).alias(f"_c{i}") for i, c in enumerate(same))).agg(F.min(key).alias("class_id"))
    out = rows.select("*", *(F.coalesce(c, F.lit("\0")).alias(f"_c{i}") for i, c in enumerate(same))).join(classes, [f"_c{i}" for i in range(len(fields))])
    for s in every:
        known = rows.dropna(subset=names(s)).groupBy(*names(s), "_has").agg(F.count(F.lit(1)).alias("n"))
        # A handful of entries: which fields a row can have.
        by = known.groupBy(*names(s)).agg(F.map_from_entries(F.collect_list(F.struct("_has", "n"))).alias(f"_n{s}"))
        out = out.join(by, names(s), "left")
    own = F.col("_has")
    count = lambda s, q: F.coalesce(F.element_at(f"_n{s}", F.lit(q)), F.lit(0)) - F.when((own == q) & own.bitwiseAND(F.lit(s)).eqNullSafe(F.lit(s)), 1).otherwise(0)
    high = medium = conflicting = F.lit(0)
    for q in every:
        some = sum((count(s, q) * (1 if len(names(s)) % 2 else -1) for s in every if s & q == s), F.lit(0))
        shared = own.bitwiseAND(F.lit(q))
        agree = lambda wide: F.coalesce(*(F.when(shared == s, count(s, q)) for s in every if s & q == s and (len(names(s)) > 1) == wide), F.lit(0)) if any(s & q == s and (len(names(s)) > 1) == wide for s in every) else F.lit(0)  # noqa: B023, E731
        h, m = agree(True), agree(False)
        high, medium, conflicting = high + h, medium + m, conflicting + some - h - m
    big = lambda c, name: c.cast("bigint").alias(name)
    return out.select(key, big(high, "likely_high"), big(medium, "likely_medium"), big(conflicting, "conflicting"), "class_id")


def capable(required: DataFrame, held: DataFrame) -> DataFrame:
    """required, held: pairs of sets of which the second has all of the first, by counting shared elements.

    Both sides are distinct sets, so this is as small as the vocabulary of sets.
    """
    r = required.select("required", F.explode("required").alias("e"))
    h = held.select("held", F.explode("held").alias("e"))
    return r.join(h, "e").groupBy("required", "held").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == F.size("required")).drop("n")


def token_pairs(records: DataFrame, most_postings: int = 100, least_milli: int = 200) -> DataFrame:
    """first, second, similarity_milli: records of different sources that share a rarer token.

    records: (record_id, source_id, tokens). Tokens with over `most_postings` records bring no
    candidates, as the semantics have it; the similarity is over all tokens, rounded half to even.
    """
    posted = records.select("record_id", "source_id", F.explode(F.filter("tokens", lambda t: F.length(t) > 1)).alias("token"))
    rare = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(f"n <= {most_postings}").select("token")
    kept = posted.join(rare, "token")
    a = kept.select("token", F.col("record_id").alias("first"), F.col("source_id").alias("sa"))
    b = kept.select("token", F.col("record_id").alias("second"), F.col("source_id").alias("sb"))
    pairs = a.join(b, "token").where((F.col("first") < F.col("second")) & (F.col("sa") != F.col("sb"))).select("first", "second").distinct()
    t1 = records.select(F.col("record_id").alias("first"), F.col("tokens").alias("t1"))
    t2 = records.select(F.col("record_id").alias("second"), F.col("tokens").alias("t2"))
    milli = F.bround(F.lit(1000.0) * F.size(F.array_intersect("t1", "t2")) / F.size(F.array_union("t1", "t2")), 0).cast("bigint")
    return pairs.join(t1, "first").join(t2, "second").select("first", "second", milli.alias("similarity_milli")).where(f"similarity_milli >= {least_milli}")


def hash_ranked(df: DataFrame, group: str, identity: Column, k: int) -> DataFrame:
    """A deterministic sample: the k rows of each group that come first by digest."""
    order = Window.partitionBy(group).orderBy("_h", identity)
    return df.withColumn("_h", F.sha2(identity, 256)).withColumn("place", F.row_number().over(order)).where(f"place <= {k}").drop("_h")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, digest: str) -> tuple[DataFrame, DataFrame]:
    """(new rows, conflicts): rows of unknown keys, and rows whose key is stored with other content."""
    known = stored.select(F.col(key).alias("_k"), F.col(digest).alias("_d"))
    new = incoming.join(known, incoming[key] == F.col("_k"), "left_anti")
    conflicts = incoming.join(known, incoming[key] == F.col("_k")).where(~F.col(digest).eqNullSafe(F.col("_d"))).drop("_k", "_d")
    return new, conflicts


def variant_pairs(records: DataFrame, most_postings: int = 100) -> DataFrame:
    """first, second, similarity_milli: records of different sources that share a rarer token, by their most alike variants.

    records: (record_id, source_id, variants), a variant being the tokens of one title.
    """
    tokens = records.select("record_id", "source_id", F.array_distinct(F.flatten("variants")).alias("tokens"))
    pairs = token_pairs(tokens, most_postings, 0).select("first", "second")
    side = lambda name, v: records.select(F.col("record_id").alias(name), F.filter("variants", lambda x: F.size(x) > 0).alias(v))
    alike = lambda x, y: F.lit(1000.0) * F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
    best = F.array_max(F.flatten(F.transform("v1", lambda x: F.transform("v2", lambda y: alike(x, y)))))
    return pairs.join(side("first", "v1"), "first").join(side("second", "v2"), "second").select("first", "second", F.bround(best, 0).cast("bigint").alias("similarity_milli"))


def exact_sets(expected: DataFrame, observed: DataFrame, keys: list[str], item: str) -> DataFrame:
    """keys, missing, unexpected, exact: whether the observed items of a key are just the expected ones, by counting both sides."""
    both = expected.select(*keys, item, F.lit(1).alias("w")).distinct().unionByName(observed.select(*keys, item, F.lit(2).alias("w")).distinct())
    each = both.groupBy(*keys, item).agg(F.sum("w").alias("w"))
    out = each.groupBy(*keys).agg(F.count_if(F.col("w") == 1).alias("missing"), F.count_if(F.col("w") == 2).alias("unexpected"))
    return out.withColumn("exact", (F.col("missing") == 0) & (F.col("unexpected") == 0))


def held_work(items: DataFrame, blockers: DataFrame, scopes: list[str]) -> DataFrame:
    """Items with `held`: whether a blocker of any scope names what the item has there. blockers: (scope, subject)."""
    fields = F.array(*(F.struct(F.lit(s).alias("scope"), F.col(s).alias("subject")) for s in scopes))
    hit = items.select("item", F.inline(fields)).join(blockers, ["scope", "subject"], "left_semi").select("item", F.lit(True).alias("held")).distinct()
    return items.join(hit, "item", "left").withColumn("held", F.coalesce("held", F.lit(False)))
