"""Exact deduplication by deterministic block naming, DataFrame functions only.

Every text is cut into blocks of a fixed number of characters. Equal blocks get equal integer
names, different blocks different ones: blocks are dealt to buckets by a hash and named by their
rank in the bucket's sort order, so a name never rests on a hash. Adjacent names are then named
pairwise, round by round, until each document has one. Two texts are equal exactly when they took
equally many blocks and ended with the same name.

A block with very many copies would fill one bucket. Such blocks (over `hot_rows` occurrences and
over a hundred-thousandth of all, so a hundred thousand at most, which are told to all tasks by 8-byte
checks) are named from their distinct values, which a map-side combine leaves few of; their
occurrences are dealt out by as many salts as hold `hot_rows` each, and the names copied to those.
Groups are summed up before the shuffle and joined back as a table of their own, so that Spark can
split the rows of one hot group.

Null text is empty. Rows are judged one by one: repeated rows of one doc_id are copies of each
other, and all rows that bear the largest doc_id of a group are marked as kept. A null doc_id is
an id below all others. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.llm.common import ensure_checkpoint_dir, table

BUCKET_ROWS = 4000
#: A block with more than one in so many of all occurrences is hot.
HOT_SHARE = 100_000


def _rank_names(distinct_or_rows: DataFrame, keys: list[str], buckets: int, first_bucket: int = 0) -> DataFrame:
    """Adds `name`: bucket and rank of the keys in the bucket's sort order, packed in a long."""
    bucketed = distinct_or_rows.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)) + first_bucket)
    rank = F.dense_rank().over(Window.partitionBy("_b").orderBy(*keys))
    return bucketed.withColumn("name", F.col("_b") * F.lit(1 << 32) + rank).drop("_b")


def _blocks(docs: DataFrame, text: Column, block_chars: int) -> DataFrame:
    """One row for each block: id, h (check of the text), n blocks, sha (on the first), i, block."""
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    rows = rows.withColumn("n", F.greatest(F.lit(1), F.ceil(F.length("t") / block_chars)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring(F.col("t"), i * block_chars + 1, F.lit(block_chars)))
    return rows.select("id", F.xxhash64("t").alias("h"), "n", F.unhex(F.sha2("t", 256)).alias("sha"), F.posexplode(cut).alias("i", "block"))


def _pair_round(names: DataFrame) -> DataFrame:
    """(id, h, left, names[]) with the array halved: each adjacent pair replaced by its name."""
    spark = names.sparkSession
    at = lambda k: F.get(F.col("names"), k)
    pairs = F.transform(F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")), lambda k: F.struct(at(2 * k).alias("a"), F.coalesce(at(2 * k + 1), F.lit(-1).cast("long")).alias("b")))
    rows = names.select("id", "h", F.posexplode(pairs).alias("i", "p")).select("id", "h", "i", "p.a", "p.b")
    distinct = rows.select("a", "b").distinct()
    buckets = max(1, spark.conf.get("spark.sql.shuffle.partitions") and int(spark.conf.get("spark.sql.shuffle.partitions"))) * 4
    named = _rank_names(distinct, ["a", "b"], buckets)
    return _as_arrays(rows.join(named, ["a", "b"]))


def _as_arrays(rows: DataFrame) -> DataFrame:
    """A document's names in order; as long as the document, never longer."""
    listed = F.sort_array(F.collect_list(F.struct("i", "name")))
    return rows.groupBy("id", "h").agg(listed.alias("l")).select("id", "h", F.col("l.name").alias("names"))


def name_texts(docs: DataFrame, text: Column | None = None, *, block_chars: int = 8192, hot_rows: int = 1000) -> DataFrame:
    """(id, h, sha, n, name) for each row of docs; (n, name) is the identity of its text."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = _blocks(docs, F.col("text") if text is None else text, block_chars)
    counted = blocks.groupBy(F.xxhash64("block").alias("fp")).count()
    counted = counted.checkpoint()
    total = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    salts = F.ceil(F.col("count") / hot_rows).cast("int").alias("salts")
    # At most HOT_SHARE rows of 12 bytes, whatever the input.
    hot_fp = counted.where(F.col("count") > max(hot_rows, total // HOT_SHARE)).select("fp", salts)
    marked = blocks.withColumn("fp", F.xxhash64("block")).join(F.broadcast(hot_fp), "fp", "left")
    buckets = max(1, total // BUCKET_ROWS) + 16
    slim = lambda rows: rows.select("id", "h", "n", F.when(F.col("i") == 0, F.col("sha")).alias("sha"), "i", "name")
    cold = slim(_rank_names(marked.where("salts is null").select("id", "h", "n", "sha", "i", "block"), ["block"], buckets))
    held = marked.where("salts is not null")
    hot_names = _rank_names(held.select("block", "salts").distinct(), ["block"], 64, buckets)
    copies = hot_names.select("block", "name", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hot = slim(held.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.col("salts")).cast("int")).join(copies, ["block", "salt"]))
    rows = cold.unionByName(hot).checkpoint()
    first = rows.where("i = 0").select("id", "h", "n", "sha", "name")
    most = first.agg(F.max("n")).first()[0] or 1
    if most == 1:
        return first.select("id", "h", "sha", "n", "name")
    names, done = _as_arrays(rows.where("n > 1").select("id", "h", "i", "name").distinct()), None
    while most > 1:
        names, most = _pair_round(names).checkpoint(), -(-most // 2)
        ended = names.where("size(names) = 1").select("id", "h", F.col("names")[0].alias("last"))
        done = ended if done is None else done.unionByName(ended)
        names = names.where("size(names) > 1")
    long = first.where("n > 1").drop("name")
    long = long.join(done, long.id.eqNullSafe(done.id) & (long.h == done.h)).select(long.id, long.h, "sha", "n", F.col("last").alias("name"))
    return first.where("n = 1").select("id", "h", "sha", "n", "name").unionByName(long)


def exact_dedup(docs: DataFrame, text: Column | None = None, **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row; the largest doc_id of equal texts stays."""
    ensure_checkpoint_dir(docs.sparkSession)
    named = name_texts(docs, text, **options).checkpoint()
    groups = named.groupBy("n", "name").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).checkpoint()
    return named.join(groups, ["n", "name"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
