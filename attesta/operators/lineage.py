"""Closures over lineage edges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoints(spark: SparkSession) -> None:
    """The cluster's shared folder; one of our own only where a local session names none."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(shared or f"/tmp/checkpoints/{uuid.uuid4().hex}")


def closure(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, ancestor): all pairs that lead from a node to an input, by path doubling.

    edges: (node, input). Each round joins paths end to end, so depth 2 ** r takes r rounds; the
    table of pairs is the result, and it is written out each round. A cycle ends when no pair is new.
    """
    spark = edges.sparkSession
    checkpoints(spark)
    paths = edges.select("node", F.col("input").alias("ancestor")).where("node is not null and input is not null").distinct().checkpoint()
    n = paths.count()
    for _ in range(most_rounds):
        on = paths.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("far"))
        paths = paths.unionByName(paths.join(on, "ancestor").select("node", F.col("far").alias("ancestor"))).distinct().checkpoint()
        last, n = n, paths.count()
        if n == last:
            return paths
    raise RuntimeError("lineage is deeper than the bound")


def reach(edges: DataFrame, start: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """start's rows (node, and any other columns) and those of all nodes that rest on its nodes, by edges (node, input).

    Each round follows edges from the rows that were new in the round before, so the work is that of
    the rows found; depth is the number of rounds.
    """
    checkpoints(edges.sparkSession)
    edges = edges.select(F.col("node").alias("_to"), F.col("input").alias("_from")).distinct().checkpoint()
    rest = [c for c in start.columns if c != "node"]
    reached = new = start.distinct().checkpoint()
    for _ in range(most_rounds):
        found = new.join(edges, new.node == edges["_from"]).select(F.col("_to").alias("node"), *rest).distinct()
        same = [found[c].eqNullSafe(reached[c]) for c in start.columns]
        new = found.join(reached, same, "left_anti").checkpoint()
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
    raise RuntimeError("lineage is deeper than the bound")


def kept(df: DataFrame) -> DataFrame:
    """df, computed once into the checkpoint folder, by columns: texts that repeat take a fraction of a checkpoint's rows."""
    checkpoints(df.sparkSession)
    at = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def depth(edges: DataFrame, most_rounds: int) -> int | None:
    """Edges of the longest path; None if it is longer than most_rounds, as on a cycle."""
    left = edges.select("node", "input").where("node is not null and input is not null")
    for r in range(most_rounds + 1):
        if left.isEmpty():
            return r
        left = kept(left.join(left.select(F.col("node").alias("input")).distinct(), "input", "left_semi").select("node", "input"))
    return None


def gathered(own: DataFrame, edges: DataFrame, most_rounds: int = 8) -> DataFrame:
    """(node, items): the distinct items of each node and of all that it rests on; nodes without any are left out.

    own: (node, item), read more than once; edges: (node, input). A round hands the items of each
    node on as one row for each edge, and nothing is written but its shuffle; the ids alone hold the
    rounds together. Deeper lineage than most_rounds, and a cycle, are swept by `reach`.
    """
    own = own.where("item is not null")
    rounds = depth(edges, most_rounds)
    if rounds is None:
        return reach(edges, own).groupBy("node").agg(F.collect_set("item").alias("items"))
    e = edges.select(F.col("node").alias("_to"), F.col("input").alias("_from")).where("_to is not null and _from is not null")
    known = own.where("node is not null")
    # Dealt as they are: lists that were begun before the shuffle would make it larger.
    step = known.repartition("node").groupBy("node").agg(F.collect_set("item").alias("items"))
    out = known.select("node").union(e.select("_to")).distinct()
    for r in range(rounds + 1):
        out = out.join(step.select("node", F.col("items").alias(f"_{r}")), "node", "left")
        moved = step.join(e, F.col("node") == F.col("_from")).select(F.col("_to").alias("node"), "items").repartition("node")
        step = moved.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    none = F.array().cast("array<string>")
    items = F.array_distinct(F.concat(*(F.coalesce(f"_{r}", none) for r in range(rounds + 1))))
    nameless = own.where("node is null").groupBy("node").agg(F.collect_set("item").alias("items"))
    return out.select("node", items.alias("items")).where(F.size("items") > 0).unionByName(nameless)


def cyclic(edges: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """Nodes on a cycle, or that rest on one; none in sound lineage.

    Nodes whose inputs are all peeled are peeled in turn; what is never peeled is left.
    """
    checkpoints(edges.sparkSession)
    left = edges.select("node", "input").where("node is not null and input is not null").distinct().checkpoint()
    n = left.count()
    for _ in range(most_rounds):
        held = left.select(F.col("node").alias("input")).distinct()
        left = left.join(held, "input", "left_semi").select("node", "input").checkpoint()
        last, n = n, left.count()
        if n == last:
            return left.select("node").distinct()
    raise RuntimeError("lineage is deeper than the bound")


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Inputs that aren't nodes."""
    return edges.select(F.col("input").alias("node")).distinct().join(nodes.select("node"), "node", "left_anti")


def and_reach(roots: DataFrame, inputs: DataFrame, outputs: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(item, round): items reached when a step fires only with all of its inputs reached.

    roots: (item); inputs: (step, item); outputs: (step, item). A round joins only the items that are
    new and adds to the counts of met inputs; only steps whose count grew can fire.
    """
    spark = roots.sparkSession
    checkpoints(spark)
    pairs = inputs.select("step", "item").distinct().checkpoint()
    need = pairs.groupBy("step").agg(F.count(F.lit(1)).alias("need")).checkpoint()
    reached = new = roots.select("item", F.lit(0).alias("round")).distinct().checkpoint()
    met = None
    for r in range(1, most_rounds + 1):
        grown = pairs.join(new.select("item"), "item").groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.lit(True).alias("fresh"))
        both = grown if met is None else grown.unionByName(met.withColumn("fresh", F.lit(False)))
        counted = both.groupBy("step").agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh")).checkpoint()
        fired = need.join(counted.where("fresh"), "step").where("need = n").select("step")
        met = counted.drop("fresh")
        found = outputs.join(fired, "step").select("item").distinct()
        new = found.join(reached, "item", "left_anti").withColumn("round", F.lit(r)).checkpoint()
        if new.isEmpty():
            return reached
        reached = reached.unionByName(new)
    raise RuntimeError("steps did not settle within the bound")
