"""graph_policy_eval: two small shuffles, and the rows that the general operators give over the edges."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from attesta.operators import governance, lineage
from attesta.plans.governance import lifecycle
from attesta.plans.lineage import graph_policy_eval
from attesta.sources import evidence
from attesta.sources.records import NOW


def over_edges(spark, d):
    """The same by joins and the edges, a node at a time."""
    how = "search_visibility", "researcher", F.lit(NOW)
    x, one, two, edges = (evidence.family(spark, d, n) for n in ("pn_contribution", "pn_derived", "pn_merged", "pn_edge"))
    share = ["consents", "purpose_code", "retention_expires_day", "confidentiality", "allowed_uses", "allowed_audiences"]
    from_x = x.withColumn("consents", F.array("consent_id")).select(F.concat(F.lit("derived_"), F.floor(F.col("k") / 4)).alias("node"), *share)
    from_one = one.select(F.concat(F.lit("merged_"), F.floor(F.col("j") / 3)).alias("node"), *share)
    own = governance.native_operation(x, lifecycle(spark, d), *how).select(F.col("contribution_id").alias("node"), "reasons")
    own = own.unionByName(governance.drift(one.unionByName(two), from_x.unionByName(from_one), *how))
    found = governance.graph_reasons(own, edges, lineage.gathered)
    return found.select("node", F.array_join(F.array_sort("reasons"), ",").alias("reasons"))


def rows(df):
    return sorted(tuple(r) for r in df.select("node", "reasons").collect())


def moved(plan):
    """Bytes written by the shuffles of a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return moved(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return moved(plan.plan())
    own = plan.metrics().apply("shuffleBytesWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(moved(plan.children().apply(i)) for i in range(plan.children().size()))


def test_little_is_moved_and_nothing_is_kept(spark):
    """Disk: shuffles of less than four times the orders and customers, and no file beside them."""
    d = "/root/testdata/sf0.01"
    lineage.checkpoints(spark)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    held = lambda: at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    before = held()
    df = graph_policy_eval(spark, d)
    assert len(df.collect()) == 18240
    assert held() == before
    assert moved(df._jdf.queryExecution().executedPlan()) < 4 * sum(os.path.getsize(f"{d}/{t}.parquet") for t in ("orders", "customer"))


def test_layers_give_what_the_edges_give(spark, sf):
    assert rows(graph_policy_eval(spark, sf)) == rows(over_edges(spark, sf))


def test_odd_orders(spark, tmp_path):
    d = str(tmp_path)
    orders = [(5, 34), (5, 34), (5, 13), (6, 17), (7, 1), (40, 22)]  # an order twice, and once more for another customer
    orders += [(25, 97), (26, 89), (27, None), (28, 10**9), (35, 31), (101, 19), (10**15, 5)]  # records that aren't linked, no customer at all
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{d}/orders.parquet")
    spark.range(120).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey")).write.parquet(f"{d}/customer.parquet")
    found = rows(graph_policy_eval(spark, d))
    assert len(found) > len(orders) and found == rows(over_edges(spark, d))


def test_packed_reasons_come_back(spark):
    lists = [[], list(governance.USUAL), ["consent:lost", "retention:review"], ["a,b", 'c"d'], [governance.USUAL[0]], [governance.USUAL[-1]]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(lists)], "i int, reasons array<string>")
    bits, rest = governance.packed(F.col("reasons"))
    got = {r.i: r for r in df.select("i", bits.alias("bits"), rest.alias("rest")).select("*", governance.unpacked(F.col("bits"), F.col("rest")).alias("reasons")).collect()}
    assert all(sorted(got[i].reasons) == sorted(r) for i, r in enumerate(lists))
    assert got[1].rest is None and got[2].rest == ["consent:lost"]
