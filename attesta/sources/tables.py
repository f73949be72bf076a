"""Reading the star-schema and corpus tables, and JSON artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTIFACT_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_artifact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A strict read of one JSON document: known schema, no repair; over 8 MiB is refused."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    if size is None or size > ARTIFACT_BYTES:
        raise ValueError("artifact is missing or over its size limit")
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def bundle(artifact: DataFrame, arrays: list[str]) -> dict[str, DataFrame]:
    """Each record array of a one-row artifact as a frame of its own; other arrays are refused."""
    extra = set(artifact.columns) - set(arrays)
    if extra:
        raise ValueError(f"unknown record arrays: {sorted(extra)}")
    return {a: artifact.select(F.inline(a)) for a in arrays if a in artifact.columns}


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """record_type, record_id, body (JSON), updated_at: one polymorphic table from three."""
    orders, events, pages = (table(spark, sf_dir, t) for t in ("orders", "events", "pages"))
    body = lambda *c: F.to_json(F.struct(*c))
    return (
        orders.select(F.lit("object_receipt").alias("record_type"), F.concat(F.lit("receipt_"), "o_orderkey").alias("record_id"), body("o_custkey", "o_orderstatus").alias("body"), F.col("o_orderdate").alias("updated_at"))
        .unionByName(events.select(F.lit("job").alias("record_type"), F.concat(F.lit("job_"), "event_id").alias("record_id"), body("user_id", "event_type").alias("body"), F.col("ts").alias("updated_at")))
        .unionByName(pages.select(F.lit("evidence").alias("record_type"), F.concat(F.lit("evidence_"), "page_id").alias("record_id"), body("url").alias("body"), F.lit(None).cast("timestamp").alias("updated_at")))
    )


def digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, length, sha of whole files, as bytes."""
    return spark.read.format("binaryFile").load(paths).select("path", "length", F.sha2("content", 256).alias("sha"))
