"""Paged discovery and leases as streams: the same rules as the batch folds, with state per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OBSERVATION = "run_id string, record_id string, page bigint, payload string, observed_at timestamp"
REQUEST = "job_id string, event string, at timestamp"


def observations(spark: SparkSession, path: str, files_per_batch: int = 8) -> DataFrame:
    """Recorded pages as a file stream; offsets are Spark's checkpoint."""
    return spark.readStream.schema(OBSERVATION).option("maxFilesPerTrigger", files_per_batch).json(path)


def first_seen(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each record of a run once; state older than the watermark is dropped."""
    return stream.withWatermark("observed_at", late).dropDuplicatesWithinWatermark(["run_id", "record_id"])


def progress(stream: DataFrame, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Observed and distinct records of each run and window of event time."""
    return stream.withWatermark("observed_at", late).groupBy(F.window("observed_at", window).alias("w"), "run_id").agg(F.count(F.lit(1)).alias("observed"), F.approx_count_distinct("record_id").alias("records"))


def _discover(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A record's first digest is its state: a repeat of it counts, another digest is a change. A run that rests is forgotten."""
    if state.hasTimedOut:
        state.remove()
        return
    digest, repeats = state.get if state.exists else (None, 0)
    verdict, last = "duplicate", 0
    for b in batches:
        last = max(last, int(b["observed_at"].max().timestamp() * 1000))
        for payload in b["payload"]:
            if digest is None:
                digest, verdict = payload, "new"
            elif payload == digest:
                repeats += 1
            else:
                verdict = "changed"
    state.update((digest, repeats))
    # The watermark trails the latest observation; state lives this much longer than a record is seen.
    state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + REST_MS)
    yield pd.DataFrame([(*key, verdict, repeats)], columns=["run_id", "record_id", "verdict", "repeats"])


#: Event time after which a record that wasn't seen again is forgotten.
REST_MS = 24 * 3600 * 1000


def discover(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """run_id, record_id, verdict (new, duplicate, changed), repeats: conflicts that dropDuplicates can't see.

    State is kept for REST_MS of event time after a record was last seen, so it is bounded by what a day brings.
    """
    marked = stream.withWatermark("observed_at", late)
    return marked.groupBy("run_id", "record_id").applyInPandasWithState(_discover, "run_id string, record_id string, verdict string, repeats bigint", "digest string, repeats bigint", "update", GroupStateTimeout.EventTimeTimeout)


def verdicts(batch: DataFrame) -> DataFrame:
    """The batch twin of `discover` over all observations of a record."""
    kinds = F.count_distinct("payload")
    return batch.groupBy("run_id", "record_id").agg(F.when(kinds > 1, "changed").when(F.count(F.lit(1)) > 1, "duplicate").otherwise("new").alias("verdict"))


def leases(stream: DataFrame, ttl: str = "5 minutes") -> DataFrame:
    """Sessions of heartbeats: a job's lease ends when no beat comes within its time to live."""
    return stream.withWatermark("at", ttl).groupBy("job_id", F.session_window("at", ttl).alias("lease")).agg(F.count(F.lit(1)).alias("beats")).select("job_id", F.col("lease.start").alias("acquired_at"), F.col("lease.end").alias("expires_at"), "beats")


def commit(stream: DataFrame, path: str, checkpoint: str):
    """Append each micro-batch once: its id is part of the path, so a replay overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.outputMode("update" if _stateful(stream) else "append").option("checkpointLocation", checkpoint).foreachBatch(write)


def _stateful(stream: DataFrame) -> bool:
    return {"verdict", "repeats"} <= {f.name for f in stream.schema.fields if isinstance(f, T.StructField)}
