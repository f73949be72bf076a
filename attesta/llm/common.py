"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The whole Parquet table; Spark's own reader, so any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; set one only where a local session names none."""
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(shared or f"/tmp/checkpoints/{uuid.uuid4().hex}")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bound the rows and bytes that one Arrow batch brings to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, rows back to back, and the n + 1 row borders. Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(borders: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of about `most` bytes; one longer row stays whole."""
    out, i, n = [], 0, len(borders) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(borders, borders[i] + most, "right")) - 1)
        out.append((i, j))
        i = j
    return out


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """The C library's own way to give freed memory back, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def released(work: Callable) -> Callable:
    """A generator over batches that gives its memory back when a partition ends; workers are reused."""

    @wraps(work)
    def run(*args, **named):
        try:
            yield from work(*args, **named)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := _trim():
                trim(0)

    return run
