"""Shared pieces of the training-data operators: table reading, staging, and
numpy views of Arrow text columns inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sinks.staging import stage_parquet

Query = Callable[[SparkSession, str], DataFrame]
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

CHUNK_BYTES = 2 << 20
ROWS_PER_BATCH = 2_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> Iterator[None]:
    """Jobs started inside hand whole documents to Python in smaller Arrow batches,
    which both sides of the hand-over hold in memory outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Return freed memory to the system (where the C library can do so)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Task) -> Task:
    """``run`` as an Arrow task whose Python worker gives back at the end what it no
    longer needs: Spark keeps workers for later tasks, beside others and a JVM."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: one written copy in the shared checkpoint folder."""
    with small_batches(df.sparkSession):
        return stage_parquet(df, label)


def scratch(spark: SparkSession, label: str) -> str:
    return scratch_path(spark, "llm", label)


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column, without copying; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offset_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offset_buf, np.int64)[column.offset : column.offset + len(column) + 1]
    if data_buf is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data_buf, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def row_chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts hold at most ``max_bytes`` together.

    A single longer text is a slice of its own, whole.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def hash_sample(df: DataFrame, size: int, n_rows: int, h: Column) -> DataFrame:
    """About ``size`` of ``n_rows`` rows, by their 64-bit hash ``h`` (all, if fewer).

    A rate, not an ordered limit: that would send ``size`` rows of every
    partition to the driver.
    """
    share = F.shiftrightunsigned(h, 11) / F.lit(float(1 << 53))
    return df.where(share < F.lit(min(1.0, size / max(1, n_rows))))


def with_offsets(df: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """Per ``part`` (one row each in ``df``), the sum of ``total`` over smaller parts.

    ``df`` has one row per partition of an earlier job, so the single-task
    window handles as many rows as that job had tasks.
    """
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(part, F.coalesce(F.sum(total).over(w), F.lit(0)).cast("long").alias(out))


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, written steps.

    The cleaner acts when the driver's JVM collects its garbage, which a large
    driver heap may not do during a whole job.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
