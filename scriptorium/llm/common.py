"""Shared plumbing of the training-data operators: tables, the shared work folder, files."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..store import discard, fresh, get_file, materialise, open_fs, put_file, scratch, shared_root, work_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attempt() -> str:
    """The number of the running task's attempt, unique in the application: part of the names of files that a task writes,
    so that no attempt touches another's files."""
    return f"{TaskContext.get().taskAttemptId():x}{uuid.uuid4().hex[:6]}"


def slots(spark: SparkSession) -> int:
    """Shuffle partitions to aim at: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trim() -> None:
    """Gives memory that a finished task has freed back to the system: Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def text_bytes(col: pa.Array) -> tuple:
    """UTF-8 bytes of a string column without Python strings: (uint8 buffer, int64 starts, int64 lengths); null counts as empty."""
    import numpy as np

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    lens = np.diff(bounds)
    if col.null_count:
        lens = np.where(np.asarray(col.is_valid()), lens, 0)
    return data, bounds[:-1].copy(), lens
