"""Intermediate tables in the folder that all executors share, and what is true of tables whatever they hold."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []
#: Tables stored by this process and not removed yet: (session, path).
_MADE: list[tuple[SparkSession, str]] = []
#: A table of fewer bytes than this for each thread is dealt out to all threads: its file may be one row group, so one task.
SMALL_BYTES = 16 << 20


def fresh(columns: list[str], stem: str) -> str:
    """stem, or stem with underscores after it: a name that none of the columns has in either case."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or the one that the context was given by setCheckpointDir. Where both are
    unset a temporary folder is made if the master is local (tests), as all tasks see it there; on a cluster it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="scriptorium-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder (URI) below the shared root, one for each call."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: cuts lineage and survives lost executors. The table stays
    until ``discard``; what a returned result still reads must stay."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    _MADE.append((spark, path))
    return out


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _MADE[:] = [x for x in _MADE if x[1] != path]


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialise`` stored, once nothing reads them any more; other tables are left alone."""
    for df in tables:
        if path := getattr(df, "stored_at", None):
            _remove(df.sparkSession, path)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes at its end all tables stored inside, but for those given to the function that it yields."""
    before, kept = {path for _, path in _MADE}, set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df.stored_at)
        return df

    yield keep
    for spark, path in list(_MADE):
        if path not in before and path not in kept:
            _remove(spark, path)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or of an absolute path, and the path in it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def put_file(uri: str, data) -> None:
    """Writes a whole file under a name of its own and renames it, so that a repeated task leaves one whole file."""
    fs, path = open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temp = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with fs.open_output_stream(temp) as out:
        out.write(data)
    fs.move(temp, path)


def get_file(uri: str) -> bytes:
    fs, path = open_fs(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def spread(df: DataFrame) -> DataFrame:
    """df dealt out to all threads if it is small by the engine's own estimate; large tables come in enough row groups."""
    threads = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(threads) if size < threads * SMALL_BYTES else df
