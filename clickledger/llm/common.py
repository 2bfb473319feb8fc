"""Helpers that several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every text contract here: space, tab, line feed, vertical tab, form feed, return.
ASCII_SPACE = " \t\n\x0b\f\r"

_fallback_dir: list[str] = []
#: The tables stored in the innermost temporary() block, if there is one.
_scratch: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a folder of our own where it is unset (local tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _fallback_dir:
        _fallback_dir.append("file://" + tempfile.mkdtemp(prefix="llm-shared-"))
    return _fallback_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends at a durable table."""
    path = new_path(df.sparkSession, name)
    if _scratch:
        _scratch[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(df: DataFrame) -> None:
    """Delete the files behind a table made by stored() that nothing reads any more."""
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        _delete(df.sparkSession, f)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables stored in the block are deleted at its end. What is made of them must have been written by then, outside of it or with kept()."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """stored(), but the table outlives the temporary() block."""
    out = stored(df, name)
    if _scratch:
        _scratch[-1].pop()
    return out


def give_back() -> None:
    """Return freed memory of a Python worker to the system at the end of a task: workers are reused, and what their allocators keep counts against the executor."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column), F.lit(""))
