"""Queries under a budget: of time, rows read, rows and bytes of the result. What exceeds it fails and is not cut."""

from __future__ import annotations

import secrets
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickledger.sources.files import HadoopFiles


class BudgetExceeded(RuntimeError):
    """A query would cost more than its budget."""


@dataclass(frozen=True)
class Budget:
    # Fixed values of the serving contract.
    seconds: float = 3.0
    rows_read: int = 2_000_000
    result_rows: int = 1_000_000
    result_bytes: int = 8 << 20


@contextmanager
def timed(df: DataFrame, seconds: float) -> Iterator[None]:
    """Jobs started in the block are cancelled when the time is over, and the block fails."""
    sc, tag = df.sparkSession.sparkContext, f"budget-{secrets.token_hex(8)}"
    over = threading.Event()

    def stop() -> None:
        over.set()
        sc.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    sc.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as e:
        if over.is_set():
            raise BudgetExceeded("the query took too long") from e
        raise
    finally:
        timer.cancel()
        sc.removeJobTag(tag)


def leaf_rows(df: DataFrame) -> int:
    """Rows that the scans of a plan read: the optimiser's count where it has one, else counted from the footers of the scanned files."""
    stack, total = [df._jdf.queryExecution().optimizedPlan()], 0
    unknown = False
    while stack:
        node = stack.pop()
        below = node.children()
        if below.size():
            stack += [below.apply(i) for i in range(below.size())]
            continue
        count = node.stats().rowCount()
        unknown |= count.isEmpty()
        total += 0 if count.isEmpty() else int(str(count.get()))
    files = df.inputFiles() if unknown else []
    if files:  # Parquet answers a count from its footers
        total += df.sparkSession.read.parquet(*files).count() if all(f.endswith(".parquet") for f in files) else 0
    return total


def buffered(df: DataFrame, budget: Budget = Budget()) -> list:
    """All rows of a small result."""
    if leaf_rows(df) > budget.rows_read:
        raise BudgetExceeded("the query would read too many rows")
    with timed(df, budget.seconds):
        rows = df.limit(budget.result_rows + 1).collect()
    if len(rows) > budget.result_rows or sum(len(str(v)) for r in rows for v in r if v is not None) > budget.result_bytes:
        raise BudgetExceeded("the result is too large")
    return rows


def streamed(df: DataFrame, budget: Budget = Budget(seconds=120.0, rows_read=100_000_000)) -> Iterator:
    """Rows one partition at a time, so that the driver holds one; the time of the reader counts."""
    if leaf_rows(df) > budget.rows_read:
        raise BudgetExceeded("the query would read too many rows")
    began, n = time.monotonic(), 0
    for row in df.toLocalIterator():
        n += 1
        if n > budget.result_rows:
            raise BudgetExceeded("the result has too many rows")
        if time.monotonic() - began > budget.seconds:
            raise BudgetExceeded("the query took too long")
        yield row


def spooled(df: DataFrame, folder: str, max_bytes: int = 8 << 30) -> Iterator:
    """Rows for a slow reader: the result is written first, so that no query waits for the reader, and deleted at the end."""
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/spool-{secrets.token_hex(8)}"
    files = HadoopFiles(spark)
    try:
        df.write.parquet(path)
        p, fs = files._at(path)
        if fs.getContentSummary(p).getLength() > max_bytes:
            raise BudgetExceeded("the result is too large to be spooled")
        yield from spark.read.schema(df.schema).parquet(path).toLocalIterator()
    finally:
        files.delete(path)


__all__ = ["Budget", "BudgetExceeded", "buffered", "leaf_rows", "spooled", "streamed", "timed"]
