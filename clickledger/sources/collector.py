"""The collector: accepted batches, committed as a whole.

A batch is two objects: its raw records and the manifest of its receipts. The manifest is created last; records without one were never
acknowledged and no reader sees them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.sources.files import LocalFiles
from clickledger.sources.packets import ENVELOPE, Rejected, accept_batch


class Collector:
    def __init__(self, root: str, files=None, clock: Callable[[], float] = time.time):
        self.root, self.files, self.clock = root.rstrip("/"), files or LocalFiles(), clock

    def accept(self, body: bytes) -> dict:
        """Commit the events of a request body; the receipts. A batch that cannot be confirmed is rejected with 503 and leaves nothing behind that a reader would see."""
        events, client = accept_batch(body)
        batch, now = str(uuid.uuid4()), int(self.clock() * 1000)
        rows = [{"batch_id": batch, "client_batch_id": client, "receipt_id": f"{batch}:{i}", "index": i, "received_at": now, "event": e} for i, e in enumerate(events)]
        receipts = {"batch_id": batch, "client_batch_id": client, "received_at": now, "receipt_ids": [r["receipt_id"] for r in rows]}
        raw, manifest = f"{self.root}/raw/{batch}.json", f"{self.root}/receipts/{batch}.json"
        try:
            stored = self.files.create(raw, "".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) + "\n" for r in rows).encode()) and self.files.create(manifest, json.dumps(receipts).encode())
        except Exception as e:
            self._undo(raw)
            raise Rejected(503, "the batch could not be committed") from e
        if not stored:
            self._undo(raw)
            raise Rejected(503, "the batch could not be committed")
        return receipts

    def _undo(self, path: str) -> None:
        try:
            self.files.delete(path)
        except Exception:  # noqa: S110 - without its manifest the object does not count
            return


def receipts(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, client_batch_id, received_at, receipt_ids) of the committed batches."""
    return spark.read.schema("batch_id string, client_batch_id string, received_at bigint, receipt_ids array<string>").json(f"{root.rstrip('/')}/receipts")


def committed(spark: SparkSession, root: str) -> DataFrame:
    """Envelopes of the committed batches."""
    raw = spark.read.schema(ENVELOPE).json(f"{root.rstrip('/')}/raw")
    return raw.join(receipts(spark, root).select("batch_id"), "batch_id", "left_semi").select(*raw.columns)


def visible_of_prefix(visibility: DataFrame, batches: DataFrame, prefix: str) -> DataFrame:
    """Visibility rows of the receipts whose client batch id starts with a prefix: one load's part of the traffic."""
    mine = batches.where(F.col("client_batch_id").startswith(prefix)).select(F.explode("receipt_ids").alias("receipt_id"))
    return visibility.join(mine, "receipt_id", "left_semi")
