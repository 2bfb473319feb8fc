"""Inspection: dated documents that one writer publishes and readers get as long as they are fresh, so that no reader pays for the query."""

from __future__ import annotations

import json
import secrets
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.functions.contracts import Rules
from clickledger.operators import monitor, reconcile
from clickledger.operators.results import ResultStore, latest_associations, latest_metrics
from clickledger.sources.archive import ArchiveIndex
from clickledger.sources.files import LocalFiles

# Fixed values of the inspection contract.
MAX_SNAPSHOT_BYTES, SCHEMA_VERSION, MAX_CLOCK_SKEW_SECONDS = 4 << 20, 1, 5
COVERAGE_EVERY_SECONDS, METRICS_EVERY_SECONDS = 120, 30


class Unavailable(RuntimeError):
    """No document that may be served."""


class Snapshots:
    def __init__(self, root: str, files=None, clock: Callable[[], float] = time.time):
        self.root, self.files, self.clock = root.rstrip("/"), files or LocalFiles(), clock

    def publish(self, name: str, document: dict) -> None:
        """Replace a document; readers see the old or the new one, never a part."""
        data = json.dumps({"schema_version": SCHEMA_VERSION, "generated_at": self.clock(), "status": "ok", "document": document}, default=str).encode()
        if len(data) > MAX_SNAPSHOT_BYTES:
            raise ValueError("the document is too large to be published")
        self.files.replace(f"{self.root}/{name}.json", data)

    def publish_error(self, name: str, error: BaseException) -> None:
        """Say that a document could not be made; of the error only its type is told."""
        self.files.replace(f"{self.root}/{name}.json", json.dumps({"schema_version": SCHEMA_VERSION, "generated_at": self.clock(), "status": "error", "error": type(error).__name__}).encode())

    def refresh(self, name: str, make: Callable[[], dict]) -> bool:
        try:
            self.publish(name, make())
            return True
        except Exception as e:
            self.publish_error(name, e)
            return False

    def read(self, name: str, max_age: float) -> dict:
        """The document, if it is whole, of this schema, made without an error, and neither too old nor from the future."""
        data = self.files.read(f"{self.root}/{name}.json")
        if data is None or len(data) > MAX_SNAPSHOT_BYTES:
            raise Unavailable("no document")
        found = json.loads(data)
        if found.get("schema_version") != SCHEMA_VERSION or found.get("status") != "ok":
            raise Unavailable("the last refresh failed")
        if not -MAX_CLOCK_SKEW_SECONDS <= self.clock() - found["generated_at"] <= max_age:
            raise Unavailable("the document is out of date")
        return found["document"] | {"generated_at": found["generated_at"]}

    @contextmanager
    def single_writer(self, lease_seconds: float = 600.0):
        """Only one process refreshes at a time. The claim is one object with an end; a claim whose end has passed is taken over."""
        path, mine = f"{self.root}/writer.lock", secrets.token_hex(8)
        claim = json.dumps({"writer": mine, "until": self.clock() + lease_seconds}).encode()
        if not self.files.create(path, claim):
            held = json.loads(self.files.read(path) or b"{}")
            if held.get("until", 0) > self.clock():
                raise Unavailable("another writer is at work")
            self.files.delete(path)
            if not self.files.create(path, claim):
                raise Unavailable("another writer is at work")
        try:
            yield
        finally:
            if json.loads(self.files.read(path) or b"{}").get("writer") == mine:
                self.files.delete(path)


def coverage_document(acknowledged: DataFrame, archived: DataFrame, quality: DataFrame, samples: int = 100) -> dict:
    """Exact counts of receipts that are missing somewhere, with bounded samples; two dispositions of one receipt, or an archive that disagrees with an acknowledgement, fail it."""
    if reconcile.disposition_conflicts(quality).limit(1).count():
        raise ValueError("a receipt has two dispositions")
    if {"sha256", "offset"} <= set(acknowledged.columns) & set(archived.columns) and reconcile.acknowledgement_conflicts(acknowledged, archived).limit(1).count():
        raise ValueError("the archive disagrees with an acknowledgement")
    counts = reconcile.coverage(acknowledged, archived, quality).first().asDict()
    lists = {"missing": reconcile.missing_samples(acknowledged, archived, samples), "pending": reconcile.pending_samples(archived, quality, samples)}
    return counts | {f"{k}_samples": [r["receipt_id"] for r in v.collect()] for k, v in lists.items()} | {"archive_complete": counts["archive_missing"] == 0}


def operational_document(store: ResultStore, release_id: str, rules: Rules, now_ms: int) -> dict:
    """Pending conversions, freshness of the last five minutes, quality counts with the newest rejected rows, acknowledged and outstanding receipts, business sums, alerts."""
    quality, receipts = store.table("quality"), store.table("receipts")
    metrics = latest_metrics(store.results, release_id)
    fresh = monitor.freshness(store.table("visibility").where(F.col("release_id") == release_id), now_ms - 300_000).first()
    waiting = reconcile.outstanding_summary(reconcile.explode_manifests(receipts), quality).first()
    return {
        "pending": monitor.pending_count(latest_associations(store.results, release_id)).first()["pending"],
        "freshness": fresh.asDict(),
        "quality": [r.asDict() for r in monitor.bounded(monitor.quality_summary(quality), monitor.MAX_GROUPS)],
        "recent": [r.asDict() for r in monitor.recent_samples(quality).select("receipt_id", "disposition", "error_code", "inserted_at").collect()],
        "acknowledged": receipts.agg(F.coalesce(F.sum(F.size("receipt_ids")), F.lit(0)).alias("n")).first()["n"],
        "outstanding": waiting["n"],
        "oldest_outstanding_seconds": max(0.0, (now_ms - waiting["oldest"]) / 1000.0) if waiting["oldest"] is not None else 0.0,
        "business": [r.asDict() for r in monitor.bounded(monitor.business_rollup(metrics), monitor.MAX_SERIES)],
        "alerts": monitor.alerts(quality, fresh["p95_ms"], rules).first().asDict(),
    }


def operational_gauges(document: dict) -> dict:
    """The document as gauges for monitor.exposition()."""
    return {
        "pending_conversions": ("Conversions that wait for their click.", [({}, document["pending"])]),
        "outstanding_receipts": ("Acknowledged receipts without a disposition.", [({}, document["outstanding"])]),
        "freshness_p95_ms": ("From acceptance to visibility.", [({}, document["freshness"]["p95_ms"] or 0)]),
        "quality_rows": ("Rows by disposition.", [({"disposition": r["disposition"], "error_code": r["error_code"]}, r["n"]) for r in document["quality"]]),
        "business": ("Counters by cohort.", [({k: str(v) for k, v in r.items() if k != "value"}, r["value"]) for r in document["business"]]),
    }


class Inspector:
    """What the inspection endpoints answer: quality and reconciliation from dated documents, one receipt's trace from the indexes."""

    def __init__(self, snapshots: Snapshots, index: ArchiveIndex, store: ResultStore):
        self.snapshots, self.index, self.store = snapshots, index, store

    def quality(self) -> dict:
        found = self.snapshots.read("operations", 2 * METRICS_EVERY_SECONDS)
        return {k: found[k] for k in ("quality", "recent", "generated_at")}

    def reconcile(self) -> dict:
        return self.snapshots.read("coverage", 3 * COVERAGE_EVERY_SECONDS)

    def trace(self, receipt_id: str) -> dict:
        raw = [r.asDict() for r in self.index.trace(receipt_id)]
        if not raw:
            raise KeyError("unknown receipt")
        return {"receipt_id": receipt_id, "raw": raw, "quality": [r.asDict() for r in self.store.quality_of(receipt_id)]}

    def health(self) -> dict:
        """Whether the process can answer: each document's state."""
        out = {}
        for name, age in (("operations", 2 * METRICS_EVERY_SECONDS), ("coverage", 3 * COVERAGE_EVERY_SECONDS)):
            try:
                self.snapshots.read(name, age)
                out[name] = "ok"
            except Unavailable as e:
                out[name] = str(e)
        return out | {"ready": all(v == "ok" for v in out.values())}
