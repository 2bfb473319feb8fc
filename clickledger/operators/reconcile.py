"""Exhaustive comparison of results and coverage of receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.functions.contracts import COUNTERS
from clickledger.operators.metrics import nonzero


def _comparable(metrics: DataFrame, associations: DataFrame, side: str) -> DataFrame:
    """(kind, key, side): the fields that must agree, of either kind in one typed struct; the other kind's are null."""
    none = lambda names, kind: [F.lit(None).cast(kind).alias(n) for n in names]
    counts, texts = sorted(COUNTERS), ("status", "reason", "experiment_id", "variant")
    m = metrics.where(nonzero()).select(F.lit("metric").alias("kind"), F.col("metric_key").alias("key"), F.struct(*[F.col(c).cast("bigint").alias(c) for c in counts], *none(texts, "string")).alias(side))
    a = associations.select(F.lit("association").alias("kind"), F.col("association_key").alias("key"), F.struct(*none(counts, "bigint"), *texts).alias(side))
    return m.unionByName(a)


def differences(expected: tuple[DataFrame, DataFrame], actual: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(kind, key, expected, actual) of every key that differs; zero metrics are as good as absent ones.

    One full outer join on (kind, key); null-safe inequality, so a missing side is a difference. Only rows that differ become text.
    """
    left, right = _comparable(*expected, "expected"), _comparable(*actual, "actual")
    differing = left.join(right, ["kind", "key"], "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))
    return differing.select("kind", "key", F.to_json("expected").alias("expected"), F.to_json("actual").alias("actual"))


def duplicate_keys(metrics: DataFrame, associations: DataFrame) -> DataFrame:
    """Keys that one side holds more than once: an error of that side, not a difference."""
    keys = metrics.where(nonzero()).select(F.lit("metric").alias("kind"), F.col("metric_key").alias("key")).unionByName(associations.select(F.lit("association").alias("kind"), F.col("association_key").alias("key")))
    return keys.groupBy("kind", "key").count().where("count > 1")


def report(expected: tuple[DataFrame, DataFrame], actual: tuple[DataFrame, DataFrame], sample_limit: int = 100) -> dict:
    """passed, the exact number of differences and an ordered, bounded sample of them."""
    if not 0 <= sample_limit <= 1000:
        raise ValueError("a sample of 0 to 1000 differences")
    for side in (expected, actual):
        if duplicate_keys(*side).limit(1).count():
            raise ValueError("duplicate business result key")
    diff = differences(expected, actual).persist()
    try:
        count = diff.count()
        sample = [r.asDict() for r in diff.orderBy("kind", "key").limit(sample_limit).collect()] if sample_limit else []
    finally:
        diff.unpersist()
    return {"passed": count == 0, "difference_count": count, "differences": sample, "sample_limit": sample_limit}


def outstanding(receipts: DataFrame, quality: DataFrame) -> DataFrame:
    """Acknowledged receipts without a terminal disposition: left anti join."""
    return receipts.join(quality.where("disposition <> 'signal'").select("receipt_id"), "receipt_id", "left_anti")


def outstanding_summary(receipts: DataFrame, quality: DataFrame) -> DataFrame:
    return outstanding(receipts, quality).agg(F.min("received_at").alias("oldest"), F.count("*").alias("n"))


def explode_manifests(manifests: DataFrame) -> DataFrame:
    """Receipt manifests (batch_id, received_at, receipt_ids) -> one row per receipt, with its place in the batch."""
    return manifests.select("batch_id", "received_at", F.posexplode("receipt_ids").alias("index", "receipt_id"))


def disposition_conflicts(quality: DataFrame) -> DataFrame:
    """Receipts with two different terminal dispositions."""
    terminal = quality.where("disposition <> 'signal'")
    return terminal.groupBy("receipt_id").agg(F.min("disposition").alias("a"), F.max("disposition").alias("b")).where("a <> b").select("receipt_id")


def acknowledgement_conflicts(acknowledged: DataFrame, archived: DataFrame) -> DataFrame:
    """Receipts whose archived topic, partition, offset or hash is not the acknowledged one."""
    fields = ("topic", "partition", "offset", "sha256")
    joined = acknowledged.select("receipt_id", F.struct(*fields).alias("ack")).join(archived.select("receipt_id", F.struct(*fields).alias("arc")), "receipt_id")
    differs = F.lit(False)
    for f in fields:
        differs = differs | ~F.col(f"ack.{f}").eqNullSafe(F.col(f"arc.{f}"))
    return joined.where(differs).select("receipt_id")


def coverage(acknowledged: DataFrame, archived: DataFrame, quality: DataFrame) -> DataFrame:
    """One row of exact counts over receipts: acknowledged, archived, classified, missing from the archive, awaiting a disposition, archived or classified without acknowledgement."""
    flag = lambda df, name: df.select("receipt_id").distinct().withColumn(name, F.lit(True))
    terminal = quality.where("disposition <> 'signal'")
    both = flag(acknowledged, "ack").join(flag(archived, "arc"), "receipt_id", "full_outer").join(flag(terminal, "cls"), "receipt_id", "full_outer")
    ack, arc, cls = (F.coalesce(F.col(n), F.lit(False)) for n in ("ack", "arc", "cls"))
    return both.agg(
        F.count_if(ack).alias("acknowledged"), F.count_if(arc).alias("archived"), F.count_if(cls).alias("classified"), F.count_if(ack & ~arc).alias("archive_missing"), F.count_if(arc & ~cls).alias("processing_pending"), F.count_if((arc | cls) & ~ack).alias("unacknowledged")
    )


def missing_samples(acknowledged: DataFrame, archived: DataFrame, limit: int = 100) -> DataFrame:
    return acknowledged.select("receipt_id").distinct().join(archived.select("receipt_id"), "receipt_id", "left_anti").orderBy("receipt_id").limit(limit)


def pending_samples(archived: DataFrame, quality: DataFrame, limit: int = 100) -> DataFrame:
    """Archived receipts that have no disposition yet, the first in order."""
    terminal = quality.where("disposition <> 'signal'").select("receipt_id")
    return archived.select("receipt_id").distinct().join(terminal, "receipt_id", "left_anti").orderBy("receipt_id").limit(limit)


def fingerprint(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """rows, and an order-free fingerprint of all rows: the sum of 60 bits of each row's MD5, over the columns in the order of their names. A null is told from an empty text."""
    cols = sorted(c for c in df.columns if c not in exclude)
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in cols])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("fingerprint"))
