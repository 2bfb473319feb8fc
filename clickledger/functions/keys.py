"""Keys of the engine as columns, byte for byte."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickledger.functions.contracts import DIMENSIONS


def json_strings(*cols: Column | str) -> Column:
    """A JSON array of strings without its closing bracket."""
    text = F.to_json(F.array(*cols))
    return F.substring(text, F.lit(1), F.length(text) - 1)


def metric_key(policy: str, window: str = "window_start", cohort: str = "cohort_basis") -> Column:
    tail = F.to_json(F.array(F.col(cohort), F.lit(policy)))
    return F.concat(json_strings(*DIMENSIONS), F.lit(","), F.col(window).cast("string"), F.lit(","), F.substring(tail, F.lit(2), F.length(tail)))


def association_key(advertiser: str = "advertiser_id", app: str = "app_id", conversion: str = "conversion_id") -> Column:
    return F.to_json(F.array(advertiser, app, conversion))


def output_key(record_type: Column, key: Column) -> Column:
    return F.concat(F.when(record_type == "metric", "m:").otherwise("a:"), key)


def business_id() -> Column:
    """The id that is unique within advertiser, app and type."""
    return F.when(F.col("event_type") == "impression", F.col("impression_id")).when(F.col("event_type") == "click", F.col("click_id")).otherwise(F.col("conversion_id"))


def window_start(timestamp: Column, window_ms: int) -> Column:
    return (timestamp - F.pmod(timestamp, F.lit(window_ms))).cast("long")
