"""The streaming clean query: raw packets in, dispositions out.

Validation and the rule filter are the batch expressions. Deduplication is keyed state with a processing-time horizon from the
first acceptance, which duplicates do not extend: by event id, then by business key among the survivors.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from clickledger.functions.contracts import INTEGER_FIELDS, TEXT_FIELDS, Rules
from clickledger.functions.keys import business_id
from clickledger.operators.validate import _first_error, parse


def staged(packets: DataFrame, rules: Rules) -> DataFrame:
    """Typed packets with error_code, null where only deduplication can still reject them. Stateless."""
    checked = parse(packets, rules).withColumn("detail", _first_error())
    stopped = (
        F.when(F.col("detail").isNotNull(), "SCHEMA_INVALID")
        .when(~F.col("schema_version").isin(*rules.schema_versions), "SCHEMA_VERSION_DISABLED")
        .when((F.col("event_time") < rules.effective_from) | (F.coalesce(F.col("region").isin(*rules.filter_regions), F.lit(False)) if rules.filter_regions else F.lit(False)), "RULE_FILTERED")
    )
    return checked.drop("_event", "_unexpected").withColumn("error_code", stopped)


class FirstWithin(StatefulProcessor):
    """Marks all but the first open row of a key within the horizon, on the processing-time clock. State expires by its time to live, which only an acceptance starts."""

    def __init__(self, horizon_ms: int, code: str):
        self.horizon_ms, self.code = horizon_ms, code

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.until = handle.getValueState("until", "until long", ttlDurationMs=self.horizon_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self.until.get()
        until = held[0] if held is not None and held[0] > now else None
        parts = list(rows)
        pdf = pd.concat(parts).sort_values("ordinal", kind="stable")
        codes = pdf["error_code"].tolist()
        for i, c in enumerate(codes):
            if c is not None and c == c:
                continue
            if until is None:
                until = now + self.horizon_ms
                self.until.update((until,))
            else:
                codes[i] = self.code
        pdf["error_code"] = codes
        yield pdf.drop(columns=["_key"], errors="ignore")

    def close(self) -> None:
        pass


def _once(rows: DataFrame, key, rules: Rules, code: str) -> DataFrame:
    open_ = F.col("error_code").isNull()
    keyed = rows.withColumn("_key", F.when(open_, key).otherwise(F.concat(F.lit("rejected:"), F.col("receipt_id"))))
    schema = StructType([f for f in rows.schema.fields])
    return keyed.groupBy("_key").transformWithStateInPandas(FirstWithin(rules.dedup_ms, code), outputStructType=schema, outputMode="append", timeMode="ProcessingTime")


def dispositions(packets: DataFrame, rules: Rules) -> DataFrame:
    """Every packet with its disposition; like the batch result where duplicates come within the horizon."""
    scope = F.to_json(F.array("advertiser_id", "app_id"))
    once = _once(staged(packets, rules), F.concat(F.lit("id:"), scope, F.col("event_id")), rules, "DUPLICATE_EVENT_ID")
    twice = _once(once, F.concat(F.lit("key:"), scope, F.col("event_type"), F.lit(":"), business_id()), rules, "DUPLICATE_BUSINESS_KEY")
    code = F.coalesce("error_code", F.lit("OK"))
    return twice.withColumn("error_code", code).withColumn("disposition", F.when(code == "OK", "cleaned").when(code.startswith("DUPLICATE"), "duplicate").when(code == "RULE_FILTERED", "filtered").otherwise("quarantined"))


CLEAN_COLUMNS = ("ordinal", "receipt_id", "received_at", *TEXT_FIELDS, *[n for n in INTEGER_FIELDS if n != "received_at"])
