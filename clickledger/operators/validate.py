"""Validation and disposition: every packet gets exactly one of quarantined, filtered, duplicate, cleaned.

The event is parsed once into a map of variants; the closed contract is one boolean expression
over it, so validation, rule filter and typing run in a single codegen stage before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickledger.functions.contracts import ENUMS, INTEGER_FIELDS, MAX_EVENT_ID, PATTERNS, REQUIRED, REQUIRED_BY_TYPE, TEXT_FIELDS, Rules
from clickledger.functions.keys import business_id

_MAP = "map<string,variant>"


def _field(name: str) -> Column:
    return F.try_element_at("_event", F.lit(name))


def _kind(name: str) -> Column:
    """The JSON type of a field as Spark names it; null if the field is absent."""
    return F.schema_of_variant(_field(name))


def _text(name: str) -> Column:
    return F.when(_kind(name) == "STRING", F.try_variant_get(_field(name), "$", "string"))


def _integer(name: str) -> Column:
    """A JSON number without a fraction (1 and 1.0 alike) as bigint; null for anything else, booleans and numeric text included."""
    kind, exact = _kind(name), F.try_variant_get(_field(name), "$", "decimal(38,18)")
    whole = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
    wide = F.try_variant_get(_field(name), "$", "double")
    return F.when(kind == "BIGINT", F.try_variant_get(_field(name), "$", "bigint")).when(kind.startswith("DECIMAL"), whole).when(kind.isin("DOUBLE", "FLOAT") & (wide == F.floor(wide)), wide.try_cast("bigint"))


def _renamed(source: str, target: str) -> Column:
    """_event with a field renamed, if it is there and its new name is not taken."""
    applies = F.map_contains_key("_event", F.lit(source)) & ~F.map_contains_key("_event", F.lit(target))
    rest = F.map_filter("_event", lambda name, _: name != source)
    return F.when(applies, F.map_concat(rest, F.create_map(F.lit(target), F.try_element_at("_event", F.lit(source))))).otherwise(F.col("_event"))


def parse(packets: DataFrame, rules: Rules) -> DataFrame:
    """packets plus _event (fields by name, mapped; null unless the event is an object), _unexpected (has other fields) and the typed columns of the contract."""
    event = F.try_variant_get(F.try_parse_json("event"), "$", _MAP)
    parsed = packets.withColumn("_event", event)
    for source, target in rules.field_mappings.items():
        parsed = parsed.withColumn("_event", _renamed(source, target))
    # A lambda keeps a projection out of whole-stage code. Here and in _first_error that is wanted: as one method the code of all
    # fields is larger than what the JVM compiles and would run interpreted, five times slower; outside it is split.
    unexpected = F.exists(F.map_keys("_event"), lambda name: ~name.isin(*TEXT_FIELDS, *INTEGER_FIELDS))
    typed = parsed.select(*packets.columns, "_event", unexpected.alias("_unexpected"), *[_text(n).alias(n) for n in TEXT_FIELDS], *[_integer(n).alias(n) for n in INTEGER_FIELDS if n != "received_at"])
    return typed


def _first_error() -> Column:
    """The first violated part of the contract as text; null if the event fulfils it."""
    has = lambda n: F.map_contains_key("_event", F.lit(n))
    lacking = F.get(F.filter(F.array(*[F.lit(n) for n in REQUIRED]), lambda n: ~F.array_contains(F.map_keys("_event"), n)), 0)
    found = F.when(F.col("_event").isNull(), "the event is not an object").when(lacking.isNotNull(), F.concat(lacking, F.lit(" is required")))
    for n in TEXT_FIELDS:
        bad = F.col(n).isNull() | (F.col(n).isin(*ENUMS[n]) == F.lit(False) if n in ENUMS else F.length(n) < 1)
        if n in PATTERNS:
            bad = bad | ~F.col(n).rlike(PATTERNS[n])
        if n == "event_id":
            bad = bad | (F.length(n) > MAX_EVENT_ID)
        found = found.when(has(n) & bad, f"{n} is not valid")
    for n, (low, high) in INTEGER_FIELDS.items():
        if n == "received_at":  # the server's value has replaced the client's
            found = found.when(F.col(n).isNull() | (F.col(n) < low), f"{n} is not valid")
            continue
        bad = F.col(n).isNull() | (F.col(n) < low)
        found = found.when(has(n) & (bad if high is None else bad | (F.col(n) > high)), f"{n} is not valid")
    for kind, names in REQUIRED_BY_TYPE.items():
        for n in names:
            found = found.when((F.col("event_type") == kind) & ~has(n), f"{n} is required")
    return found.when(F.col("_unexpected"), "unexpected fields")


def disposition(packets: DataFrame, rules: Rules) -> DataFrame:
    """One row per packet: its columns, the typed event, disposition, error_code, detail.

    Duplicates: by (advertiser, app, event id) in input order, then by business key among the survivors; both windows
    deal rejected packets out by receipt, so they never gather under one null key.
    """
    parsed = parse(packets, rules)
    checked = parsed.withColumn("detail", _first_error())
    stopped = (
        F.when(F.col("detail").isNotNull(), "SCHEMA_INVALID")
        .when(~F.col("schema_version").isin(*rules.schema_versions), "SCHEMA_VERSION_DISABLED")
        .when((F.col("event_time") < rules.effective_from) | F.coalesce(F.col("region").isin(*rules.filter_regions) if rules.filter_regions else F.lit(False), F.lit(False)), "RULE_FILTERED")
    )
    staged = checked.drop("_event", "_unexpected").withColumn("error_code", stopped)
    open_ = F.col("error_code").isNull()
    by_id = Window.partitionBy(F.when(open_, F.col("advertiser_id")), F.when(open_, F.col("app_id")), F.when(open_, F.col("event_id")).otherwise(F.col("receipt_id"))).orderBy("ordinal")
    once = staged.withColumn("error_code", F.when(open_ & (F.row_number().over(by_id) > 1), "DUPLICATE_EVENT_ID").otherwise(F.col("error_code")))
    by_key = Window.partitionBy(
        F.when(open_, F.col("advertiser_id")), F.when(open_, F.col("app_id")), F.when(open_, F.col("event_type")), F.when(open_, business_id()).otherwise(F.col("receipt_id"))
    ).orderBy("ordinal")
    twice = once.withColumn("error_code", F.when(open_ & (F.row_number().over(by_key) > 1), "DUPLICATE_BUSINESS_KEY").otherwise(F.coalesce("error_code", F.lit("OK"))))
    code = F.col("error_code")
    return twice.withColumn("disposition", F.when(code == "OK", "cleaned").when(code.startswith("DUPLICATE"), "duplicate").when(code == "RULE_FILTERED", "filtered").otherwise("quarantined"))


def quality_rows(disposed: DataFrame, rules: Rules) -> DataFrame:
    """The lineage record of every packet."""
    return disposed.select(
        "receipt_id", "event_id", F.lit("raw_events").alias("dataset"), F.lit("event-contract-v1").alias("rule_id"), F.lit(rules.rule_version).alias("rule_version"), "disposition", "error_code", "detail", "received_at"
    )


def quarantine(disposed: DataFrame) -> DataFrame:
    return disposed.where("disposition = 'quarantined'").select("receipt_id", "error_code", "detail", "received_at", F.col("event").alias("raw"))


def clean_events(disposed: DataFrame, rules: Rules) -> DataFrame:
    """Accepted events, typed, with lineage and transport delay."""
    return disposed.where("disposition = 'cleaned'").select(
        "ordinal", F.col("receipt_id").alias("_receipt_id"), "received_at", *TEXT_FIELDS, *[n for n in INTEGER_FIELDS if n != "received_at"], F.lit(rules.rule_version).alias("rule_version"), (F.col("received_at") - F.col("event_time")).alias("transport_delay_ms")
    )

