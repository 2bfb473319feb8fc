"""Cohort fan-out and metric aggregation: six counters by nine dimensions, window, cohort and policy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickledger.functions.contracts import COUNTERS, DIMENSIONS, UNKNOWN, Rules
from clickledger.functions.keys import metric_key, window_start
from clickledger.operators.dimension import with_channel


def _part(cohort: str, timestamp: Column, currency: Column | None = None, **values: Column | int) -> Column:
    zero = F.lit(0).cast("long")
    cells = [(F.lit(v) if isinstance(v, int) else v).cast("long").alias(n) if (v := values.get(n)) is not None else zero.alias(n) for n in COUNTERS]
    return F.struct(F.lit(cohort).alias("cohort_basis"), timestamp.alias("timestamp"), (F.lit("ALL") if currency is None else currency).alias("currency"), *cells)


def _dimensions(event_only: bool) -> list[Column]:
    """Advertiser and app are the event's own, campaign, region and version the impression's if there is one, experiment and variant only ever the impression's."""
    imp = (lambda n: F.col(n)) if event_only else (lambda n: F.col(f"impression.{n}"))
    linked = F.lit(True) if event_only else F.col("impression").isNotNull()
    pick = lambda n: F.when(linked, imp(n)).otherwise(F.col(n))
    return [
        F.col("advertiser_id"), F.col("app_id"), pick("campaign_id").alias("campaign_id"), F.coalesce(pick("region"), F.lit(UNKNOWN)).alias("region"), F.coalesce(pick("app_version"), F.lit(UNKNOWN)).alias("app_version"),
        F.when(linked, imp("experiment_id")).otherwise(F.lit(UNKNOWN)).alias("experiment_id"), F.when(linked, imp("variant")).otherwise(F.lit(UNKNOWN)).alias("variant"),
    ]


def contributions(clean: DataFrame, clicks: DataFrame, conversions: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per counter increment: dimensions without channel, cohort, timestamp, currency, counters; and the event's own columns in `carry`."""
    t = F.col("event_time")
    imps = clean.where("event_type = 'impression'").select(*carry, *_dimensions(True), F.explode(F.array(_part("occurrence", t, impressions=1), _part("impression", t, impressions=1))).alias("c"))
    own = [_part("occurrence", t, clicks=1), _part("click", t, clicks=1)]
    linked = F.when(F.col("impression").isNotNull(), F.array(*own, _part("impression", F.col("impression.event_time"), clicks=1))).otherwise(F.array(*own))
    clk = clicks.select(*carry, *_dimensions(False), F.explode(linked).alias("c"))
    matched = F.array(
        _part("occurrence", t, matched_conversions=1),
        _part("click", F.col("click_time"), matched_conversions=1, converted_clicks=F.col("first_of_click")),
        _part("conversion_value", F.col("click_time"), F.col("currency"), matched_conversions=1, value_minor=F.col("value_minor")),
    )
    conv = conversions.select(*carry, *_dimensions(False), F.explode(F.when(F.col("status") == "matched", matched).otherwise(F.array(_part("occurrence", t, unmatched_conversions=1)))).alias("c"))
    plain = [d for d in DIMENSIONS if d not in ("currency", "channel")]
    return imps.unionByName(clk).unionByName(conv).select(*carry, *plain, "c.*")


def aggregate(rows: DataFrame, rules: Rules, dimension: DataFrame | None = None, release_id: str = "replay-v1", status: str = "final") -> DataFrame:
    """Full metric rows. Channel is looked up at the cohort's time, after partial sums by window would no longer tell it, so before the aggregation."""
    keyed = with_channel(rows, dimension).withColumn("window_start", window_start(F.col("timestamp"), rules.window_ms))
    summed = keyed.groupBy(*DIMENSIONS, "window_start", "cohort_basis").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return summed.select(
        metric_key(rules.policy_version).alias("metric_key"), *DIMENSIONS, "window_start", "cohort_basis", F.lit(rules.policy_version).alias("policy_version"), F.lit(rules.rule_version).alias("rule_version"), F.lit(release_id).alias("release_id"), F.lit(status).alias("status"), *COUNTERS
    )


def nonzero() -> Column:
    """A metric row that differs from an absent one."""
    out = F.lit(False)
    for c in COUNTERS:
        out = out | (F.col(c) != 0)
    return out


def with_ratios(metrics: DataFrame) -> DataFrame:
    """ctr only for the impression cohort, cvr only for the click cohort, and how far a row can be trusted."""
    return metrics.select(
        "*",
        F.when(F.col("cohort_basis") == "impression", F.try_divide("clicks", "impressions")).alias("ctr"),
        F.when(F.col("cohort_basis") == "click", F.try_divide("converted_clicks", "clicks")).alias("cvr"),
        F.when(F.col("experiment_id") == UNKNOWN, "missing_exposure").when(F.greatest("impressions", "clicks") < 100, "small_sample").otherwise("available").alias("quality_status"),
    )
