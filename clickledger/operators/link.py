"""Click-to-impression and conversion-to-click links with an explicit reason for every outcome.

Both links are equi-joins on advertiser, app and id; identity, campaign, order and window only decide on
the reason, so they stay out of the join condition. Ids are unique after dedup, so no join multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickledger.functions.contracts import UNKNOWN, Rules
from clickledger.functions.keys import association_key

_IMPRESSION = ("campaign_id", "region", "app_version", "experiment_id", "variant", "event_time")


def _ladder(found: str, prefix: str, codes: tuple[str, str, str, str, str, str], window_ms: int) -> Column:
    """not found, identity, campaign, order, window, fine."""
    other = lambda n: F.col(f"{found}.{n}")
    missing, identity, campaign, order, window, fine = (f"{prefix}{c}" if i < 3 and prefix else c for i, c in enumerate(codes))
    return (
        F.when(F.col(found).isNull(), missing)
        .when(other("user_id") != F.col("user_id"), identity)
        .when(other("campaign_id") != F.col("campaign_id"), campaign)
        .when(other("event_time") > F.col("event_time"), order)
        .when(F.col("event_time") - other("event_time") > window_ms, window)
        .otherwise(fine)
    )


def link_clicks(clean: DataFrame, rules: Rules) -> DataFrame:
    """Clicks with reason and the struct `impression`, null unless the reason is OK."""
    impressions = clean.where("event_type = 'impression'").select("advertiser_id", "app_id", "impression_id", F.struct("user_id", *_IMPRESSION).alias("_found"))
    joined = clean.where("event_type = 'click'").join(impressions, ["advertiser_id", "app_id", "impression_id"], "left")
    codes = ("IMPRESSION_NOT_FOUND", "IMPRESSION_IDENTITY_MISMATCH", "IMPRESSION_CAMPAIGN_MISMATCH", "CLICK_BEFORE_IMPRESSION", "IMPRESSION_WINDOW_EXCEEDED", "OK")
    reasoned = joined.withColumn("reason", _ladder("_found", "", codes, rules.attribution_window_ms))
    return reasoned.withColumn("impression", F.when(F.col("reason") == "OK", F.struct(*[F.col(f"_found.{n}").alias(n) for n in _IMPRESSION]))).drop("_found")


def link_conversions(clean: DataFrame, clicks: DataFrame, rules: Rules) -> DataFrame:
    """Conversions with reason, status, click_time, the click's impression (only if matched) and first_of_click (1 for the first matched conversion of a click)."""
    found = clicks.select("advertiser_id", "app_id", "click_id", F.struct("user_id", "campaign_id", "event_time", "impression").alias("_found"))
    joined = clean.where("event_type = 'conversion'").join(found, ["advertiser_id", "app_id", "click_id"], "left")
    codes = ("CLICK_NOT_FOUND", "IDENTITY_MISMATCH", "CAMPAIGN_MISMATCH", "CLICK_AFTER_CONVERSION", "ATTRIBUTION_WINDOW_EXCEEDED", "MATCHED")
    reasoned = joined.withColumn("reason", _ladder("_found", "", codes, rules.attribution_window_ms))
    matched = F.col("reason") == "MATCHED"
    # Those without a match are kept apart by receipt, so that one missing click id gathers nothing.
    per_click = Window.partitionBy("advertiser_id", "app_id", F.when(matched, F.col("click_id")), F.when(~matched, F.col("_receipt_id"))).orderBy("ordinal")
    return reasoned.select(
        *clean.columns,
        "reason",
        F.when(matched, "matched").otherwise("unmatched").alias("status"),
        F.when(matched, F.col("_found.event_time")).alias("click_time"),
        F.when(matched, F.col("_found.impression")).alias("impression"),
        F.when(matched & (F.row_number().over(per_click) == 1), 1).otherwise(0).cast("long").alias("first_of_click"),
    )


def associations(conversions: DataFrame, rules: Rules, release_id: str = "replay-v1") -> DataFrame:
    return conversions.select(
        association_key().alias("association_key"), "conversion_id", "click_id", "advertiser_id", "app_id", "status", "reason", F.lit(release_id).alias("release_id"), F.lit(rules.rule_version).alias("rule_version"), F.lit(rules.policy_version).alias("policy_version"),
        "event_time", F.col("_receipt_id").alias("receipt_id"), F.coalesce("impression.experiment_id", F.lit(UNKNOWN)).alias("experiment_id"), F.coalesce("impression.variant", F.lit(UNKNOWN)).alias("variant"),
    )


def signals(clicks: DataFrame, rules: Rules) -> DataFrame:
    """A quality row for every click without a valid impression."""
    return clicks.where("reason <> 'OK'").select(
        F.col("_receipt_id").alias("receipt_id"), "event_id", F.lit("clicks").alias("dataset"), F.lit("exposure-link-v1").alias("rule_id"), F.lit(rules.rule_version).alias("rule_version"), F.lit("signal").alias("disposition"), F.col("reason").alias("error_code"), F.lit(None).cast("string").alias("detail"), "received_at"
    )
