"""Advertising traffic made from the `events` table, by one SQL text that Spark and the checking engine share.

Views are impressions, clicks clicks, purchases and signups conversions; errors have a type the contract forbids. Every ninth
event arrives twice more: once as it was, once under a new event id. Some links, users and
campaigns are perturbed, so that every reason occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPED = """
SELECT event_id AS eid, {ms} AS event_time, user_id,
  CASE event_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click' WHEN 'error' THEN 'error' ELSE 'conversion' END AS event_type,
  CASE WHEN event_type = 'signup' THEN 'signup' ELSE 'purchase' END AS conversion_type,
  CAST(round(value * 100) AS BIGINT) AS cents,
  max(CASE WHEN event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_view,
  max(CASE WHEN event_type = 'click' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_click,
  min(CASE WHEN event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_view,
  min(CASE WHEN event_type = 'click' THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_click
FROM events
"""

_EVENTS = """
SELECT eid, event_time, event_type,
  CONCAT('adv-', CAST(user_id % 3 AS VARCHAR(20))) AS advertiser_id,
  CONCAT('app-', CAST(user_id % 2 AS VARCHAR(20))) AS app_id,
  CONCAT('user-', CAST(CASE WHEN eid % 43 = 0 THEN user_id + 1 ELSE user_id END AS VARCHAR(20))) AS user_id,
  CONCAT('campaign-', CAST((CASE WHEN eid % 41 = 0 THEN user_id + 1 ELSE user_id END) % 4 AS VARCHAR(20))) AS campaign_id,
  CONCAT('1.', CAST(eid % 3 AS VARCHAR(20))) AS app_version,
  CASE WHEN event_type <> 'impression' AND eid % 5 = 0 THEN NULL ELSE CASE (user_id + eid) % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'JP' ELSE 'GB' END END AS region,
  CASE WHEN event_type = 'impression' THEN CONCAT('exp-', CAST(user_id % 2 AS VARCHAR(20))) END AS experiment_id,
  CASE WHEN event_type = 'impression' THEN CASE WHEN (user_id + eid) % 2 = 0 THEN 'control' ELSE 'treatment' END END AS variant,
  CASE WHEN event_type = 'impression' THEN CONCAT('ad-', CAST(eid % 7 AS VARCHAR(20))) END AS ad_id,
  CASE event_type WHEN 'impression' THEN CONCAT('i', CAST(eid AS VARCHAR(20)))
    WHEN 'click' THEN CONCAT('i', CAST(CASE WHEN eid % 53 = 0 THEN -1 WHEN eid % 47 = 0 THEN coalesce(next_view, -1) ELSE coalesce(last_view, -1) END AS VARCHAR(20))) END AS impression_id,
  CASE event_type WHEN 'click' THEN CONCAT('c', CAST(eid AS VARCHAR(20)))
    WHEN 'conversion' THEN CONCAT('c', CAST(CASE WHEN eid % 53 = 0 THEN -1 WHEN eid % 47 = 0 THEN coalesce(next_click, -1) ELSE coalesce(last_click, -1) END AS VARCHAR(20))) END AS click_id,
  CASE WHEN event_type = 'conversion' THEN CONCAT('v', CAST(eid AS VARCHAR(20))) END AS conversion_id,
  CASE WHEN event_type = 'conversion' THEN conversion_type END AS conversion_type,
  CASE WHEN event_type = 'conversion' THEN cents END AS value_minor,
  CASE WHEN event_type = 'conversion' THEN CASE eid % 2 WHEN 0 THEN 'USD' ELSE 'JPY' END END AS currency
FROM typed
"""

_ARRIVED = """
SELECT *, eid * 4 AS ordinal, CONCAT('event-', CAST(eid AS VARCHAR(20))) AS event_id FROM adapted
UNION ALL SELECT *, eid * 4 + 1 AS ordinal, CONCAT('event-', CAST(eid AS VARCHAR(20))) AS event_id FROM adapted WHERE eid % 9 = 0
UNION ALL SELECT *, eid * 4 + 2 AS ordinal, CONCAT('event-', CAST(eid AS VARCHAR(20)), '-again') AS event_id FROM adapted WHERE eid % 9 = 0
"""

#: Common table expressions for the checking engine, up to the arrived rows.
ORACLE_ARRIVED = f"typed AS ({_TYPED.format(ms='epoch_us(ts) // 1000')}), adapted AS ({_EVENTS}), arrived AS ({_ARRIVED})"

FIELDS = (
    "event_id", "event_type", "event_time", "app_id", "advertiser_id", "user_id", "campaign_id", "app_version", "impression_id", "click_id", "conversion_id", "ad_id", "region", "experiment_id", "variant", "conversion_type", "value_minor", "currency",
)


def arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic as typed rows with ordinal."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    typed = spark.sql(_TYPED.format(ms="unix_micros(CAST(ts AS TIMESTAMP)) div 1000").replace("FROM events", "FROM {events}"), events=events)
    adapted = spark.sql(_EVENTS.replace("FROM typed", "FROM {typed}"), typed=typed)
    # The copies are made row by row, so that the windows above run once.
    copies = F.when(F.col("eid") % 9 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    rows = adapted.withColumn("_copy", F.explode(copies))
    name = F.concat(F.lit("event-"), F.col("eid").cast("string"), F.when(F.col("_copy") == 2, "-again").otherwise(""))
    return rows.select("*", (F.col("eid") * 4 + F.col("_copy")).alias("ordinal"), name.alias("event_id")).drop("_copy")


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traffic as packets: JSON events with the receipts of one offline batch, received 250 ms after they happened."""
    rows = arrived(spark, sf_dir)
    event = F.to_json(F.struct(*FIELDS, F.lit(1).alias("schema_version"), F.concat(F.lit("trace-"), F.col("eid").cast("string")).alias("trace_id")))
    return rows.select(F.concat(F.lit("offline:"), F.col("ordinal").cast("string")).alias("receipt_id"), (F.col("event_time") + 250).alias("received_at"), "ordinal", event.alias("event"))


def campaigns(spark: SparkSession) -> DataFrame:
    """A small campaign history with every case of the temporal join: replaced, ended, deleted, future, missing (campaign-3)."""
    return spark.sql("SELECT * FROM VALUES " + _VERSIONS + " AS t(campaign_id, effective_from, effective_to, source_version, channel, deleted)")


_VERSIONS = """('campaign-0', 0L, CAST(NULL AS BIGINT), 1L, 'short-video', false), ('campaign-0', 1704672000000L, CAST(NULL AS BIGINT), 2L, 'feed', false),
  ('campaign-1', 0L, 1705276800000L, 1L, 'feed', false), ('campaign-1', 1705276800000L, CAST(NULL AS BIGINT), 1L, 'search', true),
  ('campaign-2', 1704240000000L, CAST(NULL AS BIGINT), 1L, 'search', false)"""

ORACLE_CAMPAIGNS = "campaigns(campaign_id, effective_from, effective_to, source_version, channel, deleted) AS (VALUES " + _VERSIONS.replace("L,", ",") + ")"
