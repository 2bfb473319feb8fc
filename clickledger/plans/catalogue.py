"""The driver's catalogue of queries with the SQL that checks them.

Every query runs the engine's own operators over the whole `events` table (through the adapter); the SQL restates its meaning
independently.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.functions import json as texts
from clickledger.functions.contracts import COUNTERS, DIMENSIONS, Rules
from clickledger.operators import metrics, monitor, paging, reconcile, results, validate
from clickledger.plans import adapter
from clickledger.plans.batch import Outcome, calculate
from clickledger.sources import archive, collector
from clickledger.sources import packets as sources
from clickledger.streaming import attribution

RULES = Rules()
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _outcome(spark: SparkSession, sf_dir: str) -> Outcome:
    return calculate(adapter.packets(spark, sf_dir), RULES, adapter.campaigns(spark), keep=True)


# The meaning of the engine in SQL, as a chain of common table expressions.

_BASE = f"WITH {adapter.ORACLE_ARRIVED}, {adapter.ORACLE_CAMPAIGNS}"

_DISPOSED = (
    _BASE
    + """, coded AS (
  SELECT *, CASE event_type WHEN 'impression' THEN impression_id WHEN 'click' THEN click_id ELSE conversion_id END AS business_id, event_type <> 'error' AS valid FROM arrived
), numbered AS (
  SELECT *, CASE WHEN valid THEN row_number() OVER (PARTITION BY valid, advertiser_id, app_id, event_id ORDER BY ordinal) END AS n_id FROM coded
), twice AS (
  SELECT *, CASE WHEN n_id = 1 THEN row_number() OVER (PARTITION BY n_id, advertiser_id, app_id, event_type, business_id ORDER BY ordinal) END AS n_key FROM numbered
), disposed AS (
  SELECT *, CASE WHEN NOT valid THEN 'SCHEMA_INVALID' WHEN n_id > 1 THEN 'DUPLICATE_EVENT_ID' WHEN n_key > 1 THEN 'DUPLICATE_BUSINESS_KEY' ELSE 'OK' END AS error_code,
    CASE WHEN NOT valid THEN 'quarantined' WHEN n_id > 1 OR n_key > 1 THEN 'duplicate' ELSE 'cleaned' END AS disposition, 'offline:' || ordinal AS receipt_id, event_time + 250 AS received_at FROM twice
)"""
)

_LINKED = (
    _DISPOSED
    + """, clean AS (SELECT * FROM disposed WHERE disposition = 'cleaned'),
clicks AS (
  SELECT c.*, CASE WHEN i.eid IS NULL THEN 'IMPRESSION_NOT_FOUND' WHEN i.user_id <> c.user_id THEN 'IMPRESSION_IDENTITY_MISMATCH' WHEN i.campaign_id <> c.campaign_id THEN 'IMPRESSION_CAMPAIGN_MISMATCH'
      WHEN i.event_time > c.event_time THEN 'CLICK_BEFORE_IMPRESSION' WHEN c.event_time - i.event_time > 86400000 THEN 'IMPRESSION_WINDOW_EXCEEDED' ELSE 'OK' END AS reason,
    i.campaign_id AS i_campaign, i.region AS i_region, i.app_version AS i_version, i.experiment_id AS i_experiment, i.variant AS i_variant, i.event_time AS i_time
  FROM (SELECT * FROM clean WHERE event_type = 'click') c LEFT JOIN (SELECT * FROM clean WHERE event_type = 'impression') i
    ON c.advertiser_id = i.advertiser_id AND c.app_id = i.app_id AND c.impression_id = i.impression_id
), linked AS (
  SELECT v.*, CASE WHEN c.eid IS NULL THEN 'CLICK_NOT_FOUND' WHEN c.user_id <> v.user_id THEN 'IDENTITY_MISMATCH' WHEN c.campaign_id <> v.campaign_id THEN 'CAMPAIGN_MISMATCH'
      WHEN c.event_time > v.event_time THEN 'CLICK_AFTER_CONVERSION' WHEN v.event_time - c.event_time > 86400000 THEN 'ATTRIBUTION_WINDOW_EXCEEDED' ELSE 'MATCHED' END AS reason,
    c.event_time AS c_time, c.reason = 'OK' AS exposed, c.i_campaign, c.i_region, c.i_version, c.i_experiment, c.i_variant
  FROM (SELECT * FROM clean WHERE event_type = 'conversion') v LEFT JOIN clicks c
    ON v.advertiser_id = c.advertiser_id AND v.app_id = c.app_id AND v.click_id = c.click_id
), conversions AS (
  SELECT *, reason = 'MATCHED' AS matched, reason = 'MATCHED' AND coalesce(exposed, false) AS shown,
    CASE WHEN reason = 'MATCHED' AND row_number() OVER (PARTITION BY reason = 'MATCHED', advertiser_id, app_id, click_id ORDER BY ordinal) = 1 THEN 1 ELSE 0 END AS first_of_click FROM linked
)"""
)

_CONTRIBUTED = (
    _LINKED
    + """, parts AS (
  SELECT advertiser_id, app_id, campaign_id, region, app_version, experiment_id, variant, 'ALL' AS currency, event_time AS t, c.cohort AS cohort_basis, 1 AS impressions, 0 AS clicks, 0 AS matched_conversions, 0 AS unmatched_conversions, 0 AS converted_clicks, 0 AS value_minor
  FROM clean, (VALUES ('occurrence'), ('impression')) AS c(cohort) WHERE event_type = 'impression'
  UNION ALL
  SELECT advertiser_id, app_id, CASE WHEN reason = 'OK' THEN i_campaign ELSE campaign_id END, coalesce(CASE WHEN reason = 'OK' THEN i_region ELSE region END, 'unknown'), CASE WHEN reason = 'OK' THEN i_version ELSE app_version END,
    CASE WHEN reason = 'OK' THEN i_experiment ELSE 'unknown' END, CASE WHEN reason = 'OK' THEN i_variant ELSE 'unknown' END, 'ALL', CASE WHEN c.cohort = 'impression' THEN i_time ELSE event_time END, c.cohort, 0, 1, 0, 0, 0, 0
  FROM clicks, (VALUES ('occurrence'), ('click'), ('impression')) AS c(cohort) WHERE c.cohort <> 'impression' OR reason = 'OK'
  UNION ALL
  SELECT advertiser_id, app_id, CASE WHEN shown THEN i_campaign ELSE campaign_id END, coalesce(CASE WHEN shown THEN i_region ELSE region END, 'unknown'), CASE WHEN shown THEN i_version ELSE app_version END,
    CASE WHEN shown THEN i_experiment ELSE 'unknown' END, CASE WHEN shown THEN i_variant ELSE 'unknown' END, CASE WHEN c.cohort = 'conversion_value' THEN currency ELSE 'ALL' END, CASE WHEN c.cohort = 'occurrence' THEN event_time ELSE c_time END, c.cohort, 0, 0,
    CASE WHEN matched THEN 1 ELSE 0 END, CASE WHEN matched THEN 0 ELSE 1 END, CASE WHEN c.cohort = 'click' THEN first_of_click ELSE 0 END, CASE WHEN c.cohort = 'conversion_value' THEN value_minor ELSE 0 END
  FROM conversions, (VALUES ('occurrence'), ('click'), ('conversion_value')) AS c(cohort) WHERE c.cohort = 'occurrence' OR matched
), channels AS (
  SELECT p.*, coalesce((SELECT CASE WHEN d.deleted THEN 'deleted' ELSE d.channel END FROM campaigns d
     WHERE d.campaign_id = p.campaign_id AND d.effective_from <= p.t AND (d.effective_to IS NULL OR p.t < d.effective_to) ORDER BY d.source_version DESC, d.effective_from DESC LIMIT 1), 'unknown') AS channel, t - t % 60000 AS window_start FROM parts p
), metric AS (
  SELECT advertiser_id, app_id, campaign_id, region, app_version, experiment_id, variant, currency, channel, window_start, cohort_basis,
    CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(matched_conversions) AS BIGINT) AS matched_conversions, CAST(sum(unmatched_conversions) AS BIGINT) AS unmatched_conversions, CAST(sum(converted_clicks) AS BIGINT) AS converted_clicks, CAST(sum(value_minor) AS BIGINT) AS value_minor
  FROM channels GROUP BY ALL
), metrics AS (
  SELECT '[' || concat_ws(',', '"' || advertiser_id || '"', '"' || app_id || '"', '"' || campaign_id || '"', '"' || region || '"', '"' || app_version || '"', '"' || experiment_id || '"', '"' || variant || '"', '"' || currency || '"', '"' || channel || '"', window_start, '"' || cohort_basis || '"', '"explicit-click-v1"') || ']' AS metric_key, * FROM metric
), associations AS (
  SELECT '["' || advertiser_id || '","' || app_id || '","' || conversion_id || '"]' AS association_key, conversion_id, click_id, CASE WHEN matched THEN 'matched' ELSE 'unmatched' END AS status, reason, event_time, receipt_id,
    CASE WHEN shown THEN i_experiment ELSE 'unknown' END AS experiment_id, CASE WHEN shown THEN i_variant ELSE 'unknown' END AS variant FROM conversions
)"""
)

_KEYS = (*DIMENSIONS, "window_start", "cohort_basis")


@query(_DISPOSED + " SELECT receipt_id, disposition, error_code FROM disposed")
def clean_dispositions(spark, sf_dir):
    return _outcome(spark, sf_dir).disposed.select("receipt_id", "disposition", "error_code")


@query(_DISPOSED + " SELECT receipt_id, event_id, error_code FROM disposed WHERE disposition = 'duplicate'")
def dedup_event_then_business(spark, sf_dir):
    return _outcome(spark, sf_dir).disposed.where("disposition = 'duplicate'").select("receipt_id", "event_id", "error_code")


@query(_DISPOSED + " SELECT receipt_id, error_code, event_time + 250 AS received_at FROM disposed WHERE disposition = 'quarantined'")
def quarantine_rows(spark, sf_dir):
    return validate.quarantine(_outcome(spark, sf_dir).disposed).select("receipt_id", "error_code", "received_at")


@query(_DISPOSED + " SELECT event_id, event_time, received_at - event_time AS transport_delay_ms FROM disposed WHERE disposition = 'cleaned'")
def transport_delay(spark, sf_dir):
    return _outcome(spark, sf_dir).clean.select("event_id", "event_time", "transport_delay_ms")


@query(_DISPOSED.replace("CASE WHEN NOT valid THEN 'SCHEMA_INVALID'", "CASE WHEN NOT valid THEN 'SCHEMA_INVALID' WHEN region = 'JP' OR event_time < 1704240000000 THEN 'RULE_FILTERED'").replace("event_type <> 'error' AS valid FROM arrived", "event_type <> 'error' AS valid FROM arrived").replace("CASE WHEN valid THEN row_number() OVER (PARTITION BY valid,", "CASE WHEN valid AND NOT coalesce(region = 'JP' OR event_time < 1704240000000, false) THEN row_number() OVER (PARTITION BY valid AND NOT coalesce(region = 'JP' OR event_time < 1704240000000, false),") + " SELECT error_code, count(*) AS n FROM disposed GROUP BY 1")
def rule_filtered_counts(spark, sf_dir):
    rules = Rules(filter_regions=("JP",), effective_from=1704240000000)
    return validate.disposition(adapter.packets(spark, sf_dir), rules).groupBy("error_code").agg(F.count("*").alias("n"))


@query(_DISPOSED.replace("CASE WHEN NOT valid THEN 'SCHEMA_INVALID'", "CASE WHEN NOT valid THEN 'SCHEMA_INVALID' WHEN true THEN 'SCHEMA_VERSION_DISABLED'") + " SELECT error_code, count(*) AS n FROM disposed GROUP BY 1")
def schema_version_disabled(spark, sf_dir):
    return validate.disposition(adapter.packets(spark, sf_dir), Rules(schema_versions=(2,))).groupBy("error_code").agg(F.count("*").alias("n"))


@query(_DISPOSED + " SELECT receipt_id, disposition FROM disposed")
def field_mapping_rename(spark, sf_dir):
    """Old producers call the campaign `cid`: with the mapping, nothing changes."""
    old = adapter.packets(spark, sf_dir).withColumn("event", F.regexp_replace("event", '"campaign_id"', '"cid"'))
    return validate.disposition(old, Rules(field_mappings={"cid": "campaign_id"})).select("receipt_id", "disposition")


@query(_LINKED + " SELECT click_id, reason, CASE WHEN reason = 'OK' THEN i_variant END AS variant FROM clicks")
def click_impression_link(spark, sf_dir):
    return _outcome(spark, sf_dir).clicks.select("click_id", "reason", F.col("impression.variant").alias("variant"))


@query(_CONTRIBUTED + " SELECT association_key, conversion_id, click_id, status, reason, event_time, receipt_id, experiment_id, variant FROM associations")
def conversion_click_link(spark, sf_dir):
    return _outcome(spark, sf_dir).associations.select("association_key", "conversion_id", "click_id", "status", "reason", "event_time", "receipt_id", "experiment_id", "variant")


@query(_LINKED + " SELECT 'click' AS link, reason, count(*) AS n FROM clicks GROUP BY 2 UNION ALL SELECT 'conversion', reason, count(*) FROM conversions GROUP BY 2")
def reason_counts(spark, sf_dir):
    o = _outcome(spark, sf_dir)
    return o.clicks.select(F.lit("click").alias("link"), "reason").unionByName(o.conversions.select(F.lit("conversion").alias("link"), "reason")).groupBy("link", "reason").agg(F.count("*").alias("n"))


@query(_LINKED + " SELECT event_id, reason AS error_code FROM clicks WHERE reason <> 'OK'")
def exposure_signals(spark, sf_dir):
    return _outcome(spark, sf_dir).quality.where("disposition = 'signal'").select("event_id", "error_code")


def _cohort(cohort: str):
    def run(spark, sf_dir):
        return _outcome(spark, sf_dir).metrics.where(F.col("cohort_basis") == cohort).select(*_KEYS, *COUNTERS)

    run.__name__ = f"metrics_{cohort}"
    return query(_CONTRIBUTED + f" SELECT {', '.join((*_KEYS, *COUNTERS))} FROM metrics WHERE cohort_basis = '{cohort}'")(run)


metrics_occurrence, metrics_impression, metrics_click, metrics_conversion_value = map(_cohort, ("occurrence", "impression", "click", "conversion_value"))


@query(_CONTRIBUTED + f" SELECT metric_key, {', '.join((*_KEYS, *COUNTERS))} FROM metrics")
def metrics_full(spark, sf_dir):
    return _outcome(spark, sf_dir).metrics.select("metric_key", *_KEYS, *COUNTERS)


@query(_LINKED + " SELECT count(DISTINCT (advertiser_id, app_id, click_id)) AS converted_clicks, count(*) AS matched FROM conversions WHERE matched")
def converted_clicks_distinct(spark, sf_dir):
    return _outcome(spark, sf_dir).conversions.where("status = 'matched'").agg(F.sum("first_of_click").alias("converted_clicks"), F.count("*").alias("matched"))


@query(_CONTRIBUTED + " SELECT campaign_id, channel, count(*) AS n FROM channels GROUP BY 1, 2")
def temporal_dimension_channel(spark, sf_dir):
    o = _outcome(spark, sf_dir)
    rows = metrics.with_channel(metrics.contributions(o.clean, o.clicks, o.conversions), adapter.campaigns(spark))
    return rows.groupBy("campaign_id", "channel").agg(F.count("*").alias("n"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Associations as stored: first pending, then final, the final one twice (as after a retry)."""
    o = _outcome(spark, sf_dir)
    ordinal = F.split("receipt_id", ":")[1].cast("bigint")
    final = results.as_records(o.associations, "association", F.pmod(F.xxhash64("association_key"), F.lit(3)), ordinal * 3 + 1, F.col("event_time"))
    pending = results.as_records(o.associations.withColumns({"status": F.lit("pending"), "reason": F.lit("AWAITING_CLICK")}), "association", F.pmod(F.xxhash64("association_key"), F.lit(3)), ordinal * 3, F.col("event_time"))
    return pending.unionByName(final).unionByName(final.withColumn("output_offset", F.col("output_offset") + 1))


@query(_CONTRIBUTED + " SELECT 'a:' || association_key AS output_key, status, reason, CAST(split_part(receipt_id, ':', 2) AS BIGINT) * 3 + 2 AS output_offset FROM associations")
def latest_by_offset(spark, sf_dir):
    rows = results.latest(_versions(spark, sf_dir), "replay-v1", "association")
    return rows.select("output_key", F.get_json_object("payload", "$.status").alias("status"), F.get_json_object("payload", "$.reason").alias("reason"), "output_offset")


@query(_CONTRIBUTED + " SELECT 'a:' || association_key AS output_key, 'pending' AS status FROM associations WHERE false UNION ALL SELECT 'a:' || association_key, status FROM associations WHERE status = 'matched'")
def latest_then_filter(spark, sf_dir):
    """A filter on a mutable field after the reduction: superseded pending rows never come back."""
    rows = results.latest(_versions(spark, sf_dir), "replay-v1", "association")
    status = F.get_json_object("payload", "$.status")
    return rows.where(status.isin("pending", "matched")).select("output_key", status.alias("status"))


@query(_CONTRIBUTED + " SELECT count(*) AS pending FROM associations WHERE CAST(split_part(receipt_id, ':', 2) AS BIGINT) % 3 = 0")
def pending_count(spark, sf_dir):
    """Conversions whose final version has not come yet: every third."""
    rows = _versions(spark, sf_dir)
    early = rows.where((F.col("output_offset") % 3 == 0) | (F.floor(F.col("output_offset") / 3) % 3 != 0))
    return monitor.pending_count(results.latest_associations(early, "replay-v1"))


@query(_CONTRIBUTED + " SELECT 'a:' || association_key AS output_key, status FROM associations ORDER BY 1 LIMIT 101")
def keyset_page_first(spark, sf_dir):
    return paging.page_frame(_versions(spark, sf_dir), "replay-v1", "association").select("output_key", F.get_json_object("payload", "$.status").alias("status"))


@query(_CONTRIBUTED + """ SELECT 'a:' || association_key AS output_key, status FROM associations WHERE status = 'unmatched' AND 'a:' || association_key > 'a:["adv-1","app-1"' ORDER BY 1 LIMIT 51""")
def keyset_page_next(spark, sf_dir):
    page = paging.page_frame(_versions(spark, sf_dir), "replay-v1", "association", 50, 'a:["adv-1","app-1"', {"status": "unmatched"})
    return page.select("output_key", F.get_json_object("payload", "$.status").alias("status"))


@query(
    _CONTRIBUTED
    + """ SELECT metric_key, CASE WHEN cohort_basis = 'impression' AND impressions > 0 THEN clicks / impressions END AS ctr, CASE WHEN cohort_basis = 'click' AND clicks > 0 THEN converted_clicks / clicks END AS cvr,
  CASE WHEN experiment_id = 'unknown' THEN 'missing_exposure' WHEN greatest(impressions, clicks) < 100 THEN 'small_sample' ELSE 'available' END AS quality_status FROM metrics"""
)
def derived_ctr_cvr(spark, sf_dir):
    return metrics.with_ratios(_outcome(spark, sf_dir).metrics).select("metric_key", "ctr", "cvr", "quality_status")


@query(
    _CONTRIBUTED
    + """ SELECT variant, sum(clicks) FILTER (cohort_basis = 'impression') / nullif(sum(impressions) FILTER (cohort_basis = 'impression'), 0) AS ctr,
  sum(converted_clicks) FILTER (cohort_basis = 'click') / nullif(sum(clicks) FILTER (cohort_basis = 'click'), 0) AS cvr FROM metrics GROUP BY 1"""
)
def ratio_by_variant(spark, sf_dir):
    return monitor.ratio_of_sums(_outcome(spark, sf_dir).metrics, ("variant",))


def _acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.packets(spark, sf_dir).select("receipt_id", "received_at", "ordinal")


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rows, as if those of every 50th receipt had not come yet."""
    return _outcome(spark, sf_dir).quality.where(F.split("receipt_id", ":")[1].cast("bigint") % 50 != 0)


@query(_DISPOSED + " SELECT receipt_id, received_at FROM disposed WHERE ordinal % 50 = 0")
def outstanding_receipts_anti(spark, sf_dir):
    return reconcile.outstanding(_acknowledged(spark, sf_dir), _classified(spark, sf_dir)).select("receipt_id", "received_at")


@query(_DISPOSED + " SELECT min(received_at) AS oldest, count(*) AS n FROM disposed WHERE ordinal % 50 = 0")
def outstanding_summary(spark, sf_dir):
    return reconcile.outstanding_summary(_acknowledged(spark, sf_dir), _classified(spark, sf_dir))


@query(
    _DISPOSED
    + """ SELECT count(*) FILTER (ordinal % 7 <> 0) AS acknowledged, count(*) FILTER (ordinal % 11 <> 0) AS archived, count(*) FILTER (ordinal % 50 <> 0) AS classified, count(*) FILTER (ordinal % 7 <> 0 AND ordinal % 11 = 0) AS archive_missing,
  count(*) FILTER (ordinal % 11 <> 0 AND ordinal % 50 = 0) AS processing_pending, count(*) FILTER (ordinal % 7 = 0 AND (ordinal % 11 <> 0 OR ordinal % 50 <> 0)) AS unacknowledged FROM disposed"""
)
def coverage_report(spark, sf_dir):
    acked = _acknowledged(spark, sf_dir)
    return reconcile.coverage(acked.where("ordinal % 7 <> 0"), acked.where("ordinal % 11 <> 0"), _classified(spark, sf_dir))


@query(_DISPOSED + " SELECT receipt_id FROM disposed WHERE ordinal % 11 = 0 ORDER BY 1 LIMIT 100")
def missing_archive_samples(spark, sf_dir):
    acked = _acknowledged(spark, sf_dir)
    return reconcile.missing_samples(acked, acked.where("ordinal % 11 <> 0"))


def _two_sides(spark: SparkSession, sf_dir: str):
    """The results, and the results with injected differences: lost, wrong and additional zero rows."""
    o = _outcome(spark, sf_dir)
    minute = F.col("window_start") / 60000
    wrong = o.metrics.where(minute % 13 != 0).withColumn("clicks", F.when(minute % 17 == 0, F.col("clicks") + 1).otherwise(F.col("clicks")))
    zero = o.metrics.where(minute % 13 == 0).withColumns({c: F.lit(0).cast("bigint") for c in COUNTERS}).withColumn("metric_key", F.concat("metric_key", F.lit("z")))
    other = o.associations.withColumn("reason", F.when(F.col("event_time") % 19 == 0, "CLICK_NOT_FOUND").otherwise(F.col("reason")))
    return (o.metrics, o.associations), (wrong.unionByName(zero), other)


_DIFFERENT = _CONTRIBUTED + """, diff AS (
  SELECT 'metric' AS kind, metric_key AS key FROM metrics WHERE (window_start // 60000) % 13 = 0 OR (window_start // 60000) % 17 = 0
  UNION ALL SELECT 'association', association_key FROM associations WHERE event_time % 19 = 0 AND reason <> 'CLICK_NOT_FOUND'
)"""


@query(_DIFFERENT + " SELECT kind, key FROM diff")
def compare_full_outer(spark, sf_dir):
    return reconcile.differences(*_two_sides(spark, sf_dir)).select("kind", "key")


@query(_DIFFERENT + " SELECT kind, key FROM diff ORDER BY kind, key LIMIT 100")
def difference_samples(spark, sf_dir):
    return reconcile.differences(*_two_sides(spark, sf_dir)).orderBy("kind", "key").limit(100).select("kind", "key")


@query(_DISPOSED + " SELECT receipt_id FROM disposed WHERE ordinal % 23 = 0 OR ordinal % 29 = 0")
def ack_conflicts(spark, sf_dir):
    p = adapter.packets(spark, sf_dir)
    acked = p.select("receipt_id", F.lit("raw").alias("topic"), (F.col("ordinal") % 3).cast("int").alias("partition"), F.col("ordinal").alias("offset"), F.sha2("event", 256).alias("sha256"))
    moved = F.when(F.col("offset") % 23 == 0, F.col("offset") + 1).otherwise(F.col("offset"))
    stored = acked.select("receipt_id", "topic", "partition", moved.alias("offset"), F.when(F.col("offset") % 29 != 0, F.col("sha256")).alias("sha256"))
    return reconcile.acknowledgement_conflicts(acked, stored)


@query(_DISPOSED + " SELECT receipt_id, disposition FROM disposed WHERE receipt_id IN (SELECT 'offline:' || eid * 4 FROM arrived WHERE event_type = 'click')")
def semi_lookup(spark, sf_dir):
    wanted = adapter.arrived(spark, sf_dir).where("event_type = 'click'").select(F.concat(F.lit("offline:"), (F.col("eid") * 4).cast("string")).alias("receipt_id"))
    return _outcome(spark, sf_dir).disposed.join(wanted, "receipt_id", "left_semi").select("receipt_id", "disposition")


@query(_CONTRIBUTED + f" SELECT metric_key, 'replay-v2' AS release_id, {', '.join(f'CAST(0 AS BIGINT) AS {c}' for c in COUNTERS)} FROM metrics WHERE campaign_id = 'campaign-1'")
def vanished_zero_rows(spark, sf_dir):
    m = _outcome(spark, sf_dir).metrics
    return results.vanished(m, m.where("campaign_id <> 'campaign-1'"), "replay-v2", "rules-v1").select("metric_key", "release_id", *COUNTERS)


def _visibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = adapter.packets(spark, sf_dir)
    return p.select("receipt_id", "received_at", (F.col("received_at") + 1000 + F.col("ordinal") % 37001).alias("visible_at")).unionByName(p.select("receipt_id", "received_at", (F.col("received_at") + 90000).alias("visible_at")))


@query(_BASE + ", d AS (SELECT list_sort(list(1000 + ordinal % 37001)) AS l FROM arrived) SELECT len(l) AS n, l[CAST(floor(0.95 * len(l)) AS BIGINT) + 1] AS p95_ms, l[len(l)] AS max_ms FROM d")
def freshness_p95(spark, sf_dir):
    return monitor.freshness(_visibility(spark, sf_dir))


@query(_CONTRIBUTED + ", u AS (UNPIVOT metrics ON " + ", ".join(COUNTERS) + " INTO NAME counter VALUE value) SELECT counter, cohort_basis, variant, currency, campaign_id, region, app_version, CAST(sum(value) AS BIGINT) AS value FROM u GROUP BY ALL")
def business_rollup_unpivot(spark, sf_dir):
    return monitor.business_rollup(_outcome(spark, sf_dir).metrics)


@query(_DISPOSED + " SELECT event_id, count(*) AS n FROM disposed GROUP BY 1 HAVING count(*) > 1")
def duplicate_having(spark, sf_dir):
    return adapter.arrived(spark, sf_dir).groupBy("event_id").agg(F.count("*").alias("n")).where("n > 1")


def _manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = adapter.packets(spark, sf_dir)
    return p.groupBy(F.floor(F.col("ordinal") / 1000).alias("b")).agg(F.min("received_at").alias("received_at"), F.array_sort(F.collect_list("receipt_id")).alias("receipt_ids")).select(F.concat(F.lit("batch-"), F.col("b").cast("string")).alias("batch_id"), "received_at", "receipt_ids")


@query(_DISPOSED + " SELECT 'batch-' || (ordinal // 1000) AS batch_id, count(*) AS n, min(receipt_id) AS first_receipt FROM disposed GROUP BY 1")
def receipt_explode_count(spark, sf_dir):
    return reconcile.explode_manifests(_manifests(spark, sf_dir)).groupBy("batch_id").agg(F.count("*").alias("n"), F.min("receipt_id").alias("first_receipt"))


@query(_DISPOSED + " SELECT count(*) AS acknowledged FROM disposed")
def acknowledged_count(spark, sf_dir):
    return _manifests(spark, sf_dir).agg(F.sum(F.size("receipt_ids")).alias("acknowledged"))


@query(_DISPOSED + " SELECT disposition, error_code, 'rules-v1' AS rule_version, count(*) AS n FROM disposed GROUP BY 1, 2")
def quality_summary(spark, sf_dir):
    o = _outcome(spark, sf_dir)
    return monitor.quality_summary(validate.quality_rows(o.disposed, RULES))


@query(_DISPOSED + " SELECT receipt_id, disposition, received_at AS inserted_at FROM disposed WHERE disposition <> 'cleaned' ORDER BY received_at DESC, receipt_id LIMIT 50")
def top_recent_quality(spark, sf_dir):
    rows = validate.quality_rows(_outcome(spark, sf_dir).disposed, RULES).withColumn("inserted_at", F.col("received_at"))
    return monitor.recent_samples(rows).select("receipt_id", "disposition", "inserted_at")


@query(
    """WITH c AS (SELECT event_id, 'campaign-' || user_id % 50 AS campaign_id, (event_id % 5) * 86400000 AS effective_from, 1 + event_id % 2 AS source_version, event_type = 'error' AS deleted, 'channel-' || event_id % 6 AS channel,
  row_number() OVER (PARTITION BY user_id % 50, event_id % 5, event_id % 2 ORDER BY event_id DESC) AS n FROM events) SELECT campaign_id, effective_from, source_version, channel, deleted FROM c WHERE n = 1"""
)
def cdc_latest_versions(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    row = F.struct(F.concat(F.lit("campaign-"), (F.col("user_id") % 50).cast("string")).alias("campaign_id"), ((F.col("event_id") % 5) * 86400000).alias("effective_from"), (F.col("event_id") % 2 + 1).alias("source_version"), F.to_json(F.struct(F.concat(F.lit("channel-"), (F.col("event_id") % 6).cast("string")).alias("channel"))).alias("attributes"))
    nothing = F.lit(None).cast(row_type := "struct<campaign_id:string,effective_from:bigint,source_version:bigint,attributes:string>")
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    change = F.struct(op.alias("op"), F.when(op == "d", row).otherwise(nothing).cast(row_type).alias("before"), F.when(op == "u", row).otherwise(nothing).cast(row_type).alias("after"))
    value = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(change.alias("payload")))).otherwise(F.to_json(change))
    changes = sources.decode_changes(e.select(F.lit("campaign_versions").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), value.alias("value")))
    return changes.select("campaign_id", "effective_from", "source_version", "channel", "deleted")


@query(_BASE + " SELECT 'offline:' || ordinal AS receipt_id, row_number() OVER (ORDER BY event_time, ordinal) - 1 AS ordinal FROM arrived")
def input_ordinal(spark, sf_dir):
    p = adapter.packets(spark, sf_dir).withColumn("index", F.col("ordinal"))
    return sources.with_ordinal(p).select("receipt_id", "ordinal")


@query(_CONTRIBUTED + " SELECT DISTINCT channel, cohort_basis FROM metrics")
def distinct_labels(spark, sf_dir):
    return _outcome(spark, sf_dir).metrics.select("channel", "cohort_basis").distinct()


_FINGERPRINT = sorted((*_KEYS, *COUNTERS, "metric_key"))


@query(_CONTRIBUTED + " SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in _FINGERPRINT) + ")), 1, 15) AS HUGEINT)) AS VARCHAR) AS fingerprint FROM metrics")
def dataset_fingerprint(spark, sf_dir):
    return reconcile.fingerprint(_outcome(spark, sf_dir).metrics.select(*_FINGERPRINT))


_BROKEN = """CASE ordinal % 10 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN true WHEN 4 THEN region IS NOT NULL WHEN 5 THEN event_type = 'conversion' WHEN 6 THEN true WHEN 7 THEN event_type IN ('click', 'conversion') ELSE false END"""


@query(_BASE + f" SELECT 'offline:' || ordinal AS receipt_id FROM arrived WHERE event_type = 'error' OR {_BROKEN}")
def contract_violations(spark, sf_dir):
    """Every part of the contract broken in some events: no object, a missing field, an unknown one, a wrong type, pattern, boolean, length, a field that the type requires."""
    e, n = F.col("event"), F.col("ordinal") % 10
    broken = (
        F.when(n == 0, F.concat(F.lit("["), e, F.lit("]"))).when(n == 1, F.regexp_replace(e, '"user_id":"[^"]*",', "")).when(n == 2, F.regexp_replace(e, r"^\{", '{"extra":1,')).when(n == 3, F.regexp_replace(e, '"event_time":([0-9]+)', '"event_time":"$1"'))
        .when(n == 4, F.regexp_replace(e, '"region":"[A-Z]*"', '"region":"us"')).when(n == 5, F.regexp_replace(e, '"value_minor":-?[0-9]+', '"value_minor":true')).when(n == 6, F.regexp_replace(e, '"event_id":"', '"event_id":"' + "x" * 128)).when(n == 7, F.regexp_replace(e, '"click_id":"[^"]*",', ""))
        .otherwise(e)
    )
    packets = adapter.packets(spark, sf_dir).withColumn("event", broken)
    return validate.disposition(packets, RULES).where("error_code = 'SCHEMA_INVALID'").select("receipt_id")


@query(_CONTRIBUTED + " SELECT 'a:' || association_key AS output_key, status, reason FROM associations")
def latest_tuple(spark, sf_dir):
    return results.latest_fields(_versions(spark, sf_dir), "replay-v1", "association", "status", "reason")


def _folder(spark: SparkSession, name: str) -> str:
    """A folder for the tables that a query writes: where the session's executors share one, there; else, in local tests, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="clickledger-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _store(spark: SparkSession) -> results.ResultStore:
    return results.ResultStore(spark, _folder(spark, "store"))


@query(_CONTRIBUTED + " SELECT 'a:' || association_key AS output_key, CAST(split_part(receipt_id, ':', 2) AS BIGINT) * 3 + v AS output_offset, CASE WHEN v = 0 THEN 'pending' ELSE status END AS status FROM associations, (VALUES (0), (1), (2)) AS t(v)")
def sink_results(spark, sf_dir):
    """Result messages delivered twice: every position is stored once."""
    store, told = _store(spark), results.as_messages(_versions(spark, sf_dir), "live.results").persist()
    for _ in range(2):
        store.deliver(told, now=0)
    told.unpersist()
    return store.results.select("output_key", "output_offset", F.get_json_object("payload", "$.status").alias("status"))


@query(_DISPOSED + " SELECT receipt_id, disposition, error_code FROM disposed")
def sink_quality(spark, sf_dir):
    store, rows = _store(spark), validate.quality_rows(_outcome(spark, sf_dir).disposed, RULES)
    at = F.split("receipt_id", ":")[1].cast("bigint")
    store.deliver(rows.select(F.lit("live.quality").alias("topic"), (at % 3).cast("int").alias("partition"), at.alias("offset"), F.to_json(F.struct("receipt_id", "disposition", "error_code", "rule_version")).alias("value")), now=0)
    return store.table("quality").select("receipt_id", "disposition", "error_code")


@query(_LINKED + " SELECT DISTINCT receipt_id, event_time + 250 AS received_at, 4102444800000 AS visible_at FROM clean")
def sink_visibility(spark, sf_dir):
    """Receipts that a metric message names become visible with it."""
    o = _outcome(spark, sf_dir)
    rows = metrics.contributions(o.clean, o.clicks, o.conversions, ("_receipt_id", "received_at", "event_time")).withColumn("window_start", F.floor(F.col("timestamp") / 60000) * 60000)
    changed = results.with_receipts(rows, ["advertiser_id", "app_id", "campaign_id", "window_start", "cohort_basis"])
    key = F.to_json(F.array(*[F.col(c).cast("string") for c in ("advertiser_id", "app_id", "campaign_id", "window_start", "cohort_basis")]))
    value = F.to_json(F.struct(F.lit("live-v1").alias("release_id"), F.lit("metric").alias("record_type"), F.concat(F.lit("m:"), key).alias("output_key"), "received_at", F.struct("receipt_updates").alias("payload")))
    store = _store(spark)
    store.deliver(changed.select(F.lit("live.results").alias("topic"), F.lit(0).alias("partition"), F.xxhash64(key).alias("offset"), value.alias("value")), now=4102444800000)
    return store.table("visibility").select("receipt_id", "received_at", "visible_at").distinct()


@query(_CONTRIBUTED + f" SELECT metric_key, {', '.join(f'CASE WHEN campaign_id = $$campaign-1$$ THEN 0 ELSE {c} END AS {c}' for c in COUNTERS)} FROM metrics")
def published_release(spark, sf_dir):
    """A release published over a baseline whose campaign-1 it lacks: what readers get has zero rows for it."""
    o, store = _outcome(spark, sf_dir), _store(spark)
    store.publish("base", o.metrics, o.associations, now=0)
    store.publish("next", o.metrics.where("campaign_id <> 'campaign-1'"), o.associations, baseline="base", now=0)
    return results.latest_metrics(store.results, "next").select("metric_key", *COUNTERS)


@query(_BASE + " SELECT ordinal % 3 AS partition, ordinal AS \"offset\", 'offline:' || ordinal || ' ' || event_type AS value FROM arrived")
def archive_round_trip(spark, sf_dir):
    """All traffic archived twice, indexed, and read from the index."""
    rows = adapter.arrived(spark, sf_dir).select(F.lit("demo.raw").alias("topic"), (F.col("ordinal") % 3).cast("int").alias("partition"), F.col("ordinal").alias("offset"), F.concat(F.lit("offline:"), F.col("ordinal").cast("string"), F.lit(" "), F.col("event_type")).alias("value")).persist()
    root = _folder(spark, "archive")
    for _ in range(2):
        archive.archive_batch(rows, root)
    rows.unpersist()
    index = archive.ArchiveIndex(spark, root, f"{root}-index")
    index.refresh()
    return index.records().select(F.col("partition").cast("bigint").alias("partition"), "offset", "value")


@query(_BASE + " SELECT 'offline:' || ordinal AS receipt_id, row_number() OVER (ORDER BY event_time, ordinal) - 1 AS ordinal FROM arrived WHERE ordinal % 7 <> 0")
def expected_packets(spark, sf_dir):
    """Archived raw records that were acknowledged, in the input order."""
    p = adapter.packets(spark, sf_dir)
    envelope = F.to_json(F.struct("receipt_id", "received_at", F.col("ordinal").alias("index"), F.try_parse_json("event").alias("event")))
    raw = p.select(F.lit("demo.raw").alias("topic"), F.lit(0).alias("partition"), F.col("ordinal").alias("offset"), envelope.alias("value"))
    return sources.expected_packets(raw, p.where("ordinal % 7 <> 0")).select("receipt_id", "ordinal")


@query(_DISPOSED + " SELECT receipt_id FROM disposed WHERE ordinal % 11 <> 0 AND ordinal % 50 = 0 ORDER BY 1 LIMIT 100")
def pending_samples(spark, sf_dir):
    return reconcile.pending_samples(_acknowledged(spark, sf_dir).where("ordinal % 11 <> 0"), _classified(spark, sf_dir))


@query(_DISPOSED + " SELECT receipt_id, received_at + 90000 AS visible_at FROM disposed WHERE (ordinal // 1000) % 2 = 1")
def visibility_of_prefix(spark, sf_dir):
    """Of one load's batches only."""
    batches = _manifests(spark, sf_dir).withColumn("client_batch_id", F.concat(F.lit("load-"), (F.regexp_extract("batch_id", "[0-9]+", 0).cast("bigint") % 2).cast("string"), F.lit(":"), "batch_id"))
    seen = adapter.packets(spark, sf_dir).select("receipt_id", (F.col("received_at") + 90000).alias("visible_at"))
    return collector.visible_of_prefix(seen, batches, "load-1:")


@query("""SELECT event_id, json_extract(props, '$.k')::VARCHAR AS raw_k, CAST(json_extract(props, '$.k') AS BIGINT) AS unsigned_k, [CAST(event_id AS VARCHAR), '"x"'] AS items, CAST(event_id AS VARCHAR) AS sort_key, '{"id":' || event_id || '}' AS without, greatest(0, event_id - 100) AS clamped FROM events""")
def json_functions(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    i = F.col("event_id").cast("string")
    listed = F.concat(F.lit('{"a":['), i, F.lit(',"x"]}'))
    bulky = F.concat(F.lit('{"id":'), i, F.lit(',"receipt_updates":[1,2]}'))
    return e.select("event_id", texts.raw(F.col("props"), "k").alias("raw_k"), texts.unsigned(F.col("props"), "k").alias("unsigned_k"), texts.items(listed, "a").alias("items"), texts.element(F.concat(F.lit("["), i, F.lit("]")), 0).alias("sort_key"), texts.without_fields(bulky, "receipt_updates").alias("without"), texts.at_least_zero(F.col("event_id") - 100).alias("clamped"))


@query("SELECT round(median(value), 6) AS median FROM events")
def median_of_repeats(spark, sf_dir):
    return monitor.median(spark.read.parquet(f"{sf_dir}/events.parquet"), "value").select(F.round("median", 6).alias("median"))


@query(_DISPOSED + ", r AS (SELECT avg(CASE WHEN error_code = 'SCHEMA_INVALID' THEN 1.0 ELSE 0.0 END) AS e, avg(CASE WHEN disposition = 'duplicate' THEN 1.0 ELSE 0.0 END) AS d FROM disposed) SELECT e > 0.01 AS schema_error_rate, d > 0.05 AS duplicate_rate, true AS freshness FROM r")
def alerts_broken(spark, sf_dir):
    return monitor.alerts(_outcome(spark, sf_dir).quality, 61_000, RULES)


@query(_BASE + ", f AS (SELECT list_sort(list(1000 + ordinal % 37001)) AS l FROM arrived WHERE event_time + 250 >= 1704672000000) SELECT len(l) AS n, l[CAST(floor(0.95 * len(l)) AS BIGINT) + 1] AS p95_ms, l[len(l)] AS max_ms FROM f")
def freshness_since(spark, sf_dir):
    return monitor.freshness(_visibility(spark, sf_dir), 1704672000000)


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'receipt' ELSE 'dimension' END AS kind FROM events")
def topic_classes(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    topic = F.concat(F.lit("x."), F.element_at(F.array(F.lit("raw"), F.lit("receipts"), F.lit("campaign_versions")), (F.col("event_id") % 3 + 1).cast("int")))
    return e.select("event_id", sources.topic_kind(topic).alias("kind"))


_STREAMED = """ SELECT 'association' AS kind, 'a:' || association_key AS output_key, concat_ws(',', status, reason, experiment_id, variant) AS told FROM associations
UNION ALL SELECT 'metric', 'm:' || metric_key, concat_ws(',', {}) FROM metrics""".format(", ".join(COUNTERS))


@query(_CONTRIBUTED + _STREAMED)
def streaming_attribution_converges(spark, sf_dir):
    """The bounded streaming engine over all clean events in several files, and at the end two clock events that end every wait: the batch result. Waits are longer than the data, and the retention longer than the way to the clock events."""
    day = 86_400_000
    rules = Rules(join_wait_ms=400 * day, state_retention_ms=800 * day)
    clean = _outcome(spark, sf_dir).clean
    root = _folder(spark, "attribution")
    end = clean.agg(F.max("ordinal")).first()[0] + 1
    thirds = [clean.where((F.col("ordinal") >= end * i // 3) & (F.col("ordinal") < end * (i + 1) // 3)) for i in range(3)]
    # Each batch takes as many files: the rows of a third are many for each of them, or it is one file.
    files = spark.sparkContext.defaultParallelism if min(part.count() for part in thirds) >= 50_000 else 1
    for part in thirds:  # one after the other: which conversion of a click is its first follows from the order of arrival
        part.repartition(files).write.mode("append").json(f"{root}/in")
    clock = clean.where("event_type = 'impression'").orderBy("ordinal").limit(1).withColumn("advertiser_id", F.lit("clock"))
    for i in (1, 2):
        moved = clock.select("*", F.explode(F.sequence(F.lit(1), F.lit(files))).alias("n")).withColumns({"event_time": F.lit(1_704_067_200_000 + 500 * day + i).cast("bigint"), "impression_id": F.concat(F.lit(f"clock-{i}-"), "n"), "ordinal": F.col("n") * 2 + F.lit(10**15 + i), "_receipt_id": F.concat(F.lit(f"clock:{i}:"), "n")})
        moved.drop("n").repartition(files).write.mode("append").json(f"{root}/in")
    old = {n: spark.conf.get(n, None) for n in ("spark.sql.shuffle.partitions", *attribution.STATE_OPTIONS)}
    spark.conf.set("spark.sql.shuffle.partitions", str(max(4, spark.sparkContext.defaultParallelism)))
    try:
        stream = spark.readStream.schema(clean.schema).option("maxFilesPerTrigger", files).json(f"{root}/in")
        attribution.start(spark, stream, f"{root}/live", rules, adapter.campaigns(spark), availableNow=True).awaitTermination()
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    read = lambda kind, *names: attribution.latest(spark, f"{root}/live", kind).withColumn("p", F.from_json("payload", ", ".join(f"{n} string" for n in names)))
    row = lambda kind, *names: (F.lit(kind).alias("kind"), "output_key", F.concat_ws(",", *(f"p.{n}" for n in names)).alias("told"))
    said = ("status", "reason", "experiment_id", "variant")
    links = read("association", *said).select(*row("association", *said))
    sums = read("metric", "advertiser_id", *COUNTERS).where("p.advertiser_id <> 'clock'").select(*row("metric", *COUNTERS))
    return links.unionByName(sums)
