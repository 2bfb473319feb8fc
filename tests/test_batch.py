from __future__ import annotations

import pytest
from tests.helpers import BASE, event, packets
from pyspark.sql import functions as F

from clickledger.functions.contracts import CAMPAIGN_VERSION, COUNTERS, Rules
from clickledger.operators import reconcile, validate
from clickledger.plans.batch import calculate
from clickledger.sources import generator
from clickledger.sources.packets import offline_packets

DAY = 86_400_000


def codes(spark, events, rules=None):
    rows = validate.disposition(packets(spark, events), rules or Rules()).orderBy("ordinal").select("disposition", "error_code").collect()
    return [tuple(r) for r in rows]


BAD = {
    "text": "nonsense", "list": "[1]", "number": "3", "null": "null", "missing": event("click", click_id=...), "extra": event("click", more=1), "bool": event("conversion", value_minor=True), "numeric text": event("conversion", value_minor="123"),
    "fraction": event("impression", event_time=1.5), "negative": event("impression", event_time=-1), "too late": event("impression", event_time=4102444800001), "region": event("impression", region="us"), "empty": event("click", user_id=""), "long id": event("click", event_id="x" * 129), "type": event("click", event_type="view"),
    "null field": event("click", region=None), "version text": event("click", schema_version="1"), "variant": event("impression", variant="other"), "big value": event("conversion", value_minor=10**12 + 1),
}


def test_contract_violations_are_quarantined(spark):
    assert set(codes(spark, list(BAD.values()))) == {("quarantined", "SCHEMA_INVALID")}


def test_accepted_shapes(spark):
    good = [event("impression"), event("click", event_time=float(BASE)), event("conversion", value_minor=0), event("click", "2", region="US", received_at=1)]
    assert codes(spark, good) == [("cleaned", "OK")] * 4
    assert codes(spark, [event("click", received_at="client nonsense")]) == [("cleaned", "OK")]  # the server's time replaces it


def test_rules(spark):
    e = [event("impression", "1"), event("impression", "2", region="JP")]
    assert codes(spark, e, Rules(filter_regions=("JP",))) == [("cleaned", "OK"), ("filtered", "RULE_FILTERED")]
    assert codes(spark, e, Rules(schema_versions=(2,))) == [("quarantined", "SCHEMA_VERSION_DISABLED")] * 2
    assert codes(spark, [event("click", at=5)], Rules(effective_from=6)) == [("filtered", "RULE_FILTERED")]
    old = event("click", campaign_id=..., cid="campaign-0")
    both = event("click", "2", cid="campaign-1")
    assert codes(spark, [old, both], Rules(field_mappings={"cid": "campaign_id"})) == [("cleaned", "OK"), ("quarantined", "SCHEMA_INVALID")]


@pytest.mark.parametrize("wrong", [{"state_retention_ms": 1}, {"window_ms": 0}, {"filter_regions": ("us",)}, {"schema_versions": ()}])
def test_rules_are_checked(wrong):
    with pytest.raises(ValueError):
        Rules(**wrong)


def test_dedup_order_and_codes(spark):
    e = [event("click", "1"), event("click", "1"), event("click", "1", event_id="other"), event("click", "1", event_id="other"), event("click", "2", event_id="other"), event("click", "1", advertiser_id="adv2")]
    assert [c for _, c in codes(spark, e)] == ["OK", "DUPLICATE_EVENT_ID", "DUPLICATE_BUSINESS_KEY", "DUPLICATE_EVENT_ID", "DUPLICATE_EVENT_ID", "OK"]


@pytest.mark.parametrize("delta,reason", [(-1, "CLICK_AFTER_CONVERSION"), (0, "MATCHED"), (DAY, "MATCHED"), (DAY + 1, "ATTRIBUTION_WINDOW_EXCEEDED")])
def test_attribution_interval_is_closed(spark, delta, reason):
    o = calculate(packets(spark, [event("click"), event("conversion", at=BASE + delta)]))
    assert o.associations.first()["reason"] == reason


@pytest.mark.parametrize("change,reason", [({"user_id": "x"}, "IDENTITY_MISMATCH"), ({"campaign_id": "x"}, "CAMPAIGN_MISMATCH"), ({"advertiser_id": "x"}, "CLICK_NOT_FOUND"), ({"app_id": "x"}, "CLICK_NOT_FOUND")])
def test_identity(spark, change, reason):
    a = calculate(packets(spark, [event("click"), event("conversion", **change)])).associations.first()
    assert (a["status"], a["reason"]) == ("unmatched", reason)


@pytest.mark.parametrize(
    "imp,reason",
    [({}, "OK"), ({"impression_id": "other"}, "IMPRESSION_NOT_FOUND"), ({"user_id": "x"}, "IMPRESSION_IDENTITY_MISMATCH"), ({"campaign_id": "x"}, "IMPRESSION_CAMPAIGN_MISMATCH"), ({"at": BASE + 1}, "CLICK_BEFORE_IMPRESSION"), ({"at": BASE - DAY}, "OK"), ({"at": BASE - DAY - 1}, "IMPRESSION_WINDOW_EXCEEDED")],
)
def test_exposure(spark, imp, reason):
    o = calculate(packets(spark, [event("impression", **imp), event("click"), event("conversion", at=BASE + 5)]))
    assert o.clicks.first()["reason"] == reason
    a = o.associations.first()
    assert a["status"] == "matched" and a["variant"] == ("control" if reason == "OK" else "unknown")
    assert o.quality.where("disposition = 'signal'").count() == (reason != "OK")


def totals(o):
    rows = o.metrics.groupBy("cohort_basis", "currency").agg(*[F.sum(c).alias(c) for c in COUNTERS]).collect()
    return {(r["cohort_basis"], r["currency"]): {c: r[c] for c in COUNTERS if r[c]} for r in rows}


def test_two_conversions_of_a_click(spark):
    e = [event("impression"), event("click", at=BASE + 60_000), event("conversion", "1", at=BASE + 3_600_000), event("conversion", "2", at=BASE + 3_600_001, click_id="c1", currency="JPY", value_minor=7)]
    o = calculate(packets(spark, e))
    assert totals(o) == {
        ("occurrence", "ALL"): {"impressions": 1, "clicks": 1, "matched_conversions": 2},
        ("impression", "ALL"): {"impressions": 1, "clicks": 1},
        ("click", "ALL"): {"clicks": 1, "matched_conversions": 2, "converted_clicks": 1},
        ("conversion_value", "USD"): {"matched_conversions": 1, "value_minor": 500},
        ("conversion_value", "JPY"): {"matched_conversions": 1, "value_minor": 7},
    }
    assert {r["window_start"] for r in o.metrics.where("cohort_basis = 'click'").collect()} == {(BASE + 60_000) // 60_000 * 60_000}


def test_channel_is_that_of_the_cohort_time(spark):
    dim = spark.createDataFrame([("campaign-0", BASE, None, 1, "feed", False), ("campaign-0", BASE, None, 2, "search", False), ("campaign-1", 0, BASE, 1, "feed", False), ("campaign-2", 0, None, 1, "feed", True)], CAMPAIGN_VERSION)
    e = [event("impression", "1"), event("impression", "2", at=BASE - 1), event("impression", "3", campaign_id="campaign-1"), event("impression", "4", campaign_id="campaign-2"), event("impression", "5", campaign_id="nowhere")]
    got = {(r["campaign_id"], r["channel"]) for r in calculate(packets(spark, e), dimension=dim).metrics.collect()}
    assert got == {("campaign-0", "search"), ("campaign-0", "unknown"), ("campaign-1", "unknown"), ("campaign-2", "deleted"), ("nowhere", "unknown")}


def test_metric_key_is_canonical(spark):
    m = calculate(packets(spark, [event("impression", region="US", user_id='q"é')])).metrics.where("cohort_basis = 'occurrence'").first()
    assert m["metric_key"] == f'["adv","app","campaign-0","US","1","x","control","ALL","unknown",{BASE // 60000 * 60000},"occurrence","explicit-click-v1"]'


@pytest.mark.parametrize("scenario", generator.SCENARIOS)
def test_transport_does_not_change_results(spark, scenario):
    rows = generator.truth(spark, 60, scenario).cache()
    want, got = calculate(offline_packets(rows)), calculate(offline_packets(generator.transport(rows, scenario)))
    report = reconcile.report((want.metrics, want.associations), (got.metrics, got.associations))
    assert report["passed"], report["differences"][:3]
    n = generator.transport(rows, scenario).count()
    assert got.disposed.count() == n and got.quality.where("disposition <> 'signal'").count() == n


def test_empty_input(spark):
    o = calculate(packets(spark, []))
    assert o.metrics.count() == 0 and o.associations.count() == 0 and o.quality.count() == 0
