"""Small builders for events and packets."""

from __future__ import annotations

import json

from clickledger.functions.contracts import PACKET

BASE = 1_700_000_000_000


def event(kind: str, n: str = "1", at: int = BASE, **more) -> dict:
    e = {
        "event_id": f"e-{kind}-{n}", "event_type": kind, "event_time": at, "schema_version": 1, "app_id": "app", "trace_id": "t", "advertiser_id": "adv", "user_id": "u", "campaign_id": "campaign-0", "app_version": "1",
    }
    e |= {
        "impression": {"impression_id": f"i{n}", "ad_id": "ad", "region": "US", "experiment_id": "x", "variant": "control"},
        "click": {"click_id": f"c{n}", "impression_id": f"i{n}"},
        "conversion": {"conversion_id": f"v{n}", "click_id": f"c{n}", "conversion_type": "purchase", "value_minor": 500, "currency": "USD"},
    }[kind]
    e |= more
    return {k: v for k, v in e.items() if v is not ...}


def packets(spark, events: list):
    rows = [(f"r{i}", BASE + i, i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, PACKET)
