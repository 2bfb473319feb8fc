"""The batch engine: packets in, quality, associations and metrics out, as one declarative plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickledger.functions.contracts import Rules
from clickledger.operators import link, metrics, validate


@dataclass(frozen=True)
class Outcome:
    """Lazy results of one calculation."""

    disposed: DataFrame
    clean: DataFrame
    clicks: DataFrame
    conversions: DataFrame
    quality: DataFrame
    associations: DataFrame
    metrics: DataFrame


def calculate(packets: DataFrame, rules: Rules | None = None, dimension: DataFrame | None = None, release_id: str = "replay-v1", keep: bool = False) -> Outcome:
    """packets: receipt_id, received_at, ordinal (the input order), event (JSON text).

    keep caches the clean events, which links and metrics read several times.
    """
    rules = rules or Rules()
    disposed = validate.disposition(packets, rules)
    clean = validate.clean_events(disposed, rules)
    if keep:
        clean = clean.persist()
    clicks = link.link_clicks(clean, rules)
    conversions = link.link_conversions(clean, clicks, rules)
    rows = metrics.contributions(clean, clicks, conversions)
    return Outcome(
        disposed, clean, clicks, conversions,
        validate.quality_rows(disposed, rules).unionByName(link.signals(clicks, rules)),
        link.associations(conversions, rules, release_id),
        metrics.aggregate(rows, rules, dimension, release_id),
    )
