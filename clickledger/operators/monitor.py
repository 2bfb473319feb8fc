"""Operational queries: freshness, quality counts, business roll-ups, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickledger.functions.contracts import COUNTERS, Rules
from clickledger.functions.json import at_least_zero

ROLLUP = ("cohort_basis", "variant", "currency", "campaign_id", "region", "app_version")
#: More groups than this are an error: the snapshots that hold them are bounded documents.
MAX_GROUPS, MAX_SERIES = 1000, 10_000


#: Values of the coarse step of a quantile: so many lie in one bucket.
BUCKET = 1000


def rank_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """(n, quantile, largest): the element at floor(q * n) of the sorted whole numbers, the last at most; one row, nulls if there are none.

    Counts per value, then a running sum over buckets of BUCKET values, then one over the values of the bucket that holds the rank: no task sees
    more than the distinct buckets or BUCKET values.
    """
    per = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("bigint").alias("v")).agg(F.count("*").alias("c"))
    bucketed = per.withColumn("b", F.floor(F.col("v") / BUCKET))
    before = lambda by: F.coalesce(F.sum("c").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = bucketed.groupBy("b").agg(F.sum("c").alias("c"), F.max("v").alias("top"))
    ranked = buckets.select("b", "c", before("b").alias("under"), F.sum("c").over(Window.partitionBy()).alias("n"), F.max("top").over(Window.partitionBy()).alias("largest"))
    rank = F.least(F.floor(F.col("n") * F.lit(q)), F.col("n") - 1)
    home = ranked.where((F.col("under") <= rank) & (rank < F.col("under") + F.col("c"))).select("b", (rank - F.col("under")).alias("rest"), "n", "largest")
    inside = bucketed.join(F.broadcast(home), "b").withColumn("under", before("v"))  # home is one row
    found = inside.where((F.col("under") <= F.col("rest")) & (F.col("rest") < F.col("under") + F.col("c")))
    return found.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.max("v").alias("quantile"), F.max("largest").alias("largest"))


def median(df: DataFrame, value: str) -> DataFrame:
    """(median) of a measurement's repeats: the mean of the two in the middle for an even number."""
    return df.agg(F.median(value).alias("median"))


def freshness(visibility: DataFrame, since: int | None = None) -> DataFrame:
    """n, p95_ms, max_ms of the time from acceptance to first visibility, per receipt; since: accepted at or after this time."""
    rows = visibility if since is None else visibility.where(F.col("received_at") >= since)
    first = rows.groupBy("receipt_id").agg(at_least_zero(F.min("visible_at") - F.min("received_at")).alias("delay"))
    return rank_quantile(first, "delay", 0.95).select("n", F.col("quantile").alias("p95_ms"), F.col("largest").alias("max_ms"))


def exposition(gauges: dict[str, tuple[str, list[tuple[dict[str, str], float]]]]) -> str:
    """Metrics by name, (help, [(labels, value)]), in the text format that scrapers read."""
    quoted = lambda v: v.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
    out = []
    for name, (text, rows) in sorted(gauges.items()):
        out += [f"# HELP {name} {text}", f"# TYPE {name} gauge"]
        for labels, value in rows:
            inner = ",".join(f'{k}="{quoted(str(v))}"' for k, v in sorted(labels.items()))
            out.append(f"{name}{{{inner}}} {value:g}" if inner else f"{name} {value:g}")
    return "\n".join(out) + "\n"


def quality_summary(quality: DataFrame) -> DataFrame:
    return quality.groupBy("disposition", "error_code", "rule_version").agg(F.count("*").alias("n"))


def bounded(df: DataFrame, limit: int) -> list:
    """All rows of a small table, or an error if there are more than `limit`."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} groups")
    return rows


def recent_samples(quality: DataFrame, limit: int = 50) -> DataFrame:
    return quality.where("disposition not in ('signal', 'cleaned')").orderBy(F.desc("inserted_at"), "receipt_id").limit(limit)


def business_rollup(metrics: DataFrame) -> DataFrame:
    """(counter, roll-up dimensions, value): every counter summed, one row each."""
    pairs = ", ".join(f"'{c}', {c}" for c in COUNTERS)
    long = metrics.select(*ROLLUP, F.expr(f"stack({len(COUNTERS)}, {pairs}) as (counter, value)"))
    return long.groupBy("counter", *ROLLUP).agg(F.sum("value").alias("value"))


def ratio_of_sums(metrics: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """CTR over the impression cohort and CVR over the click cohort, as ratios of sums."""
    of = lambda cohort, c: F.sum(F.when(F.col("cohort_basis") == cohort, F.col(c)))
    return metrics.groupBy(*by).agg(F.try_divide(of("impression", "clicks"), of("impression", "impressions")).alias("ctr"), F.try_divide(of("click", "converted_clicks"), of("click", "clicks")).alias("cvr"))


def pending_count(latest_associations: DataFrame) -> DataFrame:
    return latest_associations.agg(F.count_if(F.col("status") == "pending").alias("pending"))


def alerts(quality: DataFrame, p95_ms: int | None, rules: Rules) -> DataFrame:
    """Which thresholds of the rules are broken."""
    t = rules.thresholds
    terminal = quality.where("disposition <> 'signal'")
    rates = terminal.agg(F.try_divide(F.count_if(F.col("error_code") == "SCHEMA_INVALID"), F.count("*")).alias("e"), F.try_divide(F.count_if(F.col("disposition") == "duplicate"), F.count("*")).alias("d"))
    return rates.select((F.coalesce("e", F.lit(0.0)) > t["schema_error_rate"]).alias("schema_error_rate"), (F.coalesce("d", F.lit(0.0)) > t["duplicate_rate"]).alias("duplicate_rate"), F.lit((p95_ms or 0) > t["freshness_seconds"] * 1000).alias("freshness"))
