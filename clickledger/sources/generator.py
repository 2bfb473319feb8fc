"""Deterministic synthetic traffic: a truth, and what transport makes of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCENARIOS = ("normal", "duplicates", "schema", "out-of-order", "conversion-first", "hotspot", "mixed")
START = 1_788_696_000_000


def _draw(seed: int, *what: Column | str) -> Column:
    """A number in [0, 1) from a hash of the seed and what it is for."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.lit(w) if isinstance(w, str) else w for w in what]), F.lit(1_000_003)) / 1_000_003.0


def truth(spark: SparkSession, users: int, scenario: str = "normal", seed: int = 17, start: int = START) -> DataFrame:
    """(ordinal, event): impressions of all users, clicks of about 65 %, conversions of about 45 % of these (two for every seventh user)."""
    if scenario not in SCENARIOS:
        raise ValueError(f"one of {SCENARIOS}")
    i = F.col("id")
    campaign = F.concat(F.lit("campaign-"), (i % 4).cast("string"))
    if scenario == "hotspot":
        campaign = F.when(_draw(seed, "hot", i) < 0.9, F.lit("campaign-0")).otherwise(campaign)
    base = spark.range(users).select(
        "id", F.concat(F.lit("adv-"), (i % 3).cast("string")).alias("advertiser_id"), F.lit("app-1").alias("app_id"), F.concat(F.lit("user-"), i.cast("string")).alias("user_id"), campaign.alias("campaign_id"),
        F.element_at(F.array(F.lit("US"), F.lit("JP"), F.lit("GB")), (i % 3 + 1).cast("int")).alias("region"), F.when(i % 2 == 0, "control").otherwise("treatment").alias("variant"), (F.lit(start) + i * 1000).alias("t"),
        (_draw(seed, "click", i) < 0.65).alias("clicked"), (_draw(seed, "convert", i) < 0.45).alias("converted"),
    )
    ident = lambda kind, n="": F.concat(F.lit(f"{kind}-"), i.cast("string"), F.lit(n))
    common = lambda kind, at, n="": [F.concat(F.lit(f"event-{kind}-"), i.cast("string"), F.lit(n)).alias("event_id"), F.lit(kind).alias("event_type"), at.alias("event_time"), F.lit(1).alias("schema_version"), "app_id", F.concat(F.lit("trace-"), i.cast("string")).alias("trace_id"), "advertiser_id", "user_id", "campaign_id", F.lit("1.4.0").alias("app_version")]
    t = F.col("t")
    imp = base.select("id", F.lit(0).alias("step"), F.to_json(F.struct(*common("impression", t), ident("imp").alias("impression_id"), ident("ad").alias("ad_id"), "region", F.lit("creative-test").alias("experiment_id"), "variant")).alias("event"))
    clk = base.where("clicked").select("id", F.lit(1).alias("step"), F.to_json(F.struct(*common("click", t + 1500), ident("clk").alias("click_id"), ident("imp").alias("impression_id"), "region")).alias("event"))
    value = (F.lit(100) + F.pmod(F.xxhash64(F.lit(seed), F.lit("value"), i), F.lit(9901))).cast("bigint")
    conv = lambda n: F.to_json(F.struct(*common("conversion", t + 5000 + (0 if not n else 1), n), ident("conv", n).alias("conversion_id"), ident("clk").alias("click_id"), F.lit("purchase").alias("conversion_type"), value.alias("value_minor"), F.lit("USD").alias("currency"), "region"))
    buy = base.where("clicked and converted")
    out = imp.unionByName(clk).unionByName(buy.select("id", F.lit(2).alias("step"), conv("").alias("event"))).unionByName(buy.where("id % 7 = 0").select("id", F.lit(3).alias("step"), conv("-b").alias("event")))
    return out.select((F.col("id") * 4 + F.col("step")).alias("ordinal"), "event")


def transport(rows: DataFrame, scenario: str, seed: int = 17) -> DataFrame:
    """The same traffic as it arrives: repeated, malformed, shuffled or in reverse, by scenario."""
    out = rows.select((F.col("ordinal") * 10).alias("ordinal"), "event")
    if scenario in ("duplicates", "mixed"):
        ninth = rows.where("ordinal % 9 = 0")
        renamed = F.regexp_replace("event", '"event_id":"([^"]*)"', '"event_id":"$1-again"')
        out = out.unionByName(ninth.select((F.col("ordinal") * 10 + 1).alias("ordinal"), "event")).unionByName(ninth.select((F.col("ordinal") * 10 + 2).alias("ordinal"), renamed.alias("event")))
    if scenario in ("schema", "mixed"):
        out = out.unionByName(rows.where("ordinal = 0").select(F.lit(5).cast("bigint").alias("ordinal"), F.regexp_replace("event", '"event_time":([0-9]+)', '"event_time":"$1"').alias("event")))
    if scenario in ("out-of-order", "mixed"):
        # Copies of a record must not overtake the record that truth knows: they keep its place.
        out = out.withColumn("ordinal", (F.pmod(F.xxhash64(F.lit(seed), F.floor(F.col("ordinal") / 10)), F.lit(1 << 40)) * 10 + F.col("ordinal") % 10).cast("bigint"))
    if scenario == "conversion-first":
        kind = F.get_json_object("event", "$.event_type")
        out = out.withColumn("ordinal", F.when(kind == "conversion", F.col("ordinal")).when(kind == "click", F.col("ordinal") + (1 << 40)).otherwise(F.col("ordinal") + (2 << 40)))
    return out
