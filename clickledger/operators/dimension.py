"""The temporally versioned campaign dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickledger.functions.contracts import UNKNOWN

#: The history is a broadcast table; more versions than this are an error, not a truncation.
MAX_VERSIONS = 10_000


def version_lists(dimension: DataFrame, max_versions: int = MAX_VERSIONS) -> DataFrame:
    """(_campaign, _versions): the bounded history, one row per campaign, ready to be broadcast."""
    if len(dimension.select("campaign_id").limit(max_versions + 1).collect()) > max_versions:
        raise ValueError(f"the campaign history has more than {max_versions} versions")
    return dimension.groupBy(F.col("campaign_id").alias("_campaign")).agg(F.collect_list(F.struct("source_version", "effective_from", "effective_to", "channel", "deleted")).alias("_versions"))


def _in_force(versions: Column, timestamp: Column) -> Column:
    return F.filter(versions, lambda v: (v["effective_from"] <= timestamp) & (v["effective_to"].isNull() | (timestamp < v["effective_to"])))


def channel_at(versions: Column, timestamp: Column) -> Column:
    """The channel of the version in force: the largest (source_version, effective_from) whose interval [from, to) holds the time."""
    valid = _in_force(versions, timestamp)
    ranked = F.transform(valid, lambda v: F.struct(v["source_version"].alias("s"), v["effective_from"].alias("f"), F.when(v["deleted"], "deleted").otherwise(v["channel"]).alias("c")))
    return F.coalesce(F.array_max(ranked)["c"], F.lit(UNKNOWN))


def with_channel(rows: DataFrame, dimension: DataFrame | None, campaign: str = "campaign_id", timestamp: str = "timestamp") -> DataFrame:
    """rows plus channel, by a broadcast join on the campaign and a look into its versions: no row is multiplied, nothing is shuffled."""
    if dimension is None:
        return rows.withColumn("channel", F.lit(UNKNOWN))
    lists = version_lists(dimension)
    joined = rows.join(F.broadcast(lists), rows[campaign] == lists["_campaign"], "left")
    return joined.withColumn("channel", channel_at(F.col("_versions"), F.col(timestamp))).drop("_campaign", "_versions")


def without_version(rows: DataFrame, dimension: DataFrame, campaign: str = "campaign_id", timestamp: str = "timestamp") -> DataFrame:
    """The rows whose campaign has no version in force at their time; one with a deleted version has one."""
    lists = version_lists(dimension)
    joined = rows.join(F.broadcast(lists), rows[campaign] == lists["_campaign"], "left")
    return joined.where(F.coalesce(F.size(_in_force(F.col("_versions"), F.col(timestamp))), F.lit(0)) <= 0).drop("_campaign", "_versions")
