"""Operator 4: mix sources to target weights by Poisson replication.

Every document draws its number of copies from a Poisson distribution whose mean is its
source's repetition rate. The draw inverts the distribution at a uniform number hashed
from seed and id, so it is the same on every run and executor. The copies are then
dealt out by a hash of seed, id and copy: a global shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 52 bits of MD5 as a number in [0, 1).
_BITS = 13
#: A larger mean is the sum of independent draws of this mean and one of the rest.
STEP = 32.0
_TERMS = 160
#: Copies that one task expands from one row before they are dealt out again.
_CHUNK = 1024
#: A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
MAX_BROADCAST_SOURCES = 10_000


def _hash52(*parts: F.Column) -> F.Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, _BITS), 16, 10).cast("long")


def source_rates(df: DataFrame, source: str, size: F.Column, weights: dict[str, float] | None, budget: float | None) -> DataFrame:
    """(source, rate): target weight times budget over the source's size.

    No weights: all sources get the same. No budget: the size of the corpus. A source that
    weighs nothing, is not named in the weights or has no bytes gets rate 0. Null is a source.
    """
    per = df.select(df[source].alias("_source"), size.alias("_size")).groupBy("_source").agg(F.sum("_size").cast("double").alias("_size"))
    if weights is None:
        weight = F.when(F.col("_size") > 0, F.lit(1.0)).otherwise(0.0)
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    per = per.withColumn("_weight", weight)
    total = per.agg(F.sum("_weight").alias("w"), F.sum("_size").alias("s")).first()  # two numbers
    w, spend = total["w"] or 0.0, float(budget) if budget is not None else total["s"] or 0.0
    rate = F.col("_weight") / F.lit(w) * F.lit(spend) / F.col("_size") if w > 0 else F.lit(0.0)
    return per.select("_source", F.when(F.col("_size") > 0, rate).otherwise(0.0).alias("_rate"))


def poisson_cdf(rate: F.Column) -> F.Column:
    """P(X <= k) for k = 0, 1, ... of X Poisson with a mean of at most STEP, by adding up the probabilities; 160 terms carry all 52 bits of a draw."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_TERMS)),
        F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c")),
        lambda a, i: F.struct((a["p"] * rate / i).alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * rate / i)).alias("c")),
    )["c"]


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: dict[str, float] | None = None, budget: float | None = None, seed: str = "mix-1") -> DataFrame:
    """All columns of df plus copy (from 0) and shuffle_key, one row per copy, dealt out at random.

    Size is UTF-8 bytes. A document with rate r appears k times, k Poisson with mean r. A null id
    draws as the text "null" (all null ids alike); rows that repeat an id draw alike; an empty table gives no
    rows. Input columns named copy or shuffle_key are replaced.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c.lower() not in ("copy", "shuffle_key")]
    size = F.coalesce(F.octet_length(df[text]).cast("long"), F.lit(0))
    # The input's columns travel as one struct, so no name of theirs meets one of ours.
    rows = df.select(F.struct(*[df[c] for c in names]).alias("_row"), F.coalesce(df[id_col].cast("string"), F.lit("null")).alias("_ident"), df[source].alias("_of"))
    rates = source_rates(df, source, size, weights, budget)
    steps = F.floor(F.col("_rate") / STEP).cast("int")
    rates = rates.select("_source", "_rate", steps.alias("_steps"), poisson_cdf(F.col("_rate") - steps * STEP).alias("_rest"), F.when(steps > 0, poisson_cdf(F.lit(STEP))).alias("_whole"))
    few = len(rates.select("_source").limit(MAX_BROADCAST_SOURCES + 1).collect()) <= MAX_BROADCAST_SOURCES
    rated = rows.join(F.broadcast(rates) if few else rates, F.col("_of").eqNullSafe(F.col("_source")))
    u = lambda j: _hash52(F.lit(seed), F.col("_ident"), j.cast("string")) / F.lit(float(2 ** (4 * _BITS)))
    invert = lambda cdf, j: F.size(F.filter(cdf, lambda c: c <= u(j))).cast("long")
    rest = invert(F.col("_rest"), F.lit(0))
    whole = F.aggregate(F.sequence(F.lit(1), F.col("_steps")), F.lit(0).cast("long"), lambda n, j: n + invert(F.col("_whole"), j))
    draws = rated.where(F.col("_rate") > 0).select("_row", "_ident", (rest + F.when(F.col("_steps") > 0, whole).otherwise(F.lit(0))).alias("_count"))
    # Two steps, with a shuffle between them, so that a row with very many copies is not expanded by one task.
    chunks = draws.where("_count > 0").withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1, F.lit(_CHUNK).cast("long"))))
    dealt = chunks.repartition(F.xxhash64("_ident", "_from"))
    copies = dealt.withColumn("copy", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + _CHUNK, F.col("_count")) - 1)))
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.col("_ident"), F.col("copy").cast("string")))
    copies = copies.select("_row", "copy", F.conv(F.substring(place, 1, 15), 16, 10).cast("long").alias("shuffle_key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key").select("_row.*", "copy", "shuffle_key")


def invert_poisson(rate: float, us: list[float]) -> int:
    """The count of mix() in plain Python, for tests: us[0] draws the rest, us[1:] the whole steps."""
    total = 0
    for mean, u in [(rate - STEP * (len(us) - 1), us[0]), *((STEP, x) for x in us[1:])]:
        p = c = math.exp(-mean)
        k = 0
        while c <= u and k <= _TERMS:
            k += 1
            p = p * mean / k
            c += p
        total += k
    return total
