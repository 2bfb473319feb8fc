"""Connected components of an edge table that no single machine has to hold.

Alternating large-star and small-star rounds (Kiveris et al., 2014): each round is two
grouped minima and two equi-joins, by slices of a node's links so that a large component's root is
spread over tasks, and ends in a table in the shared folder, so that a lost executor costs at most one round. As soon as
a round leaves at most FEW links, one task joins the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickledger.llm.common import drop_stored, stored

#: Links that one task may hold, 16 bytes each and as much again for its work: counted before.
FEW = 1_000_000

#: The links of a node are handled in this many slices.
SLICES = 64


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))


def with_least(links: DataFrame) -> DataFrame:
    """links (a, b, ...) plus m, the smallest b of their a. A task gets one slice of a node's links, or one row of each of its slices."""
    sliced = links.withColumn("s", F.pmod(F.xxhash64("b"), F.lit(SLICES)))
    least = sliced.groupBy("a", "s").agg(F.min("b").alias("m"))
    back = least.withColumn("m", F.min("m").over(Window.partitionBy("a")))
    return sliced.join(back, ["a", "s"]).drop("s")


def _large_star(e: DataFrame) -> DataFrame:
    links = with_least(_both_ways(e)).where("b > a")
    return links.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return with_least(down).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node of each one's component) of links between a[i] and b[i]."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    up = np.arange(len(nodes))
    while True:  # hook the larger root under the smaller one, then halve all paths; nodes are numbered in order
        p, q = up[x], up[y]
        low, high = np.minimum(p, q), np.maximum(p, q)
        if (low == high).all():
            return nodes, nodes[up]
        np.minimum.at(up, high, low)
        while not np.array_equal(up, up[up]):
            up = up[up]


def _in_one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if len(b)]
    if held:
        nodes, roots = forest(*(np.concatenate([h[i] for h in held]) for i in range(2)))
        far = nodes != roots
        for i in range(0, int(far.sum()), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[far][i : i + 10_000]), pa.array(roots[far][i : i + 10_000])], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 64, few: int = FEW) -> DataFrame:
    """(a, b) links -> (node, root), root the smallest node of its component; roots themselves have no row.

    Links in any direction, repeated or from a node to itself are fine; no links give no rows.
    """
    e = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(rounds):
        row = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (row["n"], row["x"]) == seen or not row["n"]:
            break
        few_left = row["n"] <= few
        new = stored(e.coalesce(1).mapInArrow(_in_one_task, "a bigint, b bigint") if few_left else _small_star(_large_star(e)), "edges")
        drop_stored(e)
        e, seen = new, (row["n"], row["x"])
        if few_left:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
