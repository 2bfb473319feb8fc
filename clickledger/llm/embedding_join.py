"""Operator 5: embedding near-dedup by an epsilon grid order join.

Unit vectors within an angle are points within a distance epsilon. Vectors are turned to their
principal axes (a rotation keeps distances), put in the lexicographic order of their grid cells of width
epsilon on the leading axes within each label, and cut into blocks of that sequence. Blocks whose
boxes lie further apart than epsilon are never paired; a pair of blocks is joined by halving both
intervals again and again, skipping halves that are provably distant, down to small products in
double precision. Counts and a spanning forest of links leave a block pair, never a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import stored
from clickledger.llm.components import components

#: Vectors of a block, and of an interval that is multiplied out.
BLOCK = 2048
LEAF = 256
#: Axes in the sort order and in the boxes.
ORDER_AXES = 4
BOX_AXES = 12
#: Slack of the box test over epsilon, for rounding; the cosine itself decides on a pair.
SLACK = 1e-6


def _valid(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(vec, label, v) of the vectors that can link: known key and label, not null or empty, all components finite, not zero."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        df.select(df[key].cast("bigint").alias("vec"), df[label].alias("label"), df[vector].alias("v"))
        .where("vec is not null and label is not null and v is not null and size(v) > 0")
        .where(~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))
    )


def _unit(flat: np.ndarray) -> np.ndarray:
    x = flat.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow and no underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes (as columns, leading first) per dimension, from the second moments of all vectors; a task sends one matrix per dimension."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            lists = b.column(0)
            dims = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                x = _unit(_matrix(lists.filter(pa.array(dims == d)), int(d)))
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], names=["dim", "i", "row"])

    rows = vectors.select("v").mapInArrow(run, "dim int, i int, row array<double>")
    summed = rows.select("dim", "i", F.posexplode("row").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x"))
    out: dict[int, np.ndarray] = {}
    for r in summed.collect():  # dim * dim numbers for each dimension, whatever the rows
        out.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"], r["j"]] = r["x"]
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1] for d, m in out.items()}


def _blocks(vectors: DataFrame, axes: dict[int, np.ndarray], eps: float) -> DataFrame:
    """The grid-ordered sequence in blocks: block, label, dim, n, lo, hi (box), vec, weight, data (binary, float64, turned)."""
    label = vectors.schema["label"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast({d: a.copy() for d, a in axes.items()})  # dim * dim numbers

    def cells(batches):
        for b in batches:
            dims = pa.compute.list_value_length(b.column(3)).to_numpy(zero_copy_only=False)
            for d in np.unique(dims).tolist():
                at = pa.array(dims == d)
                x = _unit(_matrix(b.column(3).filter(at), d)) @ shared.value[d]
                grid = np.zeros((len(x), ORDER_AXES), np.int64)
                k = min(d, ORDER_AXES)
                grid[:, :k] = np.floor(x[:, :k] / eps)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).filter(at) for i in range(3)), pa.array([d] * len(x), pa.int32()), *(pa.array(grid[:, i]) for i in range(ORDER_AXES)), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["vec", "label", "weight", "dim", *(f"c{i}" for i in range(ORDER_AXES)), "data"],
                )

    order = ["label", "dim", *(f"c{i}" for i in range(ORDER_AXES)), "vec"]
    celled = vectors.select("vec", "label", "weight", "v").mapInArrow(cells, f"vec bigint, label {label}, weight bigint, dim int, " + ", ".join(f"c{i} bigint" for i in range(ORDER_AXES)) + ", data binary")
    celled = stored(celled, "cells")
    parts = max(1, min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-celled.count() // BLOCK)))
    sequence = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, number = TaskContext.get().partitionId() << 32, 0
        names = ["block", "label", "dim", "n", "lo", "hi", "vec", "weight", "data"]
        kind, held = None, []  # rows of one (label, dim)

        def block(rows):
            nonlocal number
            dim = kind[1]
            x = np.frombuffer(b"".join(r[2] for r in rows), np.float64).reshape(-1, dim)
            k = min(dim, BOX_AXES)
            number += 1
            return (first + number - 1, kind[0], dim, len(rows), x[:, :k].min(0).tolist(), x[:, :k].max(0).tolist(), np.array([r[0] for r in rows], np.int64).tobytes(), np.array([r[1] for r in rows], np.int64).tobytes(), x.tobytes())

        schema = None

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema)], names=names)

        for b in batches:
            if schema is None:
                schema = [pa.int64(), b.schema.field(1).type, pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            out = []
            vec, lab, weight, dim, data = (b.column(i).to_pylist() for i in range(5))
            for i in range(len(vec)):
                if (lab[i], dim[i]) != kind or len(held) >= BLOCK:
                    if held:
                        out.append(block(held))
                    kind, held = (lab[i], dim[i]), []
                held.append((vec[i], weight[i], data[i]))
            if out:
                yield batch(out)
        if held:
            yield batch([block(held)])

    return stored(sequence.select("vec", "label", "weight", "dim", "data").mapInArrow(cut, f"block bigint, label {label}, dim int, n int, lo array<double>, hi array<double>, vec binary, weight binary, data binary"), "blocks")


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(i, j), i <= j: blocks of a label whose boxes come within eps, found by an equi-join on cells of the first axis."""
    box = blocks.select("block", "label", "dim", "lo", "hi")
    cell = lambda side, by: F.floor(F.get(side, F.lit(0)) / eps) + by
    left = box.select(F.col("block").alias("i"), "label", "dim", F.col("lo").alias("lo_i"), F.col("hi").alias("hi_i"), F.explode(F.sequence(cell("lo", 0), cell("hi", 0))).alias("cell"))
    right = box.select(F.col("block").alias("j"), "label", "dim", F.col("lo").alias("lo_j"), F.col("hi").alias("hi_j"), F.explode(F.sequence(cell("lo", -1), cell("hi", 1))).alias("cell"))
    gaps = F.zip_with(
        F.zip_with("lo_i", "hi_j", lambda a, b: F.greatest(a - b, F.lit(0.0))),
        F.zip_with("lo_j", "hi_i", lambda a, b: F.greatest(a - b, F.lit(0.0))),
        lambda a, b: F.greatest(a, b),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return left.join(right, ["label", "dim", "cell"]).where("i <= j").where(apart <= F.lit((eps + SLACK) ** 2)).select("i", "j").distinct()


class _Side:
    def __init__(self, row: tuple, dim: int):
        self.vec, self.weight = np.frombuffer(row[0], np.int64), np.frombuffer(row[1], np.int64)
        self.x = np.frombuffer(row[2], np.float64).reshape(-1, dim)
        self.count = np.zeros(len(self.vec), np.int64)


class _Forest:
    """Smallest-root union-find over local numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def join_blocks(a: _Side, b: _Side, cosine: float, eps: float) -> _Forest:
    """Count links of each vector between two blocks (or within one, a is b); the forest numbers a's vectors, then b's."""
    same = a is b
    shift = 0 if same else len(a.vec)
    forest = _Forest(len(a.vec) + (0 if same else len(b.vec)))
    k = min(a.x.shape[1], BOX_AXES)
    limit = (eps + SLACK) ** 2

    def apart(x: np.ndarray, y: np.ndarray) -> bool:
        gap = np.maximum(np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)), 0.0)
        return float(gap @ gap) > limit

    todo = [(0, len(a.vec), 0, len(b.vec))]
    while todo:
        p, q, r, s = todo.pop()
        if same and r < p:
            continue  # the mirror image is done
        if apart(a.x[p:q, :k], b.x[r:s, :k]):
            continue
        if q - p > LEAF or s - r > LEAF:
            pm, rm = (p + q) // 2, (r + s) // 2
            if same and (p, q) == (r, s):
                todo += [(p, pm, p, pm), (p, pm, pm, q), (pm, q, pm, q)]
            elif q - p >= s - r:
                todo += [(p, pm, r, s), (pm, q, r, s)]
            else:
                todo += [(p, q, r, rm), (p, q, rm, s)]
            continue
        link = a.x[p:q] @ b.x[r:s].T >= cosine
        if same and (p, q) == (r, s):
            np.fill_diagonal(link, False)
            a.count[p:q] += link @ a.weight[p:q]
        else:
            a.count[p:q] += link @ b.weight[r:s]
            b.count[r:s] += a.weight[p:q] @ link
        if link.any():
            _tie(forest, link, p, shift + r)
    return forest


def _tie(forest: _Forest, link: np.ndarray, at: int, to: int) -> None:
    """Join what a matrix of links connects, by one spanning walk instead of one step per link."""
    left = np.flatnonzero(link.any(1))
    done = np.zeros(link.shape[1], bool)
    open_rows = np.zeros(link.shape[0], bool)
    open_rows[left] = True
    for i in left:
        if not open_rows[i]:
            continue
        open_rows[i] = False
        front = link[i] & ~done
        for j in np.flatnonzero(link[i] & done)[:1]:
            forest.join(at + int(i), to + int(j))
        while front.any():
            done |= front
            for j in np.flatnonzero(front):
                forest.join(at + int(i), to + int(j))
            rows = link[:, front].any(1) & open_rows
            open_rows &= ~rows
            for x in np.flatnonzero(rows):
                forest.join(at + int(i), at + int(x))
            front = link[rows].any(0) & ~done if rows.any() else np.zeros_like(done)


def _pair_links(cosine: float, eps: float):
    """Rows (i, j, block, dim, vec, weight, data) sorted by i, j, block -> (vec, n, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}

        def result() -> pa.RecordBatch:
            a, b = _Side(*held[now[0]]), None
            b = a if now[0] == now[1] else _Side(*held[now[1]])
            forest = join_blocks(a, b, cosine, eps)
            vec = a.vec if a is b else np.concatenate([a.vec, b.vec])
            n = a.count if a is b else np.concatenate([a.count, b.count])
            at = np.flatnonzero(n)
            root = np.array([forest.find(int(x)) for x in at], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(vec[at]), pa.array(n[at]), pa.array(vec[root] if len(at) else np.zeros(0, np.int64))], names=["vec", "n", "root"])

        for batch in batches:
            for r in range(batch.num_rows):
                i, j, block, dim = (batch.column(c)[r].as_py() for c in range(4))
                if (i, j) != now:
                    if now is not None:
                        yield result()
                    now, held = (i, j), {}
                held[block] = (tuple(batch.column(c)[r].as_py() for c in range(4, 7)), dim)
        if now is not None:
            yield result()

    return run


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.93) -> DataFrame:
    """One row per row of df: key, n_links, component_id, kept.

    Two vectors of one label link when their cosine, in double precision, is at least `cosine`. Null, empty or zero
    vectors, vectors with null or non-finite components, and rows with a null label or key link with
    nothing (component: their own key; a null key has a null component and is kept). Vectors of different lengths do not
    link. Rows that repeat a key are one vector; equal vectors are compared once. An empty table gives
    no rows; other columns are not read.
    """
    if not -1 < cosine <= 1:
        raise ValueError("a cosine above -1")
    eps = float(np.sqrt(max(2 - 2 * cosine, 1e-12)))
    valid = _valid(df, key, vector, label)
    hashed = stored(valid.select("vec", "label", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")).groupBy("vec").agg(F.min_by(F.struct("label", "h1", "h2"), F.struct("label", "h1", "h2")).alias("s")).select("vec", "s.*"), "vector-hashes")
    reps = stored(hashed.groupBy("label", "h1", "h2").agg(F.min("vec").alias("rep"), F.count("*").alias("weight")), "vector-reps")
    chosen = valid.join(reps.select(F.col("rep").alias("vec"), "weight", "h1", "h2", F.col("label").alias("_l")), "vec").where((F.col("label") == F.col("_l")) & (F.xxhash64("v") == F.col("h1")) & (F.xxhash64(F.lit(1), "v") == F.col("h2"))).select("vec", "label", "weight", "v").dropDuplicates(["vec"])
    chosen = stored(chosen, "vectors")
    axes = principal_axes(chosen)
    blocks = _blocks(chosen, axes, eps)
    pairs = stored(_block_pairs(blocks, eps), "block-pairs")
    sides = pairs.select("i", "j", F.col("i").alias("block")).union(pairs.where("i <> j").select("i", "j", F.col("j").alias("block")))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sides.join(blocks.select("block", "dim", "vec", "weight", "data"), "block").select("i", "j", "block", "dim", "vec", "weight", "data").repartition(parts, "i", "j").sortWithinPartitions("i", "j", "block")
    linked = stored(rows.mapInArrow(_pair_links(cosine, eps), "vec bigint, n bigint, root bigint"), "vector-links")
    counts = linked.groupBy("vec").agg(F.sum("n").alias("n"))
    comp = components(linked.select(F.col("vec").alias("a"), F.col("root").alias("b")))
    groups = (
        reps.join(counts, reps["rep"] == counts["vec"], "left").join(comp, reps["rep"] == comp["node"], "left")
        .select("label", "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component"))
    )
    found = hashed.join(groups, ["label", "h1", "h2"]).select("vec", "n_links", "component")
    kind = df.schema[key].dataType.simpleString()
    ids = df.select(df[key].alias("_id"))
    return ids.join(found, ids["_id"] == found["vec"], "left").select(
        F.col("_id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "_id").cast(kind).alias("component_id"), F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("_id")), F.lit(True)).alias("kept")
    )
