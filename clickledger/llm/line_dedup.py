"""Operator 2: line dedup by a sharded minimal perfect hash.

Pass 1 hashes every line key to 128 bits and keeps, per hash found in two documents or more, the
number of documents and the smallest id. These hashes are dealt to shards; each shard becomes a
minimal perfect hash with compact arrays of fingerprints, counts and keepers, one row of an index table in the
shared folder. The hashes of pass 1 are then dealt to the shards, and each probes the arrays: a task reads its shard once, however
large the index is, and a shard that very many lines probe is read by several tasks, each with a slice of them. No line is ever joined with a
line. Pass 2 cuts the texts of the documents that have hits; all reading and writing is Spark's own.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickledger.llm.common import ASCII_SPACE, drop_stored, give_back, stored

#: Keys per shard: bounds the memory that building or probing one shard takes (about 13 MB).
SHARD_KEYS = 500_000
#: Probes that one task takes to a shard.
SLICE_PROBES = 500_000
_LEVELS = 40
_U64 = np.uint64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finalizer over x plus a seed."""
    with np.errstate(over="ignore"):
        x = x + _U64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


class PerfectHash:
    """Levels of bit arrays over distinct 128-bit keys; the rank of a key's bit is its slot, so n keys have slots 0 to n-1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rank: np.ndarray, rest1: np.ndarray, rest2: np.ndarray):
        self.sizes, self.bits, self.rank, self.rest1, self.rest2 = sizes, bits, rank, rest1, rest2
        self.base = np.concatenate([[0], np.cumsum(sizes >> 6)]).astype(np.int64)
        self.placed = int(rank[-1]) if len(rank) else 0

    @staticmethod
    def build(h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        left = np.arange(len(h1))
        sizes, words = [], []
        for level in range(_LEVELS):
            if not len(left):
                break
            m = max(64, (2 * len(left) + 63) // 64 * 64)
            at = (_mix(h1[left], level + 1) % _U64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            word = np.packbits(alone.reshape(-1, 8)[:, ::-1], axis=1).reshape(-1, 8)
            words.append(np.ascontiguousarray(word).view("<u8").ravel())
            sizes.append(m)
            left = left[~alone[at]]
        bits = np.concatenate(words) if words else np.zeros(0, "<u8")
        rank = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.int64)
        return PerfectHash(np.array(sizes, np.int64), bits, rank, h1[left], h2[left])

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Slots of keys; a key that was not built in gets some slot or -1."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, m in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (_mix(h1[left], level + 1) % _U64(m)).astype(np.int64)
            word, bit = self.base[level] + (at >> 6), (at & 63).astype(_U64)
            held = self.bits[word]
            hit = (held >> bit) & _U64(1) == 1
            w, b = word[hit], bit[hit]
            out[left[hit]] = self.rank[w] + np.bitwise_count(self.bits[w] & ((_U64(1) << b) - _U64(1)))
            left = left[~hit]
        for i, (a, b) in enumerate(zip(self.rest1.tolist(), self.rest2.tolist(), strict=True)):  # keys whose first half meets another's: hardly ever any
            out[(h1 == _U64(a)) & (h2 == _U64(b))] = self.placed + i
        return out


class Shard:
    """A perfect hash with its arrays: fingerprint (second half of the key), count of documents, keeper."""

    def __init__(self, f: PerfectHash, fingerprint: np.ndarray, count: np.ndarray, keeper: np.ndarray):
        self.f, self.fingerprint, self.count, self.keeper = f, fingerprint, count, keeper

    @staticmethod
    def build(h1: np.ndarray, h2: np.ndarray, count: np.ndarray, keeper: np.ndarray) -> Shard:
        f = PerfectHash.build(h1, h2)
        order = np.empty(len(h1), np.int64)
        order[f.slots(h1, h2)] = np.arange(len(h1))
        return Shard(f, h2[order], np.minimum(count[order], 0xFFFFFFFF).astype("<u4"), keeper[order])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, sizes=self.f.sizes, bits=self.f.bits, rank=self.f.rank, rest1=self.f.rest1, rest2=self.f.rest2, fingerprint=self.fingerprint, count=self.count, keeper=self.keeper)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Shard:
        with np.load(io.BytesIO(data)) as z:
            return Shard(PerfectHash(z["sizes"], z["bits"], z["rank"], z["rest1"], z["rest2"]), z["fingerprint"], z["count"], z["keeper"])

    def keepers(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, keeper) of each key."""
        slot = self.f.slots(h1, h2)
        ok = slot >= 0
        ok[ok] = self.fingerprint[slot[ok]] == h2[ok]
        keep = np.zeros(len(h1), np.int64)
        keep[ok] = self.keeper[slot[ok]]
        return ok, keep


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines of a batch's texts (null: one empty line) and the row that each is of."""
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _hashes(lines: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which lines have a key that counts, and its two hash halves."""
    key = pc.ascii_lower(pc.ascii_trim(lines, characters=ASCII_SPACE))
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(key), min_chars).to_numpy(zero_copy_only=False))
    digest = xxhash.xxh3_128_digest
    raw = b"".join([digest(x) for x in key.cast(pa.large_binary()).take(pa.array(at)).to_pylist()])
    both = np.frombuffer(raw, "<u8").reshape(-1, 2)
    return at, both[:, 0].copy(), both[:, 1].copy()


def line_keys(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc): the line keys of each document that has a key, those that stand twice in a batch's document once."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            lines, parent = _lines(b.column(1))
            at, h1, h2 = _hashes(lines, min_chars)
            row = parent[at]
            known = b.column(0).is_valid().to_numpy(zero_copy_only=False)[row]
            h1, h2, row = h1[known], h2[known], row[known]
            order = np.lexsort((h2, h1, row))
            h1, h2, row = h1[order], h2[order], row[order]
            first = np.ones(len(h1), bool)
            first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (row[1:] != row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(h1[first].view(np.int64)), pa.array(h2[first].view(np.int64)), b.column(0).take(pa.array(row[first]))], names=["h1", "h2", "doc"])
            give_back()

    return df.select(df[key], df[text]).mapInArrow(run, f"h1 bigint, h2 bigint, doc {kind}")


def _mark(doc: str, kind: T.DataType) -> F.Column:
    """A number for a key: itself, or its hash where it is no number."""
    return F.col(doc).cast("bigint") if isinstance(kind, T.IntegralType) else F.xxhash64(doc)


def repeated_lines(seen: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, keeper) of the line keys that stand in at least two documents; keeper: the mark of the smallest. n_docs may count a document's rows."""
    per = seen.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min("doc").alias("_first"), F.max("doc").alias("_last"))
    return per.where("_first <> _last").select("h1", "h2", "n_docs", _mark("_first", seen.schema["doc"].dataType).alias("keeper"))


def build_index(repeated: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """The index of a stored repeated_lines() table, (shard, payload), and its number of shards."""
    shards = max(1, -(-repeated.count() // shard_keys))

    def one(part: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = part["h1"].to_numpy(np.int64).view(_U64), part["h2"].to_numpy(np.int64).view(_U64)
        s = Shard.build(h1, h2, part["n_docs"].to_numpy(np.int64), part["keeper"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "payload": [s.dump()]})

    dealt = repeated.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)))
    return stored(dealt.groupBy("shard").applyInPandas(one, "shard bigint, payload binary"), "line-index"), shards


def probe(seen: DataFrame, index: DataFrame, shards: int, slice_probes: int = SLICE_PROBES) -> DataFrame:
    """(doc, h1, h2) of the lines to drop: those whose key another document keeps."""
    kind = seen.schema["doc"].dataType
    homed = seen.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)))
    slices = homed.groupBy("shard").agg(F.ceil(F.count("*") / slice_probes).cast("int").alias("slices"))
    asked = homed.join(slices, "shard").select("shard", F.pmod(F.xxhash64("doc"), F.col("slices")).cast("int").alias("slice"), "h1", "h2", "doc", _mark("doc", kind).alias("mark"))
    told = index.join(slices, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        for b in batches:
            places = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            ends = [i for i in range(1, len(places)) if places[i] != places[i - 1]]
            for x, y in zip([0, *ends], [*ends, len(places)], strict=True):
                if places[x] != now:
                    now, shard = places[x], None
                if b.column(6)[x].is_valid:  # a shard comes before its probes
                    shard, x = Shard.load(b.column(6)[x].as_py()), x + 1
                if shard is not None and x < y:
                    h1, h2 = (b.column(i).slice(x, y - x).to_numpy(zero_copy_only=False).view(_U64) for i in (2, 3))
                    found, keep = shard.keepers(h1, h2)
                    hit = pa.array(np.flatnonzero(found & (keep != b.column(5).slice(x, y - x).to_numpy(zero_copy_only=False))) + x)
                    yield pa.RecordBatch.from_arrays([b.column(i).take(hit) for i in (4, 2, 3)], names=["doc", "h1", "h2"])
            give_back()

    both = asked.unionByName(told, allowMissingColumns=True).repartition("shard", "slice").sortWithinPartitions("shard", "slice", F.col("payload").isNull())
    return both.mapInArrow(run, f"doc {kind.simpleString()}, h1 bigint, h2 bigint")


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 10, shard_keys: int = SHARD_KEYS, slice_probes: int = SLICE_PROBES) -> DataFrame:
    """All columns of df with the text cut down to the lines that stay, plus n_lines and n_dropped.

    A line's key is the line stripped of ASCII white space and A-Z lower-cased. A key of at least min_chars code
    points in two documents or more stays only in the document of the smallest key, with all its lines there.
    A null or empty text is one empty line and comes back empty. Rows with a null key take no part: they keep
    all lines. Rows that repeat a key are one document. Keys are of any type with an order; such that are no whole numbers are compared by 64-bit hashes. An
    empty table gives no rows. Input columns named n_lines or n_dropped are replaced.
    """
    seen = stored(line_keys(df, key, text, min_chars), "line-keys")
    repeated = stored(repeated_lines(seen), "repeated-lines")
    index, shards = build_index(repeated, shard_keys)
    hits = probe(seen, index, shards, slice_probes).groupBy("doc").agg(F.collect_set(F.struct("h1", "h2")).alias("_hits"))
    hits = stored(hits.select(F.col("doc").alias("_doc"), F.transform("_hits", lambda x: x["h1"]).alias("_h1"), F.transform("_hits", lambda x: x["h2"]).alias("_h2")), "line-hits")
    for done in (seen, repeated, index):
        drop_stored(done)
    names = [c for c in df.columns if c.lower() not in ("n_lines", "n_dropped")]
    # The input's columns travel as one struct, so no name of theirs meets one of ours.
    rows = df.select(F.struct(*[df[c] for c in names if c != text]).alias("_row"), df[key].alias("_key"), df[text].alias("_text"))
    answered = rows.join(hits, rows["_key"] == hits["_doc"], "left").select("_row", "_text", "_h1", "_h2")
    row_type, body = answered.schema["_row"].dataType.simpleString(), answered.schema["_text"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, parent = _lines(b.column(1))
            total = np.bincount(parent, minlength=len(b))
            drop = np.zeros(len(lines), bool)
            asked = np.flatnonzero(b.column(2).is_valid().to_numpy(zero_copy_only=False)[parent])
            if len(asked):
                at, h1, h2 = _hashes(lines.take(pa.array(asked)), min_chars)
                row = parent[asked[at]]
                size = pc.fill_null(pc.list_value_length(b.column(2)), 0).to_numpy(zero_copy_only=False)
                gone = {(int(i), int(x), int(y)) for i, x, y in zip(np.repeat(np.arange(len(b)), size), b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy(), strict=True)}
                out = [(i, x, y) in gone for i, x, y in zip(row.tolist(), h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), strict=True)]
                drop[asked[at]] = out
            dropped = np.bincount(parent[drop], minlength=len(b))
            offsets = np.concatenate([[0], np.cumsum(total - dropped)]).astype(np.int64)
            texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), lines.filter(pa.array(~drop))), pa.scalar("\n", pa.large_string()))
            yield pa.RecordBatch.from_arrays([b.column(0), texts.cast(pa.string()), pa.array(total.astype(np.int64)), pa.array(dropped.astype(np.int64))], names=["_row", "_text", "n_lines", "n_dropped"])
            give_back()

    cut = answered.mapInArrow(run, f"_row {row_type}, _text {body}, n_lines bigint, n_dropped bigint")
    return cut.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`") for c in names], "n_lines", "n_dropped")
