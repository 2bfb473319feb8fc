"""Operator 7: fixed virtual slots between records and shards.

A record hashes into one of SLOTS slots for good; only the slot-to-shard map changes.
The map is a versioned table, one folder per version, that is appended to and never rewritten: `SlotMaps`. The first deals the slots out evenly; an
edit writes the next one, either by giving a new shard slots of all others or by moving slots of the newest version according to the
bytes that were aggregated per slot. An edit for a further shard moves slots to it only, one by bytes as few as balance needs.

`assign_shards` places records by law 'key': where a record goes depends on its key and the number of shards only. So it reads the version of its
map that has that many shards and no edit by bytes; the version edited by the bytes of its own records is stored behind them.

Native: DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickledger.llm.common import shared_dir, stored

SLOTS = 4096


def slot_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version `shards` of the map, index = slot: version 1 edited once per added shard.

    The new shard takes slots // n slots, one at a time from the shard that then holds most.
    """
    if not 1 <= shards <= slots:
        raise ValueError("between one shard and as many shards as slots")
    held = [list(range(slots - 1, -1, -1))]
    for n in range(2, shards + 1):
        new: list[int] = []
        while len(new) < slots // n:
            donor = max(range(len(held)), key=lambda s: (len(held[s]), -s))
            new.append(held[donor].pop())
        held.append(sorted(new, reverse=True))
    out = [0] * slots
    for shard, mine in enumerate(held):
        for slot in mine:
            out[slot] = shard
    return out


def rebalance(current: list[int], slot_bytes: list[int], shards: int, tolerance: float = 0.02) -> list[int]:
    """A new version of a map: move as few slots as needed, until no shard exceeds the mean bytes by more than `tolerance` (or no move helps)."""
    out, load = list(current), [0] * shards
    for slot, shard in enumerate(out):
        load[shard] += slot_bytes[slot]
    mean = sum(load) / shards
    while load and max(load) > mean * (1 + tolerance):
        src, dst = load.index(max(load)), load.index(min(load))
        fits = [s for s in range(len(out)) if out[s] == src and 0 < slot_bytes[s] <= (load[src] - load[dst]) / 2]
        if not fits:
            break
        s = max(fits, key=lambda x: (slot_bytes[x], -x))
        out[s] = dst
        load[src] -= slot_bytes[s]
        load[dst] += slot_bytes[s]
    return out


def _lookup(values: list[int], index: F.Column) -> F.Column:
    """values[index] with the list as one folded constant of SLOTS entries."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ","), index).cast("int")


def slot_of(key: F.Column, slots: int = SLOTS) -> F.Column:
    """The fixed slot of a key: the first 32 bits of the MD5 of its decimal text, modulo the slots; a null key counts as empty text."""
    return (F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long") % slots).cast("int")


class SlotMaps:
    """The versions of a map under one folder: version, edit, shards, virtual_slot, shard, n_rows, n_bytes; SLOTS rows each. A version is one folder, written once."""

    def __init__(self, spark: SparkSession, root: str, slots: int = SLOTS):
        self.spark, self.root, self.slots = spark, root.rstrip("/"), slots

    def _path(self, version: int | None = None):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root if version is None else f"{self.root}/version={version}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        path, fs = self._path()
        if not fs.exists(path):
            return []
        names = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName().startswith("version=")]
        return sorted(int(p.getName()[8:]) for p in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def table(self) -> DataFrame:
        """All versions."""
        schema = "edit string, shards int, virtual_slot int, shard int, n_rows bigint, n_bytes bigint, version int"
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*[f"{self.root}/version={v}" for v in self.versions()])

    def write(self, edit: str, shards: int, shard_of: list[int], held: DataFrame | None = None) -> int:
        """Store the next version, with the rows and bytes of the slots where they are known. A version is written once: of two writers one takes the number after."""
        every = self.spark.range(self.slots).select(F.col("id").cast("int").alias("virtual_slot"))
        if held is None:
            held = every.select("virtual_slot", F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("long").alias("n_bytes"))
        rows = every.join(held, "virtual_slot", "left").select(F.lit(edit).alias("edit"), F.lit(shards).alias("shards"), "virtual_slot", _lookup(shard_of, F.col("virtual_slot")).alias("shard"), "n_rows", "n_bytes").coalesce(1)
        version = (self.versions() or [0])[-1] + 1
        while True:
            try:
                rows.write.mode("error").parquet(f"{self.root}/version={version}")
                return version
            except AnalysisException as e:
                if e.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                version += 1

    def of_shards(self, shards: int) -> DataFrame:
        """(virtual_slot, shard) of the version that only the number of shards decides; it is stored if it is not there."""
        if self.versions():
            found = self.table().where((F.col("shards") == shards) & F.col("edit").isin("even", "grown")).agg(F.max("version")).first()[0]
            if found is not None:
                return self.table().where(F.col("version") == found).select("virtual_slot", "shard")
        version = self.write("grown" if self.versions() else "even", shards, slot_map(shards, self.slots))
        return self.table().where(F.col("version") == version).select("virtual_slot", "shard")

    def rebalance(self, held: DataFrame, shards: int) -> int:
        """An edit of the newest version of so many shards that moves slots by their bytes. held: virtual_slot, n_rows, n_bytes, at most SLOTS rows."""
        newest = self.table().where(F.col("shards") == shards).agg(F.max("version")).first()[0]
        shard_of, slot_bytes = [0] * self.slots, [0] * self.slots
        for r in self.table().where(F.col("version") == newest).select("virtual_slot", "shard").collect():
            shard_of[r["virtual_slot"]] = r["shard"]
        for r in held.select("virtual_slot", "n_bytes").collect():
            slot_bytes[r["virtual_slot"]] = r["n_bytes"]
        return self.write("bytes", shards, rebalance(shard_of, slot_bytes, shards), held)


def assign_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, slots: int = SLOTS, maps: SlotMaps | None = None) -> DataFrame:
    """One row per record: key, size, text_crc32, law, shard, slot, grown_shard, virtual_slot.

    size: UTF-8 bytes plus 1 (null text: 1, its checksum that of no bytes). slot: the record's
    place in its shard, gapless from 0, by virtual slot, then key, checksum and size. A null key has a fixed slot
    too; repeated rows keep a place each; an empty table gives no rows; other columns are not read.

    maps: where the versions of the map are kept (none: a folder named for these slots in the shared folder). Law 'key' reads the versions for
    `shards` and for one more; a version edited by the bytes of these records is appended.
    """
    spark = df.sparkSession
    maps = maps or SlotMaps(spark, f"{shared_dir(spark)}/slot-maps/{slots}", slots)
    body = F.coalesce(df[text], F.lit(""))
    rows = stored(
        df.select(df[key].alias("_key"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), slot_of(df[key], slots).alias("virtual_slot")),
        "slot-rows",
    )
    held = stored(rows.groupBy("virtual_slot").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes")), "slot-bytes")
    now, grown = maps.of_shards(shards), maps.of_shards(shards + 1).withColumnRenamed("shard", "grown_shard")
    maps.rebalance(held, shards)
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)  # at most SLOTS rows
    places = held.join(now, "virtual_slot").join(grown, "virtual_slot").select("virtual_slot", "shard", "grown_shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0).cast("long")).alias("first_place"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("_key", "text_crc32", "size")
    numbered = rows.withColumn("_n", F.row_number().over(in_slot).cast("long") - 1)
    return numbered.join(F.broadcast(places), "virtual_slot").select(  # at most SLOTS rows
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first_place") + F.col("_n")).alias("slot"), "grown_shard", "virtual_slot"
    )
