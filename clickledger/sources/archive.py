"""The raw archive: content-addressed objects of lines with a manifest each as commit marker, on any file system that Spark writes to.

An object is the folder data/sha256=<hash of its lines>, its manifest the folder manifests/sha256=<the same>. Data is written before manifests, so what
has no manifest does not exist for readers; writing the same records again finds their manifests and writes nothing. Reading
verifies every byte: hash, number of lines, identity and hash of every value. Equal records in several objects are one; differing ones are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickledger.sources.files import HadoopFiles, LocalFiles

RECORD = "topic string, partition int, offset bigint, value string"
MANIFEST = "format_version int, sha256 string, record_count bigint, records array<struct<topic:string,partition:int,offset:bigint,sha256:string>>"
#: Bounds of an object and of a manifest.
MAX_OBJECT_ROWS, MAX_OBJECT_BYTES, MAX_MANIFEST_BYTES = 1000, 64 << 20, 8 << 20
#: Objects that one step of an index refresh reads.
STEP = 500

_POSITION = ["topic", "partition", "offset"]


def _names(spark: SparkSession, root: str, part: str) -> list[str]:
    """Hashes that have a folder of this part."""
    return [n.removeprefix("sha256=") for n in HadoopFiles(spark).names(f"{root}/{part}") if n.startswith("sha256=")]


def _objects(records: DataFrame) -> DataFrame:
    """(sha256, lines, records): records cut along their positions into objects of bounded rows and bytes."""
    line = F.to_json(F.struct("offset", "partition", "topic", "value"))
    along = Window.partitionBy("topic", "partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = records.select(*_POSITION, line.alias("line"), F.sha2("value", 256).alias("sha256")).withColumns({"_n": F.count("*").over(along), "_b": F.sum(F.octet_length("line")).over(along)})
    placed = cut.withColumn("_object", F.concat_ws(":", F.floor((F.col("_n") - 1) / MAX_OBJECT_ROWS), F.floor(F.col("_b") / (MAX_OBJECT_BYTES // 2))))
    whole = placed.groupBy("topic", "partition", "_object").agg(F.array_sort(F.collect_list(F.struct("offset", "line", "sha256"))).alias("r"))
    lines = whole.select(F.transform("r", lambda x: x["line"]).alias("lines"), F.transform("r", lambda x: F.struct(F.col("topic").alias("topic"), F.col("partition").alias("partition"), x["offset"].alias("offset"), x["sha256"].alias("sha256"))).alias("records"))
    return lines.select(F.sha2(F.concat(F.array_join("lines", "\n"), F.lit("\n")), 256).alias("sha256"), "lines", "records")


def archive_batch(records: DataFrame, root: str) -> int:
    """Archive (topic, partition, offset, value); the number of objects added."""
    spark = records.sparkSession
    root = root.rstrip("/")
    there = spark.createDataFrame([(n,) for n in _names(spark, root, "manifests")], "sha256 string")
    fresh = _objects(records).dropDuplicates(["sha256"]).join(there, "sha256", "left_anti").persist()
    try:
        n = fresh.count()
        if n:
            text = F.array_join("lines", "\n")
            fresh.select("sha256", F.when(F.octet_length(text) > MAX_OBJECT_BYTES, F.raise_error(F.lit("an archive object is bounded"))).otherwise(text).alias("value")).write.mode("append").partitionBy("sha256").text(f"{root}/data")
            manifest = F.to_json(F.struct(F.lit(2).alias("format_version"), "sha256", F.size("records").cast("bigint").alias("record_count"), "records"))
            fresh.select("sha256", manifest.alias("value")).write.mode("append").partitionBy("sha256").text(f"{root}/manifests")
        return n
    finally:
        fresh.unpersist()


def archive_sink(root: str):
    """A foreachBatch function that archives (topic, partition, offset, value); repeating a batch adds nothing."""
    return lambda batch, _: archive_batch(batch, root) and None


def _read(spark: SparkSession, root: str, part: str, names: list[str] | None, max_bytes: int) -> DataFrame:
    """(sha256, text) of the files of a part; a file over its bound is an error."""
    paths = [f"{root}/{part}"] if names is None else [f"{root}/{part}/sha256={n}" for n in names]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(paths)
    text = F.when(F.col("length") > max_bytes, F.raise_error(F.lit("an archive file exceeds its bound"))).otherwise(F.col("content").cast("string"))
    return files.select(F.regexp_extract("path", r"sha256=([0-9a-f]{64})/", 1).alias("sha256"), text.alias("text"))


def manifests(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    found = _read(spark, root.rstrip("/"), "manifests", names, MAX_MANIFEST_BYTES)
    return found.select(F.col("sha256").alias("_name"), F.from_json("text", MANIFEST).alias("m")).select("_name", "m.*").dropDuplicates(["_name"])


def _refused(wrong: Column, why: str, value: Column) -> Column:
    return F.when(wrong, F.raise_error(F.lit(why))).otherwise(value)


def verified_records(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """(topic, partition, offset, value) of all manifested objects, or of some; one row per position, or an error if anything does not verify."""
    root = root.rstrip("/")
    listed = manifests(spark, root, names)
    stored = _read(spark, root, "data", names, MAX_OBJECT_BYTES + 1).select("sha256", F.sha2("text", 256).alias("_actual"), F.split(F.regexp_replace("text", "\n$", ""), "\n").alias("_lines")).dropDuplicates(["sha256", "_actual"])
    objects = listed.join(stored, listed["_name"] == stored["sha256"], "left").select("_name", "record_count", listed["sha256"].alias("_told"), "_actual", "_lines", "records")
    wrong = F.col("_actual").isNull() | (F.col("_actual") != F.col("_name")) | ~F.col("_told").eqNullSafe(F.col("_name")) | (F.size("_lines") != F.col("record_count")) | (F.size("records") != F.col("record_count"))
    lines = objects.select("_name", F.posexplode(_refused(wrong, "an archive object does not match its manifest", F.col("_lines"))).alias("_i", "line"), "records")
    rows = lines.select("_name", F.from_json("line", RECORD).alias("r"), F.get("records", F.col("_i")).alias("ref"))
    same = F.col("r.topic").eqNullSafe(F.col("ref.topic")) & F.col("r.partition").eqNullSafe(F.col("ref.partition")) & F.col("r.offset").eqNullSafe(F.col("ref.offset")) & F.sha2("r.value", 256).eqNullSafe(F.col("ref.sha256"))
    proved = rows.select("_name", _refused(~same, "an archive record does not match its manifest", F.col("r")).alias("r")).select("_name", "r.*")
    one = proved.groupBy(*_POSITION).agg(F.min("value").alias("value"), F.max("value").alias("_last"))
    return one.select(*_POSITION, _refused(~F.col("value").eqNullSafe(F.col("_last")), "one position was archived with different values", F.col("value")).alias("value"))


class ArchiveIndex:
    """Verified records as a Parquet table, one row per position, that grows by what the archive has gained: only new objects are read. An object counts as indexed when its name is, after its records."""

    def __init__(self, spark: SparkSession, root: str, index: str):
        self.spark, self.root, self.index = spark, root.rstrip("/"), index.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        if not HadoopFiles(self.spark).names(f"{self.index}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.index}/{name}")

    def records(self) -> DataFrame:
        return self._table("records", RECORD)

    def refresh(self, audit: bool = False) -> int:
        """Index the objects of manifests that the index lacks; their number. An indexed manifest that is gone, and a position that comes again with another value, are errors. audit reads all."""
        there = _names(self.spark, self.root, "manifests")
        listed = self.spark.createDataFrame([(n,) for n in there], "manifest string")
        known = self._table("manifests", "manifest string")
        if known.join(listed, "manifest", "left_anti").limit(1).count():
            raise ValueError("an indexed manifest has been removed")
        if audit and there:
            verified_records(self.spark, self.root).select(F.count("value")).first()
        fresh = [r["manifest"] for r in listed.join(known, "manifest", "left_anti").orderBy("manifest").collect()]  # names of new objects
        for i in range(0, len(fresh), STEP):
            step = fresh[i : i + STEP]
            rows = verified_records(self.spark, self.root, step).select(*_POSITION, "value").persist()
            old = self.records().select(*_POSITION, F.col("value").alias("_old"))
            try:
                if rows.join(old, _POSITION).where(~F.col("value").eqNullSafe(F.col("_old"))).limit(1).count():
                    raise ValueError("one position was archived with different values")
                rows.join(old, _POSITION, "left_anti").write.mode("append").parquet(f"{self.index}/records")
                self.spark.createDataFrame([(n,) for n in step], "manifest string").coalesce(1).write.mode("append").parquet(f"{self.index}/manifests")
            finally:
                rows.unpersist()
        return len(fresh)

    def trace(self, receipt_id: str, limit: int = 10) -> list:
        """The raw records of one receipt; more than `limit` are an error."""
        rows = self.records().where(F.get_json_object("value", "$.receipt_id") == receipt_id).orderBy(*_POSITION).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError("too many records of one receipt")
        return rows


def write_json(path: str, value: object) -> None:
    import json

    LocalFiles().replace(path, (json.dumps(value, indent=2, ensure_ascii=False) + "\n").encode())
