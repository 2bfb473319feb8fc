"""The live engine: micro-batches that keep a durable clean table and re-emit the metric rows they touch.

A micro-batch validates its packets and appends what the clean table lacks; then it recomputes links and metrics for the identity
scopes that new events belong to, and writes them as full replacement values under a rising offset. Late,
early and out-of-order events are therefore corrected and not dropped: at every point the latest values are those
of the batch engine over what has arrived, but for conversions that still wait for their click. A repeated batch writes the same rows
under the same offsets.

The watermark of a batch is the largest event time accepted before it, less the allowed disorder. A conversion without its click is
`pending` until the watermark has passed its event time and the join wait, and counts from then on; the batch that finds this out
visits its scope even if nothing new came for it. Signals say what a consumer of published values must know:

* CLICK_NOT_FOUND, IMPRESSION_NOT_FOUND: the wait is over. A conversion that came after its wait is unmatched without a signal.
* the other exposure reasons: with the click or the impression that brought them up.
* LATE_CLICK_REPLAY_REQUIRED: a click of a conversion already published as unmatched.
* LATE_REPLAY_REQUIRED: an event older than the retention.
* DIMENSION_HISTORY_MISSING: an event that counts for a campaign and a time without a version in the history, once. None without a history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickledger.functions.contracts import Rules
from clickledger.operators import dimension as campaigns
from clickledger.operators import link, metrics, results, validate

_SCOPE = ("advertiser_id", "app_id")
_NEVER = -(1 << 62)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


class LiveEngine:
    """Tables under root, all by batch: packets (accepted), progress (largest event time), waiting (deadlines by scope), results (by release and kind), signals."""

    def __init__(self, spark: SparkSession, root: str, rules: Rules | None = None, dimension: DataFrame | None = None, release_id: str = "live-v1"):
        self.spark, self.root, self.rules, self.dimension, self.release_id = spark, root.rstrip("/"), rules or Rules(), dimension, release_id

    def _table(self, name: str, schema: str) -> DataFrame:
        if not _exists(self.spark, f"{self.root}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def packets(self, before: int | None = None) -> DataFrame:
        df = self._table("packets", "receipt_id string, received_at bigint, ordinal bigint, event string, advertiser_id string, app_id string, batch bigint")
        return df if before is None else df.where(F.col("batch") < before)

    def results(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/results")

    def signals(self) -> DataFrame:
        return self._table("signals", "receipt_id string, event_id string, dataset string, rule_id string, rule_version string, disposition string, error_code string, detail string, received_at bigint, batch bigint")

    def watermark(self, batch_id: int) -> int:
        """The watermark during a batch: of all that was accepted before it."""
        path = f"{self.root}/progress/batch={batch_id - 1}"
        row = self.spark.read.schema("event_time bigint").parquet(path).first() if _exists(self.spark, path) else None
        return _NEVER if row is None or row["event_time"] is None else row["event_time"] - self.rules.out_of_order_ms

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch_id}")

    def _signals(self, clean: DataFrame, clicks: DataFrame, conversions: DataFrame, now: int, earlier: int, batch_id: int) -> DataFrame:
        """Signals of one batch; `_new` marks its events, `now` and `earlier` are its watermark and the one before."""
        deadline = F.col("event_time") + self.rules.join_wait_ms
        just_over = (deadline > earlier) & (deadline <= now)
        coded = lambda df, code: df.select("_receipt_id", "event_id", "received_at", code.alias("error_code"))
        missing = F.col("reason") == "IMPRESSION_NOT_FOUND"
        arrived = clean.where("event_type = 'impression' AND _new").select(*_SCOPE, "impression_id", F.lit(True).alias("_arrived"))
        exposed = clicks.where("reason <> 'OK'").join(arrived, [*_SCOPE, "impression_id"], "left")
        published = conversions.where(~F.col("_new") & (deadline <= earlier)).select(*_SCOPE, "click_id").distinct()
        rows = (
            coded(clean.where(F.col("_new") & (F.col("event_time") + self.rules.state_retention_ms <= now)), F.lit("LATE_REPLAY_REQUIRED"))
            .unionByName(coded(exposed.where(F.when(missing, just_over | (F.col("_new") & (deadline <= now))).otherwise(F.col("_new") | F.coalesce("_arrived", F.lit(False)))), F.col("reason")))
            .unionByName(coded(conversions.where(~F.col("_new") & just_over & (F.col("reason") == "CLICK_NOT_FOUND")), F.col("reason")))
            .unionByName(coded(clicks.where("_new").join(published, [*_SCOPE, "click_id"], "left_semi"), F.lit("LATE_CLICK_REPLAY_REQUIRED")))
        )
        if self.dimension is not None:
            counted = metrics.contributions(clean, clicks, conversions.where((F.col("reason") != "CLICK_NOT_FOUND") | (deadline <= now)), ("_receipt_id", "event_id", "received_at"))
            lacking = campaigns.without_version(counted, self.dimension).dropDuplicates(["_receipt_id"])
            told = self.signals().where((F.col("batch") < batch_id) & (F.col("error_code") == "DIMENSION_HISTORY_MISSING")).select(F.col("receipt_id").alias("_receipt_id"))
            rows = rows.unionByName(coded(lacking.join(told, "_receipt_id", "left_anti"), F.lit("DIMENSION_HISTORY_MISSING")))
        return rows.select(
            F.col("_receipt_id").alias("receipt_id"), "event_id", F.lit("attribution").alias("dataset"), F.lit("attribution-v1").alias("rule_id"), F.lit(self.rules.rule_version).alias("rule_version"), F.lit("signal").alias("disposition"), "error_code", F.lit(None).cast("string").alias("detail"), "received_at"
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The foreachBatch function. Packets are stored with the scope that their event claims; dedup and links never cross a scope."""
        now, earlier = self.watermark(batch_id), self.watermark(batch_id - 1)
        v = F.try_parse_json("event")
        scoped = batch.select("receipt_id", "received_at", "ordinal", "event", *[F.coalesce(F.try_variant_get(v, f"$.{n}", "string"), F.lit("")).alias(n) for n in _SCOPE])
        fresh = scoped.join(self.packets(batch_id).select("receipt_id"), "receipt_id", "left_anti").dropDuplicates(["receipt_id"])
        self._write(fresh, "packets", batch_id)
        mine = self.spark.read.parquet(f"{self.root}/packets/batch={batch_id}")
        due = self._table("waiting", "advertiser_id string, app_id string, deadline bigint, batch bigint").where((F.col("batch") < batch_id) & (F.col("deadline") > earlier) & (F.col("deadline") <= now))
        touched = mine.select(*_SCOPE).union(due.select(*_SCOPE)).distinct()
        known = self.packets(batch_id + 1).join(touched, list(_SCOPE), "left_semi")
        disposed = validate.disposition(known.select("receipt_id", "received_at", "ordinal", "event"), self.rules)
        news = mine.select(F.col("receipt_id").alias("_receipt_id"), F.lit(True).alias("_new"))
        clean = validate.clean_events(disposed, self.rules).join(news, "_receipt_id", "left").withColumn("_new", F.coalesce("_new", F.lit(False))).persist()
        clicks = link.link_clicks(clean, self.rules)
        conversions = link.link_conversions(clean, clicks, self.rules)
        deadline = F.col("event_time") + self.rules.join_wait_ms
        waits = (F.col("reason") == "CLICK_NOT_FOUND") & (deadline > now)
        rows = metrics.aggregate(metrics.contributions(clean, clicks, conversions.where(~waits)), self.rules, self.dimension, self.release_id, "provisional")
        shown = conversions.withColumns({"status": F.when(waits, "pending").otherwise(F.col("status")), "reason": F.when(waits, "AWAITING_CLICK").otherwise(F.col("reason"))})
        linked = link.associations(shown, self.rules, self.release_id)
        partition = lambda key: F.pmod(F.xxhash64(key), F.lit(3))
        offset = F.lit(batch_id)
        out = results.as_records(rows, "metric", partition("metric_key"), offset, offset).unionByName(results.as_records(linked, "association", partition("association_key"), offset, offset))
        if _exists(self.spark, f"{self.root}/results"):
            # A key that a late event has emptied (its click now has an exposure, say) is overwritten with zeros.
            old = self.results().where(f"batch < {batch_id}").drop("batch")
            if old.limit(1).count():
                stale = results.latest_metrics(old, self.release_id).join(touched, list(_SCOPE), "left_semi")
                gone = results.vanished(stale, rows, self.release_id, self.rules.rule_version)
                out = out.unionByName(results.as_records(gone, "metric", partition("metric_key"), offset, offset))
        self._write(out, "results", batch_id)
        self._write(self._signals(clean, clicks, conversions, now, earlier, batch_id), "signals", batch_id)
        lacking = clicks.where((F.col("reason") == "IMPRESSION_NOT_FOUND") & (deadline > now)).select(*_SCOPE, deadline.alias("deadline"))
        self._write(lacking.unionByName(conversions.where(waits).select(*_SCOPE, deadline.alias("deadline"))).distinct(), "waiting", batch_id)
        reached = None if now == _NEVER else now + self.rules.out_of_order_ms
        self._write(clean.agg(F.greatest(F.max("event_time"), F.lit(reached).cast("bigint")).alias("event_time")), "progress", batch_id)
        clean.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """Run over a stream of packets. A release with output but without its checkpoint is refused: it would count twice."""
        if _exists(self.spark, f"{self.root}/results") and not _exists(self.spark, checkpoint):
            raise ValueError("the release has output but no checkpoint")
        writer = stream.writeStream.foreachBatch(lambda df, i: self.process(df, i)).option("checkpointLocation", checkpoint).queryName(f"live-{self.release_id}")
        return writer.trigger(**(trigger or {"processingTime": f"{self.rules.emit_interval_ms} milliseconds"})).start()
