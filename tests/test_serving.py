from __future__ import annotations

import json
import shutil

import pytest
from tests.helpers import BASE, event, packets
from pyspark.sql import functions as F

from clickledger.functions.contracts import Rules
from clickledger.__main__ import demo
from clickledger.operators import monitor, paging, reconcile, results
from clickledger.operators.budget import Budget, BudgetExceeded, buffered, spooled, streamed
from clickledger.operators.inspection import Inspector, Snapshots, Unavailable, operational_document, operational_gauges
from clickledger.operators.releases import Registry
from clickledger.plans.batch import calculate
from clickledger.sources import archive, collector
from clickledger.sources.files import HadoopFiles, LocalFiles
from clickledger.sources import packets as sources


@pytest.fixture(scope="module")
def outcome(spark):
    e = [event("impression", str(i), at=BASE + i * 61_000) for i in range(12)] + [event("click", str(i), at=BASE + i * 61_000 + 5) for i in range(9)] + [event("conversion", str(i), at=BASE + i * 61_000 + 9) for i in range(11)]
    o = calculate(packets(spark, e))
    o.metrics.cache(), o.associations.cache()
    return o


def versions(o, status="final"):
    final = results.as_records(o.associations, "association", F.lit(0), F.monotonically_increasing_id() + 1000, F.col("event_time"))
    pending = results.as_records(o.associations.withColumn("status", F.lit("pending")), "association", F.lit(0), F.monotonically_increasing_id(), F.col("event_time"))
    return pending.unionByName(final)


def test_latest_before_filter(spark, outcome):
    rows = versions(outcome).cache()
    assert paging.page_frame(rows, "replay-v1", "association", filters={"status": "pending"}).count() == 0
    assert paging.page_frame(rows, "replay-v1", "association", filters={"status": "matched"}).count() == 9


def test_traversal_is_complete(spark, outcome, tmp_path):
    registry = Registry(tmp_path / "releases")
    registry.register("replay-v1", Rules())
    pages = paging.Pages(lambda: versions(outcome), registry, paging.Bookmarks(b"k" * 32), budget=Budget(seconds=120))
    with pytest.raises(PermissionError):
        pages.page("association", "replay-v1")
    registry.validate("replay-v1", {"passed": True, "archive_complete": True, "sink_complete": True})
    registry.activate("replay-v1", "first")
    seen, cursor = [], None
    while True:
        p = pages.page("association", limit=4, cursor=cursor)
        seen += [r["association_key"] for r in p["rows"]]
        cursor, last = p["next_cursor"], cursor
        if cursor is None:
            break
    assert seen == sorted(seen) and len(seen) == len(set(seen)) == 11
    with pytest.raises(KeyError):
        pages.page("association", "nothing")
    with pytest.raises(paging.InvalidCursor):
        pages.page("association", "other-release", cursor=last)


def test_metric_pages_filters_and_ratios(spark, outcome, tmp_path):
    registry = Registry(tmp_path / "releases")
    registry.register("live-v1", Rules(), "live")
    rows = results.as_records(outcome.metrics.withColumn("release_id", F.lit("live-v1")), "metric", F.lit(0), F.lit(1), F.lit(1)).cache()
    pages = paging.Pages(lambda: rows, registry, paging.Bookmarks(b"k" * 32), budget=Budget(seconds=120))
    first = pages.page("metric", limit=5, cohort="impression")
    assert first["consistency"] == "live_keyset" and len(first["rows"]) == 5 and {r["cohort_basis"] for r in first["rows"]} == {"impression"} and all(r["ctr"] in (0.0, 1.0) for r in first["rows"])
    with pytest.raises(paging.InvalidCursor):  # a cursor of another question
        pages.page("metric", limit=5, cohort="click", cursor=first["next_cursor"])
    assert len(pages.page("metric", limit=500, cohort="impression", cursor=first["next_cursor"])["rows"]) == 7


def test_bookmarks():
    now = [1000.0]
    c = paging.Bookmarks(b"s" * 32, lambda: now[0])
    t = c.mark("r1", "metric", "m:ü", {"region": "US", "cohort": "click"})
    assert c.read(t, "metric", {"cohort": "click", "region": "US"}) == ("r1", "m:ü", 2800)
    for kind, filters in (("association", {"region": "US", "cohort": "click"}), ("metric", {"region": "JP", "cohort": "click"}), ("metric", {}), ("metric", {"regionUS": "", "cohort": "click"})):
        with pytest.raises(paging.InvalidCursor):
            c.read(t, kind, filters)
    for bad in (t[:-1], t[:5] + ("A" if t[5] != "A" else "B") + t[6:], "", "!", "x" * 5000, None, t + "==", "AAAA"):
        with pytest.raises(paging.InvalidCursor):
            c.read(bad, "metric", {"region": "US", "cohort": "click"})
    with pytest.raises(paging.InvalidCursor):
        paging.Bookmarks(b"t" * 32, lambda: now[0]).read(t, "metric", {"region": "US", "cohort": "click"})
    now[0] += 900
    later = c.mark("r1", "metric", "m:y", {}, c.read(t, "metric", {"region": "US", "cohort": "click"}).lease_end)
    now[0] += 900
    for token, filters in ((t, {"region": "US", "cohort": "click"}), (later, {})):  # the lease is not renewed
        with pytest.raises(paging.ExpiredCursor):
            c.read(token, "metric", filters)
    with pytest.raises(paging.KeyTooLong):
        c.mark("r1", "metric", "m" * 1501, {})
    with pytest.raises(ValueError):
        paging.Bookmarks(b"short")


def test_budgets(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert len(buffered(table, Budget(seconds=60))) == 1000
    for small in (Budget(seconds=60, rows_read=999), Budget(seconds=60, result_rows=999), Budget(seconds=60, result_bytes=100)):
        with pytest.raises(BudgetExceeded):
            buffered(table, small)
    slow = spark.range(10**12).selectExpr("sum(id % 7)")
    with pytest.raises(BudgetExceeded, match="long"):
        buffered(slow, Budget(seconds=1.0, rows_read=10**13))
    assert sum(1 for _ in streamed(table)) == 1000
    with pytest.raises(BudgetExceeded):
        list(streamed(table, Budget(seconds=60, result_rows=10)))
    assert sum(r["id"] for r in spooled(table, str(tmp_path))) == 499_500
    with pytest.raises(BudgetExceeded):
        list(spooled(table, str(tmp_path), max_bytes=10))
    assert [n for n in HadoopFiles(spark).names(str(tmp_path)) if n.startswith("spool")] == []


@pytest.mark.parametrize("kind", ["local", "hadoop"])
def test_files(spark, tmp_path, kind):
    f = LocalFiles() if kind == "local" else HadoopFiles(spark)
    at = f"{tmp_path}/d/x.json"
    assert f.read(at) is None and f.names(f"{tmp_path}/d") == []
    assert f.create(at, b"one") and not f.create(at, b"two") and f.read(at) == b"one"
    f.replace(at, "drei ü".encode())
    assert f.read(at).decode() == "drei ü" and f.names(f"{tmp_path}/d") == ["x.json"]
    f.delete(at)
    assert f.names(f"{tmp_path}/d") == []


@pytest.mark.parametrize("args", [dict(limit=0), dict(limit=501), dict(limit=True), dict(after="x" * 1501), dict(filters={"x": "y"}), dict(filters={"status": "y" * 201})])
def test_page_arguments(spark, outcome, args):
    with pytest.raises(ValueError):
        paging.page_frame(versions(outcome), "r", "association", **args)


def test_admission(tmp_path):
    pages = paging.Pages(lambda: None, Registry(tmp_path / "r"), paging.Bookmarks(), at_once=1)
    with pages._admitted(), pytest.raises(paging.Overloaded):
        pages.page("metric")


def test_registry(tmp_path):
    r = Registry(tmp_path / "r")
    r.register("a", Rules())
    r.register("live-v1", Rules(), "live")
    r.register("live-v1", Rules(), "live")
    with pytest.raises(ValueError):
        r.register("live-v1", Rules(rule_version="v2"), "live")
    for bad in ("", "a b", "x" * 81):
        with pytest.raises(ValueError):
            r.register(bad, Rules())
    with pytest.raises(ValueError):
        r.activate("a", "not validated")
    with pytest.raises(ValueError):
        r.validate("a", {"passed": True})
    done = {"passed": True, "archive_complete": True, "sink_complete": True}
    r.validate("a", done)
    with pytest.raises(ValueError):
        r.activate("a", " ")
    assert r.activate("a", "go")["changed"] and not r.activate("a", "again")["changed"]
    r.register("b", Rules())
    r.validate("b", done)
    r.activate("b", "next")
    assert r.get("a")["status"] == "retired" and r.active() == "b"
    assert r.activate("a", "back")["previous"] == "b" and len(r.audit()) == 3
    other = Registry(tmp_path / "r")  # another reader of the same journal
    assert other.active() == "a" and [x["release_id"] for x in other.list()] == ["b", "live-v1", "a"]
    other.register("c", Rules())
    with pytest.raises(ValueError):
        r.register("c", Rules())
    r.fail("c")
    assert other.get("c")["status"] == "failed"
    with pytest.raises(ValueError):
        other.validate("c", done)


def test_store_is_idempotent_and_refuses_conflicts(spark, outcome, tmp_path):
    store = results.ResultStore(spark, str(tmp_path / "store"))
    rows = versions(outcome).cache()
    told = results.as_messages(rows, "t.results").cache()
    assert store.deliver(told) == 22 and store.deliver(told) == 0
    assert results.latest(store.results, "replay-v1", "association").count() == 11
    with pytest.raises(ValueError, match="other content"):
        store.deliver(told.withColumn("value", F.concat("value", F.lit(" "))))
    with pytest.raises(ValueError, match="partition"):
        store.deliver(told.withColumns({"partition": F.lit(1), "offset": F.col("offset") + 50}))
    with pytest.raises(ValueError, match="no table"):
        store.append("other", rows)
    view = results.latest_view(store.results).collect()
    assert len(view) == 11 and all(r["inserted_at"] > BASE for r in view)
    fields = results.latest_fields(store.results, "replay-v1", "association", "status", "reason").collect()
    assert len(fields) == 11 and {r["status"] for r in fields} == {"matched", "unmatched"}


def test_a_delivery_that_failed_half_way_is_completed(spark, outcome, tmp_path):
    store = results.ResultStore(spark, str(tmp_path / "store"))
    told = results.as_messages(versions(outcome), "t.results").cache()
    store.append("deliveries", told.select("topic", "partition", "offset", F.sha2("value", 256).alias("hash")))
    assert store.deliver(told) == 22


def test_quality_receipts_and_visibility_are_routed(spark, tmp_path):
    store = results.ResultStore(spark, str(tmp_path / "store"))
    payload = {"metric_key": "k", "clicks": 1, "receipt_updates": [{"receipt_id": "b:0", "received_at": 5, "event_time": 4}, {"receipt_id": "b:1", "received_at": 6, "event_time": 4}]}
    rows = [
        ("x.results", 0, 1, json.dumps({"release_id": "r", "record_type": "metric", "output_key": "m:k", "received_at": 5, "payload": payload})),
        ("x.quality", 0, 1, json.dumps({"receipt_id": "b:0", "disposition": "cleaned", "error_code": "OK", "rule_version": "v"})),
        ("x.quality", 0, 2, json.dumps({"receipt_id": "b:1", "disposition": "duplicate", "error_code": "D", "rule_version": "v"})),
        ("x.receipts", 0, 1, json.dumps({"batch_id": "b", "received_at": 5, "receipt_ids": ["b:0", "b:1", "b:2"]})),
    ]
    messages = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    assert store.deliver(messages, now=100) == 6 and store.deliver(messages, now=200) == 0
    assert [(r["receipt_id"], r["visible_at"]) for r in store.table("visibility").orderBy("receipt_id").collect()] == [("b:0", 100), ("b:1", 100)]
    assert tuple(monitor.freshness(store.table("visibility")).first()) == (2, 95, 95)
    assert reconcile.outstanding(reconcile.explode_manifests(store.table("receipts")), store.table("quality")).first()["receipt_id"] == "b:2"
    assert [r["disposition"] for r in store.quality_of("b:1")] == ["duplicate"]
    public = paging.page_frame(store.results, "r", "metric").first()["payload"]
    assert json.loads(public) == {"metric_key": "k", "clicks": 1}


def test_publication_writes_zero_rows_once_and_reads_back(spark, outcome, tmp_path):
    store = results.ResultStore(spark, str(tmp_path / "store"))
    m, a = outcome.metrics, outcome.associations
    n = store.publish("one", m, a)
    assert n == m.count() + a.count() and store.published("one", m, a, seconds=1)
    less = m.where("clicks = 0")
    assert not store.published("one", less, a, seconds=0.1, pause=0.1)
    store.publish("two", less, a, baseline="one")
    assert store.published("two", less, a, seconds=1)
    zero = results.latest_metrics(store.results, "two").where("clicks = 0 and impressions = 0 and matched_conversions = 0 and unmatched_conversions = 0")
    assert zero.count() >= m.where("clicks > 0").count() > 0
    with pytest.raises(ValueError, match="already"):
        store.publish("two", m, a)


def test_snapshots(tmp_path):
    now = [1000.0]
    s = Snapshots(str(tmp_path), clock=lambda: now[0])
    with pytest.raises(Unavailable):
        s.read("x", 10)
    s.publish("x", {"a": 1})
    assert s.read("x", 10) == {"a": 1, "generated_at": 1000.0}
    for t in (1011.0, 994.0):
        now[0] = t
        with pytest.raises(Unavailable):
            s.read("x", 10)
    now[0] = 1000.0
    assert not s.refresh("x", lambda: 1 / 0)
    with pytest.raises(Unavailable):
        s.read("x", 10)
    assert "ZeroDivisionError" in (tmp_path / "x.json").read_text() and "division by" not in (tmp_path / "x.json").read_text()
    with pytest.raises(ValueError):
        s.publish("x", {"a": "x" * (5 << 20)})
    with s.single_writer(60):
        with pytest.raises(Unavailable), s.single_writer():
            pass
        now[0] += 61  # the claim has run out
        with s.single_writer():
            pass
    with s.single_writer():
        pass


def test_inspection_and_demo(spark, tmp_path):
    done = demo(spark, str(tmp_path / "demo"), users=12)
    assert done["again"] == done["retried"] == done["difference_count"] == 0 and done["equal"] and done["active"] == "demo-1" and done["objects"] == done["indexed"] > 0
    assert done["coverage"]["archive_missing"] == done["coverage"]["processing_pending"] == 0
    store = results.ResultStore(spark, str(tmp_path / "demo/store"))
    index = archive.ArchiveIndex(spark, str(tmp_path / "demo/archive"), str(tmp_path / "demo/index"))
    quality = spark.createDataFrame([("x.quality", 0, i, json.dumps({"receipt_id": f"offline:{i * 10}", "disposition": "cleaned", "error_code": "OK", "rule_version": "v"})) for i in range(3)], "topic string, partition int, offset long, value string")
    store.deliver(quality)
    snapshots = Snapshots(str(tmp_path / "docs"))
    inspector = Inspector(snapshots, index, store)
    assert inspector.health()["ready"] is False
    assert snapshots.refresh("operations", lambda: operational_document(store, "demo-1", Rules(), BASE)) and snapshots.refresh("coverage", lambda: done["coverage"])
    assert inspector.health()["ready"] and inspector.reconcile()["archive_complete"] and [r["n"] for r in inspector.quality()["quality"]] == [3]
    receipt = index.records().select(F.get_json_object("value", "$.receipt_id").alias("r")).first()["r"]
    assert inspector.trace(receipt)["raw"][0]["topic"] == "demo.raw"
    with pytest.raises(KeyError):
        inspector.trace("nobody")
    text = monitor.exposition(operational_gauges(snapshots.read("operations", 60)))
    assert "# TYPE pending_conversions gauge\npending_conversions 0" in text and 'quality_rows{disposition="cleaned",error_code="OK"} 3' in text


def test_collector_commits_whole_batches(spark, tmp_path):
    c = collector.Collector(str(tmp_path), clock=lambda: 7.0)
    got = c.accept(b'{"events":[{"a":1},"x"],"client_batch_id":"load-1"}')
    assert got["receipt_ids"] == [f"{got['batch_id']}:0", f"{got['batch_id']}:1"] and got["received_at"] == 7000

    class Failing(LocalFiles):
        def create(self, path, data):
            if "/receipts/" in path:
                raise OSError("no room")
            return super().create(path, data)

    with pytest.raises(sources.Rejected) as e:
        collector.Collector(str(tmp_path), Failing()).accept(b'{"events":[1]}')
    assert e.value.status == 503
    LocalFiles().create(f"{tmp_path}/raw/orphan.json", b'{"batch_id":"orphan","receipt_id":"orphan:0","event":1}\n')
    rows = collector.committed(spark, str(tmp_path)).orderBy("index").collect()
    assert [(r["receipt_id"], r["event"]) for r in rows] == list(zip(got["receipt_ids"], ['{"a":1}', "x"], strict=True))
    seen = spark.createDataFrame([(got["receipt_ids"][0], 1), ("else", 1)], "receipt_id string, visible_at long")
    batches = collector.receipts(spark, str(tmp_path))
    assert collector.visible_of_prefix(seen, batches, "load-").count() == 1 and collector.visible_of_prefix(seen, batches, "other").count() == 0


def test_vanished_and_compare(spark, outcome):
    m, a = outcome.metrics, outcome.associations
    assert reconcile.report((m, a), (m, a))["passed"]
    less = m.where("clicks = 0")
    report = reconcile.report((m, a), (less, a), 3)
    assert report["difference_count"] == m.where("clicks > 0").count() and len(report["differences"]) == 3
    zero = results.vanished(m, less, "r2", "rules-v1")
    assert reconcile.report((less, a), (less.unionByName(zero), a))["passed"]
    with pytest.raises(ValueError):
        reconcile.report((m, a.union(a)), (m, a))


def test_outstanding_and_coverage(spark):
    r = spark.createDataFrame([("a", 200), ("b", 100), ("c", 200), ("d", 200)], "receipt_id string, received_at long")
    q = spark.createDataFrame([("a", "cleaned"), ("a", "signal"), ("c", "duplicate"), ("foreign", "cleaned"), ("b", "signal")], "receipt_id string, disposition string")
    assert tuple(reconcile.outstanding_summary(r, q).first()) == (100, 2)
    c = reconcile.coverage(r, r.where("receipt_id <> 'd'"), q).first().asDict()
    assert c == {"acknowledged": 4, "archived": 3, "classified": 3, "archive_missing": 1, "processing_pending": 1, "unacknowledged": 1}
    assert reconcile.disposition_conflicts(q.union(spark.createDataFrame([("a", "filtered")], q.schema))).collect()[0][0] == "a"


@pytest.mark.parametrize("n", [1, 20, 2100])
def test_quantiles(spark, n):
    df = spark.range(n).select((F.col("id") * 3).alias("x"))
    want = 3 * min(n - 1, int(0.95 * n))
    assert tuple(monitor.rank_quantile(df, "x", 0.95).first()) == (n, want, 3 * (n - 1))
    spread = spark.range(n).select((F.col("id") * 5000 - 7).alias("x"))
    assert monitor.rank_quantile(spread, "x", 0.95).first()[1] == 5000 * min(n - 1, int(0.95 * n)) - 7
    assert tuple(monitor.rank_quantile(df.limit(0), "x", 0.95).first()) == (0, None, None)


def test_archive_round_trip_and_tampering(spark, tmp_path):
    root = str(tmp_path / "archive")
    put = lambda rows: archive.archive_batch(spark.createDataFrame(rows, "topic string, partition int, offset long, value string"), root)
    assert put([("raw", 0, 0, "é1\nx"), ("raw", 0, 1, '{"a":1}')]) == 1
    assert put([("raw", 0, 0, "é1\nx"), ("raw", 0, 1, '{"a":1}')]) == 0
    assert put([("raw", 0, 1, '{"a":1}'), ("raw", 1, 0, "x")]) == 2
    assert put([("raw", 2, i, f"v{i}") for i in range(2500)]) == 3  # bounded objects
    (tmp_path / "archive/data" / f"sha256={'0' * 64}").mkdir()
    (tmp_path / "archive/data" / f"sha256={'0' * 64}/part.txt").write_text("orphan\n")
    rows = {(r["partition"], r["offset"]): r["value"] for r in archive.verified_records(spark, root).collect()}
    assert len(rows) == 2503 and {k: v for k, v in rows.items() if k[0] < 2} == {(0, 0): "é1\nx", (0, 1): '{"a":1}', (1, 0): "x"}
    index = archive.ArchiveIndex(spark, root, str(tmp_path / "index"))
    assert index.refresh() == 6 and index.refresh(audit=True) == 0 and index.records().select("partition", "offset").distinct().count() == 2503
    assert sources.dimension_records(index.records()).count() == 0
    before = set((tmp_path / "archive/manifests").iterdir())
    put([("raw", 0, 1, "other")])
    (new,) = set((tmp_path / "archive/manifests").iterdir()) - before
    with pytest.raises(Exception, match="different values"):
        archive.verified_records(spark, root).collect()
    with pytest.raises(ValueError, match="different values"):
        index.refresh()
    (path,) = (tmp_path / "archive/data" / new.name).glob("*.txt")
    path.write_text(path.read_text().replace("other", "OTHER"))
    for crc in path.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="does not match"):
        archive.verified_records(spark, root).collect()
    shutil.rmtree(new)
    shutil.rmtree(next(iter(before)))
    with pytest.raises(ValueError, match="removed"):
        index.refresh()


def test_changes(spark):
    row = lambda **k: {"campaign_id": "c", "effective_from": 0, "source_version": 1, "attributes": {"channel": "feed"}} | k
    values = [json.dumps(row()), json.dumps({"op": "u", "before": None, "after": row(attributes='{"channel":"search"}')}), json.dumps({"payload": {"op": "d", "before": row(source_version=2), "after": None}}), None, "junk"]
    df = spark.createDataFrame([("t", 0, i, v) for i, v in enumerate(values)], "topic string, partition int, offset long, value string")
    got = {(r["source_version"], r["channel"], r["deleted"]) for r in sources.decode_changes(df).collect()}
    assert got == {(1, "search", False), (2, "feed", True)}


def test_ingest(spark):
    events, client = sources.accept_batch(b'{"events":[1,{"a":2}],"client_batch_id":"x"}')
    assert len(events) == 2 and client == "x"
    for body, status in ((b"{", 400), (b"[]", 422), (b'{"events":[]}', 422), (b'{"events":' + json.dumps([0] * 1001).encode() + b"}", 422), (b" " * (2 << 20 | 1), 413)):
        with pytest.raises(sources.Rejected) as e:
            sources.accept_batch(body)
        assert e.value.status == status
    raw = spark.createDataFrame([("t", 0, 7, '{"receipt_id":"r","received_at":5,"event":{"b":1,"a":"x"}}'), ("t", 0, 8, "junk"), ("t", 0, 9, None)], "topic string, partition int, offset long, value string")
    got = [(r["receipt_id"], json.loads(r["event"])) for r in sources.decode_raw(raw).orderBy("offset").collect()]
    assert got == [("r", {"a": "x", "b": 1}), ("t:0:8", "INVALID_RAW_ENVELOPE")]
    b = spark.createDataFrame([("b1", None, 5, ["x", "y"]), ("b0", None, 6, ["z"])], "batch_id string, client_batch_id string, received_at long, events array<string>")
    assert [r["receipt_id"] for r in sources.with_ordinal(sources.wrap_batches(b)).orderBy("ordinal").collect()] == ["b1:0", "b1:1", "b0:0"]
