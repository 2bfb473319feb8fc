from __future__ import annotations

import json
import random
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickledger.functions.contracts import COUNTERS, PACKET, Rules
from clickledger.operators import reconcile, results
from clickledger.plans.batch import calculate
from clickledger.sources import generator
from clickledger.sources.packets import offline_packets
from clickledger.streaming import attribution, clean
from clickledger.streaming.live import LiveEngine

from tests.helpers import BASE, event
from tests.helpers import packets as packets_of


def files(spark, packets, path, n=3):
    packets.repartitionByRange(n, "ordinal").write.json(path)


@pytest.mark.parametrize("scenario", ["mixed", "conversion-first"])
def test_live_results_converge_to_the_batch_result(spark, tmp_path, scenario):
    sent = offline_packets(generator.transport(generator.truth(spark, 25), scenario)).cache()
    files(spark, sent, str(tmp_path / "in"))
    # Two late impressions of another advertiser move the watermark past every wait; what has not found its click by then is unmatched.
    clock = []
    for i in (1, 2):
        late = json.dumps(event("impression", f"clock{i}", 4_000_000_000_000 + i, advertiser_id="clock"))
        clock.append(spark.createDataFrame([(f"clock{i}", 4_000_000_000_000, 1_000_000_000 + i, late)], PACKET))
        clock[-1].coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    packets = sent.unionByName(clock[0]).unionByName(clock[1])
    engine = LiveEngine(spark, str(tmp_path / "live"))
    stream = lambda: spark.readStream.schema(PACKET).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    engine.start(stream(), str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    want = calculate(packets)
    stored = engine.results().drop("batch")
    got = results.latest_metrics(stored, "live-v1"), results.latest_associations(stored, "live-v1")
    report = reconcile.report((want.metrics, want.associations), got)
    assert report["passed"], report["differences"][:2]
    # A restart finds nothing new; a lost checkpoint is refused.
    n = engine.results().count()
    engine.start(stream(), str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    assert engine.results().count() == n
    with pytest.raises(ValueError):
        engine.start(stream(), str(tmp_path / "other"), availableNow=True)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    packets = offline_packets(generator.truth(spark, 8)).cache()
    engine = LiveEngine(spark, str(tmp_path / "live"))
    engine.process(packets, 0)
    first = {tuple(r) for r in engine.results().collect()}
    engine.process(packets, 0)
    assert {tuple(r) for r in engine.results().collect()} == first


def test_pending_conversions_and_signals(spark, tmp_path):
    hour = 3_600_000
    batches = [
        [event("conversion", "1"), event("impression", "9")],
        [event("impression", "10", BASE + 3 * hour)],
        [event("impression", "11", BASE + 3 * hour + 1, advertiser_id="other")],
        [event("click", "1", BASE - 1000)],
        [event("impression", "12", BASE - 30 * hour), event("impression", "1", BASE - 2000)],
    ]
    every = packets_of(spark, [e for b in batches for e in b]).cache()
    engine = LiveEngine(spark, str(tmp_path / "live"))
    at, seen = 0, []
    for i, b in enumerate(batches):
        engine.process(every.where(f"ordinal >= {at} AND ordinal < {at + len(b)}"), i)
        at += len(b)
        stored = engine.results().drop("batch")
        (a,) = results.latest_associations(stored, "live-v1").collect()
        counted = results.latest_metrics(stored, "live-v1").agg(F.sum("unmatched_conversions")).first()[0]
        seen.append((a["status"], a["reason"], a["variant"], counted, sorted((r["event_id"], r["error_code"]) for r in engine.signals().where(f"batch = {i}").collect())))
    assert seen == [
        ("pending", "AWAITING_CLICK", "unknown", 0, []),
        ("pending", "AWAITING_CLICK", "unknown", 0, []),
        ("unmatched", "CLICK_NOT_FOUND", "unknown", 1, [("e-conversion-1", "CLICK_NOT_FOUND")]),
        ("matched", "MATCHED", "unknown", 0, [("e-click-1", "IMPRESSION_NOT_FOUND"), ("e-click-1", "LATE_CLICK_REPLAY_REQUIRED")]),
        ("matched", "MATCHED", "control", 0, [("e-impression-12", "LATE_REPLAY_REQUIRED")]),
    ]


def test_missing_campaign_history_is_signalled_once(spark, tmp_path):
    versions = "campaign_id string, effective_from bigint, effective_to bigint, source_version bigint, channel string, deleted boolean"
    own = event("impression", "1")["campaign_id"]
    history = spark.createDataFrame([(own, BASE, None, 1, "feed", False)], versions)
    batches = [
        [event("impression", "1"), event("impression", "2", BASE - 1), event("impression", "3", campaign_id="campaign-new"), event("conversion", "7", campaign_id="campaign-new")],
        [event("impression", "4", BASE + 1), event("impression", "5", campaign_id="campaign-new")],
    ]
    every = packets_of(spark, [e for b in batches for e in b]).cache()
    engine = LiveEngine(spark, str(tmp_path / "live"), dimension=history)
    at = 0
    for i, b in enumerate(batches):
        engine.process(every.where(f"ordinal >= {at} AND ordinal < {at + len(b)}"), i)
        at += len(b)
    got = sorted((r["batch"], r["event_id"]) for r in engine.signals().where("error_code = 'DIMENSION_HISTORY_MISSING'").collect())
    # The conversion still waits for its click and does not count yet.
    assert got == [(0, "e-impression-2"), (0, "e-impression-3"), (1, "e-impression-5")]


def test_clean_query_dispositions(spark, tmp_path):
    packets = offline_packets(generator.transport(generator.truth(spark, 20), "mixed")).cache()
    files(spark, packets, str(tmp_path / "in"), 2)
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # With a processing-time clock every batch asks for another one; without data there is nothing to do here.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        stream = spark.readStream.schema(PACKET).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        out = clean.dispositions(stream, Rules()).select("receipt_id", "disposition")
        q = out.writeStream.format("memory").queryName("clean_out").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    got = spark.table("clean_out").groupBy("disposition").count().collect()
    want = calculate(packets).disposed.groupBy("disposition").count().collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in want}


def attributed(spark, path, kind, *names):
    get = lambda n: F.get_json_object("payload", f"$.{n}")
    return sorted(tuple(r) for r in attribution.latest(spark, path, kind).select("output_key", *map(get, names)).collect())


@pytest.fixture
def state_store(spark):
    old = {n: spark.conf.get(n, None) for n in ("spark.sql.shuffle.partitions", *attribution.STATE_OPTIONS)}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_bounded_engine_converges_and_restarts(spark, tmp_path, state_store):
    """Half of the traffic, then, from the checkpoint, the rest: together the batch result; late rows are not dropped."""
    out = calculate(offline_packets(generator.transport(generator.truth(spark, 25), "mixed")))
    clean = out.clean.cache()
    middle = clean.approxQuantile("ordinal", [0.5], 0.0)[0]
    stream = lambda: spark.readStream.schema(clean.schema).json(f"{tmp_path}/in")
    for part in (clean.where(F.col("ordinal") <= middle), clean.where(F.col("ordinal") > middle)):
        part.coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        q = attribution.start(spark, stream(), f"{tmp_path}/live", availableNow=True)
        q.awaitTermination()
        assert all(s["numRowsDroppedByWatermark"] == 0 for p in q.recentProgress for s in p["stateOperators"])
    fields = ("status", "reason", "experiment_id", "variant")
    assert attributed(spark, f"{tmp_path}/live", "association", *fields) == sorted(("a:" + r["association_key"], *(r[f] for f in fields)) for r in out.associations.collect())
    assert attributed(spark, f"{tmp_path}/live", "metric", *COUNTERS) == sorted(("m:" + r["metric_key"], *(str(r[c]) for c in COUNTERS)) for r in out.metrics.collect())
    shutil.rmtree(f"{tmp_path}/live/checkpoint")
    with pytest.raises(ValueError):
        attribution.start(spark, stream(), f"{tmp_path}/live", availableNow=True)


def test_bounded_engine_waits_signals_and_forgets(spark, tmp_path, state_store):
    hour = 3_600_000
    batches = [
        [event("conversion", "1"), event("impression", "9")],
        [event("impression", "10", BASE + 3 * hour)],
        [event("impression", "11", BASE + 3 * hour + 1, advertiser_id="other"), event("click", "1", BASE - 1000)],
        [event("impression", "12", BASE + 40 * hour, advertiser_id="other")],
        [event("impression", "13", BASE, advertiser_id="late"), event("impression", "14", BASE + 41 * hour, advertiser_id="other")],
    ]
    every = calculate(packets_of(spark, [e for b in batches for e in b])).clean.cache()
    at, seen = 0, []
    for b in batches:
        every.where(f"ordinal >= {at} AND ordinal < {at + len(b)}").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        at += len(b)
        attribution.start(spark, spark.readStream.schema(every.schema).json(f"{tmp_path}/in"), f"{tmp_path}/live", availableNow=True).awaitTermination()
        seen.append((attributed(spark, f"{tmp_path}/live", "association", "status", "reason")[0][1:], sorted(x[1:] for x in attributed(spark, f"{tmp_path}/live", "signal", "receipt_id", "error_code"))))
    assert seen[0] == (("pending", "AWAITING_CLICK"), [])
    over = ("r0", "CLICK_NOT_FOUND")
    assert seen[1] == (("unmatched", "CLICK_NOT_FOUND"), [over])  # the wait ends when the watermark passes it
    click = [("r4", "IMPRESSION_NOT_FOUND"), ("r4", "LATE_CLICK_REPLAY_REQUIRED")]
    assert seen[2] == (("unmatched", "CLICK_NOT_FOUND"), [over, *click])  # what was told is not taken back
    assert seen[4][1] == [over, *click, ("r6", "LATE_REPLAY_REQUIRED")]


class _States:
    """State variables and timers of one group, in memory; reads and writes of records are noted."""

    def __init__(self):
        self.maps, self.timers, self.noted = {}, set(), []

    def getMapState(self, name, *_):  # noqa: N802
        held, noted = self.maps.setdefault(name, {}), self.noted if name.startswith("records") else []

        class Map:
            getValue = lambda _, k: (noted.append(("read", k)), held.get(k))[1]
            updateValue = lambda _, k, v: (noted.append(("write", k)), held.update({k: v}))
            removeKey = lambda _, k: held.pop(k)

        return Map()

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)


def test_a_call_takes_all_keys_of_a_group_and_forgets_each_in_its_time():
    """Impressions of the even keys, clicks of all keys before and after them: one call a batch, each record is read and written once in it, and each wait and retention ends by its own time."""
    rules, states, keys = Rules(attribution_window_ms=4000, join_wait_ms=1000, state_retention_ms=5000), _States(), 200
    processor = attribution.Exposure(rules)
    processor.init(states)
    at = lambda now: type("Now", (), {"getCurrentWatermarkInMs": lambda _: now, "getExpiryTimeInMs": lambda _: now})()

    def call(kind, now, numbers, shift):
        rows = [{n: None for n in attribution._NAMES} | {"kind": kind, "event": json.dumps({"event_time": shift + i, "user_id": "u", "campaign_id": "c", "n": i}), "event_time": shift + i, "ordinal": i, "key": f"k{i}"} for i in numbers]
        passing = rows[0] | {"kind": "conversion", "key": None}
        states.noted.clear()
        # As Spark hands them over: in several frames, which have the same index.
        out = list(processor.handleInputRows((7,), iter([pd.DataFrame(rows[:50]), pd.DataFrame([*rows[50:], passing])]), at(now)))
        assert len(states.noted) == len(set(states.noted))
        return sorted((x.kind, json.loads(x.event)["n"], x.reason) for frame in out for x in frame.itertuples())

    def pass_time(now):
        told = []
        while due := [t for t in states.timers if t <= now]:
            told += [x for frame in processor.handleExpiredTimer((7,), at(now), type("Info", (), {"getExpiryTimeInMs": lambda _, t=min(due): t})()) for x in frame.itertuples()]
            states.timers.discard(min(due))
        return sorted((x.kind, json.loads(x.event)["n"], x.reason) for x in told)

    even, odd = range(0, keys, 2), range(1, keys, 2)
    assert call("click", 0, range(keys), 10_000) == [("conversion", 0, None)]
    assert call("impression", 0, even, 9_500) == [*[("click", i, "OK") for i in even], ("conversion", 0, None), *[("impression", i, "OK") for i in even]]
    assert call("click", 0, even, 9_600)[:100] == [("click", i, "OK") for i in even]
    assert pass_time(10_999) == []
    none = "IMPRESSION_NOT_FOUND"
    for now, over in ((11_020, odd[:10]), (11_021, odd[10:11]), (12_000, odd[11:])):
        assert pass_time(now) == sorted((kind, i, none) for i in over for kind in ("click", "signal"))
    assert pass_time(14_599) == []
    assert {k for (k,) in states.maps["records-v2"]} == {f"k{i}" for i in even if i > 99}
    assert pass_time(20_000) == []
    assert states.maps == {"records-v2": {}, "due-v2": {}}
    assert call("impression", 20_000, [1], 9_501)[1:] == [("signal", 1, "LATE_REPLAY_REQUIRED")]


class _Kept(_States):
    """State of one group in memory, by whole maps; every call is counted, as each would go from Python to the JVM."""

    def __init__(self):
        super().__init__()
        self.calls = 0

    def getMapState(self, name, *_):  # noqa: N802
        held, states = self.maps.setdefault(name, {}), self

        def called(f):
            def call(*args):
                states.calls += 1
                return f(*args)

            return staticmethod(call)

        return type("Map", (), {"getValue": called(held.get), "updateValue": called(lambda k, v: held.update({k: v})), "removeKey": called(held.pop)})()

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        super().registerTimer(at)


def _at(now, expiry=None):
    return type("Now", (), {"getCurrentWatermarkInMs": lambda _: now, "getExpiryTimeInMs": lambda _: now if expiry is None else expiry})()


def _told(frames):
    return [tuple(x) for frame in frames for x in frame.astype(object).where(frame.notna(), None).itertuples(index=False)]


def _pass(processor, states, now):
    told = []
    while due := [t for t in states.timers if t <= now]:
        told += _told(processor.handleExpiredTimer((7,), _at(now), _at(now, min(due))))
        states.timers.discard(min(due))
    return told


def _steps(kind, numbers, shift):
    body = lambda i: json.dumps({"event_time": shift + i, "user_id": "u", "campaign_id": "c"})
    return pd.DataFrame([{n: None for n in attribution._NAMES} | {"kind": kind, "event": body(i), "event_time": shift + i, "ordinal": shift + i, "key": f"k{i}"} for i in numbers])


@pytest.mark.parametrize("operator", [attribution.Exposure, attribution.Conversion])
def test_pages_tell_what_records_by_key_tell_in_few_calls(operator):
    """Anchors, rows before and after them, and rows that wait in vain, in growing and shrinking groups: the same rows from either form of state, in order; pages take a fraction of the calls and are gone in the end."""
    rules = Rules(attribution_window_ms=30_000, join_wait_ms=20_000, state_retention_ms=50_000)
    early, late = ("impression", "click") if operator is attribution.Exposure else ("click", "conversion")
    rng = random.Random(3)
    batches = [(0, late, rng.sample(range(3000), 700), 10_000), (0, early, rng.sample(range(3000), 1500), 9_000), (1_000, late, range(0, 3000, 3), 12_000), (31_000, early, [5], 40_000), (40_000, early, range(2000, 2400), 41_000), (70_000, late, range(1900, 2500), 71_000), (400_000, late, [7], 400_000)]
    told, calls, kept = {}, {}, {}
    for paged in (False, True):
        states = kept[paged] = _Kept()
        processor = operator(rules, paged)
        processor.init(states)
        told[paged], calls[paged] = [], []
        for now, kind, numbers, shift in batches:
            before = states.calls
            told[paged].append(_pass(processor, states, now))
            told[paged].append(_told(processor.handleInputRows((7,), iter([_steps(kind, numbers, shift)]), _at(now))))
            calls[paged].append(states.calls - before)
        told[paged].append(_pass(processor, states, 10**9))
    assert [sorted(map(str, x)) for x in told[True]] == [sorted(map(str, x)) for x in told[False]]
    assert told[True][1::2] == told[False][1::2]  # rows of a batch, in order
    assert {x[3] for x in sum(told[True], [])} >= {operator.CODES[0], operator.CODES[-1]}
    for many in (0, 1, 2):  # the pages of 3,000 keys, read and written, and times
        assert calls[True][many] < 3 * 3000 // attribution.PAGE < len(batches[many][2]) < calls[False][many]
    assert kept[True].maps == {"pages-v1": {}, "due-v2": {}}
    assert kept[False].maps == {"records-v2": {}, "due-v2": {}}


def test_a_batch_of_many_sums_takes_few_calls():
    """A batch of 4,000 metric keys in one group, twice, then a batch of three: sums of all, pages of about PAGE keys, and a small batch touches its own pages only."""
    rules, states = Rules(), _Kept()
    processor = attribution.Sums(rules, True)
    processor.init(states)
    names = attribution._TOLD_NAMES

    def call(numbers):
        rows = [dict.fromkeys(names, 0) | {"kind": "metric", "output_key": f"m:{i}", "key": f"m:{i}", "payload": "{}", "window_start": 10**6 + i, "clicks": i} for i in numbers]
        before = states.calls
        out = pd.concat(list(processor.handleInputRows((7,), iter([pd.DataFrame(rows)]), _at(0))))
        return dict(zip(out["output_key"], out["clicks"], strict=True)), states.calls - before

    for times in (1, 2):
        sums, calls = call(range(4000))
        assert sums == {f"m:{i}": times * i for i in range(4000)}
        assert calls < 3 * 4000 // attribution.PAGE
    assert len(states.maps["pages-v1"]) == 1 + 4000 // attribution.PAGE
    sums, calls = call([1, 2, 3])
    assert sums == {f"m:{i}": 3 * i for i in (1, 2, 3)} and calls <= 7
    frozen = 10**6 + 4000 + rules.window_ms + rules.state_retention_ms
    assert _pass(processor, states, frozen - 2000) == [] and sum(len(v.split("\n")) for (p,), (v,) in states.maps["pages-v1"].items() if p >= 0) == 1999
    assert _pass(processor, states, frozen) == [] and states.maps == {"pages-v1": {}, "due-v2": {}}


def test_a_checkpoint_goes_on_in_its_own_form_of_state(spark, tmp_path, state_store):
    every = calculate(packets_of(spark, [event("impression", "1"), event("click", "1")])).clean
    every.coalesce(1).write.json(f"{tmp_path}/in")
    begin = lambda paged: attribution.start(spark, spark.readStream.schema(every.schema).json(f"{tmp_path}/in"), f"{tmp_path}/live", paged=paged, availableNow=True)
    begin(False).awaitTermination()
    with pytest.raises(ValueError, match="another form"):
        begin(True)
    begin(False).awaitTermination()
    assert sum(int(x[1] or 0) for x in attributed(spark, f"{tmp_path}/live", "metric", "clicks")) == 3
