"""The bounded streaming engine: clean events in, versions of metrics and associations and signals out, with keyed state that event time clears.

Three keyed operators in a row, each with state of its own and timers on the watermark:

* `Exposure`, by impression id: the first impression stays for the retention; clicks wait for theirs as long as the join wait.
* `Conversion`, by click id: the first click stays for the retention; a conversion without its click is told as pending at once, and final when its click
  comes or its wait is over.
* `Sums`, by metric key: six sums, told as a whole whenever a batch has changed them; they are frozen and dropped when the window is older than the retention.

The watermark is the largest event time less the allowed disorder. Spark drops rows behind it from operators whose input carries the watermarked
column; here that column is projected away, so late rows arrive and are told as signals: LATE_REPLAY_REQUIRED beyond the retention,
LATE_CLICK_REPLAY_REQUIRED for a click whose conversion was told as unmatched, METRIC_FROZEN_REPLAY_REQUIRED for a frozen window. One watermark is global, so a source
that is idle holds nothing back. Rows of one batch are taken in input order, impressions and clicks first.

Keys are dealt into GROUPS groups, and an operator is called once for a group's rows of a batch, not once for each key. Every read and write of state is a call
from Python to the JVM, so the records of a group's keys lie in pages of about PAGE keys, and a batch reads and writes the pages that it has keys of, once each; a
group's pages split as its keys grow. A small batch so writes up to PAGE records for each of its keys; `paged=False` keeps, reads and writes each record by itself.
Records are cleared by key. What only passes through an operator has no key and no state there. The number of groups and the form of the state are fixed at the
first start of a query.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clickledger.functions.contracts import COUNTERS, DIMENSIONS, INTEGER_FIELDS, TEXT_FIELDS, UNKNOWN, Rules
from clickledger.functions.keys import association_key, metric_key, output_key, window_start
from clickledger.operators import metrics
from clickledger.operators.dimension import with_channel
from clickledger.operators.results import ASSOCIATION_FIELDS, METRIC_FIELDS
from clickledger.sources.files import HadoopFiles

#: State that a query over many keys needs: on disk, with changes only in each checkpoint.
STATE_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "false",
}

#: Groups that keys are dealt into; more partitions than that stay empty.
GROUPS = 512
#: Keys that share a page of state.
PAGE = 32
#: Once the first of the times stored together has passed, the rest is stored again in at most so many parts, or in parts of so many.
TOGETHER = 64

_EVENT = ", ".join([*(f"{n} string" for n in TEXT_FIELDS), *(f"{n} bigint" for n in INTEGER_FIELDS if n != "received_at"), "_receipt_id string", "received_at bigint", "ordinal bigint"])
_STEP = "kind string, event string, impression string, reason string, status string, click_time bigint, first_of_click bigint, event_time bigint, ordinal bigint"
_NAMES = [x.split()[0] for x in _STEP.split(", ")]
_ORDER = {"impression": 0, "click": 1, "conversion": 2}


def _row(kind: str, event: str, event_time: int, ordinal: int, impression=None, reason=None, status=None, click_time=None, first=0) -> tuple:
    return kind, event, impression, reason, status, click_time, first, event_time, ordinal


def _frame(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    if rows:
        df = pd.DataFrame(rows, columns=_NAMES)
        df["click_time"] = df["click_time"].astype("Int64")
        yield df


def reason_of(event: dict, found: dict | None, window_ms: int, codes: tuple[str, ...]) -> str:
    """missing, identity, campaign, order, window, fine: the first that applies."""
    missing, identity, campaign, order, window, fine = codes
    if found is None:
        return missing
    passed = event["event_time"] - found["event_time"]
    tests = ((event["user_id"] != found["user_id"], identity), (event["campaign_id"] != found["campaign_id"], campaign), (passed < 0, order), (passed > window_ms, window))
    return next((code for wrong, code in tests if wrong), fine)


class _ByKey:
    """A record for each key."""

    def __init__(self, handle: StatefulProcessorHandle):
        self._map = handle.getMapState("records-v2", "key string", "record string")

    def get(self, key: str) -> str | None:
        found = self._map.getValue((key,))
        return found[0] if found else None

    def put(self, key: str, record: str) -> None:
        self._map.updateValue((key,), (record,))

    def remove(self, key: str) -> None:
        self._map.removeKey((key,))

    def flush(self) -> None:
        pass


class _Paged:
    """The records of a group in pages by linear hashing: with n pages, a key's is its hash modulo the next power of two, or half of that where this is no page yet.
    Pages are read once and written by flush(), which ends a call of the operator. Under -1: how many pages and keys there are. A page has a line for each key, with a
    tab before its record: keys and records are JSON, which has neither inside.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        self._map = handle.getMapState("pages-v1", "page int", "records string")
        self._forget()

    def _forget(self) -> None:
        self._n, self._keys, self._head, self._pages, self._stored, self._changed = 0, 0, None, {}, set(), set()

    def _at(self, key: str) -> int:
        if not self._n:
            found = self._map.getValue((-1,))
            self._head = found[0] if found else None
            self._n, self._keys = json.loads(self._head) if found else (1, 0)
        top = 1 << (self._n.bit_length() - 1)
        p = zlib.crc32(key.encode()) & (2 * top - 1)
        return p if p < self._n else p - top

    def _page(self, p: int) -> dict[str, str]:
        page = self._pages.get(p)
        if page is None:
            found = self._map.getValue((p,))
            if found:
                self._stored.add(p)
            page = self._pages[p] = dict(line.split("\t", 1) for line in found[0].split("\n")) if found else {}
        return page

    def get(self, key: str) -> str | None:
        return self._page(self._at(key)).get(key)

    def put(self, key: str, record: str) -> None:
        p = self._at(key)
        page = self._page(p)
        self._keys += key not in page
        page[key] = record
        self._changed.add(p)

    def remove(self, key: str) -> None:
        p = self._at(key)
        if self._page(p).pop(key, None) is not None:
            self._keys -= 1
            self._changed.add(p)

    def _grow(self, n: int) -> None:
        """Split pages until there are n."""
        old, self._n = self._n, n
        split = set()
        for p in range(old, n):
            self._pages[p] = {}
            while p >= old:
                p -= 1 << (p.bit_length() - 1)
            split.add(p)
        for p in split:
            page = self._page(p)
            for key in list(page):
                if (to := self._at(key)) != p:
                    self._pages[to][key] = page.pop(key)
                    self._changed |= {p, to}

    def flush(self) -> None:
        if self._changed:
            if (n := -(-self._keys // PAGE)) > self._n:
                self._grow(n)
            for p in self._changed:
                if page := self._pages[p]:
                    self._map.updateValue((p,), ("\n".join([f"{key}\t{record}" for key, record in page.items()]),))
                elif p in self._stored:
                    self._map.removeKey((p,))
            head = json.dumps([self._n, self._keys]) if self._keys else None
            if head is None and self._head is not None:
                self._map.removeKey((-1,))
            elif head != self._head:
                self._map.updateValue((-1,), (head,))
        self._forget()


class _Dealt(StatefulProcessor):
    """State by key within the groups that keys are dealt into, so that a batch calls once per group instead of once per key: a record of each
    key, and the times at which to look at keys again.
    """

    def __init__(self, rules: Rules, paged: bool = False):
        self.rules = rules
        self.paged = paged

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = (_Paged if self.paged else _ByKey)(handle)
        # Times of one batch are stored together under the first of them; n numbers what is stored under one time, and at -1 is how many.
        self.due = handle.getMapState("due-v2", "at bigint, n int", "pairs string")

    def later(self, pairs: list[tuple[int, str]]) -> None:
        """Look at keys again: (time, key)."""
        if pairs:
            pairs.sort()
            at = pairs[0][0]
            count = self.due.getValue((at, -1))
            n = int(count[0]) if count else 0
            self.due.updateValue((at, n), (json.dumps(pairs),))
            self.due.updateValue((at, -1), (str(n + 1),))
            self.handle.registerTimer(at)

    def passed(self, at: int, now: int) -> dict[str, list[int]]:
        """The times of each key that have passed, of those stored under a time; the rest is stored again."""
        count = self.due.getValue((at, -1))
        passed: dict[str, list[int]] = {}
        rest = []
        for n in range(int(count[0]) if count else 0):
            for t, key in json.loads(self.due.getValue((at, n))[0]):
                if t <= now:
                    passed.setdefault(key, []).append(t)
                else:
                    rest.append((t, key))
            self.due.removeKey((at, n))
        if count:
            self.due.removeKey((at, -1))
        rest.sort()
        together = max(TOGETHER, -(-len(rest) // TOGETHER))
        for i in range(0, len(rest), together):
            self.later(rest[i : i + together])
        return passed

    def close(self) -> None:
        pass


class _Held:
    """A key's record while a batch is at it: an anchor that stays for the retention, rows that wait for it, and new times to look at it."""

    __slots__ = ("anchor", "stored", "times", "waiting")

    def __init__(self, stored: str | None):
        self.stored = stored
        self.anchor, self.waiting = json.loads(stored) if stored else (None, [])
        self.times: list[int] = []

    def take_waiting(self) -> list[list]:
        """Rows that wait, in input order."""
        taken, self.waiting = self.waiting, []
        return sorted(taken, key=lambda x: x[2])


class _Joined(_Dealt):
    """What both joins share."""

    def late(self, event_time: int, watermark: int) -> bool:
        return event_time + self.rules.state_retention_ms <= watermark

    def keep(self, held: _Held, event: str | None, impression: str | None, reason: str | None, event_time: int, expired: bool, converted: bool) -> None:
        held.anchor = [event, impression, reason, event_time, expired, converted]
        held.times.append(event_time + self.rules.state_retention_ms)

    def wait(self, held: _Held, row) -> None:
        held.waiting.append([row.event, int(row.event_time), int(row.ordinal)])
        held.times.append(int(row.event_time) + self.rules.join_wait_ms)

    def save(self, every: dict[str, _Held]) -> None:
        for key, held in every.items():
            record = json.dumps([held.anchor, held.waiting]) if held.anchor or held.waiting else None
            if record is None and held.stored is not None:
                self.records.remove(key)
            elif record != held.stored:
                self.records.put(key, record)
        self.records.flush()
        self.later([(t, key) for key, held in every.items() for t in held.times])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows), ignore_index=True)
        passing = every["key"].isna()
        if passing.any():
            yield every.loc[passing, _NAMES].astype({"click_time": "Int64", "first_of_click": "Int64"})
        mine = every.assign(_o=every["kind"].map(_ORDER))[~passing]
        out: list[tuple] = []
        held: dict[str, _Held] = {}
        now = timerValues.getCurrentWatermarkInMs()
        for row in mine.sort_values(["_o", "ordinal"], kind="stable").itertuples():
            if row.key not in held:
                held[row.key] = _Held(self.records.get(row.key))
            self.one(held[row.key], row, now, out)
        self.save(held)
        yield from _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        now = timerValues.getCurrentWatermarkInMs()
        every: dict[str, _Held] = {}
        for name, times in self.passed(expiredTimerInfo.getExpiryTimeInMs(), now).items():
            held = every[name] = _Held(self.records.get(name))
            self.pass_times(held, times, now, out)
        self.save(every)
        yield from _frame(out)

    def pass_times(self, held: _Held, times: list[int], now: int, out: list[tuple]) -> None:
        """Times that have passed, and those that come of them, one after the other: waits that end by then, then the anchor's retention."""
        heapify(times)
        waiting, taken = sorted(held.waiting, key=lambda x: x[1]), 0
        coming = []
        while times:
            at, first = heappop(times), taken
            while taken < len(waiting) and waiting[taken][1] + self.rules.join_wait_ms <= at:
                taken += 1
            for row in sorted(waiting[first:taken], key=lambda x: x[2]):
                self.over(held, *row, out)
            for t in held.times:
                heappush(times, t) if t <= now else coming.append(t)
            held.times = []
            if held.anchor is not None and held.anchor[3] + self.rules.state_retention_ms <= at:
                held.anchor = None
        if taken:
            held.waiting = waiting[taken:]
        held.times = coming


class Exposure(_Joined):
    CODES = ("IMPRESSION_NOT_FOUND", "IMPRESSION_IDENTITY_MISMATCH", "IMPRESSION_CAMPAIGN_MISMATCH", "CLICK_BEFORE_IMPRESSION", "IMPRESSION_WINDOW_EXCEEDED", "OK")

    def _click(self, event: str, event_time: int, ordinal: int, shown: str | None, out: list[tuple]) -> None:
        reason = reason_of(json.loads(event), json.loads(shown) if shown else None, self.rules.attribution_window_ms, self.CODES)
        out.append(_row("click", event, event_time, ordinal, shown if reason == "OK" else None, reason))
        if reason != "OK":
            out.append(_row("signal", event, event_time, ordinal, reason=reason))

    def one(self, held: _Held, row, now: int, out: list[tuple]) -> None:
        at = int(row.event_time)
        if self.late(at, now):
            out.append(_row("signal", row.event, at, row.ordinal, reason="LATE_REPLAY_REQUIRED"))
        elif row.kind == "impression":
            if held.anchor is None:
                out.append(_row("impression", row.event, at, row.ordinal, row.event, "OK"))
                self.keep(held, row.event, None, None, at, False, False)
                for waiting in held.take_waiting():
                    self._click(*waiting, row.event, out)
        elif held.anchor is not None:
            self._click(row.event, at, row.ordinal, held.anchor[0], out)
        elif at + self.rules.join_wait_ms <= now:
            self._click(row.event, at, row.ordinal, None, out)
        else:
            self.wait(held, row)

    def over(self, held: _Held, event: str, event_time: int, ordinal: int, out: list[tuple]) -> None:
        self._click(event, event_time, ordinal, None, out)


class Conversion(_Joined):
    CODES = ("CLICK_NOT_FOUND", "IDENTITY_MISMATCH", "CAMPAIGN_MISMATCH", "CLICK_AFTER_CONVERSION", "ATTRIBUTION_WINDOW_EXCEEDED", "MATCHED")

    def _final(self, held: _Held, event: str, event_time: int, ordinal: int, found: bool, out: list[tuple]) -> None:
        """Tell a conversion's last word."""
        click = json.loads(held.anchor[0]) if found else None
        reason = reason_of(json.loads(event), click, self.rules.attribution_window_ms, self.CODES)
        matched = reason == "MATCHED"
        first = matched and not held.anchor[5]
        out.append(_row("conversion", event, event_time, ordinal, held.anchor[1] if matched else None, reason, "matched" if matched else "unmatched", click["event_time"] if matched else None, int(first)))
        if first:
            held.anchor[5] = True

    def one(self, held: _Held, row, now: int, out: list[tuple]) -> None:
        at, found = int(row.event_time), held.anchor is not None and bool(held.anchor[0])
        if row.kind == "click":
            if found:
                return
            out.append(_row("click", row.event, at, row.ordinal, row.impression, row.reason))
            told = held.anchor is not None  # a conversion of it was told as unmatched
            if told:
                out.append(_row("signal", row.event, at, row.ordinal, reason="LATE_CLICK_REPLAY_REQUIRED"))
            self.keep(held, row.event, row.impression, row.reason, at, told, False)
            for waiting in held.take_waiting():
                self._final(held, *waiting, True, out)
        elif self.late(at, now):
            out.append(_row("signal", row.event, at, row.ordinal, reason="LATE_REPLAY_REQUIRED"))
        elif found:
            self._final(held, row.event, at, row.ordinal, True, out)
        elif at + self.rules.join_wait_ms <= now:
            self._final(held, row.event, at, row.ordinal, False, out)
            self.keep(held, None, None, None, at, True, False)
        else:
            out.append(_row("conversion", row.event, at, row.ordinal, None, "AWAITING_CLICK", "pending"))
            self.wait(held, row)

    def over(self, held: _Held, event: str, event_time: int, ordinal: int, out: list[tuple]) -> None:
        self._final(held, event, event_time, ordinal, False, out)
        out.append(_row("signal", event, event_time, ordinal, reason="CLICK_NOT_FOUND"))
        self.keep(held, None, None, None, event_time, True, False)


_TOLD = "kind string, output_key string, event_time bigint, window_start bigint, payload string, " + ", ".join(f"{c} bigint" for c in COUNTERS)
_TOLD_NAMES = [x.split()[0] for x in _TOLD.split(", ")]


class Sums(_Dealt):
    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows), ignore_index=True)
        passing = every["key"].isna()
        if passing.any():
            yield every.loc[passing, _TOLD_NAMES]
        mine, names = every[~passing], list(COUNTERS)
        if mine.empty:
            return
        now, times = timerValues.getCurrentWatermarkInMs(), []
        last = mine.drop_duplicates("key", keep="last").set_index("key")
        added = mine.groupby("key")[names].sum().reindex(last.index)
        kinds, payloads, counts = last["kind"].tolist(), last["payload"].tolist(), added.to_numpy().tolist()
        for i, (name, start) in enumerate(zip(last.index, last["window_start"].tolist(), strict=True)):
            freezes = int(start) + self.rules.window_ms + self.rules.state_retention_ms
            if freezes <= now:
                kinds[i] = "signal"
                payloads[i] = json.dumps({"error_code": "METRIC_FROZEN_REPLAY_REQUIRED", "metric_key": last["output_key"].iloc[i]})
                continue
            record = self.records.get(name)
            if record is None:
                times.append((freezes, name))
            else:
                counts[i] = [h + c for h, c in zip(json.loads(record), counts[i], strict=True)]
            self.records.put(name, str(counts[i]))  # a list of whole numbers: JSON
        self.records.flush()
        self.later(times)
        last = last.assign(kind=kinds, payload=payloads)
        last[names] = counts
        yield last.reset_index()[_TOLD_NAMES]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for name in self.passed(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()):
            self.records.remove(name)
        self.records.flush()
        yield from ()


def _dealt(rows: DataFrame, key: F.Column, other: str) -> DataFrame:
    """Rows by groups of keys; rows without a key, which only pass through, by another column."""
    return rows.withColumn("key", key).withColumn("group", F.pmod(F.xxhash64(F.coalesce("key", other)), F.lit(GROUPS)).cast("int")).groupBy("group")


def _key(kinds: tuple[str, ...], *parts: str) -> F.Column:
    return F.when(F.col("kind").isin(*kinds), F.to_json(F.array(*parts)))


def _contributions(rows: DataFrame) -> DataFrame:
    """Counter increments of final rows, in one pass."""
    t, part = F.col("event_time"), metrics._part
    own_click = [part("occurrence", t, clicks=1), part("click", t, clicks=1)]
    matched = F.array(part("occurrence", t, matched_conversions=1), part("click", F.col("click_time"), matched_conversions=1, converted_clicks=F.col("first_of_click")), part("conversion_value", F.col("click_time"), F.col("currency"), matched_conversions=1, value_minor=F.col("value_minor")))
    parts = (
        F.when(F.col("kind") == "impression", F.array(part("occurrence", t, impressions=1), part("impression", t, impressions=1)))
        .when((F.col("kind") == "click") & F.col("impression").isNotNull(), F.array(*own_click, part("impression", F.col("impression.event_time"), clicks=1)))
        .when(F.col("kind") == "click", F.array(*own_click))
        .when(F.col("status") == "matched", matched)
        .when(F.col("status") == "unmatched", F.array(part("occurrence", t, unmatched_conversions=1)))
    )
    return rows.select("*", F.explode_outer(parts).alias("c"))


def attribute(clean: DataFrame, rules: Rules, dimension: DataFrame | None = None, release_id: str = "live-v1", paged: bool = True) -> DataFrame:
    """A stream of clean events (the columns of validate.clean_events) -> (kind, output_key, event_time, payload): kind metric, association or signal; each row replaces earlier ones of its key."""
    marked = clean.withColumn("_ts", F.timestamp_millis("event_time")).withWatermark("_ts", f"{rules.out_of_order_ms} milliseconds")
    body = F.to_json(F.struct(*[x.split()[0] for x in _EVENT.split(", ")]))
    none = [F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in _STEP.split(", ")[2:7]]
    shown = marked.withColumn("kind", F.col("event_type")).withColumn("key", _key(("impression", "click"), "advertiser_id", "app_id", "impression_id"))
    rows = shown.select("kind", body.alias("event"), *none, "event_time", "ordinal", "key")  # the watermarked column stays behind
    event = F.from_json("event", _EVENT)
    step = lambda groups, processor: groups.transformWithStateInPandas(processor, outputStructType=_STEP, outputMode="append", timeMode="EventTime")
    exposed = step(_dealt(rows, F.col("key"), "event"), Exposure(rules, paged)).withColumn("_e", F.from_json("event", "advertiser_id string, app_id string, click_id string"))
    told = step(_dealt(exposed.withColumn("key", _key(("click", "conversion"), "_e.advertiser_id", "_e.app_id", "_e.click_id")).drop("_e"), F.col("key"), "event"), Conversion(rules, paged))
    typed = told.select("kind", "reason", "status", "click_time", "first_of_click", event.alias("e"), F.from_json("impression", _EVENT).alias("impression")).select("kind", "reason", "status", "click_time", "first_of_click", "impression", "e.*")
    own = [d for d in DIMENSIONS if d not in ("currency", "channel")]
    spread = _contributions(typed)
    placed = spread.select(*[c for c in typed.columns if c not in (*own, *COUNTERS, "currency")], F.col("currency").alias("_currency"), *metrics._dimensions(False), F.col("c.currency").alias("currency"), F.col("c.cohort_basis").alias("cohort_basis"), F.coalesce("c.timestamp", "event_time").alias("timestamp"), *[F.coalesce(f"c.{c}", F.lit(0)).cast("bigint").alias(c) for c in COUNTERS], F.posexplode(F.array(F.lit(0), F.lit(1))).alias("_n", "_which"))
    # A row is a counter increment, or (once for each event) its association or signal.
    is_metric = (F.col("_which") == 0) & F.col("cohort_basis").isNotNull()
    says = (F.col("_which") == 1) & (F.col("kind").isin("conversion", "signal") & (F.col("cohort_basis").isNull() | (F.col("cohort_basis") == "occurrence")))
    chosen = with_channel(placed.where(is_metric | says), dimension).withColumn("window_start", window_start(F.col("timestamp"), rules.window_ms))
    released = chosen.withColumns({"policy_version": F.lit(rules.policy_version), "rule_version": F.lit(rules.rule_version), "release_id": F.lit(release_id), "receipt_id": F.col("_receipt_id"), "metric_key": metric_key(rules.policy_version), "association_key": association_key()})
    association = F.to_json(F.struct(*[F.col(n) if n not in ("experiment_id", "variant") else F.coalesce(f"impression.{n}", F.lit(UNKNOWN)).alias(n) for n in sorted(ASSOCIATION_FIELDS)]))
    signal = F.to_json(F.struct("receipt_id", "event_id", F.lit("attribution").alias("dataset"), F.lit("attribution-v1").alias("rule_id"), "rule_version", F.lit("signal").alias("disposition"), F.col("reason").alias("error_code")))
    base = F.to_json(F.struct(*[F.lit("provisional").alias(n) if n == "status" else F.col(n) for n in sorted(set(METRIC_FIELDS) - set(COUNTERS))]))
    out = released.select(
        F.when(F.col("_which") == 0, "metric").when(F.col("kind") == "signal", "signal").otherwise("association").alias("kind"),
        F.when(F.col("_which") == 0, output_key(F.lit("metric"), F.col("metric_key"))).when(F.col("kind") == "signal", F.concat_ws(":", F.lit("s"), "receipt_id", "reason")).otherwise(output_key(F.lit("association"), F.col("association_key"))).alias("output_key"),
        "event_time", "window_start", F.when(F.col("_which") == 0, base).when(F.col("kind") == "signal", signal).otherwise(association).alias("payload"), *COUNTERS,
    )
    summed = _dealt(out, F.when(F.col("kind") == "metric", F.col("output_key")), "output_key").transformWithStateInPandas(Sums(rules, paged), outputStructType=_TOLD, outputMode="append", timeMode="EventTime")
    whole = F.when(F.col("kind") == "metric", F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit(","), F.expr("substring(to_json(struct(" + ", ".join(COUNTERS) + ")), 2)"))).otherwise(F.col("payload"))
    return summed.select("kind", "output_key", "event_time", whole.alias("payload"))


def start(spark, clean: DataFrame, root: str, rules: Rules | None = None, dimension: DataFrame | None = None, release_id: str = "live-v1", paged: bool = True, **trigger) -> StreamingQuery:
    """Run over a stream and append versions to root/results, by batch; a batch that runs again replaces its own rows. Output without its checkpoint is refused: it would count twice.

    The number of state partitions is that of shuffle partitions at the first start, for good, and so is the form of the state (`paged`); a failed query is started again by its supervisor from the checkpoint.
    """
    files, root, rules = HadoopFiles(spark), root.rstrip("/"), rules or Rules()
    if files.exists(f"{root}/results") and not files.exists(f"{root}/checkpoint"):
        raise ValueError("the release has output but no checkpoint")
    form = b"pages-1" if paged else b"records-2"
    if files.exists(f"{root}/checkpoint"):
        if (files.read(f"{root}/state-form") or b"records-2") != form:
            raise ValueError("the checkpoint has state of another form")
    else:
        files.replace(f"{root}/state-form", form)
    for name, value in STATE_OPTIONS.items():
        spark.conf.set(name, value)

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/results/batch={n}")

    writer = attribute(clean, rules, dimension, release_id, paged).writeStream.outputMode("append").queryName(f"attribution-{release_id}").option("checkpointLocation", f"{root}/checkpoint").foreachBatch(write)
    return writer.trigger(**(trigger or {"processingTime": f"{rules.emit_interval_ms} milliseconds"})).start()


def latest(spark, root: str, kind: str) -> DataFrame:
    """(output_key, payload) of the newest version of every key; a conversion's last word outranks its pending one."""
    rows = spark.read.schema("kind string, output_key string, event_time bigint, payload string, batch bigint").parquet(f"{root.rstrip('/')}/results").where(F.col("kind") == kind)
    rank = F.struct("batch", (F.get_json_object("payload", "$.status") != "pending").alias("final"))
    return rows.groupBy("output_key").agg(F.max_by("payload", rank).alias("payload"))
