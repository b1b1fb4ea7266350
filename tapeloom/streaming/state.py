"""Keyed state that grows by event: each symbol's events taken in time order, an entry of the state store a block of them.

Rows wait in the store until the watermark has passed them, so what comes out doesn't depend on how they were cut into
micro-batches or in which order they came. Events that come together are one entry, as a call to the store costs far
more than an event; only those of a block that the watermark's delay lets wait are written again.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_store(spark: SparkSession) -> None:
    """Sets the session's state store to RocksDB, which map state and timers need; change logs instead of whole snapshots."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


#: A silence in milliseconds that no feed has: thirty thousand years.
_NEVER = 10**15
#: Events that are made Python values at a time.
SLICE = 50_000


class InOrder(StatefulProcessor):
    """Hands a key's events to ``step`` in the order of (time, tie) once the watermark is past them.

    A key that is silent for more than ``ttl_ms`` of event time loses its state. Repeats of an event are events of their own.
    """

    def __init__(self, names: list[str], ttl_ms: int):
        self.names, self.ttl_ms = names, ttl_ms
        self.row = np.dtype([("at", "<i8"), ("tie", "<i8"), ("nth", "<i8"), *[(f"v{i}", "<f8") for i in range(len(names))]])

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "block long", "soonest long, events binary")
        self.clock = handle.getValueState("clock", "arrived long, last long, expiry long")
        self.open()

    def _wait(self, events: np.ndarray) -> None:
        self.waiting.updateValue((int(events["nth"][0]),), (int(events["at"].min()), events.tobytes()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived, last, expiry = self.clock.get() if self.clock.exists() else (0, -1, -1)
        soonest = None
        for frame in rows:
            if not len(frame):
                continue
            events = np.empty(len(frame), self.row)
            events["nth"] = np.arange(arrived, arrived + len(frame))
            for field, name in zip(self.row.names, ["at", "tie", None, *self.names], strict=True):
                if name:
                    events[field] = frame[name].to_numpy()
            self._wait(events)
            arrived += len(frame)
            first = int(events["at"].min())
            soonest = first if soonest is None else min(first, soonest)
        if soonest is not None:
            self.clock.update((arrived, last, expiry))
            self.handle.registerTimer(soonest // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        due, rest = [], None
        for (block,), (soonest, packed) in list(self.waiting.iterator()):
            if soonest < mark:
                events = np.frombuffer(packed, self.row)
                late = events["at"] < mark
                due.append(events[late])
                self.waiting.removeKey((block,))
                if late.all():
                    continue
                events = events[~late]  # what the watermark's delay lets wait
                self._wait(events)
                soonest = int(events["at"].min())
            rest = soonest if rest is None else min(rest, soonest)
        arrived, last, expiry = self.clock.get() if self.clock.exists() else (0, -1, -1)
        if due:
            due = np.sort(np.concatenate(due), order=["at", "tie", "nth"])
            # cut where the key was silent for too long, whether or not a timer came in between
            silent = np.diff(due["at"], prepend=last if last >= 0 else due["at"][0]) > self.ttl_ms * 1000
            last = int(due["at"][-1])
            if expiry > 0:
                self.handle.deleteTimer(expiry)
            expiry = last // 1000 + self.ttl_ms
            self.clock.update((arrived, last, expiry))
            self.handle.registerTimer(expiry)
            if rest is not None:
                self.handle.registerTimer(rest // 1000 + 1)
            cuts = np.flatnonzero(silent)
            # slices end where the time changes, as events of one time belong together
            starts = np.flatnonzero(np.diff(due["at"], prepend=due["at"][0] - 1))
            ends = starts[np.searchsorted(starts, np.arange(SLICE, len(due), SLICE)).clip(max=len(starts) - 1)]
            edges = np.unique(np.concatenate([[0], cuts, ends, [len(due)]]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if silent[a]:
                    self.forget()
                yield self.step(key, [(e[:3], e[3:]) for e in due[a:b].tolist()])
        elif rest is None and last >= 0 and expiredTimerInfo.getExpiryTimeInMs() >= expiry:
            self.forget()
            self.clock.clear()

    def close(self) -> None:
        pass


class Rolling(InOrder):
    """Mean and population deviation over the last seconds or rows: a queue of values in the store, in blocks; head and tail counted."""

    def __init__(self, names: list[str], ttl_ms: int, seconds: int | None, rows: int | None):
        super().__init__(names, ttl_ms)
        self.reach, self.rows = None if seconds is None else seconds * 1_000_000, rows

    def open(self) -> None:
        self.queue = self.handle.getMapState("queue", "first long", "size long, events binary")
        self.sums = self.handle.getValueState("sums", "head long, tail long, mean double, square double")

    def forget(self) -> None:
        self.queue.clear()
        self.sums.clear()

    def step(self, key, due) -> pd.DataFrame:
        head, tail, mean, square = self.sums.get() if self.sums.exists() else (0, 0, 0.0, 0.0)
        entry = np.dtype([("at", "<i8"), ("value", "<f8")])
        blocks = sorted((first, size, packed) for (first,), (size, packed) in self.queue.iterator())
        held = deque(e for first, _, packed in blocks for e in np.frombuffer(packed, entry)[max(0, head - first) :].tolist())
        added, out = tail, []
        # over seconds, events of one time see each other, as rows of a range frame do
        for _, peers in groupby(due, key=(lambda e: e[0][0]) if self.rows is None else (lambda e: e[0])):
            peers = list(peers)
            for (at, _, _), (value, *_) in peers:
                held.append((at, value))
                tail += 1
                before, n = mean, tail - head
                mean += (value - mean) / n
                square += (value - before) * (value - mean)
            while held:
                at, value = held[0]
                if (self.rows is None and at >= peers[-1][0][0] - self.reach) or (self.rows is not None and tail - head <= self.rows):
                    break
                held.popleft()
                head += 1
                before, n = mean, tail - head
                mean = mean + (mean - value) / n if n else 0.0
                square = square - (value - before) * (value - mean) if n else 0.0
            dev = (max(0.0, square) / (tail - head)) ** 0.5
            out += [(key[0], k[0], k[1], *v, mean, dev) for k, v in peers]
        for first, size, _ in blocks:
            if first + size <= head:
                self.queue.removeKey((first,))
        if (kept := max(added, head)) < tail:
            self.queue.updateValue((kept,), (tail - kept, np.array(list(islice(held, len(held) - (tail - kept), None)), entry).tobytes()))
        self.sums.update((head, tail, mean, square))
        return pd.DataFrame(out, columns=["symbol", "at", "tie", *self.names, "mean", "dev"])


class Previous(InOrder):
    """The value before each one."""

    def open(self) -> None:
        self.held = self.handle.getValueState("held", "value double")

    def forget(self) -> None:
        self.held.clear()

    def step(self, key, due) -> pd.DataFrame:
        before = self.held.get()[0] if self.held.exists() else None
        out = []
        for k, v in due:
            out.append((key[0], k[0], k[1], *v, before))
            before = v[0]
        self.held.update((before,))
        return pd.DataFrame(out, columns=["symbol", "at", "tie", *self.names, "before"]).astype({"before": "float64"})


def _run(df: DataFrame, processor: InOrder, ts: str, tie: str, value: Column, carry: list[str], more: str) -> DataFrame:
    use_store(df.sparkSession)
    shaped = df.select("symbol", ts, F.unix_micros(ts).alias("at"), F.col(tie).cast("long").alias("tie"), value.cast("double").alias("value"), *[F.col(c).cast("double").alias(c) for c in carry])
    shaped = shaped.where("symbol is not null and at is not null and tie is not null and value is not null")
    schema = f"symbol string, at long, tie long, value double, {''.join(f'{c} double, ' for c in carry)}{more}"
    done = shaped.groupBy("symbol").transformWithStateInPandas(processor, schema, "Append", "EventTime")
    return done.withColumn("at", F.timestamp_micros("at")).withColumnRenamed("at", "ts")


def rolling(df: DataFrame, ts: str, tie: str, value: Column, seconds: int | None = None, rows: int | None = None, carry: list[str] | None = None, ttl_minutes: int = 15) -> DataFrame:
    """Per symbol, mean and population deviation of the value over the last seconds (or rows), each event's own included.

    ``df`` is a stream with a watermark on ``ts``. Returns symbol, ts, tie, value, the columns of ``carry``, mean and
    dev, a row an event, once the watermark has passed it: the values of the batch's range or row frame on the same
    rows. Events without symbol, time, tie or value are left out, as are those that come behind the watermark.
    """
    if (seconds is None) == (rows is None):
        raise ValueError("either seconds or rows")
    names = ["value", *(carry or [])]
    ttl = max(ttl_minutes * 60_000, (seconds or 0) * 1000)
    return _run(df, Rolling(names, ttl, seconds, rows), ts, tie, value, carry or [], "mean double, dev double")


def change(df: DataFrame, ts: str, tie: str, value: Column, carry: list[str] | None = None, ttl_minutes: int | None = 24 * 60) -> DataFrame:
    """Per symbol, the value before each one and the change against it in per cent (null where there is none or it is 0).

    Without ``ttl_minutes`` a symbol's last value is kept however long it is silent: a row a symbol.
    """
    names = ["value", *(carry or [])]
    out = _run(df, Previous(names, _NEVER if ttl_minutes is None else ttl_minutes * 60_000), ts, tie, value, carry or [], "before double")
    return out.withColumn("change_pct", (F.col("value") - F.col("before")) / F.nullif("before", F.lit(0.0)) * 100)
