"""Stateful processors: a user's own logic per key, with state and timers kept by Spark.

Each class is a ``StatefulProcessor`` for ``transformWithState`` (which needs the RocksDB state
store, see ``with_rocksdb``) and has a function that applies it to a stream. State and timers are
part of the stream's checkpoint, so a restarted query goes on where the last committed
micro-batch ended; a retried micro-batch starts from the state before it.

* ``delta_trigger`` (W8, A5, U9): fires when a distance grew by more than a threshold since the
  last firing row, with the largest measure of the last span of time;
* ``lateness_firings`` (L4, L6, U8): windows that fire when the watermark passes them and
  again for each row that comes late, until they are cleaned up;
* ``masked_by_rules`` (J2, L7): messages under a rule that changes while the stream runs.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ..functions.time import epoch_micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB, as the processors need."""
    before = spark.conf.get(STORE_CONF)
    spark.conf.set(STORE_CONF, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STORE_CONF, before)


def units(df: DataFrame, col: str, threshold: float | None = None) -> tuple[Column, str, float | int | None]:
    """``col`` in a type whose sums and differences are exact (whole numbers of a decimal's unit;
    doubles stay doubles, NaN becomes null), its SQL type, and ``threshold`` in that type."""
    kind = df.schema[col].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        return F.nanvl(F.col(col).cast("double"), F.lit(None)), "double", threshold
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    # whole numbers exceed the threshold where they exceed its floor
    limit = None if threshold is None else math.floor(Decimal(str(threshold)).scaleb(scale))
    return (F.col(col) * F.lit(10**scale)).cast("bigint"), "bigint", limit


class DeltaTrigger(StatefulProcessor):
    """State of a key: the distance so far and the baseline (one value), and the rows that can
    still be the largest of the eviction frame (a list in which measures fall and times rise, so
    it is short however many rows the span holds)."""

    def __init__(self, kind: str, threshold, evict_us: int, cumulative: bool):
        self.kind, self.threshold, self.evict_us, self.cumulative = kind, threshold, evict_us, cumulative

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", f"distance {self.kind}, baseline {self.kind}")
        self.frame = handle.getListState("frame", "us bigint, seq bigint, measure double")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        ordered = sorted((r for r in rows if r.us is not None), key=lambda r: (r.us, r.seq))
        if not ordered:
            return
        distance, baseline = self.at.get() if self.at.exists() else (None, None)
        frame = deque(self.frame.get()) if self.frame.exists() else deque()
        low = lambda m: -math.inf if m is None else m
        i = 0
        while i < len(ordered):
            now, j = ordered[i].us, i
            while j < len(ordered) and ordered[j].us == now:  # the frame holds a whole instant
                r = ordered[j]
                while frame and low(frame[-1][2]) < low(r.measure):
                    frame.pop()
                frame.append((r.us, r.seq, r.measure))
                j += 1
            while frame and frame[0][0] <= now - self.evict_us:
                frame.popleft()
            for r in ordered[i:j]:
                step = r.distance
                if step is None:
                    continue
                distance = step + (distance or 0) if self.cumulative else step
                if baseline is None:
                    baseline = distance
                elif distance - baseline > self.threshold:
                    baseline = distance
                    us, seq, measure = frame[0]
                    yield Row(key=key[0], seq=r.seq, top=measure, top_id=seq, top_us=us)
            i = j
        self.at.update((distance, baseline))
        self.frame.put(list(frame))

    def close(self) -> None:
        pass


def delta_trigger(stream: DataFrame, key: str, ts: str, seq: str, measure: str, distance: str, threshold: float,
                  evict_us: int, cumulative: bool = False) -> DataFrame:
    """W8 + A5 on a stream: the columns of the batch ``delta_trigger_max``.

    Rows of a key are taken in ``(ts, seq)`` order within a micro-batch, micro-batches in their
    order. With ``cumulative`` the column ``distance`` is what a row adds (its running sum is the
    distance), else it is the distance itself; it may fall. A row without time is left out, one
    without distance neither fires nor moves the baseline but can be a maximum. Of equal
    maxima the earliest counts. A null key is a key.
    """
    d, kind, limit = units(stream, distance, threshold)
    rows = stream.select(F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), epoch_micros(ts).alias("us"),
                         F.col(measure).cast("double").alias("measure"), d.alias("distance"))
    key_t = stream.schema[key].dataType.simpleString()
    fired = rows.groupBy("key").transformWithState(
        DeltaTrigger(kind, limit, evict_us, cumulative),
        f"key {key_t}, seq bigint, top double, top_id bigint, top_us bigint", "Append", "None")
    return fired.select(F.col("key").alias(key), F.col("seq").alias(seq), "top", "top_id",
                        F.timestamp_micros("top_us").cast("timestamp_ntz").alias("top_ts"))


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Count, smallest and largest time and whether it has fired, of two parts of a window."""
    return b if a is None else (a[0] + b[0], min(a[1], b[1]), max(a[2], b[2]), a[3] or b[3])


class LatenessWindows(StatefulProcessor):
    """State of a key: for each open window its count, smallest and largest time and whether it
    has fired. Two timers a window: one fires it, one cleans it up. Rows come as data frames; of a
    micro-batch only the late ones are held, to take them in order."""

    def __init__(self, size_ms: int, lateness_ms: int):
        self.size, self.lateness = size_ms, lateness_ms
        # The stream's watermark stays this far behind the clock, so that Spark itself drops no
        # row that a window still takes.
        self.behind = size_ms + lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start bigint", "n bigint, low bigint, high bigint, fired boolean")

    def _clock(self, timerValues) -> float:
        mark = timerValues.getCurrentWatermarkInMs()
        return mark + self.behind if mark > 0 else -math.inf  # 0: no watermark yet

    def _fired(self, key, start, kind: str, n, low, high, seq=None) -> pd.DataFrame:
        return pd.DataFrame({"key": key[0], "start": start, "kind": kind, "n": n, "low": low, "high": high,
                             "seq": -1 if seq is None else seq[0], "known": False if seq is None else seq[1]})

    def _on_time(self, key, start: int, held) -> pd.DataFrame:
        return self._fired(key, [start], "on_time", *([v] for v in held[:3]))

    def _held(self, start: int) -> tuple | None:
        return self.windows.getValue((start,)) if self.windows.containsKey((start,)) else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = self._clock(timerValues)
        found: dict[int, tuple] = {}  # what the micro-batch adds to windows that are not due
        late = []
        for some in rows:
            ms = some["ms"].to_numpy()
            some = some.assign(start=ms - ms % self.size)
            last = some["start"] + self.size - 1
            some = some[last + self.lateness > clock]  # the others are cleaned up already: dropped
            due = some["start"] + self.size - 1 <= clock
            if due.any():
                late.append(some.loc[due, ["order", "seq", "known", "ms", "start"]])
            sums = some[~due].groupby("start")["ms"].agg(["size", "min", "max"])
            for start, n, low, high in sums.itertuples(name=None):
                found[start] = _merged(found.get(start), (int(n), int(low), int(high), False))
        touched = {start: _merged(self._held(start), new) for start, new in found.items()}
        if late:
            by_window = pd.concat(late).sort_values("order", kind="stable", na_position="first").groupby("start")
            for start, some in by_window:
                start, held = int(start), self._held(int(start))
                if held is not None and not held[3]:  # due since the watermark moved: before these rows
                    yield self._on_time(key, start, held)
                ms, n = some["ms"].to_numpy(), 0 if held is None else held[0]
                lows, highs = np.minimum.accumulate(ms), np.maximum.accumulate(ms)
                if held is not None:
                    lows, highs = np.minimum(lows, held[1]), np.maximum(highs, held[2])
                yield self._fired(key, start, "late", n + np.arange(1, len(ms) + 1), lows, highs,
                                  (some["seq"].to_numpy(), some["known"].to_numpy()))
                touched[start] = (n + len(ms), int(lows[-1]), int(highs[-1]), True)
        for start, held in touched.items():
            if not self.windows.containsKey((start,)):
                for due in self._due(start):
                    self.handle.registerTimer(due)
            self.windows.updateValue((start,), held)

    def _due(self, start: int) -> tuple[int, int]:
        """When a window's timers expire, on the scale of the watermark, which is ``behind`` the
        clock: a timer expires once the watermark has reached it."""
        fires = start + self.size - 1 - self.behind
        return fires, fires + self.lateness

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = self._clock(timerValues)
        fires = expiredTimerInfo.getExpiryTimeInMs() + self.behind + 1 - self.size
        for start in sorted({fires, fires - self.lateness}):
            if start % self.size or not self.windows.containsKey((start,)):
                continue
            held, last = self.windows.getValue((start,)), start + self.size - 1
            if last <= clock and not held[3]:
                yield self._on_time(key, start, held)
                self.windows.updateValue((start,), (*held[:3], True))
            if last + self.lateness <= clock:
                self.windows.removeKey((start,))

    def close(self) -> None:
        pass


def lateness_firings(stream: DataFrame, key: str, ts: str, order: str, seq: str, size_ms: int, delay_ms: int,
                     lateness_ms: int) -> DataFrame:
    """L4 on a stream: tumbling windows per key that fire once the watermark (``delay_ms`` behind
    the largest time of the micro-batches before) has reached their last millisecond, fire again
    with their cumulative content for every row that comes later, and take rows up to
    ``lateness_ms`` after that; rows later still are dropped.

    Returns ``key, window_start, window_end, kind, n, first_ts, last_ts, seq``: ``kind`` is
    ``on_time`` or ``late``, ``seq`` the row that a late firing is for.
    Rows of a micro-batch are taken in the order of ``order``. Spark's watermark is the same for
    all rows of a micro-batch. ``ts`` is a TIMESTAMP after 1970; a row without one is left out.
    """
    windows = LatenessWindows(size_ms, lateness_ms)
    # Numbers are without nulls in the data frames (a null would turn them into doubles), and so is the key.
    rows = stream.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(seq).cast("bigint"), F.lit(-1)).alias("seq"),
                         F.col(seq).isNotNull().alias("known"), F.col(order).alias("order"),
                         F.col(ts).alias("ts"), F.unix_millis(ts).alias("ms")) \
        .withWatermark("ts", f"{delay_ms + windows.behind} milliseconds").where(F.col("ms").isNotNull())
    fired = rows.groupBy("key").transformWithStateInPandas(
        windows, "key string, start bigint, kind string, n bigint, low bigint, high bigint, seq bigint, known boolean",
        "Append", "EventTime")
    at = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
    return fired.select(F.col("key").cast(stream.schema[key].dataType).alias(key), at(F.col("start")).alias("window_start"),
                        at(F.col("start") + size_ms).alias("window_end"), "kind", "n", at(F.col("low")).alias("first_ts"),
                        at(F.col("high")).alias("last_ts"), F.when(F.col("known"), F.col("seq")).alias(seq))


class RuleMask(StatefulProcessor):
    """State of a share of the messages: the rule in force. Rows come as data frames: each message
    looks up its rule among the sorted rules of the micro-batch."""

    def __init__(self, default: str):
        self.default = default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", "us bigint, said boolean, seq bigint, keyword string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.rule.get() if self.rule.exists() else None
        messages, rules = [], []
        for some in rows:
            is_message = some["is_message"].to_numpy()
            messages.append(some.loc[is_message, ["us", "timed", "seq", "known", "text"]])
            rules.append(some.loc[~is_message & some["timed"].to_numpy(), ["us", "seq", "text"]])
        told = pd.concat(rules, ignore_index=True)
        said = told["text"].notna()
        told = told.assign(said=said, text=told["text"].where(said, self.default)).sort_values(
            ["us", "said", "seq"], kind="stable")
        if held is not None:  # an older one than the rule in force changes nothing
            us, said, seq, _ = held
            told = told[(told["us"] > us) | (told["us"] == us) & (
                (told["said"] > said) | (told["said"] == said) & (told["seq"] >= seq))]
        times = told["us"].to_numpy()
        # first the keyword before the rules of the micro-batch
        keywords = np.concatenate([np.array([self.default if held is None else held[3]], dtype=object),
                                   told["text"].to_numpy(dtype=object)])
        for some in messages:
            if len(some):
                keyword = keywords[np.searchsorted(times, some["us"].to_numpy(), side="right")]
                yield pd.DataFrame({"seq": some["seq"], "known": some["known"], "text": some["text"],
                                    "keyword": np.where(some["timed"].to_numpy(), keyword, self.default)})
        if len(told):
            last = told.iloc[-1]
            self.rule.update((int(last["us"]), bool(last["said"]), int(last["seq"]), last["text"]))

    def close(self) -> None:
        pass


def masked_by_rules(messages: DataFrame, rules: DataFrame, ts: str, seq: str, text: str, keyword: str,
                    default: str, shares: int = 64) -> DataFrame:
    """J2 and L7 as one stateful stream: ``seq, text, keyword`` of every message, with the
    keyword in force for it.

    ``messages`` and ``rules`` are streams (or two selections of one). Messages are dealt to
    ``shares`` by their id and every rule goes to all of them, as a broadcast would: the state of a
    share is one rule. Within a micro-batch rules and messages are taken by time, a rule before
    the messages of its instant, the rule of the largest ``seq`` last (after those without keyword); a rule that arrives in a later
    micro-batch is for the messages from there on, and an older one than the rule in force changes
    nothing. Before the first rule, and under a rule without keyword, ``default`` holds; rules without
    time never come into force, messages without time are under the default.
    """
    # Numbers are without nulls in the data frames: a null would turn them into doubles.
    number, us = F.col(seq).cast("bigint"), epoch_micros(ts)
    columns = [F.coalesce(us, F.lit(0)).alias("us"), us.isNotNull().alias("timed"),
               F.coalesce(number, F.lit(-1)).alias("seq"), number.isNotNull().alias("known")]
    said = messages.select(F.pmod(F.xxhash64(number), F.lit(shares)).alias("share"), *columns,
                           F.lit(True).alias("is_message"), F.col(text).alias("text"))
    told = rules.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shares - 1).cast("bigint"))).alias("share"),
                        *columns, F.lit(False).alias("is_message"), F.col(keyword).alias("text"))
    out = said.unionByName(told).groupBy("share").transformWithStateInPandas(
        RuleMask(default), "seq bigint, known boolean, text string, keyword string", "Append", "None")
    return out.select(F.when(F.col("known"), F.col("seq")).alias(seq), F.col("text").alias(text), "keyword")
