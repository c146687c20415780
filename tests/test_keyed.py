"""Stateful processors: goldens, brute force, restarts."""

import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtures import OUT_OF_ORDER
from riverbend.operators.triggers import delta_trigger_max
from riverbend.session import checkpoint_path
from riverbend.streaming import keyed
from riverbend.streaming.replay import replay_batches, stream_folder

DAY = 86_400_000  # Spark's watermark starts at 1970, so samples near it are moved by a day


def batches(spark, rows, schema, flush=None):
    """A stream whose micro-batches are the lists of ``rows``."""
    flat = [(*r, i) for i, some in enumerate(rows) for r in some]
    df = spark.createDataFrame(flat, f"{schema}, batch int")
    last = [spark.createDataFrame([flush], schema)] if flush else []
    replay = replay_batches(df, "batch", len(rows), "keyed", last)
    return stream_folder(spark, replay, df.drop("batch").schema)


def run(spark, sdf, name=None, **options):
    name = name or f"k{uuid.uuid4().hex[:8]}"
    out = checkpoint_path(spark, f"out/{name}")
    q = start(spark, sdf.writeStream.format("parquet").option("path", out).options(**options)
              .option("checkpointLocation", checkpoint_path(spark, f"ckpt/{name}")))
    q.awaitTermination()
    return spark.read.parquet(out)


def start(spark, writer):
    """Two state partitions: each is a worker and a store in every micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        with keyed.with_rocksdb(spark):
            return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def lateness(spark, rows, size, delay, late):
    flush = ("flush", max(r[1] for some in rows for r in some) + 10**12, -1)
    s = batches(spark, rows, "key string, ms bigint, seq bigint", flush).withColumn("ts", F.timestamp_millis("ms"))
    out = run(spark, keyed.lateness_firings(s, "key", "ts", "seq", "seq", size, delay, late))
    at = lambda t: int(t.timestamp() * 1000)
    return sorted((r["kind"], r["key"], at(r["window_start"]), r["n"], at(r["first_ts"]), at(r["last_ts"]), r["seq"] or -1)
                  for r in out.collect() if r["key"] != "flush")


def brute_lateness(rows, size, delay, late):
    """One clock for all rows of a micro-batch; windows fire when it reaches their last millisecond."""
    out, held, clock, top = [], {}, float("-inf"), None
    for some in rows:
        for (k, start), w in sorted(held.items()):
            if start + size - 1 <= clock and not w[3]:
                out.append(("on_time", k, start, *w[:3], -1))
                w[3] = True
        for k, ms, seq in sorted(some, key=lambda r: r[2]):
            start = ms - ms % size
            last = start + size - 1
            if last + late <= clock:
                continue
            w = held.setdefault((k, start), [0, ms, ms, False])
            w[:3] = w[0] + 1, min(w[1], ms), max(w[2], ms)
            if last <= clock:
                w[3] = True
                out.append(("late", k, start, *w[:3], seq))
        top = max([ms for _, ms, _ in some] + ([top] if top is not None else []))
        clock = top - delay
    out += [("on_time", k, start, *w[:3], -1) for (k, start), w in held.items() if not w[3]]
    return sorted(out)


def test_out_of_order_golden(spark):
    """Each line a micro-batch of its own: the watermark moves after each row."""
    rows = [[(k, ms + DAY, i)] for i, (k, ms) in enumerate(OUT_OF_ORDER)]
    got = [(*r[:2], r[2] - DAY, r[3], r[4] - DAY, r[5] - DAY) for r in lateness(spark, rows, 10_000, 5_000, 5_000)]
    assert got == sorted([
        ("on_time", "Flink", 0, 2, 1000, 9000), ("on_time", "php", 0, 1, 3000, 3000),
        ("on_time", "Hadoop", 0, 1, 6000, 6000), ("late", "Flink", 0, 3, 1000, 9000),
        ("late", "Scala", 0, 1, 5000, 5000), ("on_time", "Flink", 10000, 1, 12000, 12000),
        ("on_time", "Python", 10000, 1, 15000, 15000), ("on_time", "Flink", 20000, 1, 20000, 20000),
        ("on_time", "Spark", 20000, 1, 21000, 21000)])


@pytest.mark.parametrize("seed", [1, 2])
def test_lateness_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, seq = [], 0
    for b in range(7):
        some = []
        for _ in range(rng.randint(1, 25)):
            # small windows, so that clocks often meet a window's last millisecond
            some.append((rng.choice("ab"), DAY + b * 12 + rng.randint(-30, 12), seq))
            seq += 1
        rows.append(some)
    for size, delay, late in ((10, 3, 7), (4, 0, 0), (5, 2, 11)):
        assert lateness(spark, rows, size, delay, late) == brute_lateness(rows, size, delay, late)


def cars(seed, n=300, falling=False):
    rng = random.Random(seed)
    t, rows = 0, []
    for i in range(n):
        t += rng.choice([0, 1, 1, 5, 30])
        rows.append((rng.choice([1, 1, 1, 2, None]), i, DAY * 1000 + t * 1_000_000, rng.choice([None, *map(float, range(90))]),
                     rng.choice([None, *range(-20 if falling else 0, 30)])))
    return rows


@pytest.mark.parametrize("falling", [False, True])
def test_delta_trigger_equals_batch(spark, falling):
    """Three micro-batches (cut between instants) against the batch operator."""
    rows = cars(5, falling=falling)
    schema = "car bigint, id bigint, us bigint, speed double, step int"
    cuts, parts = [100, 200, len(rows)], [[], [], []]
    for k, r in enumerate(rows):
        place = next(i for i, c in enumerate(cuts) if k < c or rows[c - 1][2] == r[2])
        parts[place].append(r)
    timed = lambda d: d.withColumn("ts", F.timestamp_micros("us"))
    out = run(spark, keyed.delta_trigger(timed(batches(spark, parts, schema)), "car", "ts", "id", "speed", "step", 50,
                                         10_000_000, cumulative=True))
    from pyspark.sql import Window
    w = Window.partitionBy("car").orderBy("us", "id").rowsBetween(Window.unboundedPreceding, 0)
    flat = timed(spark.createDataFrame(rows, schema)).withColumn(
        "distance", F.when(F.col("step").isNotNull(), F.sum("step").over(w)))
    want = delta_trigger_max(flat, "car", "ts", "id", "speed", "distance", 50, 10_000_000)
    cols = ["car", "id", "top", "top_id", "top_ts"]
    key = lambda r: tuple(map(str, r))
    got = sorted(map(key, out.select(cols).collect()))
    assert got == sorted(map(key, want.select(cols).collect())) and len(got) > 10


def test_top_speed_golden(spark):
    rows = [[(1, 50.0, 0.0, 0)], [(1, 60.0, 40.0, 3), (1, 70.0, 51.0, 6)], [(1, 55.0, 101.0, 9), (1, 50.0, 102.0, 17)]]
    s = batches(spark, rows, "car int, speed double, distance double, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    out = run(spark, keyed.delta_trigger(s.withColumn("id", F.col("s")), "car", "ts", "id", "speed", "distance", 50.0, 10_000_000))
    assert sorted((r["id"], r["top"], r["top_id"]) for r in out.collect()) == [(6, 70.0, 6), (17, 55.0, 9)]


RULES = "ts timestamp, seq bigint, text string, is_rule boolean"


def masked(stream, shares=3):
    return keyed.masked_by_rules(stream.where("not is_rule"), stream.where("is_rule"), "ts", "seq", "text", "text", "java", shares)


def test_rules_between_messages(spark):
    from datetime import datetime, timedelta
    at = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    say = lambda s, i: (at(s), i, f"m{i}", False)
    rule = lambda s, i, k: (at(s), i, k, True)
    rows = [[*(say(s, s) for s in range(1, 6)), rule(3, 100, "python"), rule(3, 101, "scala")],
            [*(say(s, s) for s in range(6, 9)), rule(2, 102, "too old")],
            [rule(9, 103, None), say(9, 9), say(10, 10), rule(11, 104, "go"), say(11, 11), (None, 12, "m12", False),
             (None, 105, "no time", True)]]
    got = {r["seq"]: r["keyword"] for r in run(spark, masked(batches(spark, rows, RULES))).collect()}
    assert got == {1: "java", 2: "java", 3: "scala", 4: "scala", 5: "scala", 6: "scala", 7: "scala", 8: "scala",
                   9: "java", 10: "java", 11: "go", 12: "java"}


def test_state_survives_a_restart(spark):
    """The query stops after a failed micro-batch and goes on: nothing lost, nothing twice."""
    rows = cars(9)
    schema = "car bigint, id bigint, us bigint, speed double, step int"
    parts = [rows[:120], rows[120:200], rows[200:]]
    s = batches(spark, parts, schema).withColumn("ts", F.timestamp_micros("us"))
    fired = lambda: keyed.delta_trigger(s, "car", "ts", "id", "speed", "step", 50, 10_000_000, cumulative=True)
    whole = sorted(map(str, run(spark, fired()).collect()))
    name, tries = f"restart{uuid.uuid4().hex[:8]}", []
    out = checkpoint_path(spark, f"out/{name}")

    def sink(batch, epoch):
        tries.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        if epoch == 1 and tries.count(1) == 1:
            raise RuntimeError("lost")

    for attempt in range(2):
        q = start(spark, fired().writeStream.foreachBatch(sink).option(
            "checkpointLocation", checkpoint_path(spark, f"ckpt/{name}")))
        if attempt == 0:
            with pytest.raises(Exception):
                q.awaitTermination()
        else:
            q.awaitTermination()
    assert tries == [0, 1, 1, 2]
    got = spark.read.parquet(out).drop("epoch")
    assert sorted(map(str, got.collect())) == whole


class FakeState:
    """A value and a map state, and the handle that makes them."""

    def __init__(self):
        self.held, self.timers = {}, []

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def registerTimer(self, due):
        self.timers.append(due)

    def exists(self):
        return None in self.held

    def get(self):
        return self.held.get(None)

    def update(self, value):
        self.held[None] = value

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_rules_are_looked_up_by_data_frames():
    """a share takes its rows as data frames; no Python object per rule and message."""
    mask, state = keyed.RuleMask("7"), FakeState()
    mask.init(state)

    def frame(*rows):
        return pd.DataFrame(rows, columns=["us", "timed", "seq", "known", "is_message", "text"])

    def masked(*frames):
        return [tuple(r) for d in mask.handleInputRows((0,), iter(frames), None) for r in d[["seq", "keyword"]].itertuples(index=False)]

    assert masked(frame((5, True, 1, True, True, "m"), (9, True, 2, True, False, "b")),
                  frame((9, True, 3, True, True, "m"), (6, True, 4, True, False, None), (6, True, 5, True, True, "m"),
                        (0, False, 6, True, True, "m"), (0, False, 7, True, False, "never"))) == [
        (1, "7"), (3, "b"), (5, "7"), (6, "7")]
    assert state.get() == (9, True, 2, "b")
    # an older rule changes nothing, a later one does
    assert masked(frame((8, True, 8, True, False, "old"), (8, True, 9, True, True, "m"), (12, True, 10, True, False, None),
                        (12, True, 11, True, True, "m"))) == [(9, "b"), (11, "7")]
    assert state.get() == (12, False, 10, "7")


def test_lateness_windows_take_data_frames():
    """windows that are not due take counts of data frames; only late rows come one by one, in order."""
    windows, state = keyed.LatenessWindows(10, 20), FakeState()
    windows.init(state)

    def given(mark, *frames):
        state.mark = mark - windows.behind
        frames = [pd.DataFrame(f, columns=["order", "seq", "known", "ms"]) for f in frames]
        return [tuple(r) for d in windows.handleInputRows(("k",), iter(frames), state)
                for r in d[["start", "kind", "n", "low", "high", "seq"]].itertuples(index=False)]

    assert given(1000, [(1, 1, True, 1001), (2, 2, True, 1012)], [(3, 3, True, 1004), (4, 4, True, 900)]) == []
    assert state.held == {(1000,): (2, 1001, 1004, False), (1010,): (1, 1012, 1012, False)}
    assert given(1009, [(7, 7, True, 1000), (5, 5, True, 1009)], [(6, 6, True, 1018)]) == [
        (1000, "on_time", 2, 1001, 1004, -1), (1000, "late", 3, 1001, 1009, 5), (1000, "late", 4, 1000, 1009, 7)]
    assert state.held == {(1000,): (4, 1000, 1009, True), (1010,): (2, 1012, 1018, False)}
    assert len(state.timers) == 4
