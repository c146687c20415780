import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from riverbend.operators.triggers import count_trigger, delta_trigger_max, purging_count_trigger
from riverbend.plans.skew import CHUNK, split_hot_keys
from riverbend.operators.windows import running_per_key
from riverbend.sources.tables import load


def _words(spark):
    data = [(w, i, i, 1) for i, w in enumerate(["a", "a", "a", "a", "a", "b", "b"])]
    return spark.createDataFrame(data, "word string, ord long, seq long, v int")


def test_count_trigger_golden(spark):
    out = count_trigger(_words(spark), "word", "ord", "seq", "v", 2)
    assert rows(out, "word", "n", "total") == [("a", 2, 2.0), ("a", 4, 4.0), ("b", 2, 2.0)]


def test_purging_count_trigger_golden(spark):
    out = purging_count_trigger(_words(spark), "word", "ord", "seq", "v", 2)
    assert rows(out, "word", "n", "total") == [("a", 2, 2.0), ("a", 2, 2.0), ("b", 2, 2.0)]


def test_running_hot_key_split_equals_single_pass(spark):
    ev = load(spark, SF_MID, "events")
    cols = ("event_type", "event_id", "_rn", "_run")
    whole = rows(running_per_key(ev, ["event_type"], "ts", ["event_id"], "value", 10**9, scale=2), *cols)
    split = rows(running_per_key(ev, ["event_type"], "ts", ["event_id"], "value", 37, scale=2), *cols)
    assert whole == split


def test_purge_totals_not_above_running(spark):
    ev = load(spark, SF_MID, "events")
    run = count_trigger(ev, "event_type", "ts", "event_id", "value", 2, rows_per_chunk=50) \
        .groupBy("event_type").agg(F.max("total").alias("t"))
    pur = purging_count_trigger(ev, "event_type", "ts", "event_id", "value", 2, rows_per_chunk=50) \
        .groupBy("event_type").agg(F.sum("total").alias("p"))
    for r in run.join(pur, "event_type").collect():
        assert r["p"] <= r["t"] + 1e-6


def test_top_speed_golden(spark):
    # (speed, distance m, ts s) of one car; threshold 50 m, evictor 10 s.
    data = [(0, 50, 0.0, 0), (0, 60, 40.0, 3), (0, 70, 51.0, 6), (0, 55, 101.0, 9),
            (0, 50, 102.0, 17)]
    df = spark.createDataFrame([(c, i, s, d, t) for i, (c, s, d, t) in enumerate(data)],
                               "car int, seq long, speed int, distance double, t long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    out = delta_trigger_max(df, "car", "ts", "seq", "speed", "distance", 50.0, 10_000_000)
    got = rows(out, "seq", "top", "top_id")
    assert got == [(2, 70.0, 2), (4, 55.0, 3)]


def _cars(spark):
    ev = load(spark, SF_MID, "events").select("user_id", "event_id", "ts", "value")
    # Few cars, so each is hot: key = user_id % 3.
    ev = ev.withColumn("car", (F.col("user_id") % 3).cast("int"))
    return running_per_key(ev, ["car"], "ts", ["event_id"], "value", scale=2) \
        .withColumnRenamed("_run", "distance").drop("_rn")


def test_top_speed_parallel_equals_sequential(spark):
    cars = _cars(spark)
    args = ("car", "ts", "event_id", "value", "distance", 50.0, 24 * 3600 * 1_000_000)
    seq = rows(delta_trigger_max(cars, *args), "car", "event_id", "top", "top_id", "top_ts")
    par = rows(delta_trigger_max(cars, *args, monotone=True, rows_per_chunk=97),
               "car", "event_id", "top", "top_id", "top_ts")
    assert seq == par and len(seq) > 1000


def test_top_speed_parallel_large_threshold_and_short_frame(spark):
    # Threshold spanning many rows: many candidates per chunk, chains merge.
    cars = _cars(spark)
    args = ("car", "ts", "event_id", "value", "distance", 2000.0, 3600 * 1_000_000)
    seq = rows(delta_trigger_max(cars, *args), "car", "event_id", "top", "top_id")
    par = rows(delta_trigger_max(cars, *args, monotone=True, rows_per_chunk=53),
               "car", "event_id", "top", "top_id")
    assert seq == par and len(seq) > 20


def test_count_trigger_counts_null_values(spark):
    data = [("a", 0, 0, 1), ("a", 1, 1, None), ("a", 2, 2, 1), ("a", 3, 3, None)]
    df = spark.createDataFrame(data, "word string, ord long, seq long, v int")
    out = count_trigger(df, "word", "ord", "seq", "v", 2)
    assert rows(out, "word", "n", "total", "fired_at") == [("a", 2, 1.0, 1), ("a", 4, 2.0, 3)]


def test_sums_keep_the_type_of_the_input(spark):
    df = spark.createDataFrame([("a", 0, 0, 0.004), ("a", 1, 1, 0.004)], "k string, o long, s long, v double")
    assert rows(count_trigger(df, "k", "o", "s", "v", 2), "total") == [(0.008,)]
    assert rows(purging_count_trigger(df, "k", "o", "s", "v", 2), "total") == [(0.008,)]


def test_split_keeps_the_carry_over_nulls(spark):
    """Nulls at the head, middle and tail of a chunk: split and unsplit totals agree."""
    values = [None if i in (0, 8, 9, 10, 11, 16, 17) else 1.0 for i in range(20)]
    df = spark.createDataFrame([("k", i, i, v) for i, v in enumerate(values)],
                               "key string, ts int, seq int, value double")
    whole, split = (sorted(tuple(r) for r in count_trigger(df, "key", "ts", "seq", "value", 2, n).collect())
                    for n in (10**9, 4))
    assert split == whole and whole[4][3] == 7.0


def _fold(cars, threshold):
    """Firing rows of a plain walk in order."""
    base, fired = {}, []
    for car, seq, dist in cars:
        if car not in base:
            base[car] = dist
        elif dist - base[car] > threshold:
            fired.append(seq)
            base[car] = dist
    return sorted(fired)


def test_top_speed_compares_doubles_and_keeps_null_cars(spark):
    """A walk of speed / 3.6 a step, with a car whose key is null and one above 2**53."""
    data, dist = [], {}
    for i, v in enumerate(r["value"] for r in load(spark, SF_MID, "events").orderBy("event_id")
                          .limit(6000).select("value").collect()):
        car = (None, 7, 2**53 + 1)[i % 3]
        dist[car] = dist.get(car, 0.0) + v / 3.6
        data.append((car, i, v, dist[car], i * 60))
    df = spark.createDataFrame(data, "car long, seq long, speed double, distance double, t long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    want = _fold([(c, s, d) for c, s, _, d, _ in data], 50.0)
    args = ("car", "ts", "seq", "speed", "distance", 50.0, 600 * 1_000_000)
    whole = rows(delta_trigger_max(df, *args), "seq", "top", "top_id")
    split = rows(delta_trigger_max(df, *args, monotone=True, rows_per_chunk=97), "seq", "top", "top_id")
    assert [r[0] for r in whole] == want and len(want) > 1000
    assert split == whole


def test_delta_trigger_threshold_as_the_type_computes_it(spark):
    df = spark.createDataFrame([(1, i, 1.0, d, i) for i, d in enumerate([0.0, 50.005, None, 100.011])],
                               "car int, seq long, speed double, distance double, t long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    args = ("car", "ts", "seq", "speed", "distance", 50.0, 10_000_000)
    for kw in ({}, {"monotone": True, "rows_per_chunk": 1}):
        assert rows(delta_trigger_max(df, *args, **kw), "seq") == [(1,), (3,)]


def _brute_delta(data, threshold, evict_s):
    """Row by row: firing row, and the largest (earliest of equal) measure of its frame."""
    cars, out = {}, []
    for car, seq, t, speed, dist in sorted(data, key=lambda r: (r[2], r[1])):
        cars.setdefault(car, []).append((seq, t, speed, dist))
    for car, found in cars.items():
        base = None
        for seq, t, _, dist in found:
            if dist is None:
                continue
            if base is not None and dist - base > threshold:
                frame = [(-math.inf if s is None else s, -u, -i) for i, u, s, _ in found if t - evict_s < u <= t]
                top = max(frame)
                out.append((str(car), seq, None if top[0] == -math.inf else top[0], -top[2]))
            if base is None or dist - base > threshold:
                base = dist
    return sorted(out, key=str)


@pytest.mark.parametrize("name,threshold,evict,step,ticks", [
    ("slow cars: a threshold spans many chunks", 150, 40, lambda r: r.choice([0, 1, 2]), [1, 2]),
    ("distances that fall", 6, 300, lambda r: r.randint(-9, 9), [0, 1, 30]),
    ("frames over all chunks, crowded instants", 3, 10**6, lambda r: r.choice([1, 2, None]), [0] * 30 + [5]),
    ("one instant", 10, 5, lambda r: r.randint(0, 3), [0]),
])
def test_delta_trigger_against_brute_force(spark, name, threshold, evict, step, ticks):
    rng = random.Random(name)
    data, t, dist = [], 0, {}
    for i in range(260):
        t += rng.choice(ticks)
        car = rng.choice([1, 1, 1, 1, 2, None])
        s = step(rng)
        dist[car] = dist.get(car, 0) + (s or 0)
        data.append((car, i, t, rng.choice([None, *map(float, range(40))]), None if s is None else dist[car]))
    df = spark.createDataFrame(data, "car long, seq long, t long, speed double, distance long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    want = _brute_delta(data, threshold, evict)
    args = ("car", "ts", "seq", "speed", "distance", threshold, evict * 1_000_000)
    for chunk in (10**6, 9):
        got = [(str(r["car"]), r["seq"], r["top"], r["top_id"]) for r in
               delta_trigger_max(df, *args, rows_per_chunk=chunk).collect()]
        assert sorted(got, key=str) == want and want


def test_an_instant_of_a_hot_key_is_cut(spark):
    """All rows of a key share one time: chunks are cut along the tie-break, results are equal."""
    df = spark.range(2000).select(F.lit("k").alias("k"), F.lit(5).alias("t"), F.col("id").alias("seq"), F.lit(1.0).alias("v"))
    df = df.unionByName(spark.range(900).select(F.lit("k").alias("k"), (F.col("id") % 9).cast("int").alias("t"),
                                                (F.col("id") + 5000).alias("seq"), F.lit(2.0).alias("v")))
    split = split_hot_keys(df, ["k"], "t", 100, tie="seq")
    sizes = split.df.groupBy(CHUNK).agg(F.count("*").alias("n"), F.min(F.struct("t", "seq")).alias("low"),
                                        F.max(F.struct("t", "seq")).alias("high")).orderBy(CHUNK).collect()
    assert max(r["n"] for r in sizes) <= 220 and sum(r["n"] for r in sizes) == 2900
    assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:]))  # numbers rise along (t, seq)
    for trigger in (count_trigger, purging_count_trigger):
        whole, cut = (rows(trigger(df, "k", "t", "seq", "v", 3, n), "n", "total", "fired_at") for n in (10**9, 100))
        assert whole == cut and len(whole) == 966


def test_frames_of_a_hot_key_are_read_once(spark):
    """no frame that slides over rows, which would read all rows of a day again for each row."""
    df = spark.createDataFrame([("k", i, i // 9, float(i % 40), 2 * i) for i in range(400)],
                               "car string, seq long, t long, speed double, distance long") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    args = ("car", "ts", "seq", "speed", "distance", 7, 20_000_000)
    got = delta_trigger_max(df, *args, rows_per_chunk=100)
    assert "specifiedwindowframe(RangeFrame, -" not in got._jdf.queryExecution().toString()
    assert rows(got, "seq", "top", "top_id") == rows(delta_trigger_max(df, *args), "seq", "top", "top_id")
