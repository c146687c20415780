"""Plug points: a user's source, table function and aggregate; windows by the clock."""

import random
import time
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from riverbend.functions.tables import TableFunction, apply_table, event_gaps
from riverbend.functions.text import try_parse_tuple_text
from riverbend.operators.aggregates import Aggregate, Count, Mean, user_aggregate
from riverbend.session import checkpoint_path
from riverbend.sources.feed import ParquetFeed, read_feed
from riverbend.sources.files import CAR_FIELDS, read_car_text, read_car_text_tolerant
from riverbend.sources.tables import load
from riverbend.streaming import twins
from riverbend.streaming.replay import replay_files, stream_folder


def test_gaps_of_a_hot_user(spark):
    rng = random.Random(1)
    data, t = [], 0
    for i in range(600):
        t += rng.choice([0, 0, 1, 5])
        data.append((rng.choice([1, 1, 1, 1, 2, None]), i, t))
    data.append((1, 1000, None))
    df = spark.createDataFrame(data, "user long, id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    want, last = [], {}
    for user, i, s in sorted((r for r in data if r[2] is not None), key=lambda r: (r[2], r[1])):
        want.append((str(user), i, None if user not in last else (s - last[user]) * 1_000_000))
        last[user] = s
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # state goes over batches
    try:
        for chunk in (10**6, 20):
            got = [(str(r["user"]), r["id"], r["gap_us"]) for r in event_gaps(df, "user", "ts", "id", chunk).collect()]
            assert sorted(got, key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def numbered():
    # made here, so that it travels to the workers by value
    class Numbered(TableFunction):
        def __init__(self):
            self.n = 0

        def rows(self, batch):
            self.n += batch.num_rows
            return [pa.array(range(self.n - batch.num_rows + 1, self.n + 1), pa.int64())]

    return Numbered


def test_table_function_takes_any_schema(spark):
    df = spark.range(50).selectExpr("id % 3 as k", "id", "array(id, 1) as a", "struct(id as x) as s", "date'2024-01-01' as d")
    out = apply_table(df, numbered(), ["k"], ["id"], "n bigint")
    assert out.columns == ["k", "id", "a", "s", "d", "n"]
    assert all(r["n"] == r["id"] // 3 + 1 and r["a"] == [r["id"], 1] for r in out.collect())
    assert apply_table(df.where("false"), numbered(), ["k"], ["id"], "n bigint").collect() == []


def span():
    # made here, so that it travels to the workers by value
    class Span(Aggregate):
        """Smallest and largest of two columns: an accumulator that starts empty."""

        state, result_type = "low bigint, high bigint", "bigint"

        def create(self):
            return None, None

        def add(self, acc, *columns):
            for c in columns:
                for v in c.drop_null().to_pylist():
                    acc = self.merge(acc, (v, v))
            return acc

        def merge(self, a, b):
            if None in a or None in b:
                return b if None in a else a
            return min(a[0], b[0]), max(a[1], b[1])

        def result(self, acc):
            return None if None in acc else acc[1] - acc[0]

    return Span


@pytest.mark.parametrize("max_keys", [100_000, 2])
def test_user_aggregates(spark, max_keys):
    rng = random.Random(2)
    data = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), rng.choice([1, None]), rng.choice([None, *range(99)]), i)
            for i in range(500)] + [("empty", 1, None, None)]
    df = spark.createDataFrame(data, "k string, j int, x long, y long").repartition(5)
    both = df.groupBy("k", "j")
    key = lambda r: tuple(map(str, r))
    same = lambda got, want: sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert same(user_aggregate(df, ["k", "j"], ["x"], Count(), "n", max_keys), both.agg(F.count("*")))
    assert same(user_aggregate(df, ["k", "j"], ["x"], Mean(), "m", max_keys), both.agg(F.avg("x")))
    want = both.agg(F.greatest(F.max("x"), F.max("y")) - F.least(F.min("x"), F.min("y")))
    assert same(user_aggregate(df, ["k", "j"], ["x", "y"], span()(), "s", max_keys), want)
    assert user_aggregate(df.where("false"), ["k"], ["x"], Mean(), "m").collect() == []


def test_tolerant_parse(spark, scratch):
    lines = ["(1,55,15.25,1000)", "(x,55,15.25,1000)", "", "(1,2)", "(1,2,3,4,5)", "1", "(1,2,null,4)", "(9999999999,1,1,1)"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/t")
    good, bad = read_car_text_tolerant(spark, f"{scratch}/t")
    assert rows(good) == [(1, 2, 3.0, 4), (1, 55, 15.25, 1000)]
    assert sorted(r[0] for r in bad.collect()) == sorted(set(lines) - {lines[0], lines[4]})
    with pytest.raises(Exception):
        read_car_text(spark, f"{scratch}/t").collect()
    null = spark.range(1).select(try_parse_tuple_text(F.lit(None).cast("string"), CAR_FIELDS).alias("t"))
    assert null.first()["t"] is None


def feed_query(spark, folder, name, sink, **options):
    s = read_feed(spark, ParquetFeed, "id bigint, word string", path=folder, **options)
    return s.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_path(spark, f"ckpt/{name}")).start()


@pytest.mark.parametrize("bounded", [False, True])
def test_feed_survives_failures_and_grows(spark, scratch, bounded):
    """A failed micro-batch is read again, a restarted query goes on, added files are seen: no loss, no repeats."""
    folder, name, tries = f"{scratch}/feed", uuid.uuid4().hex[:8], []
    out = f"{scratch}/out"
    options = {"rowsPerBatch": 30, "progress": f"{scratch}/at.json", "rowsPerPartition": 7} if bounded else {}
    table = lambda a, b: pa.table({"word": [f"w{i}" for i in range(a, b)], "id": list(range(a, b)), "other": [0] * (b - a)})
    import os
    import pyarrow.parquet as pq
    os.mkdir(folder)
    pq.write_table(table(0, 50), f"{folder}/a.parquet", row_group_size=11)
    pq.write_table(table(50, 70), f"{folder}/b.parquet")

    def sink(batch, epoch):
        tries.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        if epoch == (1 if bounded else 0) and tries.count(epoch) == 1:
            raise RuntimeError("lost")

    q = feed_query(spark, folder, name, sink, **options)
    with pytest.raises(Exception):
        q.processAllAvailable()
    for more in (None, (70, 95), None):
        if more:
            pq.write_table(table(*more), f"{folder}/c.parquet", row_group_size=4)
        q = feed_query(spark, folder, name, sink, **options)
        q.processAllAvailable()
        q.stop()
    got = spark.read.parquet(out).collect()
    assert sorted((r["id"], r["word"]) for r in got) == [(i, f"w{i}") for i in range(95)]
    if bounded:
        sizes = spark.read.parquet(out).groupBy("epoch").count().collect()
        assert len(sizes) >= 4
    with pytest.raises(Exception):
        feed_query(spark, folder, name + "x", sink, rowsPerBatch=5).processAllAvailable()


def test_windows_by_the_clock_survive_a_retry(spark):
    ev = load(spark, SF_SMALL, "events")
    replay = replay_files(ev, "event_id", 3, "clock")
    name, seen, tries = uuid.uuid4().hex[:8], {}, []
    out = checkpoint_path(spark, f"out/{name}")

    def sink(batch, epoch):
        tries.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
        found = rows(batch, "event_type", "window_start", "window_end", "count")
        if tries.count(epoch) == 2:
            assert found == seen[epoch]  # the same windows, seconds later
        seen[epoch] = found
        if epoch == 1 and tries.count(1) == 1:
            raise RuntimeError("lost")

    for attempt in range(2):
        counts = twins.arrival_counts(stream_folder(spark, replay, ev.schema), ["event_type"], "100 milliseconds")
        q = (counts.writeStream.foreachBatch(sink).outputMode("update")
             .option("checkpointLocation", checkpoint_path(spark, f"ckpt/{name}")).trigger(availableNow=True).start())
        if attempt == 0:
            with pytest.raises(Exception):
                q.awaitTermination()
            time.sleep(1.5)
        else:
            q.awaitTermination()
    assert tries[:3] == [0, 1, 1]
    last = twins.last_firings(spark.read.parquet(out), ["event_type", "window_start", "window_end"], ["count"])
    assert rows(last.groupBy("event_type").agg(F.sum("count").alias("n"))) == rows(ev.groupBy("event_type").count())
    assert last.select("window_start").distinct().count() >= 3
