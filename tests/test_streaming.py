"""Streaming twins replayed over ordered file batches equal their batch twins."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from riverbend.operators.lookup import latest_rule_asof, mask_messages
from riverbend.operators.topn import hot_items
from riverbend.operators.triggers import count_trigger, purging_count_trigger
from riverbend.operators.windows import session_windows, sliding_counts, window_summary
from riverbend.session import checkpoint_path
from riverbend.sources.tables import load
from riverbend.streaming import replay as replay_module
from riverbend.streaming import twins
from riverbend.streaming.replay import flush_rows, replay_batches, replay_files, stream_folder

FLUSH_KEY = "__flush__"


@pytest.fixture(scope="module")
def replay(spark):
    ev = load(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    flush = [flush_rows(ev, "ts", {"event_type": FLUSH_KEY, "user_id": -1, "event_id": 10**12 + i,
                                   "props": '{"k": -1}', "value": 0.0}, years=100 + i)
             for i in range(2)]
    root = replay_files(ev, "event_id", 4, "events", flush)
    return root, ev.schema


def _stream(spark, replay):
    root, schema = replay
    return stream_folder(spark, root, schema)


def _run_memory(spark, sdf, mode="append"):
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = (sdf.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint_path(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def _run_foreach(spark, sdf, fn):
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = (sdf.writeStream.foreachBatch(fn).outputMode("append")
         .option("checkpointLocation", checkpoint_path(spark, name))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _batch_events(spark):
    return load(spark, SF_SMALL, "events")


def test_stream_tumbling_equals_batch(spark, replay):
    out = _run_memory(spark, twins.tumbling_counts(_stream(spark, replay), ["event_type"], "ts",
                                                   "10 minutes"))
    got = rows(out.where(F.col("event_type") != FLUSH_KEY),
               "event_type", "window_start", "window_end", "count")
    want = rows(window_summary(_batch_events(spark), ["event_type"], "ts", 600),
                "event_type", "window_start", "window_end", "n")
    assert got == want and len(got) > 100


def test_stream_hot_items_equals_batch(spark, replay, scratch):
    counts = twins.sliding_item_counts(
        _stream(spark, replay).select(
            F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts",
            "event_type"),
        "item_id", "ts", "60 minutes", "5 minutes", keep="event_type = 'view'")
    out = os.path.join(scratch, "hot")
    _run_foreach(spark, counts, twins.hot_items_sink(out, 3))
    got = rows(spark.read.parquet(out).where("item_id <> -1"),
               "window_end", "rank", "item_id", "view_count")
    ev = _batch_events(spark).where("event_type = 'view'").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts")
    want = rows(hot_items(sliding_counts(ev, "item_id", "ts", 3600, 300), 3),
                "window_end", "rank", "item_id", "view_count")
    assert got == want and len(got) > 100


def test_stream_sessions_equal_batch(spark, replay):
    out = _run_memory(spark, twins.sessions(_stream(spark, replay), "user_id", "ts",
                                            "30 minutes", "value", scale=2))
    got = rows(out.where("user_id <> -1"), "user_id", "first_ts", "session_end", "n", "total")
    want = rows(session_windows(_batch_events(spark), "user_id", "ts", 30 * 60 * 1_000_000,
                                "value", scale=2), "user_id", "first_ts", "session_end", "n", "total")
    assert got == want and len(got) > 100


def _run_count_trigger(spark, sdf, *cols, purge=False, every=2):
    out = checkpoint_path(spark, f"t_{uuid.uuid4().hex[:8]}")
    _run_foreach(spark, sdf, twins.count_trigger_sink(out, f"{out}-carry", *cols, every, purge))
    return spark.read.parquet(out)


@pytest.mark.parametrize("purge", [False, True])
@pytest.mark.parametrize("every", [2, 7])
def test_stream_count_trigger_equals_batch(spark, replay, purge, every):
    cols = ("event_type", "ts", "event_id", "value")
    out = _run_count_trigger(spark, _stream(spark, replay).where(F.col("event_type") != FLUSH_KEY),
                             *cols, purge=purge, every=every)
    batch = (purging_count_trigger if purge else count_trigger)(_batch_events(spark), *cols, every)
    assert rows(out, "event_type", "n", "fired_at") == rows(batch, "event_type", "n", "fired_at")
    assert [x[0] for x in rows(out, "total")] == pytest.approx([x[0] for x in rows(batch, "total")])


@pytest.mark.parametrize("purge", [False, True])
@pytest.mark.parametrize("split", [None, "3"])
def test_stream_count_trigger_with_nulls_equals_batch(spark, purge, split):
    """Null values, a null key, a key of nulls alone, and keys cut in chunks of three rows."""
    data = [("a", i, i, None if i % 3 == 0 else float(i)) for i in range(1, 22)] + \
        [("b", i, i, None) for i in range(1, 4)] + [(None, i, i, float(i)) for i in range(2, 15)]
    df = spark.createDataFrame(data, "k string, o long, s long, v double")
    root = replay_files(df, "o", 3, "nulls")
    if split:
        spark.conf.set("riverbend.scan.rowsPerChunk", split)
    try:
        out = _run_count_trigger(spark, stream_folder(spark, root, df.schema), "k", "o", "s", "v", purge=purge)
    finally:
        spark.conf.unset("riverbend.scan.rowsPerChunk")
    op = purging_count_trigger if purge else count_trigger
    none_first = lambda d: sorted(map(str, d.select("k", "n", "total", "fired_at").collect()))
    assert none_first(out) == none_first(op(df, "k", "o", "s", "v", 2))


def test_rules_that_change_while_the_stream_runs(spark, scratch):
    """Rules appended between micro-batches, two of them of one time: as the batch lookup."""
    rules = [(i, 10 * i, f"w{i}") for i in range(1, 8)] + [(99, 40, "tie")]
    messages = [(1000 + t, t, "w1 w2 w3 w4 w5 w6 w7 tie") for t in range(5, 80, 3)]

    def table(data, text):
        return spark.createDataFrame(data, f"id long, s long, {text} string").select(
            "id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), text)

    source, rule_path, out = (os.path.join(scratch, n) for n in ("in", "rules", "out"))
    os.makedirs(source)
    schema = table(messages, "body").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    sink = twins.keyword_mask_sink(rule_path, out, "ts", "body", "w7", "id")
    for low, high in ((0, 30), (30, 55), (55, 99)):
        table([r for r in rules if low <= r[1] < high], "keyword").write.mode("append").parquet(rule_path)
        table([m for m in messages if low <= m[1] < high], "body").coalesce(1).write.mode("append").parquet(source)
        q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(scratch, "ckpt"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    want = mask_messages(latest_rule_asof(table(messages, "body"), table(rules, "keyword"), "ts", "keyword",
                                          "w7", "id"), "body", "keyword")
    got = spark.read.parquet(out)
    assert got.select("epoch").distinct().count() == 3
    assert rows(got, "id", "masked") == rows(want, "id", "masked")


def test_stream_fan_out_writes_both_branches(spark, scratch):
    from riverbend.functions.text import NON_WORD, tokenize
    from riverbend.operators.routing import side_output
    from riverbend.sinks import fan_out_stream

    docs = load(spark, SF_SMALL, "documents").select("doc_id", "text")
    root = replay_files(docs, "doc_id", 3, "docs")
    toks = tokenize(stream_folder(spark, root, docs.schema), "text", NON_WORD, lower=True,
                    keep=["doc_id"])
    paths = {"main": os.path.join(scratch, "main"), "rejected": os.path.join(scratch, "rej")}

    def writer(path):
        return lambda d, epoch: d.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    sink = fan_out_stream({"main": lambda d: side_output(d, "word")[0],
                           "rejected": lambda d: side_output(d, "word")[1]},
                          {k: writer(p) for k, p in paths.items()})
    _run_foreach(spark, toks, sink)
    main, rejected = side_output(tokenize(docs, "text", NON_WORD, lower=True, keep=["doc_id"]),
                                 "word")
    # Output is keyed by epoch (path/epoch=<id>): compare the branch columns.
    assert rows(spark.read.parquet(paths["main"]), "doc_id", "word") == rows(main)
    assert rows(spark.read.parquet(paths["rejected"]), "doc_id", "word") == rows(rejected)


def test_replay_of_many_files_a_range_equals_batch(spark, monkeypatch):
    from riverbend.streaming import replay as module

    monkeypatch.setattr(module, "ROWS_PER_FILE", 50)
    ev = _batch_events(spark).withColumn("ts", F.col("ts").cast("timestamp"))
    flush = [flush_rows(ev, "ts", {"event_type": FLUSH_KEY, "event_id": 10**15})]
    replayed = replay_files(ev, "event_id", 4, "many", flush)
    assert replayed.files > 1
    out = _run_memory(spark, twins.tumbling_counts(stream_folder(spark, replayed, ev.schema),
                                                   ["event_type"], "ts", "10 minutes"))
    got = rows(out.where(F.col("event_type") != FLUSH_KEY),
               "event_type", "window_start", "window_end", "count")
    want = rows(window_summary(_batch_events(spark), ["event_type"], "ts", 600),
                "event_type", "window_start", "window_end", "n")
    assert got == want


def test_replay_keeps_rows_without_order(spark):
    df = spark.createDataFrame([(k, f"r{k}") for k in range(40)] + [(None, "a"), (None, "b")], "o long, v string")
    read = lambda r, cols: spark.read.option("recursiveFileLookup", "true").schema(cols).parquet(r.root)
    for ranges in (1, 4):
        assert rows(read(replay_files(df, "o", ranges, "nullorder"), df.schema), "v") == rows(df, "v")
    numbered = df.withColumn("batch", (F.col("o") / 20).cast("int"))
    assert rows(read(replay_batches(numbered, "batch", 2, "nullbatch"), df.schema), "v") == rows(df, "v")


def test_text_bounds_the_ranges_of_a_replay(spark, monkeypatch):
    """F2: more text gives more micro-batches, in order, each row once; one pass deals the rows."""
    monkeypatch.setattr(replay_module, "TEXT_PER_BATCH", 1000)
    df = spark.createDataFrame([(None, "n" * 50)] + [(i % 90, "x" * 100) for i in range(100)], "id long, text string")
    got = replay_files(df, "id", 4, "bounded", least_files=2, text="text")
    parts = sorted(os.listdir(got.root))
    assert len(parts) == 11 and got.files == 2
    held = [[r["id"] for r in spark.read.schema(df.schema).parquet(os.path.join(got.root, p)).collect()] for p in parts]
    assert sorted((x for p in held for x in p), key=str) == sorted((r["id"] for r in df.collect()), key=str)
    assert None in held[0]
    ends = [(min(x for x in p if x is not None), max(x for x in p if x is not None)) for p in held]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
