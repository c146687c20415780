"""Registered streaming queries: each replays a driver table as an ordered
file stream (plus flush rows), runs the streaming twin to completion with
``availableNow`` into a file sink (exactly-once), and returns the sink's
content with the flush key removed. Their oracles are the batch twins' SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import NON_WORD, WHITESPACE_ONE, text_lines, tokenize
from ..functions.time import to_epoch_millis, to_event_time
from ..operators.lookup import mask_messages
from ..operators.routing import connect_flat, even_odd_selector, select_tags, tag_rows
from ..session import checkpoint_path
from ..sources.feed import ParquetFeed, read_feed
from ..sources.inline import timestamped_events
from ..sources.tables import load, table_path
from .queries import DEFAULT_KEYWORD, SPEED_EVICT_US, SPEED_THRESHOLD
from ..streaming import keyed, twins
from ..streaming.replay import flush_rows, replay_batches, replay_files, stream_folder

FLUSH_KEY = "__flush__"
VALUE_SCALE = 2  # events.value holds two decimals
REPLAY_FILES = 4
# One far-future flush file: after it, Spark runs a no-data batch with the
# advanced watermark, which closes every remaining window.
FLUSH_FILES = 1
STATE_PARTITIONS_CONF = "riverbend.stream.statePartitions"
# Late data: every 13th event arrives 3/8 of the table later, in eight micro-batches.
LATE_EVERY, LATE_BATCHES, LATE_HOP = 13, 8, 3
HOUR_MS = 3_600_000
FEED_ROWS = 40_000  # of a micro-batch of the custom source
LATE_WINDOW, LATE_DELAY, LATENESS = "1 hour", "2 hours", "1 day"


def _event_stream(spark: SparkSession, sf: str, flushed: bool = True) -> DataFrame:
    ev = load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    flush = [flush_rows(ev, "ts", {"event_type": FLUSH_KEY, "user_id": -1,
                                   "event_id": 10**15 + i, "props": '{"k": -1}', "value": 0.0},
                        years=100 + i) for i in range(FLUSH_FILES)] if flushed else []
    root = replay_files(ev, "event_id", REPLAY_FILES, "events", flush)
    return stream_folder(spark, root, ev.schema)


def _start(spark: SparkSession, writer):
    """Start a new stream. Its checkpoint fixes the number of state partitions for good: the
    one of ``riverbend.stream.statePartitions`` if set, else ``spark.sql.shuffle.partitions``."""
    wanted = spark.conf.get(STATE_PARTITIONS_CONF, None)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if wanted:
        spark.conf.set(key, wanted)
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


def _stateful(spark: SparkSession, sdf: DataFrame, name: str) -> DataFrame:
    """``_to_files`` for a stream of ``streaming.keyed``."""
    with keyed.with_rocksdb(spark):
        return _to_files(spark, sdf, name)


def _to_files(spark: SparkSession, sdf: DataFrame, name: str) -> DataFrame:
    run = f"{name}-{uuid.uuid4().hex[:8]}"
    out = checkpoint_path(spark, f"sinks/{run}")
    q = _start(spark, sdf.writeStream.format("parquet").outputMode("append")
               .option("path", out)
               .option("checkpointLocation", checkpoint_path(spark, f"ckpt/{run}")))
    q.awaitTermination()
    return spark.read.parquet(out)


def _foreach(spark: SparkSession, sdf: DataFrame, name: str, make_sink,
             mode: str = "append") -> DataFrame:
    run = f"{name}-{uuid.uuid4().hex[:8]}"
    out = checkpoint_path(spark, f"sinks/{run}")
    q = _start(spark, sdf.writeStream.foreachBatch(make_sink(out)).outputMode(mode)
               .option("checkpointLocation", checkpoint_path(spark, f"ckpt/{run}")))
    q.awaitTermination()
    return spark.read.parquet(out)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def stream_window_counts(spark, sf):
    s = _event_stream(spark, sf)
    out = _to_files(spark, twins.tumbling_counts(s, ["event_type"], "ts", "10 minutes"),
                    "window_counts")
    return _ntz(out.where(F.col("event_type") != FLUSH_KEY), "window_start", "window_end")


def stream_hot_items(spark, sf):
    s = _event_stream(spark, sf).select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts", "event_type")
    counts = twins.sliding_item_counts(s, "item_id", "ts", "60 minutes", "5 minutes",
                                       keep="event_type = 'view'")
    out = _foreach(spark, counts, "hot_items", lambda p: twins.hot_items_sink(p, 3))
    return _ntz(out.where("item_id <> -1").select("window_end", "rank", "item_id",
                                                  "view_count"), "window_end")


def stream_sessions(spark, sf):
    s = _event_stream(spark, sf)
    out = _to_files(spark, twins.sessions(s, "user_id", "ts", "30 minutes", "value",
                                         scale=VALUE_SCALE), "sessions")
    return _ntz(out.where("user_id <> -1"), "first_ts", "session_end")


def _count_trigger(spark, sf, name, purge):
    s = _event_stream(spark, sf).where(F.col("event_type") != FLUSH_KEY)
    out = _foreach(spark, s, name, lambda p: twins.count_trigger_sink(
        p, f"{p}-carry", "event_type", "ts", "event_id", "value", 2, purge, VALUE_SCALE))
    return out.select("event_type", "n", "total", "fired_at")


def stream_count_trigger(spark, sf):
    return _count_trigger(spark, sf, "count_trigger", False)


def stream_count_trigger_purged(spark, sf):
    return _count_trigger(spark, sf, "count_trigger_purged", True)


def _late_stream(spark: SparkSession, sf: str, flush: bool) -> DataFrame:
    """Events (type and epoch millis) in an arrival order with late rows, cut into
    ``LATE_BATCHES`` micro-batches of equal stretches of it."""
    ev = load(spark, sf, "events").select("event_id", "event_type", to_epoch_millis("ts").alias("ms"))
    total = (ev.agg(F.max("event_id")).first()[0] or 0) + 1
    hop = total * LATE_HOP // LATE_BATCHES
    arrival = F.col("event_id") + F.when(F.col("event_id") % LATE_EVERY == 0, F.lit(hop)).otherwise(F.lit(0))
    batch = F.floor(arrival * LATE_BATCHES / F.lit(total + hop)).cast("int")
    ev = ev.withColumn("batch", F.greatest(batch, F.lit(0)))  # ids below 0 come with the first
    last = [ev.agg(F.max("ms").alias("ms")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(FLUSH_KEY).alias("event_type"),
        (F.col("ms") + F.lit(365 * 100 * 86_400_000)).alias("ms"))] if flush else []
    return stream_folder(spark, replay_batches(ev, "batch", LATE_BATCHES, "late", last), ev.drop("batch").schema)


def stream_late_drop(spark, sf):
    """Hourly counts with a watermark two hours behind; later rows are dropped."""
    s = timestamped_events(_late_stream(spark, sf, flush=True), "ms", "ts", LATE_DELAY)
    out = _to_files(spark, twins.tumbling_counts(s, ["event_type"], "ts", LATE_WINDOW, None), "late_drop")
    return out.where(F.col("event_type") != FLUSH_KEY)


def stream_window_summary_late(spark, sf):
    """L4: hourly summaries that fire again for rows up to a day late; the last firing counts."""
    s = timestamped_events(_late_stream(spark, sf, flush=False), "ms", "ts")
    s = s.withColumn("ts", to_event_time("ts"))
    out = _foreach(spark, twins.window_summaries(s, ["event_type"], "ts", LATE_WINDOW, LATE_DELAY, LATENESS),
                   "window_summary_late", twins.epoch_sink, "update")
    return twins.last_firings(out, ["event_type", "window_start", "window_end"], ["n", "first_ts", "last_ts"])


def stream_lateness_firings(spark, sf):
    """Hourly windows that fire on time and again for each row up to a day late. Spark's
    watermark moves between micro-batches; the SQL states that rule."""
    s = _late_stream(spark, sf, flush=True).withColumn("ts", F.timestamp_millis("ms"))
    out = _stateful(spark, keyed.lateness_firings(s, "event_type", "ts", "event_id", "event_id", HOUR_MS, 2 * HOUR_MS,
                                                  24 * HOUR_MS), "lateness_firings")
    return _ntz(out, "window_start", "window_end", "first_ts", "last_ts").where(F.col("event_type") != FLUSH_KEY)


def stream_top_speed(spark, sf):
    """W8 + A5: the distance is the running sum of a car's speeds, kept in its state."""
    s = _event_stream(spark, sf, flushed=False).withColumn("step", F.col("value").cast(f"decimal(18,{VALUE_SCALE})"))
    out = _stateful(spark, keyed.delta_trigger(s, "user_id", "ts", "event_id", "value", "step", SPEED_THRESHOLD,
                                               SPEED_EVICT_US, cumulative=True), "top_speed")
    return _ntz(out, "top_ts")


def stream_rule_updates(spark, sf):
    """One stream of messages and of rules that arrive between them."""
    ev = _event_stream(spark, sf, flushed=False)
    rule = F.col("event_type") == "signup"
    rules = ev.where(rule).withColumn("keyword", F.get_json_object("props", "$.k"))
    # Every rule goes to every share, and a fifth of these events are rules: one share a core.
    out = _stateful(spark, keyed.masked_by_rules(ev.where(~rule), rules, "ts", "event_id", "props", "keyword",
                                                 DEFAULT_KEYWORD, spark.sparkContext.defaultParallelism), "rule_updates")
    return mask_messages(out, "props", "keyword").select("event_id", "masked")


def stream_arrival_windows(spark, sf):
    """Rows in windows of the clock. Which ones depends on the clock; together they hold every
    row once, which is what the query returns."""
    s = _event_stream(spark, sf, flushed=False)
    out = _foreach(spark, twins.arrival_counts(s, ["event_type"], "1 second"), "arrival", twins.epoch_sink, "update")
    last = twins.last_firings(out, ["event_type", "window_start", "window_end"], ["count"])
    return last.groupBy("event_type").agg(F.sum("count").alias("n"))


def source_custom_stream(spark, sf):
    """The events through a source of our own, in micro-batches of its making."""
    run = f"feed-{uuid.uuid4().hex[:8]}"
    schema = load(spark, sf, "events").select("event_id", "event_type", "ts", "value").schema
    rows = read_feed(spark, ParquetFeed, schema, path=table_path(sf, "events"), rowsPerBatch=FEED_ROWS,
                     progress=checkpoint_path(spark, f"{run}.json"), rowsPerPartition=FEED_ROWS // 4)
    out = checkpoint_path(spark, f"sinks/{run}")
    q = (rows.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint_path(spark, f"ckpt/{run}")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(schema).parquet(out)


def _order_stream(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey")
    return stream_folder(spark, replay_files(orders, "o_orderkey", REPLAY_FILES, "orders"), orders.schema)


def stream_split_all(spark, sf):
    """P8-P10 on a stream."""
    tagged = tag_rows(_order_stream(spark, sf), even_odd_selector("o_orderkey"))
    return _to_files(spark, select_tags(tagged, "even", "odd").select(
        "o_orderkey", F.array_join("tags", ",").alias("tags")), "split_all")


def stream_connect(spark, sf):
    """J1 on two streams."""
    docs = load(spark, sf, "documents").select("doc_id", "text")
    texts = stream_folder(spark, replay_files(docs, "doc_id", REPLAY_FILES, "texts",
                                                     least_files=spark.sparkContext.defaultParallelism), docs.schema)
    return _to_files(spark, connect_flat(_order_stream(spark, sf), "o_orderkey",
                                         text_lines(texts, "text"), "line"), "connect")


def stream_keyword_mask(spark, sf):
    ev = load(spark, sf, "events")
    rules_path = checkpoint_path(spark, f"rules/{uuid.uuid4().hex[:8]}")
    ev.where(F.col("event_type") == "signup").select(
        "event_id", "ts", F.get_json_object("props", "$.k").alias("keyword")).write.parquet(rules_path)
    s = _event_stream(spark, sf).where(
        (F.col("event_type") != "signup") & (F.col("event_type") != FLUSH_KEY)) \
        .select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "props")
    out = _foreach(spark, s, "keyword_mask",
                   lambda p: twins.keyword_mask_sink(rules_path, p, "ts", "props", "7",
                                                     "event_id"))
    return out.select("event_id", "masked")


def _document_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Documents replayed in ``doc_id`` order with their ingestion time
    (2024-01-01 + doc_id seconds) as event time, plus flush rows."""
    docs = load(spark, sf, "documents").select(
        "doc_id", "text",
        F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
                            + F.col("doc_id")).alias("ingest_ts"))
    flush = [flush_rows(docs, "ingest_ts", {"doc_id": -1 - i, "text": FLUSH_KEY}, years=100 + i)
             for i in range(FLUSH_FILES)]
    root = replay_files(docs, "doc_id", REPLAY_FILES, "documents", flush, spark.sparkContext.defaultParallelism, "text")
    return stream_folder(spark, root, docs.schema)


def stream_tumbling_word_count(spark, sf):
    lines = text_lines(_document_stream(spark, sf), "text")
    toks = tokenize(lines, "line", WHITESPACE_ONE, keep=["doc_id", "ingest_ts"])
    out = _to_files(spark, twins.tumbling_counts(toks, ["word"], "ingest_ts", "5 seconds"),
                    "tumbling_word_count")
    return _ntz(out.where(F.col("word") != FLUSH_KEY), "window_start", "window_end")


def stream_side_output_main(spark, sf):
    docs = _document_stream(spark, sf)
    toks = tokenize(docs, "text", NON_WORD, lower=True, drop_empty=True,
                    keep=["doc_id", "ingest_ts"])
    main, _ = twins.side_outputs(toks, "ingest_ts")
    out = _to_files(spark, main, "side_output_main")
    # The flush text tokenizes to "__flush__" (kept in the plan, dropped here).
    return _ntz(out.where(F.col("word") != FLUSH_KEY.lower()), "window_start", "window_end") \
        .select("word", "window_start", "window_end", "count")


def stream_side_output_rejected(spark, sf):
    docs = _document_stream(spark, sf)
    toks = tokenize(docs, "text", NON_WORD, lower=True, drop_empty=True,
                    keep=["doc_id", "ingest_ts"])
    _, rejected = twins.side_outputs(toks, "ingest_ts")
    out = _to_files(spark, rejected.select("doc_id", F.col("word").alias("value")),
                    "side_output_rejected")
    return out.where(F.col("doc_id") >= 0)


STREAM_QUERIES = {
    "stream_window_counts": stream_window_counts,
    "stream_hot_items": stream_hot_items,
    "stream_sessions": stream_sessions,
    "stream_count_trigger": stream_count_trigger,
    "stream_count_trigger_purged": stream_count_trigger_purged,
    "stream_keyword_mask": stream_keyword_mask,
    "stream_tumbling_word_count": stream_tumbling_word_count,
    "stream_side_output_main": stream_side_output_main,
    "stream_side_output_rejected": stream_side_output_rejected,
    "stream_late_drop": stream_late_drop,
    "stream_window_summary_late": stream_window_summary_late,
    "stream_split_all": stream_split_all,
    "stream_connect": stream_connect,
    "stream_top_speed": stream_top_speed,
    "stream_lateness_firings": stream_lateness_firings,
    "stream_rule_updates": stream_rule_updates,
    "stream_arrival_windows": stream_arrival_windows,
    "source_custom_stream": source_custom_stream,
}

__all__ = ["STATE_PARTITIONS_CONF", "STREAM_QUERIES"]
