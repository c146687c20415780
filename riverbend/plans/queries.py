"""The registered queries: every operator of the inventory applied to the
driver's tables. Each function takes ``(spark, sf_dir)`` and returns a lazy
DataFrame whose column names match the DuckDB oracle in ``oracle.py``.

How the reference's inputs map onto the tables:

* text streams (word counts, tokenizers, side outputs, connect) read
  ``documents.text``; line-based jobs see one record per line;
* ingestion time of a document = 2024-01-01 + ``doc_id`` seconds;
* user behaviour = ``events``: ``view`` plays ``pv``, the item is
  ``props.k``; keyed jobs key by ``user_id`` or ``event_type``;
* cars = ``events``: car = ``user_id``, speed = ``value``, distance = running
  sum of ``value``;
* arrival order for the watermark replay = ``event_id + (event_id*7919) % 50``
  (a bounded shuffle of the event order);
* keyword rules = ``signup`` events (keyword = ``props.k``), messages = the
  other events.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (NON_WORD, WHITESPACE_ONE, WHITESPACE_RUN, format_tuple,
                              parse_tuple_text, text_lines, tokenize)
from ..functions.tables import event_gaps
from ..functions.time import to_epoch_millis, to_epoch_seconds, from_epoch_seconds
from ..operators.aggregates import Mean, user_aggregate
from ..operators.lateness import final_window_summary, lateness_firings, lateness_status
from ..operators.lookup import (latest_rule_asof, mask_messages, read_cached_text,
                                with_cached_text)
from ..operators.routing import connect_flat, even_odd_selector, select_tags, side_output, tag_rows
from ..operators.topn import hot_items as top_items
from ..operators.triggers import count_trigger, delta_trigger_max, purging_count_trigger
from ..operators.windows import (US, add_tumbling_window, grouped_sum, grouped_within, running_per_key,
                                 session_windows, sliding_counts, summary_lines, tumbling_sum,
                                 window_summary)
from ..session import checkpoint_path
from ..sources.files import CAR_FIELDS
from ..sources.tables import load
from .io_queries import IO_QUERIES
from .skew import ROWS_PER_CHUNK_CONF

# Fixed parameters of the reference jobs, and the stand-ins chosen for the
# event table (whose rows are minutes, not milliseconds, apart).
HOT_WINDOW_S, HOT_SLIDE_S, HOT_TOP_N = 3600, 300, 3
SIDE_WINDOW_S, SIDE_MAX_LEN = 5, 5
WORD_WINDOW_S = 5
SESSION_GAP_US = 30 * 60 * US
COUNT_EVERY = 2
SPEED_THRESHOLD, SPEED_EVICT_US = 50.0, 24 * 3600 * US
LATE_WINDOW_US, LATE_DELAY_US, LATE_LATENESS_US = 3600 * US, 2 * 3600 * US, 3600 * US
SUMMARY_WINDOW_S = 600
DEFAULT_KEYWORD = "7"
CHUNKED_ROWS = 1_000
VALUE_SCALE = 2  # events.value holds two decimals
INGEST_EPOCH = "2024-01-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _views(spark, sf):
    ev = load(spark, sf, "events")
    return ev.where(F.col("event_type") == "view").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts")


def _ingest_ts(doc_id: str = "doc_id"):
    return F.timestamp_seconds(F.unix_seconds(F.lit(INGEST_EPOCH).cast("timestamp"))
                               + F.col(doc_id)).cast("timestamp_ntz")


def _documents(spark, sf):
    return load(spark, sf, "documents").select("doc_id", "text")


def _doc_lines(spark, sf):
    return text_lines(_documents(spark, sf), "text")


def _arrival():
    return F.col("event_id") + (F.col("event_id") * 7919) % 50


def _late_rows(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "event_type", "ts") \
        .withColumn("arrival", _arrival())
    return lateness_status(ev, "ts", "arrival", "event_id", LATE_WINDOW_US, LATE_DELAY_US,
                           LATE_LATENESS_US)


# --- hot items (S4 P5 L8 W4 A3 A4 T1) -----------------------------------

def window_item_counts(spark, sf):
    return sliding_counts(_views(spark, sf), "item_id", "ts", HOT_WINDOW_S, HOT_SLIDE_S)


def hot_items(spark, sf):
    return top_items(window_item_counts(spark, sf), HOT_TOP_N)


def filter_eq(spark, sf):
    ev = load(spark, sf, "events")
    return ev.where(F.col("event_type") == "view").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("item_id"))


def epoch_seconds(spark, sf):
    ev = load(spark, sf, "events").select("event_id", "ts")
    secs = to_epoch_seconds("ts")
    return ev.select("event_id", secs.alias("epoch_s"),
                     from_epoch_seconds(secs).alias("event_second"),
                     (secs * 1000).alias("epoch_ms"))


# --- word counts, tokenizers, side output (P1-P4 P6 P11 A1 W1 W2) --------

def word_count(spark, sf):
    docs = _documents(spark, sf).select("text")
    return grouped_sum(tokenize(docs, "text", NON_WORD, lower=True, drop_empty=True),
                       ["word"], alias="count")


def _side_tokens(spark, sf):
    docs = _documents(spark, sf)
    # Ingestion-time window per document, before the token fan-out.
    docs = add_tumbling_window(docs.withColumn("ingest_ts", _ingest_ts()), "ingest_ts",
                               SIDE_WINDOW_S)
    # Empty tokens reach neither output, so the plain split is enough.
    toks = tokenize(docs, "text", NON_WORD, lower=True, drop_empty=True,
                    keep=["doc_id", "window_start", "window_end"])
    return side_output(toks, "word", SIDE_MAX_LEN)


def side_output_main(spark, sf):
    main, _ = _side_tokens(spark, sf)
    return grouped_sum(main, ["word", "window_start", "window_end"], alias="count")


def side_output_rejected(spark, sf):
    _, rejected = _side_tokens(spark, sf)
    return rejected.select("doc_id", F.col("word").alias("value"))


def tokens_ws_plus(spark, sf):
    toks = tokenize(_doc_lines(spark, sf), "line", WHITESPACE_RUN)
    return grouped_sum(toks, ["word"], alias="count")


def tokens_ws_single(spark, sf):
    toks = tokenize(_doc_lines(spark, sf), "line", WHITESPACE_ONE)
    return grouped_sum(toks, ["word"], alias="count")


def tumbling_word_count(spark, sf):
    docs = _documents(spark, sf)
    docs = add_tumbling_window(docs.withColumn("ingest_ts", _ingest_ts()), "ingest_ts",
                               WORD_WINDOW_S)
    window = ["window_start", "window_end"]

    def counts(docs):
        toks = tokenize(text_lines(docs, "text"), "line", WHITESPACE_ONE, keep=window)
        return grouped_sum(toks, ["word", *window], alias="count")

    return grouped_within(docs.select("text", *window), window, "text", counts)


# --- split / select, connect, cached file, tuple text (P8-P10 J1 J3 S5) --

def _tagged_orders(spark, sf):
    return tag_rows(load(spark, sf, "orders").select("o_orderkey"),
                    even_odd_selector("o_orderkey"))


def split_even(spark, sf):
    return select_tags(_tagged_orders(spark, sf), "even").select("o_orderkey")


def split_odd(spark, sf):
    return select_tags(_tagged_orders(spark, sf), "odd").select("o_orderkey")


def split_all(spark, sf):
    return select_tags(_tagged_orders(spark, sf), "even", "odd").select(
        "o_orderkey", F.array_join("tags", ",").alias("tags"))


def connect_comap(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey")
    return connect_flat(orders, "o_orderkey", _doc_lines(spark, sf), "line")


def cached_prefix(spark, sf):
    """The cached file: the five region names, one a line, as one file of the shared folder."""
    path = checkpoint_path(spark, f"io/cached-{uuid.uuid4().hex[:8]}")
    load(spark, sf, "region").orderBy("r_regionkey").select("r_name").coalesce(1).write.text(path)
    cached = read_cached_text(spark, path).select(F.regexp_replace(
        F.regexp_replace("value", r"\n\z", ""), "\n", ",").alias("text"))
    cust = load(spark, sf, "customer").select("c_custkey", "c_name")
    return with_cached_text(cust, cached, "c_name", "enriched").select("c_custkey", "enriched")


def parse_tuple(spark, sf):
    li = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    text = li.select(format_tuple("l_orderkey", "l_linenumber", "l_extendedprice",
                                  to_epoch_millis("l_shipdate")).alias("value"))
    return text.select(parse_tuple_text("value", CAR_FIELDS).alias("t")).select("t.*")


# --- sessions, summaries (W3 W5 A2 A6) -----------------------------------

def session_sum(spark, sf):
    ev = load(spark, sf, "events").select("user_id", "ts", "value")
    return session_windows(ev, "user_id", "ts", SESSION_GAP_US, "value", scale=VALUE_SCALE)


def tumbling_value_sum(spark, sf):
    """A sum of six decimals per type and 10 minutes, with the id of the window's first row."""
    ev = load(spark, sf, "events").select(
        "event_type", "event_id", "ts",
        (F.col("value").cast("decimal(18,2)") * F.lit("1.2345").cast("decimal(5,4)")).alias("amount"))
    out = tumbling_sum(ev, ["event_type"], "ts", SUMMARY_WINDOW_S, "amount", "total",
                       {"first_id": "event_id"}, "event_id")
    return out.withColumn("total", F.col("total").cast("double"))


def window_summary_10m(spark, sf):
    ev = load(spark, sf, "events").select("event_type", "ts")
    return window_summary(ev, ["event_type"], "ts", SUMMARY_WINDOW_S)


def window_summary_lines(spark, sf):
    """the summaries as lines of text."""
    return summary_lines(window_summary_10m(spark, sf), "event_type")


# --- triggers (W6 W7 W8 A5) ----------------------------------------------

def count_trigger_running(spark, sf):
    ev = load(spark, sf, "events")
    return count_trigger(ev, "event_type", "ts", "event_id", "value", COUNT_EVERY,
                         scale=VALUE_SCALE)


def count_trigger_purged(spark, sf):
    ev = load(spark, sf, "events")
    return purging_count_trigger(ev, "event_type", "ts", "event_id", "value", COUNT_EVERY,
                         scale=VALUE_SCALE)


def top_speed(spark, sf):
    ev = load(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    cars = running_per_key(ev, ["user_id"], "ts", ["event_id"], "value", scale=VALUE_SCALE) \
        .withColumnRenamed("_run", "distance").drop("_rn")
    return delta_trigger_max(cars, "user_id", "ts", "event_id", "value", "distance",
                             SPEED_THRESHOLD, SPEED_EVICT_US)


def top_speed_free(spark, sf):
    """Five cars that also go backwards (every third row), so that distances fall."""
    ev = load(spark, sf, "events").select("event_type", "event_id", "ts", "value")
    step = F.when(F.col("event_id") % 3 == 0, -F.col("value")).otherwise(F.col("value"))
    cars = running_per_key(ev.withColumn("step", step), ["event_type"], "ts", ["event_id"], "step", scale=VALUE_SCALE) \
        .withColumnRenamed("_run", "distance").drop("_rn")
    return delta_trigger_max(cars, "event_type", "ts", "event_id", "value", "distance",
                             SPEED_THRESHOLD, SPEED_EVICT_US)


# --- watermarks and lateness (L2 L4 L5 A6 F13) ---------------------------

def late_status(spark, sf):
    return _late_rows(spark, sf).select("event_id", "event_type", "window_start", "status")


def late_status_counts(spark, sf):
    return _late_rows(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def lateness_firing_history(spark, sf):
    return lateness_firings(_late_rows(spark, sf), "event_type", "ts", "arrival", "event_id")


def window_summary_with_lateness(spark, sf):
    return final_window_summary(_late_rows(spark, sf), "event_type", "ts")


# --- keyword masking (J2 L7 F4 F5) ---------------------------------------

def keyword_mask(spark, sf):
    ev = load(spark, sf, "events")
    messages = ev.where(F.col("event_type") != "signup").select("event_id", "ts", "props")
    rules = ev.where(F.col("event_type") == "signup").select(
        "event_id", "ts", F.get_json_object("props", "$.k").alias("keyword"))
    current = latest_rule_asof(messages, rules, "ts", "keyword", DEFAULT_KEYWORD, "event_id")
    return mask_messages(current, "props", "keyword").select("event_id", "masked")


# --- user functions (U2, U4) ---------------------------------------------

def user_table_function(spark, sf):
    """The gap between a user's events, by an ordered table function."""
    return event_gaps(load(spark, sf, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id")


def user_mean(spark, sf):
    """U4: a mean with create, add, merge and result; five keys, so each is hot."""
    cents = F.round(F.col("value") * 10**VALUE_SCALE).cast("bigint")
    ev = load(spark, sf, "events").select("event_type", cents.alias("cents"))
    return user_aggregate(ev, ["event_type"], ["cents"], Mean(10**VALUE_SCALE), "mean_value")


QUERIES: dict[str, Query] = {
    "hot_items": hot_items,
    "window_item_counts": window_item_counts,
    "filter_eq": filter_eq,
    "epoch_seconds": epoch_seconds,
    "word_count": word_count,
    "side_output_main": side_output_main,
    "side_output_rejected": side_output_rejected,
    "tokens_ws_plus": tokens_ws_plus,
    "tokens_ws_single": tokens_ws_single,
    "tumbling_word_count": tumbling_word_count,
    "split_even": split_even,
    "split_odd": split_odd,
    "split_all": split_all,
    "connect_comap": connect_comap,
    "cached_prefix": cached_prefix,
    "parse_tuple_text": parse_tuple,
    "session_sum": session_sum,
    "window_summary": window_summary_10m,
    "window_summary_lines": window_summary_lines,
    "tumbling_value_sum": tumbling_value_sum,
    "count_trigger_running": count_trigger_running,
    "count_trigger_purged": count_trigger_purged,
    "top_speed": top_speed,
    "top_speed_free": top_speed_free,
    "late_status": late_status,
    "late_status_counts": late_status_counts,
    "lateness_firings": lateness_firing_history,
    "window_summary_with_lateness": window_summary_with_lateness,
    "keyword_mask": keyword_mask,
    "user_table_function": user_table_function,
    "user_aggregate": user_mean,
    **IO_QUERIES,
}


def _chunked(query: Query) -> Query:
    """The query with its keys cut into chunks of ``CHUNKED_ROWS`` rows, so that the plan
    for hot keys runs on small tables too (the split is laid out when the query is built)."""
    def run(spark, sf):
        before = spark.conf.get(ROWS_PER_CHUNK_CONF, None)
        spark.conf.set(ROWS_PER_CHUNK_CONF, str(CHUNKED_ROWS))
        try:
            return query(spark, sf)
        finally:
            if before is None:
                spark.conf.unset(ROWS_PER_CHUNK_CONF)
            else:
                spark.conf.set(ROWS_PER_CHUNK_CONF, before)
    run.__name__ = f"{query.__name__}_chunked"
    return run


CHUNKED = ["count_trigger_running", "count_trigger_purged", "session_sum", "top_speed", "top_speed_free",
           "late_status", "lateness_firings", "window_summary_with_lateness", "keyword_mask",
           "user_table_function"]
QUERIES.update({f"{name}_chunked": _chunked(QUERIES[name]) for name in CHUNKED})
