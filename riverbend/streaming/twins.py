"""Structured Streaming versions of the operators.

Each twin takes a streaming DataFrame and returns either a streaming
DataFrame (to be written by the caller) or a ``foreachBatch`` function. The
event-time column must be TIMESTAMP (``functions.time.to_event_time``):
``withWatermark`` rejects TIMESTAMP_NTZ.

* tumbling / sliding / session windows: built-in stateful aggregations in
  append mode; state is evicted by the watermark;
* top-N per window: append-mode window counts, then an exact batch top-N
  per micro-batch (all groups of a window are finalized in the same batch,
  when the watermark passes its end), so no per-window list is collected;
* count triggers: ``foreachBatch`` with the batch operator's hot-key split; one
  (count, sum) row per key is carried from epoch to epoch;
* allowed lateness: update mode, where a window fires again in every micro-batch
  that brings it rows;
* keyword masking: ``foreachBatch`` as-of lookup against the rules of the batch's
  time and the last one before it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions.time import epoch_micros
from ..operators.lookup import latest_rule_asof, mask_messages
from ..operators.topn import hot_items as top_items
from ..operators.windows import running_per_key, summand
from ..plans.skew import null_safe_join, released


def _ntz(c):
    return F.col(c).cast("timestamp_ntz")


def tumbling_counts(stream: DataFrame, keys: list[str], ts: str, size: str,
                    delay: str | None = "0 seconds") -> DataFrame:
    """W1-W3 on a stream: ``keys, window_start, window_end, count``. ``delay`` None: the
    stream has its watermark already (L3)."""
    w = F.window(ts, size)
    timed = stream if delay is None else stream.withWatermark(ts, delay)
    return (timed.groupBy(*keys, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(*keys, _ntz("w.start").alias("window_start"),
                    _ntz("w.end").alias("window_end"), "count"))


def arrival_counts(stream: DataFrame, keys: list[str], size: str) -> DataFrame:
    """W1 on a stream, by the clock: ``keys, window_start, window_end, count`` of tumbling windows of
    the time of arrival, for update mode.

    The clock is that of the micro-batch. Spark writes it to the query's checkpoint before the
    micro-batch runs, so a micro-batch that is tried again puts its rows into the same windows. A window
    comes out in every micro-batch that adds to it, last with its whole content.
    """
    return tumbling_counts(stream.withColumn("_arrived", F.current_timestamp()), keys, "_arrived", size)


def sliding_item_counts(stream: DataFrame, item: str, ts: str, size: str, slide: str,
                        delay: str = "0 seconds", keep: str | None = None) -> DataFrame:
    """W4 + A3 + A4 on a stream, in two chained stateful aggregations:
    raw rows are counted per ``slide``-wide tumbling pane, and only the pane
    counts are fanned out to the ``size/slide`` sliding windows (via
    ``window_time`` of the pane), so the per-row work is a single tumbling
    aggregation. ``size`` must be a multiple of ``slide``.

    ``keep`` is a boolean column evaluated *after* the watermark (H1b: rows
    that do not match still advance event time, as in the reference,
    because the predicate mentions ``ts``)."""
    s = stream.withWatermark(ts, delay)
    if keep is not None:
        s = s.where(F.when(F.col(ts).isNotNull(), F.expr(keep)))
    panes = (s.groupBy(F.window(ts, slide).alias("p"), item)
             .agg(F.count(F.lit(1)).alias("_n"))
             .select(item, "_n", F.window_time("p").alias("_pt")))
    return (panes.groupBy(F.window("_pt", size, slide).alias("w"), item)
            .agg(F.sum("_n").alias("view_count"))
            .select(item, _ntz("w.start").alias("window_start"),
                    _ntz("w.end").alias("window_end"), "view_count"))


def hot_items_sink(path: str, n: int = 3):
    """T1 on a stream: a ``foreachBatch`` function writing the top ``n`` of
    every window finalized in the batch to ``path/epoch=<id>`` (overwrite, so
    a retried epoch replaces its own output)."""

    def write(batch: DataFrame, epoch_id: int):
        top_items(batch, n).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    return write


def sessions(stream: DataFrame, key: str, ts: str, gap: str, value: str,
             delay: str = "0 seconds", scale: int | None = None) -> DataFrame:
    """W5 + A2 on a stream (built-in session windows, merged in state)."""
    return (stream.withWatermark(ts, delay)
            .groupBy(key, F.session_window(ts, gap).alias("s"))
            .agg(F.min(ts).alias("first_ts"), F.count(F.lit(1)).alias("n"),
                 F.sum(summand(value, scale)).cast("double").alias("total"))
            .select(key, _ntz("first_ts").alias("first_ts"), _ntz("s.end").alias("session_end"),
                    "n", "total"))


def window_summaries(stream: DataFrame, keys: list[str], ts: str, size: str,
                     delay: str, lateness: str = "0 seconds") -> DataFrame:
    """L4 + A6 on a stream, for update mode: ``keys, window_start, window_end, n, first_ts,
    last_ts`` of every window that a micro-batch brought rows. A row is dropped once its
    window ended ``delay + lateness`` before the largest event time two micro-batches back
    (Spark moves the watermark between batches, and drops by the one before)."""
    w = F.window(ts, size)
    return (stream.withWatermark(ts, f"{delay} {lateness}").groupBy(*keys, w.alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
            .select(*keys, _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"),
                    "n", _ntz("first_ts").alias("first_ts"), _ntz("last_ts").alias("last_ts")))


def epoch_sink(path: str):
    """A ``foreachBatch`` function that keeps every batch in ``path/epoch=<id>`` (overwritten
    when an epoch is retried)."""
    return lambda batch, epoch_id: batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")


def last_firings(firings: DataFrame, window: list[str], values: list[str]) -> DataFrame:
    """Of the firings kept by ``epoch_sink``: each window's last content and ``firings``."""
    last = F.max_by(F.struct(*values), "epoch").alias("_last")
    return (firings.groupBy(*window).agg(last, F.count(F.lit(1)).alias("firings"))
            .select(*window, "_last.*", "firings"))


@contextmanager
def _held(df: DataFrame):
    """``df`` cached while several jobs of one micro-batch read it, and what splits cache."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with released():
            yield df
    finally:
        df.unpersist()


def _wide_sum(df: DataFrame, col: str):
    """The type that holds sums of sums of ``col``, epoch after epoch."""
    kind = df.schema[col].dataType
    return DecimalType(38, kind.scale) if isinstance(kind, DecimalType) else \
        df.agg(F.sum(col)).schema[0].dataType


def count_trigger_sink(path: str, carry_path: str, key: str, order: str, seq: str, value: str,
                       every: int = 2, purge: bool = False, scale: int | None = None):
    """W6/W7 on a stream: a ``foreachBatch`` function writing ``key, n, total, fired_at`` of
    the batch's firings to ``path/epoch=<id>``.

    Rows of a batch are numbered per key in ``(order, seq)`` order by the batch operator, hot
    keys in chunks. Between epochs each key keeps one row (its rows so far, and the sum so
    far or, with ``purge``, that of the unfinished group) in ``carry_path/epoch=<id>``. An
    epoch reads the carry of the one before and overwrites its own, so it may be retried.
    """

    def write(batch: DataFrame, epoch_id: int):
        spark = batch.sparkSession
        rows = batch.select(key, order, seq, summand(value, scale).alias("_x"))
        kind = _wide_sum(rows, "_x")
        total = lambda c: F.sum(c).cast(kind).alias("total")
        with _held(rows):
            counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), total("_x"))
            numbered = running_per_key(rows, [key], order, [seq], "_x")
            if epoch_id:
                before = spark.read.schema(counts.schema).parquet(f"{carry_path}/epoch={epoch_id - 1}")
                carry = before.withColumnsRenamed({"n": "_n0", "total": "_t0"})
                numbered = null_safe_join(numbered, carry, [key], before.count())
            else:
                before = counts.where(F.lit(False))
                numbered = numbered.withColumns({"_n0": F.lit(0), "_t0": F.lit(None).cast(kind)})
            pos = (F.col("_rn") + F.coalesce("_n0", F.lit(0))).cast("bigint")
            if purge:
                pieces = (numbered.groupBy(key, F.floor((pos - 1) / every).alias("_g"))
                          .agg(F.count(F.lit(1)).alias("n"), total("_x"), F.max_by(seq, "_rn").alias("fired_at")))
                left = F.col("n") % every
                unfinished = before.where(left > 0).select(
                    key, F.floor(F.col("n") / every).alias("_g"), left.alias("n"), "total",
                    F.lit(None).cast(rows.schema[seq].dataType).alias("fired_at"))
                groups = (pieces.unionByName(unfinished).groupBy(key, "_g")
                          .agg(F.sum("n").alias("n"), total("total"), F.max("fired_at").alias("fired_at")))
                fired = groups.where(F.col("n") == every)
                no_sum = [d.select(key, "n", F.lit(None).cast(kind).alias("total")) for d in (counts, before)]
                after = no_sum[0].unionByName(no_sum[1]).unionByName(
                    groups.where(F.col("n") < every).select(key, F.lit(0).cast("bigint").alias("n"), "total"))
            else:
                run = F.when(F.col("_run").isNotNull() | F.col("_t0").isNotNull(),
                             F.coalesce("_run", F.lit(0)).cast(kind) + F.coalesce("_t0", F.lit(0)).cast(kind))
                fired = numbered.where(pos % every == 0).select(
                    key, pos.alias("n"), run.alias("total"), F.col(seq).alias("fired_at"))
                after = counts.unionByName(before)
            fired.select(key, "n", F.col("total").cast("double").alias("total"), "fired_at") \
                .write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
            after.groupBy(key).agg(F.sum("n").alias("n"), total("total")) \
                .write.mode("overwrite").parquet(f"{carry_path}/epoch={epoch_id}")

    return write


def keyword_mask_sink(rules_path: str, out_path: str, ts: str, text: str, default: str,
                      tiebreak: str):
    """J2/L7 on a stream: each micro-batch of messages is matched to the latest
    rule at or before its time, in the rule table (appended by another
    stream or job) as it stands when the batch runs. Only the rules of the
    batch's time and those of the last instant before it are read."""

    def write(batch: DataFrame, epoch_id: int):
        with _held(batch):
            us = epoch_micros(ts)
            span = batch.agg(F.min(us).alias("low"), F.max(us).alias("high")).first()
            rules = batch.sparkSession.read.parquet(rules_path).select(ts, tiebreak, "keyword")
            at = lambda v: F.timestamp_micros(F.lit(v)).cast(rules.schema[ts].dataType)
            if span["low"] is not None:
                rules = rules.where(F.col(ts) <= at(span["high"]))
                old = rules.where(F.col(ts) <= at(span["low"])).agg(F.max(us)).first()[0]
                if old is not None:
                    rules = rules.where(F.col(ts) >= at(old))
            cur = latest_rule_asof(batch, rules, ts, "keyword", default, tiebreak)
            mask_messages(cur, text, "keyword").write.mode("overwrite") \
                .parquet(f"{out_path}/epoch={epoch_id}")

    return write


def side_outputs(tokens: DataFrame, ts: str, token_col: str = "word", max_len: int = 5,
                 size: str = "5 seconds", delay: str = "0 seconds"
                 ) -> tuple[DataFrame, DataFrame]:
    """P11 + P1 + W2 on a stream: the main branch counts tokens of length
    1..``max_len`` per tumbling window (stateful, append mode); the
    ``rejected`` branch maps longer tokens to ``"rejected: " + token``
    (stateless). Start each branch as its own query, or write stateless
    outputs from one ``foreachBatch`` (``sinks.fan_out_stream``).

    The watermark is assigned before the branch filter and the predicate
    mentions the event-time column, so Catalyst keeps it above the
    watermark: rows of the other branch still advance event time (H1b).
    """
    n = F.length(token_col)
    timed = tokens.withWatermark(ts, delay)
    main = timed.where(F.when(F.col(ts).isNotNull(), (n > 0) & (n <= max_len)))
    counts = (main.groupBy(token_col, F.window(ts, size).alias("w"))
              .agg(F.count(F.lit(1)).alias("count"))
              .select(token_col, _ntz("w.start").alias("window_start"),
                      _ntz("w.end").alias("window_end"), "count"))
    rejected = tokens.where(n > max_len).withColumn(
        token_col, F.concat(F.lit("rejected: "), F.col(token_col)))
    return counts, rejected
