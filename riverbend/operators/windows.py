"""Time windows and window aggregates.

Windows are ``[start, end)`` in event time; batch inputs carry the event
time as TIMESTAMP_NTZ (UTC wall clock). Durations are given in seconds (or
microseconds where sub-second gaps matter) and all arithmetic is done on
epoch microseconds, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.time import epoch_micros, format_millis
from ..plans.skew import (CHUNK, attach_prefix, chunk_prefix, null_safe_join,
                          split_hot_keys)

US = 1_000_000
BYTES_PER_TASK = 16 << 20  # of text whose words a task counts


def micros_to_ts(col: Column) -> Column:
    return F.timestamp_micros(col).cast("timestamp_ntz")


def summand(value: str | None, scale: int | None = None) -> Column:
    """What a sum adds up: the column in its own type, or as a decimal of ``scale``
    places where a floating sum must not depend on the order of its rows."""
    col = F.col(value) if value else F.lit(None).cast("bigint")
    return col if scale is None else col.cast(f"decimal(18,{scale})")


def tumbling_bounds(ts: str | Column, size_us: int) -> tuple[Column, Column]:
    """``(window_start, window_end)`` of the tumbling window holding ``ts``."""
    start = F.floor(epoch_micros(ts) / F.lit(size_us)) * F.lit(size_us)
    return micros_to_ts(start), micros_to_ts(start + F.lit(size_us))


def add_tumbling_window(df: DataFrame, ts: str, size_s: float) -> DataFrame:
    """Attach ``window_start, window_end`` of the tumbling window of ``ts``.

    Useful before a fan-out (e.g. tokenizing a document): the window is then
    computed once per input row instead of once per output row.
    """
    start, end = tumbling_bounds(ts, int(size_s * US))
    return df.withColumn("window_start", start).withColumn("window_end", end)


def grouped_sum(df: DataFrame, keys: list[str], value: str | None = None,
                alias: str = "count") -> DataFrame:
    """A1: ``groupBy(keys).sum(value)`` (or a count when ``value`` is None).

    Catalyst plans a partial hash aggregate before the shuffle, so a hot key
    costs one row per map task in the exchange.
    """
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(*keys).agg(agg.alias(alias))


def grouped_within(df: DataFrame, within: list[str], text: str, grouped: Callable[[DataFrame], DataFrame],
                   bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``grouped(df)``, an aggregation that takes the column ``text`` apart and whose groups each lie
    within one group of ``within`` (its keys hold these columns).

    The rows are shuffled before they are taken apart, those of a group of ``within`` to one task, so that the
    aggregation needs no shuffle of its many small groups. A group of ``within`` with more than
    ``bytes_per_task`` bytes of text is left to the aggregation's own shuffle, which cuts it.
    """
    sizes = df.groupBy(*within).agg(F.sum(F.octet_length(text)).alias("_bytes"))
    heavy = F.col("_bytes") > bytes_per_task
    total, n_heavy = sizes.agg(F.sum("_bytes"), F.count_if(heavy)).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil((total or 0) / bytes_per_task))
    if not n_heavy:
        return grouped(df.repartition(tasks, *within))
    heavy_keys = sizes.where(heavy).select(*within)
    light, rest = (null_safe_join(df, heavy_keys, within, n_heavy, how) for how in ("left_anti", "left_semi"))
    return grouped(light.repartition(tasks, *within)).unionByName(grouped(rest))


def tumbling_sum(df: DataFrame, keys: list[str], ts: str, size_s: float,
                 value: str | None = None, alias: str = "count",
                 first: dict[str, str] | None = None, tiebreak: str | None = None) -> DataFrame:
    """W1/W2/W3 + A2: per key and tumbling window, the sum of ``value``
    (a count when ``value`` is None). ``first`` maps output names to columns
    taken from the window's first row (by ``ts``, then ``tiebreak``). One
    shuffle, partial aggregation."""
    start, end = tumbling_bounds(ts, int(size_s * US))
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    order = F.struct(ts, tiebreak) if tiebreak else F.col(ts)
    return (df.groupBy(*keys, start.alias("window_start"), end.alias("window_end"))
            .agg(agg.alias(alias),
                 *[F.min_by(col, order).alias(name) for name, col in (first or {}).items()]))


def sliding_counts(df: DataFrame, key: str, ts: str, size_s: int, slide_s: int,
                   alias: str = "view_count") -> DataFrame:
    """W4 + A3 + A4: per key, the row count of every sliding window.

    Rows are first counted per ``(key, pane)`` with panes of
    ``gcd(size, slide)``, then each pane count is fanned out to the
    ``size/slide`` windows that contain it. The fan-out therefore multiplies
    pane aggregates, not raw rows, and both aggregations combine map-side.
    Output: ``key, window_start, window_end, <alias>`` (only non-empty windows).
    """
    pane = math.gcd(size_s, slide_s) * US
    size, slide = size_s * US, slide_s * US
    panes = (df.select(key, F.floor(epoch_micros(ts) / F.lit(pane)).alias("_pane"))
             .groupBy(key, "_pane").agg(F.count(F.lit(1)).alias("_n")))
    lo = F.ceil((F.col("_pane") + 1) * F.lit(pane) / F.lit(slide))
    hi = F.floor((F.col("_pane") * F.lit(pane) + F.lit(size)) / F.lit(slide))
    fanned = panes.select(key, "_n", F.explode(F.sequence(lo, hi)).alias("_end"))
    return (fanned.groupBy(key, "_end").agg(F.sum("_n").alias(alias))
            .select(key,
                    micros_to_ts(F.col("_end") * F.lit(slide) - F.lit(size)).alias("window_start"),
                    micros_to_ts(F.col("_end") * F.lit(slide)).alias("window_end"),
                    F.col(alias).cast("bigint").alias(alias)))


def window_summary(df: DataFrame, keys: list[str], ts: str, size_s: float) -> DataFrame:
    """Per key and tumbling window: count, earliest and latest event time.

    The reference buffers and sorts the whole window to read both ends;
    count/min/max are mergeable, so the window is never materialised.
    """
    start, end = tumbling_bounds(ts, int(size_s * US))
    return (df.groupBy(*keys, start.alias("window_start"), end.alias("window_end"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"),
                 F.max(ts).alias("last_ts")))


def summary_lines(summary: DataFrame, key: str) -> DataFrame:
    """a window summary as text, ``key,count,first,last,start,end``, with instants as
    ``yyyy-MM-dd HH:mm:ss.SSS``; a null key as nothing."""
    instants = [format_millis(c) for c in ("first_ts", "last_ts", "window_start", "window_end")]
    return summary.select(F.concat_ws(",", F.coalesce(F.col(key).cast("string"), F.lit("")),
                                      F.col("n").cast("string"), *instants).alias("line"))


def session_windows(df: DataFrame, key: str, ts: str, gap_us: int,
                    value: str | None = None, rows_per_chunk: int | None = None,
                    scale: int | None = None) -> DataFrame:
    """W5 + A2: event-time sessions per key with a static gap.

    Two rows of a key share a session when the next one is at most ``gap``
    after the previous (so rows at 0 and 3 with gap 3 form one session).
    Output per session: ``key, first_ts, session_end (= last ts + gap), n,
    total`` (``total`` = sum of ``value``, see ``summand``, as a double).

    Plan: hot keys are cut into contiguous time chunks (``split_hot_keys``);
    sessions are islands inside each ``(key, chunk)`` (one shuffle, sorted
    window); only the first and last island of a chunk can continue across a
    chunk border, so just those (at most two per chunk) are merged in a
    second, tiny pass.
    """
    us = epoch_micros(ts)
    base = df.select(key, F.col(ts).alias("_ts"), us.alias("_us"),
                     summand(value, scale).alias("_v"))
    split = split_hot_keys(base, [key], "_us", rows_per_chunk)
    w = Window.partitionBy(key, CHUNK).orderBy("_us")
    islands = (split.df
               .withColumn("_new", F.when(F.col("_us") - F.lag("_us").over(w) <= gap_us, 0)
                           .otherwise(1))
               .withColumn("_sid", F.sum("_new").over(
                   w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    pieces = (islands.groupBy(key, CHUNK, "_sid")
              .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"),
                   F.count(F.lit(1)).alias("n"), F.sum("_v").alias("_total")))
    if split.split:
        last_sid = F.max("_sid").over(Window.partitionBy(key, CHUNK))
        flags = split.heavy_keys.withColumn("_hot", F.lit(True))
        pieces = (null_safe_join(pieces, flags, [key], split.heavy_rows)
                  .withColumn("_edge", F.coalesce("_hot", F.lit(False))
                              & ((F.col("_sid") == 1) | (F.col("_sid") == last_sid))))
        heavy = pieces.where("_edge")
        interior = pieces.where(~F.col("_edge"))
        # Edge pieces of heavy keys: at most 2 per chunk, so this window is small.
        we = Window.partitionBy(key).orderBy("_first", CHUNK)
        merged = (heavy
                  .withColumn("_new", F.when(F.col("_first") - F.lag("_last").over(we) <= gap_us, 0)
                              .otherwise(1))
                  .withColumn("_gid", F.sum("_new").over(
                      we.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
                  .groupBy(key, "_gid")
                  .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                       F.sum("n").alias("n"), F.sum("_total").alias("_total")))
        pieces = interior.select(key, "_first", "_last", "n", "_total") \
            .unionByName(merged.select(key, "_first", "_last", "n", "_total"))
    out = pieces.select(
        key,
        micros_to_ts(F.col("_first")).alias("first_ts"),
        micros_to_ts(F.col("_last") + F.lit(gap_us)).alias("session_end"),
        F.col("n").cast("bigint").alias("n"),
        *([F.col("_total").cast("double").alias("total")] if value else []),
    )
    return out


# How a running aggregate is computed inside a chunk and carried across.
# "count" counts rows (a null input still counts, like the reference's
# count aggregate); the others skip nulls as SQL aggregates do.
_PREFIX_COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_LOCAL = {"count": lambda c: F.count(F.lit(1)), "sum": F.sum, "min": F.min, "max": F.max}


def numeric_tie(df: DataFrame, tiebreak: list[str]) -> str | None:
    """The first column of the tie-break, if a hot instant can be cut along it."""
    first = tiebreak[0] if tiebreak else None
    return first if first and isinstance(df.schema[first].dataType, NumericType) else None


def running_aggs(df: DataFrame, keys: list[str], order: str, tiebreak: list[str],
                 aggs: dict[str, tuple[str, str]],
                 rows_per_chunk: int | None = None) -> DataFrame:
    """Running aggregates per key in ``(order, *tiebreak)`` order, exact and
    hot-key safe.

    ``aggs`` maps an output column to ``(input column, kind)`` with kind in
    count/sum/min/max; each output is the aggregate over the key's rows up
    to and including the current one. Heavy keys are cut into order chunks
    (``plans.skew``); each chunk's total is carried into later chunks.
    """
    split = split_hot_keys(df, keys, order, rows_per_chunk, tie=numeric_tie(df, tiebreak))
    w = (Window.partitionBy(*keys, CHUNK).orderBy(order, *tiebreak)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = split.df
    for name, (col, kind) in aggs.items():
        local = local.withColumn(f"_l_{name}", _LOCAL[kind](F.col(col)).over(w))
    summary = split.df.groupBy(*keys, CHUNK).agg(
        *[_LOCAL[kind](F.col(col)).alias(f"_c_{name}") for name, (col, kind) in aggs.items()])
    prefix = chunk_prefix(split, summary, {
        f"_p_{name}": _PREFIX_COMBINE[kind](f"_c_{name}") for name, (_, kind) in aggs.items()})
    out = attach_prefix(local, split, prefix, [f"_p_{name}" for name in aggs])
    for name, (_, kind) in aggs.items():
        a, b = F.col(f"_l_{name}"), F.col(f"_p_{name}")
        if kind in ("count", "sum"):
            b = b.cast(local.schema[f"_l_{name}"].dataType)
            # Null until the key's first non-null value, in this chunk or an earlier one.
            merged = F.when(a.isNotNull() | b.isNotNull(),
                            F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
        elif kind == "min":
            merged = F.least(a, b)
        else:
            merged = F.greatest(a, b)
        out = out.withColumn(name, merged)
    return out.drop(*[f"_l_{n}" for n in aggs], *[f"_p_{n}" for n in aggs], CHUNK)


def running_per_key(df: DataFrame, key: list[str], order: str, tiebreak: list[str],
                    value: str | None = None, rows_per_chunk: int | None = None,
                    scale: int | None = None) -> DataFrame:
    """Running count (``_rn``) and running sum (``_run``, see ``summand``) per key
    in ``(order, *tiebreak)`` order, hot-key safe (chunked prefix)."""
    out = running_aggs(df.withColumn("_v", summand(value, scale)), key, order, tiebreak,
                       {"_rn": ("_v", "count"),
                        "_run": ("_v", "sum")}, rows_per_chunk)
    return out.drop("_v")
