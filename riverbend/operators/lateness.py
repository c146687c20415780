"""Watermarks, allowed lateness and late data.

The reference runs one watermark for the whole operator: after each row it
is ``max event time seen so far - delay``. A row is then

* ``on_time`` if its window has not fired yet (``end - 1 > watermark``),
* ``late`` if the window fired but is kept for ``lateness`` more
  (``end - 1 <= watermark < end - 1 + lateness``): it re-fires the window
  with its cumulative content,
* ``dropped`` once ``end - 1 + lateness <= watermark``.

In batch that is a replay over an arrival-order column. The running maximum
is over *all* rows in arrival order, a single global order, so it is split
into arrival chunks and carried across them (``plans.skew``). Time unit is
the microsecond (the reference's "- 1" is one millisecond).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import MILLIS_PATTERN, epoch_micros
from ..plans.skew import CHUNK, attach_prefix, chunk_prefix, split_hot_keys
from ..session import ensure_checkpoint_dir
from .windows import micros_to_ts, numeric_tie, running_aggs

ON_TIME, LATE, DROPPED = "on_time", "late", "dropped"


def lateness_status(df: DataFrame, ts: str, arrival: str, tiebreak: str,
                    size_us: int, delay_us: int, lateness_us: int,
                    rows_per_chunk: int | None = None) -> DataFrame:
    """Tag every row with its tumbling window and ``status``.

    Adds ``window_start, window_end, watermark_us, status``. The watermark
    seen by a row is built from the rows that arrived strictly before it.
    """
    us = epoch_micros(ts)
    start = F.floor(us / F.lit(size_us)) * F.lit(size_us)
    base = (df.withColumn("_us", us).withColumn("_we", start + F.lit(size_us))
            .withColumn("window_start", micros_to_ts(start))
            .withColumn("window_end", micros_to_ts(start + F.lit(size_us))))
    split = split_hot_keys(base, [], arrival, rows_per_chunk, tie=numeric_tie(base, [tiebreak]))
    w = (Window.partitionBy(CHUNK).orderBy(arrival, tiebreak)
         .rowsBetween(Window.unboundedPreceding, -1))
    local = split.df.withColumn("_lmax", F.max("_us").over(w))
    summary = split.df.groupBy(CHUNK).agg(F.max("_us").alias("_cmax"))
    prefix = chunk_prefix(split, summary, {"_pmax": F.max("_cmax")})
    out = attach_prefix(local, split, prefix, ["_pmax"])
    wm = F.greatest(F.col("_lmax"), F.col("_pmax").cast("bigint")) - F.lit(delay_us)
    end1 = F.col("_we") - F.lit(1)
    status = (F.when(wm.isNull(), F.lit(ON_TIME))
              .when(end1 + F.lit(lateness_us) <= wm, F.lit(DROPPED))
              .when(end1 <= wm, F.lit(LATE))
              .otherwise(F.lit(ON_TIME)))
    return (out.withColumn("watermark_us", wm).withColumn("status", status)
            .drop("_lmax", "_pmax", "_we", CHUNK))


def lateness_firings(status_rows: DataFrame, key: str, ts: str, arrival: str,
                     tiebreak: str, rows_per_chunk: int | None = None) -> DataFrame:
    """L4 firing history per ``(key, window)``.

    One ``on_time`` firing with the on-time rows (when the watermark passes
    the window end, or at end of input), then one ``late`` firing per late
    row with the window's cumulative content up to that row. On-time rows of
    a window always arrive before its late rows (the watermark only grows),
    so cumulative = on-time aggregate + running aggregate of late rows.
    Output: ``key, window_start, window_end, kind, fire_no, n, first_ts, last_ts``.
    """
    kept = status_rows.where(F.col("status") != DROPPED)
    wkey = [key, "window_start", "window_end"]
    on = (kept.where(F.col("status") == ON_TIME).groupBy(*wkey)
          .agg(F.count(F.lit(1)).alias("_on_n"), F.min(ts).alias("_on_min"),
               F.max(ts).alias("_on_max")))
    # Running content of the late rows per window, in arrival order; a hot
    # (key, window) is split into arrival chunks like any ordered scan. Late
    # rows are a small subset: checkpoint them (shared checkpoint folder) so
    # the split's passes read them instead of re-running the replay.
    ensure_checkpoint_dir(status_rows.sparkSession)
    late_rows = kept.where(F.col("status") == LATE).select(*wkey, ts, arrival, tiebreak) \
        .checkpoint(eager=True)
    late = running_aggs(
        late_rows, wkey, arrival, [tiebreak],
        {"_ln": (ts, "count"), "_lmin": (ts, "min"), "_lmax": (ts, "max")},
        rows_per_chunk).select(*wkey, "_ln", "_lmin", "_lmax")
    same = [late[c].eqNullSafe(on[c]) for c in wkey]  # a null key is a key like any other
    late_fires = (late.join(on, same, "left")
                  .select(*[late[c] for c in wkey], F.lit(LATE).alias("kind"), F.col("_ln").alias("fire_no"),
                          (F.coalesce("_on_n", F.lit(0)) + F.col("_ln")).alias("n"),
                          F.least("_on_min", "_lmin").alias("first_ts"),
                          F.greatest("_on_max", "_lmax").alias("last_ts")))
    on_fires = on.select(*wkey, F.lit(ON_TIME).alias("kind"), F.lit(0).cast("bigint")
                         .alias("fire_no"), F.col("_on_n").alias("n"),
                         F.col("_on_min").alias("first_ts"), F.col("_on_max").alias("last_ts"))
    return on_fires.unionByName(late_fires.withColumn("fire_no", F.col("fire_no").cast("bigint")))


def final_window_summary(status_rows: DataFrame, key: str, ts: str) -> DataFrame:
    """A6 with lateness: the content of each window's last firing (on-time
    plus late rows), with the reference's text rendering
    ``key,count,first,last,start,end`` (instants as ``yyyy-MM-dd HH:mm:ss.SSS``)."""
    agg = (status_rows.where(F.col("status") != DROPPED)
           .groupBy(key, "window_start", "window_end")
           .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"),
                F.max(ts).alias("last_ts")))
    fmt = [F.date_format(c, MILLIS_PATTERN) for c in
           ("first_ts", "last_ts", "window_start", "window_end")]
    return agg.withColumn("line", F.concat_ws(",", F.col(key).cast("string"),
                                              F.col("n").cast("string"), *fmt))
