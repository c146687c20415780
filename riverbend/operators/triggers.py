"""Global-window triggers and evictors.

A global window never closes; what defines the output is the trigger. In
batch these become ordered scans per key:

* count trigger (W6): fires on every ``n``-th row of a key with the running
  aggregate since the key's first row;
* purging count trigger (W7): disjoint batches of ``n`` rows; an incomplete
  trailing batch never fires;
* delta trigger + time evictor (W8): fires when a measure moved more than a
  threshold since the last firing row; the output is the max row of the
  rows kept by the evictor.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from ..functions.time import epoch_micros
from ..plans.skew import (BOUNDS, CHUNK, PIECES, KeySplit, attach_prefix, chunk_of, chunk_prefix,
                          null_safe_join, split_hot_keys)
from ..session import ensure_checkpoint_dir
from .windows import numeric_tie, running_per_key, summand


def count_trigger(df: DataFrame, key: str, order: str, seq: str, value: str,
                  every: int = 2, rows_per_chunk: int | None = None,
                  scale: int | None = None) -> DataFrame:
    """``GlobalWindows + CountTrigger.of(every)`` followed by ``sum``.

    Output per firing: ``key, fire_no, n`` (rows seen so far), ``total``
    (running sum of ``value``) and ``fired_at`` (the ``seq`` of the row that
    fired). Hot keys are split by ``running_per_key``; the state the
    reference keeps for ever is just a running (count, sum).
    """
    r = running_per_key(df.select(key, order, seq, value), [key], order, [seq], value,
                        rows_per_chunk, scale)
    return (r.where(F.col("_rn") % every == 0)
            .select(key, (F.col("_rn") / every).cast("bigint").alias("fire_no"),
                    F.col("_rn").cast("bigint").alias("n"),
                    F.col("_run").cast("double").alias("total"),
                    F.col(seq).alias("fired_at")))


def purging_count_trigger(df: DataFrame, key: str, order: str, seq: str, value: str,
                          every: int = 2, rows_per_chunk: int | None = None,
                  scale: int | None = None) -> DataFrame:
    """``PurgingTrigger.of(CountTrigger.of(every))`` followed by ``sum``.

    Rows are numbered per key (hot-key safe), grouped into disjoint batches
    of ``every`` consecutive rows, and only full batches fire. Output:
    ``key, batch_no, n, total, first_id`` (A2: non-summed fields come from the
    first row of the batch), ``fired_at`` (last row of the batch).
    """
    r = running_per_key(df.select(key, order, seq, value), [key], order, [seq], None,
                        rows_per_chunk)
    batch = F.floor((F.col("_rn") - 1) / every)
    return (r.groupBy(key, batch.cast("bigint").alias("batch_no"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(summand(value, scale)).cast("double").alias("total"),
                 F.min_by(seq, "_rn").alias("first_id"),
                 F.max_by(seq, "_rn").alias("fired_at"))
            .where(F.col("n") == every))


def _first_over(d: np.ndarray, base, thr) -> np.ndarray:
    """Per baseline, the index of the first element of the ascending ``d`` with
    ``d - base > thr`` as the type computes it (``len(d)`` if none). The search
    for ``base + thr`` may be off by the rounding of a double on either side."""
    base = np.atleast_1d(base)
    j = np.searchsorted(d, base + thr, side="right")
    while (back := (j > 0) & (d[np.maximum(j - 1, 0)] - base > thr)).any():
        j[back] = np.searchsorted(d, d[j[back] - 1], side="left")
    last = len(d) - 1
    while (on := (j <= last) & ~(d[np.minimum(j, last)] - base > thr)).any():
        j[on] = np.searchsorted(d, d[j[on]], side="right")
    return j


def _chain_end(d: np.ndarray, base, thr) -> tuple[list[int], object]:
    """Firings of one delta chain over the ascending ``d`` with baseline ``base``;
    returns (firing indices, final base)."""
    fired, lo = [], 0
    while lo < len(d):
        j = lo + int(_first_over(d[lo:], base, thr)[0])
        if j >= len(d):
            break
        fired.append(j)
        base = d[j]
        lo = j + 1
    return fired, base


def _reach(base: np.ndarray, thr) -> np.ndarray:
    """Per baseline, the largest distance that does not fire yet, as the type computes it."""
    y = base + thr
    if y.dtype.kind == "f":
        while (over := y - base > thr).any():
            y[over] = np.nextafter(y[over], -np.inf)
        while (under := np.nextafter(y, np.inf) - base <= thr).any():
            y[under] = np.nextafter(y[under], np.inf)
    return y


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _pieces(batch: pa.RecordBatch):
    """``(from, to, starts)`` of every run of a group in the batch; the first
    row of a group carries ``_start``, so keys are never compared here."""
    start = _column(batch, "_start")
    edges = np.unique(np.r_[0, np.flatnonzero(start), batch.num_rows])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield a, b, bool(start[a])


def _fire_fold(out_cols: list[str], thr, seeded: bool):
    """Fold each group in sorted order: without a seed the first row sets the
    baseline and cannot fire; with a seed (``_seed``) every row may fire.
    Streams over Arrow batches carrying only the current group's baseline, so
    memory stays constant whatever a group's size."""

    def fold(batches):
        base = None
        for batch in batches:
            if not batch.num_rows:
                continue
            d = _column(batch, "_d")
            fired = np.zeros(batch.num_rows, dtype=bool)
            for a, b, starts in _pieces(batch):
                if starts:
                    base = batch.column("_seed")[a].as_py() if seeded else None
                    if base is None:
                        base, a = d[a], a + 1
                idx, base = _chain_end(d[a:b], base, thr)
                fired[np.asarray(idx, dtype=np.int64) + a] = True
            if fired.any():
                yield batch.select(out_cols).filter(pa.array(fired))

    return fold


def _groups(batches):
    """Whole groups (bounded: one chunk of a heavy key each) as Arrow tables."""
    pending = []
    for batch in batches:
        if not batch.num_rows:
            continue
        for a, b, starts in _pieces(batch):
            if starts and pending:
                yield pa.Table.from_batches(pending)
                pending = []
            pending.append(batch.slice(a, b - a))
    if pending:
        yield pa.Table.from_batches(pending)


def _candidate_fold(key: str, thr):
    """The step function of each chunk of a heavy key, from entry to exit baseline.

    A chunk is entered with a baseline within ``thr`` of the largest distance before it
    (``_dprev``), so its first firing is one of its new maxima up to the first that is more than
    ``thr`` beyond. All chains from these candidates are followed at once, by doubling steps. One
    row a run of candidates that share an exit: the run's largest candidate, the exit, and the
    largest distance that does not fire after it (``_reach``). The chunk with the key's first
    row has one exit (``_head``).
    """

    def fold(batches):
        for g in _groups(batches):
            d, dprev = g.column("_d").to_numpy(), g.column("_dprev")[0].as_py()
            if dprev is None:
                _, exit_base = _chain_end(d[1:], d[0], thr)
                cand = exits = np.array([exit_base], dtype=d.dtype)
            else:
                d = np.unique(d[d > dprev])
                after = _first_over(d, d, thr) if len(d) else np.zeros(0, np.int64)
                ends = np.where(after < len(d), after, np.arange(len(d)))
                for _ in range(len(d).bit_length()):
                    ends = ends[ends]
                limit = int(_first_over(d, np.array([dprev], dtype=d.dtype), thr)[0]) if len(d) else 0
                cand, exits = d[:limit + 1], d[ends][:limit + 1]
                # Exits are non-decreasing in the candidate: keep one row per run.
                last_of_run = np.r_[exits[1:] != exits[:-1], True][:len(exits)]
                cand, exits = cand[last_of_run], exits[last_of_run]
            if not len(cand):
                continue
            same = pa.array(np.zeros(len(cand), dtype=np.int64))
            first = g.slice(0, 1).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [first.column(key).take(same), first.column(CHUNK).take(same),
                 pa.array(np.full(len(cand), dprev is None)), pa.array(cand), pa.array(exits),
                 pa.array(_reach(exits, thr))],
                [key, CHUNK, "_head", "_cand", "_exit", "_reach"])

    return fold


def _checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _steps(runs: DataFrame, key: str, rows_per_chunk: int | None) -> DataFrame:
    """``key, v, to``: from each exit baseline of a chunk to that of the next chunk that fires.

    After the exit ``v`` the first distance beyond its reach fires. It is a new maximum of its chunk,
    hence among the candidates, which rise from chunk to chunk: the run is the first one, in the
    order of candidates, beyond the reach. One scan of runs and reaches in descending order finds
    it, with heavy keys cut along that order.
    """
    run = F.when(F.col("_kind") == 1, F.col("_exit"))
    asks = runs.select(key, F.col("_reach").alias("_val"), F.lit(0).alias("_kind"), "_exit")
    both = asks.unionByName(runs.where(~F.col("_head")).select(
        key, F.col("_cand").alias("_val"), F.lit(1).alias("_kind"), "_exit"))
    split = split_hot_keys(both, [key], "_val", rows_per_chunk)
    down = (Window.partitionBy(key, CHUNK).orderBy(F.desc("_val"), "_kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = split.df.withColumn("_to", F.last(run, ignorenulls=True).over(down))
    if split.split:
        lowest = split.df.groupBy(key, CHUNK).agg(F.min_by(run, F.when(F.col("_kind") == 1, F.col("_val"))).alias("_low"))
        later = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(1, Window.unboundedFollowing)
        lowest = lowest.select(key, CHUNK, F.first("_low", ignorenulls=True).over(later).alias("_later"))
        out = null_safe_join(out, lowest, [key, CHUNK], split.heavy_rows)
        out = out.withColumn("_to", F.coalesce("_to", "_later"))
    return out.where((F.col("_kind") == 0) & F.col("_to").isNotNull()).select(
        key, F.col("_exit").alias("_v"), "_to")


def _entry_baselines(runs: DataFrame, chunks: DataFrame, key: str, rows_per_chunk: int | None) -> DataFrame:
    """``key, _chunk, _seed``: the baseline that each chunk of a heavy key is entered with.

    The steps between chunks are composed with themselves in ``log2(chunks)`` joins; in each, the
    exits known to be passed from the key's first row on double in number.
    """
    longest = (runs.groupBy(key).agg(F.count_distinct(CHUNK).alias("n")).agg(F.max("n")).first()[0] or 0)
    jump = _checkpointed(_steps(runs, key, rows_per_chunk))
    passed = runs.where("_head").select(key, F.col("_exit").alias("_v"))
    same = lambda a, b: a[key].eqNullSafe(b["_k"])
    rounds = int(longest).bit_length()
    for r in range(rounds):
        on = jump.withColumnsRenamed({key: "_k", "_v": "_from"})
        passed = _checkpointed(passed.unionByName(
            passed.join(on, same(passed, on) & (passed["_v"] == on["_from"])).select(key, F.col("_to").alias("_v"))))
        if r + 1 < rounds:
            on = jump.withColumnsRenamed({key: "_k", "_v": "_from", "_to": "_end"})
            jump = _checkpointed(jump.join(on, same(jump, on) & (jump["_to"] == on["_from"])).select(
                key, "_v", F.col("_end").alias("_to")))
    at = runs.select(F.col(key).alias("_k"), F.col("_exit").alias("_from"), CHUNK)
    # One exit a chunk is passed.
    exits = passed.join(at, same(passed, at) & (passed["_v"] == at["_from"])).groupBy(key, CHUNK).agg(
        F.max("_v").alias("_v"))
    before = Window.partitionBy(key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    exits = exits.withColumnsRenamed({key: "_k", CHUNK: "_c"})
    known = chunks.join(exits, chunks[key].eqNullSafe(exits["_k"]) & (chunks[CHUNK] == exits["_c"]), "left")
    return known.select(key, CHUNK, F.last("_v", ignorenulls=True).over(before).alias("_seed"))


def _block_maxima(blocks: pa.Table, asked: pa.Table) -> pa.Table:
    """Of one key: the best row of the chunks ``_lo`` to ``_hi`` for each pair asked, by a sparse
    table over its chunks (one row each) in two look-ups a pair."""
    found = []
    if blocks.num_rows and asked.num_rows:
        blocks = blocks.take(pa.compute.sort_indices(blocks.column(CHUNK)))
        number = blocks.column(CHUNK).to_numpy()
        parts = [blocks.column(c).to_pylist() for c in ("v", "t", "i")]
        order = sorted(range(len(number)), key=lambda j: tuple((p[j] is not None, p[j] or 0) for p in parts))
        rank = np.empty(len(number), np.int64)
        rank[order] = np.arange(len(number))
        levels = [rank]
        while 2 << (len(levels) - 1) <= len(number):
            half = 1 << (len(levels) - 1)
            levels.append(np.maximum(levels[-1][:-half], levels[-1][half:]))
        a = np.searchsorted(number, asked.column("_lo").to_numpy(), "left")
        b = np.searchsorted(number, asked.column("_hi").to_numpy(), "right")
        keep = np.flatnonzero(b > a)
        for j in keep.tolist():
            k = int(b[j] - a[j]).bit_length() - 1
            found.append(order[int(max(levels[k][a[j]], levels[k][b[j] - (1 << k)]))])
        asked = asked.take(pa.array(keep))
    else:
        asked = asked.slice(0, 0)
    best = blocks.select(["v", "t", "i"]).take(pa.array(found, pa.int64()))
    for c in ("v", "t", "i"):
        asked = asked.append_column(c, best.column(c))
    return asked


def _frame_maxima(fired: DataFrame, rows: DataFrame, split: KeySplit, key: str, seq: str, evict_us: int) -> DataFrame:
    """``key, seq, _best``: for each firing row the best row of its eviction frame, whatever the
    number of chunks that the frame spans.

    A frame is the end of the chunk that it starts in, all of the chunks between, and the start of
    its own. One scan answers a question of each firing row for either end; the chunks between come
    from a table of one maximum a chunk. No row of the input is copied.
    """
    low = F.col("_us") - F.lit(evict_us - 1)
    fired = _checkpointed(chunk_of(null_safe_join(fired, split.heavy, [key], split.heavy_rows), low, "_lo", split.grid)
                          .drop(BOUNDS))
    # ids of checkpointed rows: a task that is run again gives the same ones
    fired = fired.withColumn("_row", F.monotonically_increasing_id())
    piece = F.pmod(CHUNK, F.lit(PIECES))
    best = F.struct(F.col("_m").alias("v"), (-F.col("_us")).alias("t"), (-F.col(seq)).alias("i"))
    carry = rows.select(key, CHUNK, F.col("_us").alias("_at"), best.alias("_best"), F.lit(None).cast("bigint").alias("_row"),
                        F.lit(None).cast(rows.schema[seq].dataType).alias(seq), F.lit(0).alias("_kind"))
    nothing = F.lit(None).cast(carry.schema["_best"].dataType).alias("_best")
    # An instant that is cut into pieces is in the frame as a whole: its pieces count as chunks between.
    starts = fired.where(piece == 0).select(key, CHUNK, F.col("_us").alias("_at"), nothing, "_row", seq, F.when(
        F.col("_lo") == F.col(CHUNK), 1).otherwise(2).alias("_kind"))
    ends = fired.where(F.col("_lo") != F.col(CHUNK)).select(
        key, F.col("_lo").alias(CHUNK), low.alias("_at"), nothing, "_row", seq, F.lit(3).alias("_kind"))
    # A frame inside one chunk has the length of a span of the clock: it is the end of one span and the
    # start of the next (or just one whole span). Both are running maxima, where a sliding frame
    # would read all of its rows again for each row.
    span_of = lambda at: at - F.pmod(at, F.lit(evict_us))
    tails = fired.where((piece == 0) & (F.col("_lo") == F.col(CHUNK)) & (span_of(low) < span_of(F.col("_us")))).select(
        key, CHUNK, low.alias("_at"), nothing, "_row", seq, F.lit(4).alias("_kind"))
    w = Window.partitionBy(key, CHUNK)
    timed = F.when(F.col("_at").isNotNull(), F.col("_best"))
    up_to = lambda w, order: w.orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    asked = carry.unionByName(starts).unionByName(ends).unionByName(tails).select(
        key, seq, CHUNK, "_row", "_kind", "_at", "_best", span_of(F.col("_at")).alias("_span"),
        F.max(timed).over(up_to(w, "_at")).alias("_to"), F.max(timed).over(up_to(w, F.desc("_at"))).alias("_from"))
    w = Window.partitionBy(key, CHUNK, "_span")
    asked = asked.select(
        key, seq, "_row", "_kind", "_to", "_from", F.max("_best").over(up_to(w, "_at")).alias("_span_to"),
        F.max("_best").over(up_to(w, F.desc("_at"))).alias("_span_from"))
    answers = asked.where(F.col("_kind") > 0).select(
        key, seq, "_row", F.when(F.col("_kind") == 1, F.col("_span_to")).when(F.col("_kind") == 2, F.col("_to"))
        .when(F.col("_kind") == 3, F.col("_from")).otherwise(F.col("_span_from")).alias("_best"))
    between = fired.where(F.col("_lo") < F.col(CHUNK)).select(
        key, seq, "_row", (F.col("_lo") + 1).alias("_lo"),
        F.when(piece == 0, F.col(CHUNK) - 1).otherwise(F.col(CHUNK) - piece + F.lit(PIECES - 1)).alias("_hi"))
    # One row a chunk, and at most two pairs a chunk: both ends of a frame move forward only.
    blocks = null_safe_join(rows.groupBy(key, CHUNK).agg(F.max(best).alias("_best")), split.heavy_keys, [key],
                            split.heavy_rows, "left_semi").select(key, CHUNK, "_best.*")
    pairs = between.select(key, "_lo", "_hi").distinct()
    kinds = {f.name: f.dataType.simpleString() for f in [*pairs.schema.fields, *blocks.schema.fields]}
    maxima = blocks.groupBy(key).cogroup(pairs.groupBy(key)).applyInArrow(
        _block_maxima, ", ".join(f"{c} {kinds[c]}" for c in (key, "_lo", "_hi", "v", "t", "i")))
    middle = null_safe_join(between, maxima, [key, "_lo", "_hi"], 2 * split.heavy_rows, "inner").select(
        key, seq, "_row", F.struct("v", "t", "i").alias("_best"))
    return answers.unionByName(middle).groupBy("_row", key, seq).agg(F.max("_best").alias("_best"))


def delta_trigger_max(df: DataFrame, key: str, ts: str, seq: str, measure: str,
                      distance: str, threshold: float, evict_us: int,
                      monotone: bool = False, rows_per_chunk: int | None = None) -> DataFrame:
    """W8 + A5: per key, fire whenever ``distance`` grew by more than
    ``threshold`` since the last firing row (the first row only sets the
    baseline); each firing emits the row with the largest ``measure`` among
    rows with ``ts > firing ts - evict`` (earliest such row on ties).

    Distances are compared in their own type: floating distances as doubles,
    integers and decimals as whole numbers of their unit (which must fit 64
    bits). A null or NaN distance neither fires nor moves the baseline, though
    its row can be a maximum; a null key is a key. Output: ``key, seq`` (firing
    row), ``top`` and ``top_id`` (the max row's measure and ``seq``), ``top_ts``.

    Distances may fall: a row fires only if it is further than all rows of its key before it, so the
    chain is that of the running maximum, and ``monotone`` (kept for its callers) changes nothing.

    Plan: the trigger chain is an ordered fold (``mapInArrow`` over sorted partitions) along the
    running maximum. Hot keys are cut into order chunks. Each chunk's step function from entry to
    exit baseline is found for all its possible entries at once, the functions are composed along
    the key, and the fold then runs on every chunk from its entry baseline. Frames are asked for the
    firing rows only, from block maxima.
    """
    kind = df.schema[distance].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        d, d_t, thr = F.nanvl(F.col(distance).cast("double"), F.lit(None)), "double", float(threshold)
    else:
        scale = kind.scale if isinstance(kind, DecimalType) else 0
        d, d_t = (F.col(distance) * F.lit(10**scale)).cast("bigint"), "bigint"
        # whole numbers exceed the threshold where they exceed its floor
        thr = math.floor(Decimal(str(threshold)).scaleb(scale))
    rows = df.select(key, seq, epoch_micros(ts).alias("_us"), F.col(measure).alias("_m"),
                     d.alias("_d"))
    split = split_hot_keys(rows, [key], "_us", rows_per_chunk, keep_bounds=True, tie=numeric_tie(rows, [seq]))
    key_t, seq_t = df.schema[key].dataType.simpleString(), df.schema[seq].dataType.simpleString()
    tagged = split.df.drop(BOUNDS)
    so_far = (Window.partitionBy(key, CHUNK).orderBy("_us", seq)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def ordered(frame: DataFrame) -> DataFrame:
        """Rows with a distance in group order, the first of each group flagged."""
        first = F.row_number().over(Window.partitionBy(key, CHUNK).orderBy("_us", seq)) == 1
        return (frame.where(F.col("_d").isNotNull()).withColumn("_start", first)
                .sortWithinPartitions(key, CHUNK, "_us", seq))

    if not split.split:
        best = F.max(F.struct(F.col("_m").alias("v"), (-F.col("_us")).alias("t"), (-F.col(seq)).alias("i")))
        frame = tagged.withColumn("_best", best.over(
            Window.partitionBy(key, CHUNK).orderBy("_us").rangeBetween(-(evict_us - 1), 0)))
        frame = frame.withColumn("_d", F.when(F.col("_d").isNotNull(), F.max("_d").over(so_far)))
        out_cols = [key, seq, "_m", "_t", "_i"]
        fired = ordered(frame.select(key, seq, CHUNK, "_us", "_d", F.col("_best.v").cast("double").alias("_m"),
                                     F.col("_best.t").alias("_t"), F.col("_best.i").alias("_i"))).mapInArrow(
            _fire_fold(out_cols, thr, False), f"{key} {key_t}, {seq} {seq_t}, _m double, _t bigint, _i {seq_t}")
        fired = fired.select(key, seq, F.struct(F.col("_m").alias("v"), F.col("_t").alias("t"), F.col("_i").alias("i")).alias("_best"))
    else:
        summary = tagged.groupBy(key, CHUNK).agg(F.max("_d").alias("_cmax"))
        prefix = chunk_prefix(split, summary, {"_dprev": F.max("_cmax")})
        far = attach_prefix(tagged.select(key, seq, CHUNK, "_us", "_d").withColumn("_in", F.max("_d").over(so_far)),
                            split, prefix, ["_dprev"])
        far = far.withColumn("_d", F.when(F.col("_d").isNotNull(), F.greatest("_in", "_dprev"))).drop("_in")
        heavy = null_safe_join(far, split.heavy_keys, [key], split.heavy_rows, "left_semi")
        runs = _checkpointed(ordered(heavy).mapInArrow(
            _candidate_fold(key, thr), f"{key} {key_t}, {CHUNK} bigint, _head boolean, _cand {d_t}, "
                                       f"_exit {d_t}, _reach {d_t}"))
        seeds = _entry_baselines(runs, prefix.select(key, CHUNK), key, rows_per_chunk)
        seeded = null_safe_join(far.drop("_dprev"), seeds, [key, CHUNK], split.heavy_rows)
        fired = ordered(seeded).mapInArrow(
            _fire_fold([key, seq, CHUNK, "_us"], thr, True), f"{key} {key_t}, {seq} {seq_t}, {CHUNK} bigint, _us bigint")
        fired = _frame_maxima(fired, tagged, split, key, seq, evict_us)
    return fired.select(key, seq, F.col("_best.v").cast("double").alias("top"), (-F.col("_best.i")).alias("top_id"),
                        F.timestamp_micros(-F.col("_best.t")).cast("timestamp_ntz").alias("top_ts"))
