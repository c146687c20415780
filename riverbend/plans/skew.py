"""Hot-key splitting for ordered per-key scans.

Many operators of the reference are ordered folds per key: running counts
(count triggers), islands (session windows), a running maximum (watermarks)
or "latest value so far" (broadcast rule updates). The plain Spark form is
``Window.partitionBy(key).orderBy(t)``, which sends every row of a key to one
task. With a key that holds a third of all rows (five ``event_type`` values,
or "the whole table" for a global order) that task is the job.

``split_hot_keys`` keeps one task per light key but cuts each *heavy* key
(more rows than one task should take) into contiguous chunks along the order
column (and, where one instant alone is that large, along the next column of the
order), using approximate quantiles. Scans then run per ``(key, _chunk)`` and
a per-chunk summary, whose size is bounded by the number of chunks (not by the
data), carries the state from earlier chunks forward: the classic two-pass
parallel prefix. Chunks are contiguous in the order, so the combine is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
BOUNDS = "_bounds"
# Chunk numbers are multiples of this; the pieces of an instant that is cut follow its chunk's.
PIECES = 1 << 20

ROWS_PER_CHUNK_CONF = "riverbend.scan.rowsPerChunk"
BROADCAST_ROWS_CONF = "riverbend.broadcast.maxRows"

# Rows of one key that one task scans. It depends on neither the table nor the
# cluster, so a task's work is the same at every size; the results do not
# depend on it at all.
DEFAULT_ROWS_PER_CHUNK = 100_000
DEFAULT_BROADCAST_ROWS = 2_000_000


_CACHED: ContextVar[list[DataFrame] | None] = ContextVar("cached_split_tables", default=None)


@contextmanager
def released() -> Iterator[None]:
    """Free the key counts and bounds that splits inside the block have cached, once it
    ends: for callers that also run the result there, such as the sink of a micro-batch."""
    token = _CACHED.set([])
    try:
        yield
    finally:
        for df in _CACHED.get():
            df.unpersist()
        _CACHED.reset(token)


def _cached(df: DataFrame) -> DataFrame:
    if _CACHED.get() is not None:
        _CACHED.get().append(df)
    return df.persist()


@dataclass
class KeySplit:
    """Input rows tagged with ``_chunk`` plus the heavy-key boundary table.

    ``heavy`` is ``None`` when no key needs splitting; every row then has
    ``_chunk = 0`` and callers skip the prefix combine entirely.
    """

    df: DataFrame
    keys: list[str]
    heavy: DataFrame | None
    heavy_rows: int
    heavy_keys: DataFrame | None = None
    grid: int = 1

    @property
    def split(self) -> bool:
        return self.heavy is not None


def _conf_int(spark, name: str, default: int | None) -> int | None:
    v = spark.conf.get(name, None)
    return int(v) if v not in (None, "") else default


def checked_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` only if its known row count is under the limit.

    Callers pass a row count they computed (or bounded) themselves; above the
    limit the join stays a shuffle join, which is slower but always fits.
    """
    limit = _conf_int(df.sparkSession, BROADCAST_ROWS_CONF, DEFAULT_BROADCAST_ROWS)
    return F.broadcast(df) if rows <= limit else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], right_rows: int,
                   how: str = "left") -> DataFrame:
    """Join on ``keys`` with null equal to null; ``right`` has at most
    ``right_rows`` rows and is broadcast under a checked bound."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    renamed = checked_broadcast(right.withColumnsRenamed(names), right_rows)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(renamed, on, how).drop(*names.values())


def split_hot_keys(df: DataFrame, keys: list[str], order: str | Column,
                   rows_per_chunk: int | None = None, keep_bounds: bool = False,
                   tie: str | Column | None = None) -> KeySplit:
    """Tag rows with ``_chunk`` so that no ``(keys, _chunk)`` group is huge.

    ``order`` must be numeric or a timestamp. Chunk numbers (bigint) rise along
    ``(order, tie)``; without ``tie`` rows with equal ``order`` land in the same
    chunk. ``tie``, numeric too, is the next column of the caller's sort order:
    with it an instant of a heavy key that alone has more than
    ``rows_per_chunk`` rows is cut into pieces along it (rows whose tie is null
    come first). Rows that tie in both stay together.
    A key is heavy when it has more than ``rows_per_chunk`` rows (by default
    ``riverbend.scan.rowsPerChunk``, or 100,000). A null key is a key.
    """
    spark = df.sparkSession
    order_c = F.col(order) if isinstance(order, str) else order
    # Per-key counts are small next to the rows; cache them so the stats and
    # the heavy-key lookup below share one scan of the input.
    counts = _cached(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    stats = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("top"),
                       F.count(F.lit(1)).alias("nkeys")).first()
    total, top = int(stats["total"] or 0), int(stats["top"] or 0)
    if rows_per_chunk is None:
        rows_per_chunk = _conf_int(spark, ROWS_PER_CHUNK_CONF, DEFAULT_ROWS_PER_CHUNK)
    if top <= rows_per_chunk:
        counts.unpersist()
        return KeySplit(df.withColumn(CHUNK, F.lit(0).cast("bigint")), keys, None, 0)

    grid = math.ceil(top / rows_per_chunk)
    # Every heavy key holds more than rows_per_chunk rows, so there are at
    # most total // rows_per_chunk of them: a proven bound on the heavy table
    # (about the partition count, not the data), with no job to count it.
    heavy_keys = counts.where(F.col("_n") > rows_per_chunk).select(*keys)
    n_heavy = max(1, total // rows_per_chunk)
    sample_src = null_safe_join(df, heavy_keys, keys, n_heavy, "left_semi") if keys else df
    heavy = _cached(sample_src.groupBy(*keys).agg(_quantiles(order_c, grid).alias(BOUNDS)))
    heavy_rows = n_heavy * grid
    tagged = _tag(df, keys, order_c, heavy, heavy_rows, grid)
    if tie is not None:
        tie_c = F.col(tie) if isinstance(tie, str) else tie
        tagged, pieces = _cut_instants(tagged, keys, order_c, tie_c, rows_per_chunk, n_heavy)
        heavy_rows += pieces
    return KeySplit(tagged if keep_bounds else tagged.drop(BOUNDS), keys, heavy, heavy_rows, heavy_keys, grid)


def _quantiles(col: Column, parts: int) -> Column:
    probs = [i / parts for i in range(1, parts)]
    return F.array_distinct(F.percentile_approx(col, probs, max(10_000, 20 * parts)))


def _cut_instants(tagged: DataFrame, keys: list[str], order_c: Column, tie_c: Column, rows_per_chunk: int,
                  n_heavy: int) -> tuple[DataFrame, int]:
    """Give the rows of an instant with more than ``rows_per_chunk`` rows chunk numbers of their
    own, after those of the rows before it. Such an instant covers a quantile of its key, so it is
    one of the bounds and ends its chunk: only rows on a bound have to be counted."""
    on_bound = F.coalesce(F.get(BOUNDS, (F.col(CHUNK) / PIECES).cast("int")) == order_c, F.lit(False))
    rows = tagged.where(on_bound)
    counts = _cached(rows.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n")))
    top = counts.agg(F.max("_n")).first()[0] or 0
    if top <= rows_per_chunk:
        counts.unpersist()
        return tagged, 0
    parts = math.ceil(top / rows_per_chunk)
    crowded = counts.where(F.col("_n") > rows_per_chunk).select(*keys, CHUNK)
    inside = null_safe_join(rows, crowded, [*keys, CHUNK], n_heavy, "left_semi")
    ties = _cached(inside.groupBy(*keys, CHUNK).agg(_quantiles(tie_c, parts).alias("_ties")))
    out = null_safe_join(tagged, ties, [*keys, CHUNK], n_heavy)
    out = count_below(out, "_ties", tie_c, "_piece", parts)
    cut = on_bound & F.col("_ties").isNotNull()
    # at most n_heavy instants have that many rows
    return (out.withColumn(CHUNK, F.when(cut, F.col(CHUNK) + 1 + F.col("_piece")).otherwise(F.col(CHUNK)))
            .drop("_ties", "_piece"), n_heavy * parts)


def count_below(df: DataFrame, bounds: str, order_c: Column, out: str, max_len: int) -> DataFrame:
    """``out`` = number of elements of the ascending array ``bounds`` that
    are ``< order`` (0 for no array): a branch-free binary search in ``log2(max_len)``
    steps, so the per-row cost is logarithmic in the chunk count. The steps are one
    fold over their widths, an expression that stays small wherever Catalyst copies it."""
    n = F.size(bounds)

    def step(below: Column, width: Column) -> Column:
        ask = below + width
        return F.when((ask <= n) & (F.get(bounds, F.least(ask, n) - 1) < order_c), ask).otherwise(below)

    widths = F.lit([1 << k for k in reversed(range(max(1, max_len.bit_length())))])
    return df.withColumn(out, F.reduce(widths, F.lit(0), step))


def _tag(df: DataFrame, keys: list[str], order_c: Column, heavy: DataFrame,
         heavy_rows: int, grid: int) -> DataFrame:
    # Chunk = number of boundaries strictly below the row's order value:
    # monotone in the order, so chunks are contiguous runs of it.
    if keys:
        joined = null_safe_join(df, heavy, keys, heavy_rows)
    else:
        # One global key: the boundary table is a single row, attached as a
        # scalar subquery rather than a join.
        joined = df.withColumn(BOUNDS, heavy.select(BOUNDS).scalar())
    return chunk_of(joined, order_c, CHUNK, grid)


def chunk_of(df: DataFrame, order_c: Column, out: str, grid: int) -> DataFrame:
    """``out`` = the chunk (without pieces of an instant) that ``order_c`` belongs to."""
    df = count_below(df, BOUNDS, order_c, out, grid)
    return df.withColumn(out, F.when(F.col(BOUNDS).isNull(), F.lit(0)).otherwise(F.col(out)).cast("bigint")
                         * F.lit(PIECES))


def chunk_prefix(split: KeySplit, summary: DataFrame,
                 combine: dict[str, Column]) -> DataFrame | None:
    """Carry-in state for every chunk of every heavy key.

    ``summary`` has one row per ``(keys, _chunk)`` (computed by the caller
    from the tagged rows); ``combine`` maps output names to aggregate columns
    evaluated over all *earlier* chunks of the same key, e.g.
    ``{"_carry_n": F.sum("n")}``. Returns ``None`` when nothing was split.
    The result has at most ``heavy_rows`` rows.
    """
    if not split.split:
        return None
    keys = split.keys
    heavy_summary = summary
    if keys:
        heavy_summary = null_safe_join(summary, split.heavy_keys, keys, split.heavy_rows,
                                       "left_semi")
    # One row per chunk of a heavy key.
    w = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    out = heavy_summary.select(*keys, CHUNK,
                               *[agg.over(w).alias(name) for name, agg in combine.items()])
    return out


def attach_prefix(rows: DataFrame, split: KeySplit, prefix: DataFrame | None,
                  names: list[str]) -> DataFrame:
    """Left-join the carry-in columns onto the rows (nulls when not split)."""
    if prefix is None:
        for n in names:
            rows = rows.withColumn(n, F.lit(None))
        return rows
    return null_safe_join(rows, prefix, [*split.keys, CHUNK], split.heavy_rows)
