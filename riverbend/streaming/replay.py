"""Replay a table as a file stream (the fault-tolerant stand-in for the
reference's sockets and generator sources).

A bounded source in the reference ends with a maximal watermark, so every
window fires. A Spark stream keeps its last windows open, so the replay
appends "flush" rows far in the future under a dedicated key; they close
every window and are dropped *after* the sink (a filter on them inside the
plan can keep a window open).
"""

from __future__ import annotations

import math
import os
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..plans.skew import count_below
from ..session import checkpoint_path

FLUSH_YEARS = 100


# Rows of one file of a replayed range; a micro-batch reads a range.
ROWS_PER_FILE, FILES_PER_BATCH = 250_000, 1_000
TEXT_PER_BATCH = 64 << 20  # bytes


class Replay(NamedTuple):
    """A replayed table: its folder, and how many files make one micro-batch."""

    root: str
    files: int


def replay_files(df: DataFrame, order: str, ranges: int, name: str,
                 flush: list[DataFrame] | None = None, least_files: int = 1, text: str | None = None) -> Replay:
    """Write ``df`` as at least ``ranges`` consecutive ranges of ``order``
    (each its own folder, written in order so modification times follow the
    data), then the ``flush`` rows as the last file(s), inside the shared
    checkpoint folder.

    Every range is written by as many tasks as it has files, the same number
    for each range, so that a micro-batch is one whole range; a table with
    more rows than ``FILES_PER_BATCH`` files a range hold gets more ranges. A file is one task of
    its micro-batch: ``least_files`` a range spread long rows over more of them.
    With ``text``, a string column that the stream cuts into words, a range holds about
    ``TEXT_PER_BATCH`` bytes of it: the state of a micro-batch is then bounded at every size of the table.
    The driver loops over ranges, not over data. Where there are more of them than asked for, the rows
    are dealt to them once, so that the table is not read for each.
    """
    spark = df.sparkSession
    root = checkpoint_path(spark, f"replay/{name}-{uuid.uuid4().hex[:8]}")
    size = df.agg(F.count(F.lit(1)).alias("n"),
                  (F.sum(F.octet_length(text)) if text else F.lit(0)).alias("bytes")).first()
    total, asked = size["n"], ranges
    ranges = max(ranges, math.ceil(total / (ROWS_PER_FILE * FILES_PER_BATCH)),
                 math.ceil((size["bytes"] or 0) / TEXT_PER_BATCH))
    files = max(least_files, math.ceil(total / (ranges * ROWS_PER_FILE)))
    # Ranges only need to be contiguous, not equal.
    bounds = df.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.04 / ranges) \
        if ranges > 1 else []
    if ranges > asked:
        bounds = sorted(set(bounds))
        return _written(root, _dealt(df, order, bounds, f"{root}-dealt", files), files, flush)
    edges = [None, *bounds, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = df if low is None else df.where(F.col(order) > F.lit(low))
        up_to = F.col(order) <= F.lit(high)
        if low is None:  # rows without order come first
            up_to = up_to | F.col(order).isNull()
        parts.append(part if high is None else part.where(up_to))
    return _written(root, parts, files, flush)


def _dealt(df: DataFrame, order: str, bounds: list[float], root: str, files: int) -> list[DataFrame]:
    """The rows of each range, from a folder of its own that one pass over the table writes."""
    number = count_below(df.withColumn("_bounds", F.lit([float(b) for b in bounds])), "_bounds", F.col(order), "_range",
                         len(bounds)).drop("_bounds")
    (number.repartition(files * (len(bounds) + 1), "_range", F.pmod(F.xxhash64(order), F.lit(files)))
     .write.partitionBy("_range").parquet(root))
    dealt = df.sparkSession.read.schema(StructType([*df.schema.fields, StructField("_range", IntegerType())])).parquet(root)
    return [dealt.where(F.col("_range") == i).drop("_range") for i in range(len(bounds) + 1)]


def replay_batches(df: DataFrame, batch: str, batches: int, name: str,
                   flush: list[DataFrame] | None = None) -> Replay:
    """Write ``df`` as the micro-batches that its column ``batch`` numbers from 0 (all of them
    with rows; a null number counts as 0), then the ``flush`` rows: for rules that depend on
    where batches end."""
    root = checkpoint_path(df.sparkSession, f"replay/{name}-{uuid.uuid4().hex[:8]}")
    files = max(1, math.ceil(df.count() / (batches * ROWS_PER_FILE)))
    parts = [df.where(F.coalesce(F.col(batch), F.lit(0)) == i).drop(batch) for i in range(batches)]
    return _written(root, parts, files, flush)


def _written(root: str, parts: list[DataFrame], files: int, flush: list[DataFrame] | None) -> Replay:
    # Dealt in turn: every task of a part gets rows and writes one file. Flush files go last:
    # they move the watermark past every window, and Spark then runs a no-data batch with
    # that watermark, closing them.
    for i, part in enumerate([*(p.repartition(files) for p in parts), *(flush or [])]):
        part.write.mode("overwrite").parquet(os.path.join(root, f"{i:05d}"))
    return Replay(root, files)


def stream_folder(spark: SparkSession, replay: Replay, schema) -> DataFrame:
    """Read a replayed table as a stream, one range per micro-batch, in
    modification-time order."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", replay.files)
            .option("recursiveFileLookup", "true").parquet(replay.root))


def flush_rows(like: DataFrame, ts: str, overrides: dict, years: int = FLUSH_YEARS) -> DataFrame:
    """One row shaped like ``like`` with ``ts`` ``years`` after the latest
    event and the columns in ``overrides`` set (to a key no real row uses)."""
    row = like.agg(F.max(ts).alias(ts))
    cols = []
    for f in like.schema.fields:
        if f.name == ts:
            cols.append((F.col(ts) + F.expr(f"INTERVAL {years * 365} DAYS"))
                        .cast(f.dataType).alias(ts))
        elif f.name in overrides:
            cols.append(F.lit(overrides[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return row.select(*cols)
