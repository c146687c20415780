"""A user's table function over the ordered partitions of a table.

``apply_table`` runs a handler as an Arrow table function over ``TABLE(df) PARTITION BY ... ORDER
BY ...``: set up once a partition, then given the partition's rows in order, batch by batch, so it
can keep state across them in constant memory. Its result has the columns of the input
and those that it adds, whatever the input's schema is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.skew import CHUNK, attach_prefix, chunk_prefix, split_hot_keys
from .time import epoch_micros


class TableFunction:
    """What a user writes. A new object is made for every partition."""

    def rows(self, batch: pa.RecordBatch) -> list[pa.Array]:
        """The added columns for the next rows of the partition."""
        raise NotImplementedError


def apply_table(df: DataFrame, make: Callable[[], TableFunction], partition_by: list[str], order_by: list[str],
                adds: str) -> DataFrame:
    """``df`` with the columns ``adds`` (a schema string) that ``make()``'s objects compute."""
    added = StructType.fromDDL(adds)
    names = [*df.columns, *added.fieldNames()]
    kinds = StructType([*df.schema.fields, *added.fields])

    class Handler:
        def __init__(self) -> None:
            self.function = make()

        def eval(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, *self.function.rows(batch)], names)

    table = df.asTable().partitionBy(*partition_by)
    return F.arrow_udtf(Handler, returnType=kinds)(table.orderBy(*order_by))


class Gaps(TableFunction):
    """Microseconds since the row before, over batches; the first row's since ``_carry``."""

    def __init__(self) -> None:
        self.last = None

    def rows(self, batch: pa.RecordBatch) -> list[pa.Array]:
        us = batch.column("_us").combine_chunks() if isinstance(batch.column("_us"), pa.ChunkedArray) else batch.column("_us")
        if self.last is None:
            self.last = batch.column("_carry")[0].as_py()
        before = pa.concat_arrays([pa.array([self.last], pa.int64()), us.slice(0, len(us) - 1)])
        self.last = us[len(us) - 1].as_py()
        return [pc.subtract(us, before)]


def event_gaps(df: DataFrame, key: str, ts: str, seq: str, rows_per_chunk: int | None = None) -> DataFrame:
    """``key, seq, gap_us``: the time from a key's row to its row before, null for the first.

    Rows without time are left out. A hot key is cut along ``(ts, seq)``; each chunk is a partition of
    the table function and gets the last time of the chunks before as ``_carry``.
    """
    rows = df.select(key, F.col(seq).cast("bigint").alias(seq), epoch_micros(ts).alias("_us")).where("_us is not null")
    split = split_hot_keys(rows, [key], "_us", rows_per_chunk, tie=seq)
    last = split.df.groupBy(key, CHUNK).agg(F.max("_us").alias("_last"))
    prefix = chunk_prefix(split, last, {"_carry": F.max("_last")})
    carried = attach_prefix(split.df, split, prefix, ["_carry"]).withColumn("_carry", F.col("_carry").cast("bigint"))
    return apply_table(carried, Gaps, [key, CHUNK], ["_us", seq], "gap_us bigint").select(key, seq, "gap_us")
