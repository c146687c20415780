"""Sinks (K1-K4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_tuple


def write_delimited(df: DataFrame, path: str, field_sep: str = " ", mode: str = "overwrite"):
    """K1 ``writeAsCsv(path, "\\n", " ")``: rows on lines, fields by ``field_sep``.

    Fields are written raw, without quotes; a null field is empty."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(field_sep, *fields).alias("value")).write.mode(mode).text(path)


def tuple_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """K2 rendering: one ``(a,b,c)`` line per row, as a Java tuple prints."""
    return df.select(format_tuple(*(cols or df.columns)).alias("value"))


def write_text(df: DataFrame, path: str, mode: str = "overwrite"):
    """K2 ``writeAsText``: one line per row (tuples rendered by ``tuple_text``)."""
    out = df if df.columns == ["value"] else tuple_text(df)
    out.write.mode(mode).text(path)


def show(df: DataFrame, n: int = 20):
    """K3 console sink for batch; streams use ``writeStream.format("console")``."""
    df.show(n, truncate=False)


def fan_out(parent: DataFrame, branches: dict[str, Callable[[DataFrame], DataFrame]],
            writers: dict[str, Callable[[DataFrame], None]]):
    """K4 (batch): one job, several sinks, one computation of the parent.

    The parent is persisted (memory and disk, so it spills instead of
    failing) for the duration of the writes, then released.
    """
    cached = parent.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, branch in branches.items():
            writers[name](branch(cached))
    finally:
        cached.unpersist()


def fan_out_stream(branches: dict[str, Callable[[DataFrame], DataFrame]],
                   writers: dict[str, Callable[[DataFrame, int], None]]):
    """K4 (streaming): a ``foreachBatch`` function writing every branch of
    each micro-batch from one persisted copy of it.

    Writers receive ``(branch_df, epoch_id)``: a micro-batch can be replayed
    after a failure, so a writer should key its output by the epoch (e.g.
    overwrite ``path/epoch=<id>``) to stay exactly-once.
    """

    def run(batch: DataFrame, epoch_id: int):
        fan_out(batch, branches, {k: (lambda w: (lambda d: w(d, epoch_id)))(w)
                                  for k, w in writers.items()})

    return run
