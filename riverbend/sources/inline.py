"""Inline collections and sequences."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_elements(spark: SparkSession, values: Iterable, schema: str = "value string") -> DataFrame:
    """S2 ``fromElements``: a small literal collection (tests, fixtures)."""
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    return spark.createDataFrame(rows, schema)


def sequence(spark: SparkSession, start: int, end: int, col: str = "value") -> DataFrame:
    """S3 ``generateSequence(start, end)``: both ends inclusive, distributed
    (``spark.range`` generates each partition's slice on its executor)."""
    return spark.range(start, end + 1).withColumnRenamed("id", col)


def timestamped_events(df: DataFrame, ts_millis: str, out: str = "ts",
                       delay: str | None = None) -> DataFrame:
    """Rows carrying their own event time (epoch millis) as a timestamp. With ``delay``
    the watermark of L1-L3 is attached, and the column is a TIMESTAMP, as Spark asks for."""
    ts = F.timestamp_millis(ts_millis)
    if delay is None:
        return df.withColumn(out, ts.cast("timestamp_ntz"))
    return df.withColumn(out, ts).withWatermark(out, delay)
