"""File sources (S1, S4, S5, S6, S8), batch or streaming.

Every reader takes ``streaming=True`` to return a ``readStream`` source over
the same folder: a file stream is the replayable, fault-tolerant stand-in
for the reference's sockets and generator sources.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import from_epoch_millis
from ..functions.text import parse_key_millis, parse_tuple_text, try_parse_tuple_text

# Field order of the user-behaviour CSV and of the car tuples.
USER_BEHAVIOR_SCHEMA = ("userId bigint, itemId bigint, categoryId int, behavior string, "
                        "timestamp bigint")
CAR_FIELDS = [("car_id", "int"), ("speed", "int"), ("distance", "double"), ("ts", "bigint")]


def _reader(spark: SparkSession, streaming: bool, max_files: int | None = None):
    if not streaming:
        return spark.read
    r = spark.readStream
    return r.option("maxFilesPerTrigger", max_files) if max_files else r


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """S1 ``readTextFile``: one row per line, column ``value``. Lines end at a line feed;
    a carriage return before it belongs to the line's end, any other to the line."""
    lines = _reader(spark, streaming).option("lineSep", "\n").text(path)
    v = F.col("value")
    return lines.select(F.when(F.endswith(v, F.lit("\r")), v.substr(F.lit(1), F.length(v) - 1))
                        .otherwise(v).alias("value"))


def read_user_behavior(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """S4 typed CSV with a declared column order (no inference)."""
    return _reader(spark, streaming).schema(USER_BEHAVIOR_SCHEMA).option("mode", "FAILFAST") \
        .csv(path)


def read_car_text(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """``(id,speed,distance,ts)`` lines to typed columns."""
    parsed = read_lines(spark, path, streaming).select(
        parse_tuple_text("value", CAR_FIELDS).alias("t"))
    return parsed.select("t.*")


def read_car_text_tolerant(spark: SparkSession, path: str, streaming: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: the lines that parse, typed, and the others as ``value``.
    Every line is in one of the two."""
    parsed = read_lines(spark, path, streaming).withColumn("t", try_parse_tuple_text("value", CAR_FIELDS))
    return parsed.where("t is not null").select("t.*"), parsed.where("t is null").select("value")


def read_key_millis(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """``key,millis`` lines to ``key, ts_ms`` plus an event-time column."""
    parsed = read_lines(spark, path, streaming).select(parse_key_millis("value").alias("t"))
    return parsed.select("t.*").withColumn(
        "ts", from_epoch_millis("ts_ms"))


def read_or_default(spark: SparkSession, reader: Callable[[SparkSession, str], DataFrame],
                    path: str | None, default: Callable[[], DataFrame]) -> DataFrame:
    """The job parameter picks a file for ``reader``, else ``default`` makes the rows."""
    return reader(spark, path) if path else default()


def text_or_default(spark: SparkSession, path: str | None, default: list[str]) -> DataFrame:
    """S8 for lines: the file, else the built-in sample lines."""
    return read_or_default(spark, read_lines, path,
                           lambda: spark.createDataFrame([(x,) for x in default], "value string"))
