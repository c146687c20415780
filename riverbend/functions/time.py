"""Epoch/time helpers. The session zone is UTC (see ``session.py``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reference prints instants with this pattern.
MILLIS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSS"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros(col: str | Column) -> Column:
    """Microseconds since epoch of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(_c(col).cast("timestamp"))


def from_epoch_seconds(col: str | Column) -> Column:
    """Epoch seconds (the CSV ``timestamp`` field) to an NTZ timestamp."""
    return F.timestamp_seconds(_c(col)).cast("timestamp_ntz")


def from_epoch_millis(col: str | Column) -> Column:
    return F.timestamp_millis(_c(col)).cast("timestamp_ntz")


def to_epoch_seconds(col: str | Column) -> Column:
    return F.unix_seconds(_c(col).cast("timestamp"))


def to_epoch_millis(col: str | Column) -> Column:
    return F.unix_millis(_c(col).cast("timestamp"))


def to_event_time(col: str | Column) -> Column:
    """``withWatermark`` needs TIMESTAMP (not NTZ); with a UTC session the
    cast is the identity on the wall clock."""
    return _c(col).cast("timestamp")


def format_millis(col: str | Column) -> Column:
    return F.date_format(_c(col), MILLIS_PATTERN)
