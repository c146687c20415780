"""Projections, filters and routing.

All of these are narrow (no shuffle) and work unchanged on streaming
DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NON_WORD, java_split

TAGS = "tags"


def tag_rows(df: DataFrame, selector: Column, tags_col: str = TAGS) -> DataFrame:
    """P8 split: attach the output names of every row (``array<string>``).

    ``selector`` is an ``array<string>`` expression, the column form of an
    ``OutputSelector``; a row may carry zero, one or several names.
    """
    return df.withColumn(tags_col, selector)


def even_odd_selector(value: str | Column) -> Column:
    """The reference's selector: ``even`` when ``value % 2 == 0`` else ``odd``
    (Java and Spark both give ``-1 % 2 == -1``, so negatives are odd)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.array(F.when(v % 2 == 0, F.lit("even")).otherwise(F.lit("odd")))


def select_tags(df: DataFrame, *names: str, tags_col: str = TAGS) -> DataFrame:
    """P9/P10 select: rows carrying any of ``names``, each row at most once
    (never a union of per-name branches, which would duplicate rows)."""
    if len(names) == 1:
        return df.where(F.array_contains(tags_col, names[0]))
    wanted = F.array(*[F.lit(n) for n in names])
    return df.where(F.arrays_overlap(F.col(tags_col), wanted))


def side_output(tokens: DataFrame, token_col: str = "word", max_len: int = 5,
                prefix: str = "rejected: ") -> tuple[DataFrame, DataFrame]:
    """P11 + P1 + P6: split a token stream into the main output (length
    1..``max_len``) and the ``rejected`` side output (longer tokens, mapped to
    ``prefix + token``). Empty tokens go nowhere.

    Both outputs are complementary filters over the same parent; to write
    both from one pass, feed them to ``sinks.fan_out`` (one cached parent or
    one ``foreachBatch``).
    """
    n = F.length(token_col)
    main = tokens.where((n > 0) & (n <= max_len))
    rejected = tokens.where(n > max_len).withColumn(
        token_col, F.concat(F.lit(prefix), F.col(token_col)))
    return main, rejected


def connect_flat(numbers: DataFrame, number_col: str, texts: DataFrame, text_col: str,
                 out_col: str = "value", pattern: str = NON_WORD) -> DataFrame:
    """J1 connect + co-flatMap: numbers become their decimal string, texts
    become their ``pattern`` tokens (Java split: case kept, leading empty
    kept), and both land in one ``string`` stream."""
    left = numbers.select(F.col(number_col).cast("string").alias(out_col))
    right = texts.select(F.explode(java_split(F.col(text_col), pattern)).alias(out_col))
    return left.unionByName(right)
