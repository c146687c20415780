"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.session import checkpoint_path

#: The white space that separates words: space, tab, line feed, vertical tab, form feed,
#: carriage return. Python's ``bytes.split()`` cuts at the same six.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder named by ``spark.checkpoint.dir``.

    Cuts the lineage: a lost executor costs the tasks it ran, not the stages before.
    """
    spark = df.sparkSession
    path = checkpoint_path(spark, f"riverbend-llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of plain values, bounded by the caller's parameters."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    kind = f"array<struct<{', '.join(':'.join(c.strip().split(' ', 1)) for c in schema.split(','))}>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), kind)))


def held_out(doc_id: str, modulus: int, remainder: int):
    """crc32 of the id written as text, modulo ``modulus``, equals ``remainder`` (null id: no)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))
