"""Top-N per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of every group in ``order``; rank from 0.

    ``order`` must end in a unique column so ties are deterministic (the
    reference breaks ties by arrival). ``row_number() < n`` lets Catalyst
    insert a partial ``WindowGroupLimit`` before the shuffle, so at most
    ``n`` rows per group and map task cross the network even for a group
    that holds most of the data.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    # The filter must sit directly on row_number() for Catalyst to infer the
    # WindowGroupLimit; the 0-based rank is derived afterwards.
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n)
            .withColumn(rank_col, (F.col("_rn") - 1).cast("int"))
            .drop("_rn"))


def hot_items(counts: DataFrame, n: int = 3, item: str = "item_id",
              count: str = "view_count", window_end: str = "window_end") -> DataFrame:
    """The ``n`` most viewed items of every window, by count then item."""
    ranked = top_n_per_group(counts, [window_end],
                             [F.col(count).desc(), F.col(item).asc()], n)
    return ranked.select(window_end, "rank", item, count)
