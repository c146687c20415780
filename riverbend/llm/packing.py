"""Best-fit packing of documents into bins of fixed capacity, under conflicts.

Lengths are UTF-8 bytes plus one separator, what a byte-level model reads. A document longer
than a bin fills bins of its own; its remainder is packed like a short document. A bin may
hold at most one document of a source and one of a duplicate cluster (equal texts, or a
column of the caller's). Bins are kept in the order of their residual room, each with a
bitmap of its sources and one of its clusters; a document goes to the successor of its
length in that order, and on from there until the tightest compatible bin is found; if there
is none, it opens one. Documents come by descending length, ties by id and text hash.

Documents are dealt to groups of about ``group_docs`` by a hash of id and text, so a hot
source, or a cluster of a third of all rows, is spread over all groups, and a group is
packed in one task of bounded memory. A group of over twice as many, that repeated rows of one
id and text make, is dealt anew by row. The price is at most one fringe of open bins a group.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import written

CAPACITY, GROUP_DOCS = 16_384, 8_192


class Bins:
    """Open bins in the order of (residual, number)."""

    def __init__(self, capacity: int):
        self.capacity, self.order = capacity, []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.fill: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset in it) for a length of at most the capacity; ``source`` and
        ``cluster`` are bitmaps of one bit, or 0 for no conflict."""
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not self.sources[b] & source and not self.clusters[b] & cluster:
                del self.order[at]
                break
            at += 1
        else:
            b, residual = len(self.fill), self.capacity
            self.sources.append(0)
            self.clusters.append(0)
            self.fill.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        offset = self.fill[b]
        self.fill[b] += length
        if residual > length:
            insort(self.order, (residual - length, b))
        return b, offset


def pack_group(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Pieces ``(bin, offset, length)`` of each document, given in packing order.

    Bits are dealt to the sources and clusters of two or more documents; one that stands
    alone cannot conflict. A null source or cluster conflicts with nothing.
    """
    def bits(values: list) -> list[int]:
        often = {v: k for k, v in enumerate(v for v, n in Counter(values).items() if n > 1 and v is not None)}
        return [1 << often[v] if v in often else 0 for v in values]

    bins, out = Bins(capacity), []
    for length, source, cluster in zip(lengths, bits(sources), bits(clusters)):
        pieces = []
        for _ in range((length - 1) // capacity):  # full bins: no room, so no conflict either
            b = len(bins.fill)
            bins.fill.append(capacity)
            bins.sources.append(source)
            bins.clusters.append(cluster)
            pieces.append((b, 0, capacity))
        rest = length - capacity * len(pieces)
        out.append([*pieces, (*bins.place(rest, source, cluster), rest)])
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", cluster: Column | None = None) -> DataFrame:
    """Return ``doc_id, piece, bin, bin_offset, length, n_bytes, source, cluster``: a row for each
    piece of each document; ``bin`` is ``group-number``, ``length`` the piece's bytes.

    A null or empty text has length 1 (its separator). A null source conflicts with nothing;
    a null text has no cluster. Repeated rows are documents like any other, and being equal
    texts never share a bin. Null ids are packed too. Empty table: no rows. Only the named
    columns are read.
    """
    if capacity < 1 or group_docs < 1:
        raise ValueError("capacity and group_docs must be positive")
    h = F.xxhash64(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("n_bytes"), h.alias("h"),
        (F.when(F.col(text_col).isNotNull(), h) if cluster is None else cluster).alias("cluster"))
    groups = max(1, math.ceil(docs.count() / group_docs))
    rows = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "h", F.lit("pack")), F.lit(groups)).cast("int"))
    # Repeated rows of one id and text share their group: where they make it too large, its rows are numbered, written
    # once, and dealt to all groups by their number. At most one group in two is too large.
    large = written(rows.groupBy("g").count().where(F.col("count") > 2 * group_docs).select("g"), "large-groups")
    if groups > 1 and large.count():
        spread = written(rows.join(F.broadcast(large), "g", "left_semi").withColumn("at", F.monotonically_increasing_id()), "repeated")
        spread = spread.withColumn("g", F.pmod(F.xxhash64("at", F.lit("pack")), F.lit(groups)).cast("int")).drop("at")
        rows = rows.join(F.broadcast(large), "g", "left_anti").unionByName(spread.select(rows.columns))
    id_kind, source_kind = (rows.schema[c].dataType.simpleString() for c in ("doc_id", "source"))
    cluster_kind = rows.schema["cluster"].dataType.simpleString()

    def run(key: tuple, some: pa.Table) -> pa.Table:
        some = some.sort_by([("n_bytes", "descending"), ("doc_id", "ascending"), ("h", "ascending")])
        values = lambda c: [None if x != x else x for x in some.column(c).to_pylist()]
        found = pack_group(some.column("n_bytes").to_pylist(), values("source"), values("cluster"), capacity)
        flat = [p for pieces in found for p in pieces]
        out = some.take(pa.array([k for k, pieces in enumerate(found) for _ in pieces], pa.int64()))
        number = {"piece": pa.array([k for pieces in found for k in range(len(pieces))], pa.int32()),
                  "bin": pa.array([f"{key[0].as_py()}-{b}" for b, _, _ in flat], pa.string()),
                  "bin_offset": pa.array([o for _, o, _ in flat], pa.int64()),
                  "length": pa.array([x for _, _, x in flat], pa.int64())}
        names = ["doc_id", "piece", "bin", "bin_offset", "length", "n_bytes", "source", "cluster"]
        return pa.table([number[c] if c in number else out.column(c) for c in names], names=names)

    return rows.groupBy("g").applyInArrow(
        run, f"doc_id {id_kind}, piece int, bin string, bin_offset bigint, length bigint, n_bytes bigint, "
             f"source {source_kind}, cluster {cluster_kind}")
