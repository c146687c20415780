"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard stands at ``vnodes`` points of a ring of 63-bit positions, each row at the
position of its id's hash. A row belongs to the first point clockwise whose shard has room.
The bound of a shard is its even share of the rows (the first ``rows mod shards`` shards
take one more), so counts differ by at most one, and only what overflows leaves the place
that a plain ring would give it.

All rows of an arc (the stretch before one point) meet the same points in the same order,
so the overflow is settled on the counts of the arcs, ``shards * vnodes`` numbers whatever
the input. Rows are then ranked inside their arc, in cells of about ``cell_rows`` rows, and
a rank names the shard and the slot. Everything on the rows is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverbend.llm.common import literal_table, written

SHARDS, VNODES, CELL_ROWS = 16, 128, 10_000
TAG = "riverbend"  # names the ring's points


def _position(*cols) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def ring(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every point, in order; depends on the parameters alone."""
    points = spark.range(shards * vnodes).select(
        F.floor(F.col("id") / vnodes).cast("int").alias("s"), (F.col("id") % vnodes).cast("int").alias("v"))
    return sorted((r["p"], r["s"]) for r in
                  points.select(_position(F.lit(TAG), "s", "v").alias("p"), "s").collect())


def settle(counts: list[int], owners: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Deal the arcs' counts out: (arc, first rank, end, shard, first slot) for each piece.

    Arcs are visited clockwise. In a round each arc offers what it has left to the next
    point with room; a shard takes offers in the order of the arcs until it is full.
    """
    total, n = sum(counts), len(owners)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled, taken, pieces = [0] * shards, [0] * n, []
    at = list(range(n))  # the point each arc asks next
    open_arcs = [a for a in range(n) if counts[a]]
    while open_arcs:
        for a in open_arcs:
            while filled[owners[at[a]]] == room[owners[at[a]]]:
                at[a] = (at[a] + 1) % n
        for a in open_arcs:
            s = owners[at[a]]
            k = min(counts[a] - taken[a], room[s] - filled[s])
            if k:
                pieces.append((a, taken[a], taken[a] + k, s, filled[s]))
                taken[a], filled[s] = taken[a] + k, filled[s] + k
        open_arcs = [a for a in open_arcs if taken[a] < counts[a]]
    return pieces


def _arc(position: Column, points: list[int]) -> Column:
    """Number of points below the position, at the end of the ring again the first: a binary
    search over a constant array."""
    array = F.lit(points)
    found, size = F.lit(0), len(points)

    def jump(by: int):
        # Must take one argument: a second one, even with a default, would receive the array index.
        def step(below: Column) -> Column:
            ask = below + F.lit(by)
            return F.when((ask <= size) & (F.get(array, F.least(ask, F.lit(size)) - 1) < position), ask).otherwise(below)
        return step

    for k in reversed(range(size.bit_length())):
        # a one-element array keeps each step from being copied into the next
        found = F.get(F.transform(F.array(found), jump(1 << k)), 0)
    return found % size


def shard(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, cell_rows: int = CELL_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``size`` is the text's UTF-8 bytes plus one; a null text has size 1 and a null checksum,
    an empty one size 1 and checksum 0. The law is ``rows``, ``grown_shard`` null. Rows of
    one arc are ranked by position, id, checksum and size; equal rows are interchangeable.
    A row without id stands at the position of its text's checksum. Empty table: no rows.
    Only the two named columns are read.
    """
    spark = docs.sparkSession
    points = ring(spark, shards, vnodes)
    base = docs.select(F.col(id_col).alias("doc_id"),
                       (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(text_col).alias("text_crc32"))
    base = base.withColumn("p", F.when(F.col("doc_id").isNotNull(), _position("doc_id"))
                           .otherwise(_position(F.lit("none"), "text_crc32")))
    base = written(base.withColumn("arc", _arc(F.col("p"), [p for p, _ in points])), "ring")
    # Bounded by the parameters: shards * vnodes counts.
    counts = {r["arc"]: r["n"] for r in base.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    pieces = settle([counts.get(a, 0) for a in range(len(points))], [s for _, s in points], shards)
    dealt = literal_table(spark, pieces or [(0, 0, 0, 0, 0)],
                          "arc int, low bigint, high bigint, shard int, first bigint")
    # Cells cut the arcs further, so that no window holds more than about cell_rows rows.
    bits = max(0, (max(1, total) // cell_rows).bit_length())
    celled = base.withColumn("cell", F.shiftright("p", 63 - bits) if bits else F.lit(0).cast("long"))
    cells = celled.groupBy("arc", "cell").agg(F.count("*").alias("n"), F.min("p").alias("low_p"))
    before = Window.partitionBy("arc").orderBy("low_p").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("arc", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("arc", "cell").orderBy("p", "doc_id", "text_crc32", "size")
    ranked = celled.withColumn("in_cell", F.row_number().over(order) - 1)
    # arcs + 2 ** bits cells at most, one for each cell_rows rows; not broadcast by hint
    ranked = ranked.join(cells, ["arc", "cell"]).withColumn("rank", F.col("in_cell") + F.col("before"))
    # pieces: at most shards * vnodes + shards ** 2, by the parameters
    out = ranked.join(F.broadcast(dealt), "arc").where("rank >= low AND rank < high")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      (F.col("first") + F.col("rank") - F.col("low")).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
