"""Exact top-k search by an impact-ordered, score-at-a-time index.

Components become integers floor(256 x). Vectors are dealt by hash to blocks of about
``BLOCK`` rows, queries to blocks of about ``QUERIES``, and each pair of blocks is one
group: the stated query set against all rows, in blocks. A candidate block is indexed by
dimension: its vectors in descending order of their component, cut into posting segments of
equal quantised value. For a query a segment's impact is the largest product of its values
with the query's component, above the least of that dimension, so that all impacts are at
least zero. Segments are processed by descending impact, whatever their dimension, and each
vector gathers the impacts of its segments. What a vector has not met yet is at most the
current impact for each dimension left; when only few vectors can still reach the k-th best
exact score known, the search of the block is proved, and those are rescored exactly, ties
included. The blocks' lists are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbend.llm.common import written

BLOCK, QUERIES, WIDTH = 8192, 2048, 8
ROUNDS, FEW = 8, 512
SCALE = 256
LARGEST = float(1 << 55)  # components whose quantised value is a bigint, as in the SQL


class Index:
    """Posting segments of a block: ``order`` lists the vectors of each segment in turn."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, width: int = WIDTH):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        n, self.dims = vectors.shape
        self.largest = max(1, abs(int(vectors.max())), abs(int(vectors.min())))
        levels = self.vectors // width
        order = np.argsort(-levels, axis=0, kind="stable")
        sorted_levels = np.take_along_axis(levels, order, axis=0)
        new = np.ones((n, self.dims), bool)
        new[1:] = sorted_levels[1:] != sorted_levels[:-1]
        dim, at = np.nonzero(new.T)
        self.order = np.ascontiguousarray(order.T).ravel()
        self.start = dim * n + at
        self.end = np.append(self.start[1:], n * self.dims)
        self.dim, self.level = dim, sorted_levels[at, dim]
        values = np.take_along_axis(self.vectors, order, axis=0).T.ravel()
        self.high = np.maximum.reduceat(values, self.start)
        self.low = np.minimum.reduceat(values, self.start)

    def search(self, query: np.ndarray, k: int, own: int, known: int | None) -> list[tuple[int, int]]:
        """(score, id) of the block's possible members of the k best, the own id left out.
        ``known``: a k-th best score from other blocks, if any."""
        q = query.astype(np.int64)
        # of any sum below: a product of two components twice over, for each dimension
        bound = 4 * self.dims * self.largest * max(1, abs(int(q.max())), abs(int(q.min())))
        if bound >= 1 << 62:
            return self.exactly(q, k, own)
        impact = np.where(q[self.dim] > 0, q[self.dim] * self.high, q[self.dim] * self.low)
        floor = np.where(q > 0, q * self.vectors.min(axis=0), q * self.vectors.max(axis=0))
        above = impact - floor[self.dim]
        order = np.argsort(-above, kind="stable")
        sizes = np.cumsum((self.end - self.start)[order])
        n, other = len(self.ids), self.ids != own
        # impacts and the dimensions met in one sum of floats, dimensions in the low part, as long as that is exact
        part = 1 << int(self.dims).bit_length()
        packed = bound * part < 1 << 53
        gathered, total, met = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        base, done, best = int(floor.sum()), 0, known
        exact: dict[int, int] = {}
        for r in range(1, ROUNDS + 1):
            upto = int(np.searchsorted(sizes, sizes[-1] * r / ROUNDS, "left")) + 1
            segments = order[done:upto]
            if not len(segments):
                continue
            rows = np.concatenate([self.order[a:b] for a, b in zip(self.start[segments], self.end[segments])])
            each = (self.end - self.start)[segments]
            if packed:
                gathered += np.bincount(rows, weights=np.repeat(above[segments] * part + 1, each), minlength=n)
                total, met = np.divmod(gathered.astype(np.int64), part)
            else:
                np.add.at(total, rows, np.repeat(above[segments], each))
                met += np.bincount(rows, minlength=n)
            done = upto
            left = int(above[order[done]]) if done < len(order) else 0
            upper = base + total + left * (self.dims - met)
            # exact scores of the leaders raise the bar
            lead = np.argpartition(-total, min(4 * k, n - 1))[: 4 * k]
            for i in lead[other[lead]].tolist():
                if i not in exact:
                    exact[i] = int(self.vectors[i] @ q)
            scores = sorted(exact.values(), reverse=True)
            if len(scores) >= k:
                best = scores[k - 1] if best is None else max(best, scores[k - 1])
            may = np.nonzero(other & (upper >= best))[0] if best is not None else np.nonzero(other)[0]
            if len(may) <= FEW or done == len(order):  # proved: nothing else can reach the bar
                found = self.vectors[may] @ q
                top = np.lexsort((self.ids[may], -found))[:k]
                return [(int(found[t]), int(self.ids[may[t]])) for t in top]
        raise AssertionError("every segment was processed")

    def exactly(self, q: np.ndarray, k: int, own: int) -> list[tuple[int, int]]:
        """The k best of the block by whole numbers of any size, a slice of vectors at a time."""
        found: list[tuple[int, int]] = []
        exact = q.astype(object)
        for at in range(0, len(self.ids), FEW):
            scores = self.vectors[at: at + FEW].astype(object) @ exact
            found += [(-s, i) for s, i in zip(scores.tolist(), self.ids[at: at + FEW].tolist()) if i != own]
            found = sorted(found)[:k]
        if any(not -(1 << 63) <= -s < 1 << 63 for s, _ in found):
            raise OverflowError(f"a score of query {own} does not fit a bigint")
        return [(-s, i) for s, i in found]


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, q)`` of the rows that take part."""
    v = F.col(vector_col)
    double = F.transform(v, lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(sound)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.transform(double, lambda x: F.when(F.abs(x) < LARGEST, F.floor(x * SCALE)).otherwise(
                           F.raise_error(F.lit("a component does not fit a bigint")).cast("bigint"))).alias("q"))


def search(vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id",
           vector_col: str = "embedding", block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of each query (id divisible by ``every``).

    Vectors that are null or empty, or hold nulls or non-finite components, take no part; rows
    without id neither. A quantised component or a listed score that does not fit a bigint fails
    the query. Rows that repeat an id are candidates each, and ask each if they are queries: their
    lists are ranked together, and no row of the query's own id is in them. Vectors of unequal length
    meet only their own length. Fewer than k candidates: all of them; none, or an empty table: no rows. Ties go
    to the smaller id.
    """
    rows = written(quantised(vectors, id_col, vector_col), "vectors")
    n, low, high = rows.agg(F.count("*"), F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    if n and -(1 << 31) <= low and high < 1 << 31:  # half as much to shuffle
        rows = rows.withColumn("q", F.col("q").cast("array<int>"))
    blocks, query_blocks = max(1, math.ceil(n / block)), max(1, math.ceil(n / every / query_block))
    dealt = rows.withColumn("size", F.size("q"))
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    candidates = dealt.select("size", hashed.alias("b"), "vec_id", "q").withColumn(
        "c", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = dealt.where(F.col("vec_id") % every == 0).select(
        "size", F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(query_blocks)).cast("int").alias("c"), "vec_id", "q"
    ).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(some) and len(asked):
            index = Index(some["vec_id"].to_numpy(), np.stack(some["q"].to_list()).astype(np.int64))
            for own, q in zip(asked["vec_id"], asked["q"]):
                out += [(int(own), i, s) for s, i in index.search(np.asarray(q), k, int(own), None)]
        return pd.DataFrame({"query_id": pd.Series([x[0] for x in out], dtype="int64"),
                             "vec_id": pd.Series([x[1] for x in out], dtype="int64"),
                             "score": pd.Series([x[2] for x in out], dtype="int64")})

    found = (candidates.groupBy("size", "b", "c").cogroup(queries.groupBy("size", "b", "c"))
             .applyInPandas(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
