"""Vector code compression: a codebook for each part of the vectors, fitted over metric trees.

Components become integers floor(256 x), vectors are cut into equal parts, and each part position
has a codebook whose entries are moved by rounds of assigning and averaging. Each task makes
blocks of ``BLOCK`` vectors and, once, one anchors hierarchy for each part of a block. It is
built from the middle out: anchors (data points that own the points nearest to them, a new one
being the point farthest from its owner) are merged pairwise into balls up to the root, and the
points of each anchor are split by anchors of their own, down to leaves. Every ball caches the
sum and the count of its points.

A round walks each tree down with a list of candidate entries, all at the root. At a ball an
entry leaves the list if even the ball's most favourable point is nearer to the entry that is
nearest to the pivot; children inherit what is left. A ball with one candidate is wholly owned:
its cached sum and count go to that entry, and its points are not looked at. At a leaf each
point is compared with the candidates left. All balls of one depth, of all parts, are one numpy
step. Blocks are written once and read by each round; a round brings only sums by entry and
component together, by partial sums in each task.

Distances, sums and means are whole numbers of any size: 64-bit where a bound shows that they
fit, Python's beyond.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK, LEAF = 2048, 24
LIMB = 30  # bits of a limb, in which whole numbers beyond 64 bits are kept and summed
LARGEST = 1 << 61
UNBOUNDED = 1 << 500  # from here on squares leave floating point: balls then rule nothing out
SLACK = 1 + 1e-9  # over the rounding of a bound computed in floating point


def limbs(values: np.ndarray, count: int) -> np.ndarray:
    """Whole numbers as ``count`` limbs each, in a last axis; the highest holds the sign."""
    if count == 1:
        return values.astype(np.int64)[..., None]
    if values.dtype != object:
        values = values.astype(object)
    low = [(values >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(count - 1)]
    return np.stack([x.astype(np.int64) for x in [*low, values >> (LIMB * (count - 1))]], axis=-1)


def whole(parts: np.ndarray) -> np.ndarray:
    """The inverse of ``limbs``: 64-bit for one limb, Python's whole numbers for more."""
    if parts.shape[-1] == 1:
        return parts[..., 0]
    return reduce(lambda high, k: high * (1 << LIMB) + parts[..., k].astype(object),
                  reversed(range(parts.shape[-1] - 1)), parts[..., -1].astype(object))


def limbs_needed(largest: int) -> int:
    """Limbs for numbers up to ``largest``, whose top limb is far from 64 bits (it is summed)."""
    return 1 if largest < 1 << LIMB else max(2, math.ceil((largest.bit_length() + 1) / LIMB))


def quantised(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite doubles."""
    if np.abs(vectors).max(initial=0) < 2.0 ** 36:  # sums of a block fit 64 bits too
        return np.floor(vectors * SCALE).astype(np.int64)
    exact = lambda x: math.floor(x * SCALE) if abs(x) < 2.0 ** 900 else int(x) * SCALE
    return np.array([exact(x) for x in vectors.ravel().tolist()], object).reshape(vectors.shape)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after another."""
    if not len(size):
        return np.zeros(0, np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1]) + np.repeat(start - (ends - size), size)


def _largest(*arrays: np.ndarray) -> int:
    return max([1, *(abs(int(v)) for a in arrays if a.size for v in (a.max(), a.min()))])


def _floats(x: np.ndarray) -> np.ndarray:
    return x.astype(float) if _largest(x) < UNBOUNDED else np.zeros(x.shape)


def _square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def anchors(x: np.ndarray, start: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split groups of points (``start`` of each, points in order) into up to ``want`` anchors:
    (owner of each point as a number within its group, the anchors' points by group, -1 for none)."""
    n, groups = len(x), len(start)
    size = np.diff(np.append(start, n))
    group = np.repeat(np.arange(groups), size)
    made = np.full((groups, int(want.max())), -1)
    made[:, 0] = start
    owner = np.zeros(n, np.int64)
    far = _square(x - x[start][group])  # to the point's owner
    live = want > 1
    for k in range(1, made.shape[1]):
        top = np.maximum.reduceat(far, start)
        live = live & (want > k) & (top > 0)
        if not live.any():
            break
        on = live[group]
        at = np.flatnonzero(on & (far == top[group]))
        _, first = np.unique(group[at], return_index=True)
        new = np.zeros(groups, np.int64)
        new[group[at[first]]] = at[first]
        made[live, k] = new[live]
        # a point nearer to its owner than half of the way to the new anchor stays
        apart = _square(x[made[:, :k]] - x[new][:, None, :])
        may = np.flatnonzero(on & (4 * far > apart[group, owner]))
        near = _square(x[may] - x[new[group[may]]])
        steal = near < far[may]
        owner[may[steal]], far[may[steal]] = k, near[steal]
    return owner, made


def merges(pivot: np.ndarray, radius: np.ndarray, count: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merge the anchors of each group (``count`` of them, padded to a rectangle) pairwise, always
    the two that the smallest ball holds: for each step (groups, slot kept, slot merged into it)."""
    pivot, radius, left = pivot.copy(), radius.copy(), count.copy()
    groups, slots = radius.shape
    weight = np.ones((groups, slots))
    there = np.arange(slots) < count[:, None]
    gap = np.sqrt(_square(pivot[:, :, None, :] - pivot[:, None, :, :]))
    ball = np.maximum((gap + radius[:, :, None] + radius[:, None, :]) / 2,
                      np.maximum(radius[:, :, None], radius[:, None, :]))
    ball[~(there[:, :, None] & there[:, None, :] & (np.arange(slots)[:, None] < np.arange(slots)))] = np.inf
    steps = []
    while (left > 1).any():
        live = np.flatnonzero(left > 1)
        best = ball[live].reshape(len(live), -1).argmin(axis=1)
        a, b = best // slots, best % slots
        steps.append((live, a, b))
        total = weight[live, a] + weight[live, b]
        r = ball[live, a, b]
        pivot[live, a] = (pivot[live, a] * weight[live, a][:, None] + pivot[live, b] * weight[live, b][:, None]) / total[:, None]
        weight[live, a], radius[live, a] = total, r
        there[live, b] = False
        left[live] -= 1
        ball[live, b, :] = ball[live, :, b] = np.inf
        gap = np.sqrt(_square(pivot[live] - pivot[live, a][:, None, :]))
        both = np.maximum((gap + radius[live] + r[:, None]) / 2, np.maximum(radius[live], r[:, None]))
        both[~there[live]] = np.inf
        both[np.arange(len(live)), a] = np.inf
        low = np.arange(slots) < a[:, None]
        ball[live, a, :] = np.where(low, np.inf, both)
        ball[live, :, a] = np.where(low, both, np.inf)
    return steps


class Trees:
    """The trees of a block, one for each part, their balls in one set of arrays.

    ``points`` holds the parts' points, each tree's in its own order, and ``order`` the vector that
    each came from. A ball covers ``points[start:end]``; ``left`` is -1 in a leaf.
    """

    FIELDS = ("points", "order", "start", "end", "part", "left", "right", "pivot", "radius", "sums", "roots")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)

    @classmethod
    def build(cls, vectors: np.ndarray, parts: int, leaf: int = LEAF) -> Trees:
        n, width = len(vectors), vectors.shape[1] // parts
        points = np.ascontiguousarray(vectors.reshape(n, parts, width).transpose(1, 0, 2)).reshape(parts * n, width)
        x = _floats(points)
        part, kids, anchor = list(range(parts)), {}, [-1] * parts
        members = {p: np.arange(p * n, (p + 1) * n) for p in range(parts)}
        open_balls = [p for p in range(parts) if n > leaf]
        while open_balls:
            rows = np.concatenate([members[b] for b in open_balls])
            size = np.array([len(members[b]) for b in open_balls])
            start = np.cumsum(size) - size
            owner, made = anchors(x[rows], start, np.ceil(np.sqrt(size)).astype(np.int64))
            count = (made >= 0).sum(axis=1)
            group = np.repeat(np.arange(len(size)), size)
            slots = made.shape[1]
            slot = group * slots + owner
            pivots = np.where(made >= 0, made, 0)
            far = np.zeros(len(size) * slots)
            np.maximum.at(far, slot, _square(x[rows] - x[rows[made[group, owner]]]))
            steps = merges(x[rows[pivots]], np.sqrt(far).reshape(len(size), slots), count)
            by_slot = rows[np.argsort(slot, kind="stable")]
            ends = np.cumsum(np.bincount(slot, minlength=len(size) * slots))
            now, later = {}, []
            for g, b in enumerate(open_balls):
                if count[g] < 2:  # equal points: a leaf, whatever their number
                    continue
                for s in range(count[g]):
                    ball, at = len(part), g * slots + s
                    part.append(part[b])
                    anchor.append(int(rows[made[g, s]]))
                    members[ball] = by_slot[ends[at - 1] if at else 0:ends[at]]
                    now[g, s] = ball
                    if len(members[ball]) > leaf:
                        later.append(ball)
                del members[b]
            left = count.copy()
            for live, a, b in steps:
                for g, i, j in zip(live.tolist(), a.tolist(), b.tolist()):
                    left[g] -= 1
                    if left[g] == 1:  # the last two make up the ball that was split
                        ball = open_balls[g]
                    else:
                        ball = len(part)
                        part.append(part[open_balls[g]])
                        anchor.append(-1)
                    kids[ball] = (now[g, i], now[g, j])
                    now[g, i] = ball
            open_balls = later
        return cls._laid_out(points, n, part, kids, anchor, members, parts)

    @classmethod
    def _laid_out(cls, points, n, part, kids, anchor, members, parts) -> Trees:
        m = len(part)
        start, end, depth = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
        order, at = [], 0
        for p in range(parts):
            stack = [(p, 0, False)]
            while stack:
                ball, d, done = stack.pop()
                if done:
                    end[ball] = at
                    continue
                start[ball], depth[ball] = at, d
                if ball in kids:
                    stack += [(ball, d, True), (kids[ball][1], d + 1, False), (kids[ball][0], d + 1, False)]
                else:
                    order.append(members[ball])
                    at += len(members[ball])
                    end[ball] = at
        order = np.concatenate(order) if order else np.zeros(0, np.int64)
        points = points[order]
        upto = np.concatenate([np.zeros((1, points.shape[1]), points.dtype), np.cumsum(points, axis=0)])
        sums = upto[end] - upto[start]
        anchor = np.array(anchor)
        pivot = sums // np.maximum(1, end - start)[:, None]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        pivot[anchor >= 0] = points[back[anchor[anchor >= 0]]]
        x, c, radius = _floats(points), _floats(pivot), np.zeros(m)
        for d in range(int(depth.max(initial=0)) + 1):
            balls = np.flatnonzero((depth == d) & (end > start))
            size = (end - start)[balls]
            if len(balls):
                gap = _square(x[_ranges(start[balls], size)] - np.repeat(c[balls], size, axis=0))
                radius[balls] = np.sqrt(np.maximum.reduceat(gap, np.cumsum(size) - size))
        # what converting large whole numbers to floating point may have hidden
        radius = radius * SLACK + np.abs(x).max(initial=0) * 2.0 ** -48
        if _largest(points) >= UNBOUNDED:
            radius[:] = np.inf
        left = np.array([kids.get(b, (-1, -1))[0] for b in range(m)])
        right = np.array([kids.get(b, (-1, -1))[1] for b in range(m)])
        return cls(points=points, order=order % max(1, n), start=start, end=end, part=np.array(part), left=left,
                   right=right, pivot=pivot, radius=radius, sums=sums, roots=np.arange(parts))

    def pack(self) -> bytes:
        """The arrays as one string; whole numbers beyond 64 bits in limbs."""
        out, arrays = io.BytesIO(), {}
        for name in self.FIELDS:
            a = getattr(self, name)
            if a.dtype == object:
                largest = max((abs(v) for v in a.ravel().tolist()), default=0)
                a = limbs(a, max(2, limbs_needed(largest)))
                name += "_limbs"
            elif a.dtype.kind == "i":
                top = max(int(a.max(initial=0)), -1 - int(a.min(initial=0)))
                a = a.astype(np.min_scalar_type(-1 - top))
            arrays[name] = a
        np.savez(out, **arrays)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Trees:
        with np.load(io.BytesIO(data), allow_pickle=False) as found:
            arrays = {}
            for name in found.files:
                a = found[name]
                if name.endswith("_limbs"):
                    name, a = name.removesuffix("_limbs"), whole(a)
                arrays[name] = a.astype(np.int64) if a.dtype.kind == "i" else a
        return cls(**arrays)

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Walk down with candidate lists: (balls wholly owned, their entries, candidates left in
        each leaf reached as rows of ``(ball, entry)``). ``book``: part x entry x component."""
        entries = book.shape[1]
        largest = _largest(self.points, self.pivot, book)
        fits = book.shape[2] * (2 * largest) ** 2 * entries < LARGEST
        book, pivot = (a.astype(np.int64 if fits else object) for a in (book, self.pivot))
        never = LARGEST if fits else book.shape[2] * (2 * largest) ** 2 + 1
        bounded = largest < UNBOUNDED
        if bounded:
            apart = np.sqrt(_square(book[:, :, None, :] - book[:, None, :, :]).astype(float))
        balls = self.roots[self.end[self.roots] > self.start[self.roots]]
        mask = np.ones((len(balls), entries), bool)
        owned, owners, leaves, lists = [], [], [], []
        while len(balls):
            part = self.part[balls]
            far = _square(pivot[balls][:, None, :] - book[part])
            best = np.where(mask, far, never).argmin(axis=1)
            rows = np.arange(len(balls))
            if bounded:
                lead = (far - far[rows, best][:, None]).astype(float)
                mask = mask & ~(lead > 2 * self.radius[balls][:, None] * apart[part, best] * SLACK)
            single, is_leaf = mask.sum(axis=1) == 1, self.left[balls] < 0
            owned.append(balls[single])
            owners.append(best[single])
            at, entry = np.nonzero(mask & (is_leaf & ~single)[:, None])
            leaves.append(balls[at])
            lists.append(entry)
            down = ~single & ~is_leaf
            balls = np.concatenate([self.left[balls[down]], self.right[balls[down]]])
            mask = np.concatenate([mask[down], mask[down]])
        join = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
        return join(owned), join(owners), join(leaves), join(lists)

    def nearest(self, book: np.ndarray, balls: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Points of the balls against their listed entries: (points, entry, squared distance)."""
        by_ball = np.argsort(balls, kind="stable")
        balls, entries = balls[by_ball], entries[by_ball]
        ball, first, listed = np.unique(balls, return_index=True, return_counts=True)
        size = (self.end - self.start)[ball]
        points = _ranges(self.start[ball], size)
        if not len(points):
            return points, points, points
        lists = np.repeat(listed, size)
        pair = _ranges(np.repeat(first, size), lists)
        entry = entries[pair]
        largest = _largest(self.points, book)
        kind = np.int64 if book.shape[2] * (2 * largest) ** 2 * book.shape[1] < LARGEST else object
        gap = _square(self.points.astype(kind)[np.repeat(points, lists)]
                      - book.astype(kind)[np.repeat(self.part[ball], size * listed), entry])
        # the smallest of distance and entry: ties go to the lower index
        best = np.minimum.reduceat(gap * book.shape[1] + entry, np.cumsum(lists) - lists)
        return points, (best % book.shape[1]).astype(np.int64), best // book.shape[1]

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sums, counts) by part and entry, of the points assigned to it."""
        owned, owners, leaves, lists = self.assign(book)
        points, entry, _ = self.nearest(book, leaves, lists)
        part = points // max(1, len(self.points) // len(self.roots))
        sums = np.zeros(book.shape, self.sums.dtype)
        counts = np.zeros(book.shape[:2], np.int64)
        np.add.at(sums, (self.part[owned], owners), self.sums[owned])
        np.add.at(counts, (self.part[owned], owners), (self.end - self.start)[owned])
        np.add.at(sums, (part, entry), self.points[points])
        np.add.at(counts, (part, entry), 1)
        return sums, counts

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's entries, part by part, and the sum of its squared distances."""
        owned, owners, leaves, lists = self.assign(book)
        points, entry, gap = self.nearest(book, np.concatenate([owned, leaves]), np.concatenate([owners, lists]))
        parts = len(self.roots)
        n = len(self.points) // parts
        part, row = points // n, self.order[points]
        codes = np.zeros((n, parts), np.int64)
        codes[row, part] = entry
        errors = np.zeros((n, parts), gap.dtype)
        errors[row, part] = gap
        return codes, errors.astype(object).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            piece = b.slice(at, block - rows)
            held.append(piece)
            rows, at = rows + piece.num_rows, at + piece.num_rows
            if rows == block:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column, dims: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return quantised(flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims))


def kept_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v``: rows whose vector is there, without nulls, NaN or infinities."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).where(sound).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v"))


def _slots(sums: np.ndarray, counts: np.ndarray, parts_of: int) -> np.ndarray:
    """Sums in limbs beside counts: what tasks add up, as one row of numbers."""
    return np.concatenate([limbs(sums, parts_of).reshape(*counts.shape, -1), counts[..., None]], axis=-1).ravel()


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
           leaf: int = LEAF, id_col: str = "vec_id", vector_col: str = "embedding",
           label_col: str = "label") -> tuple[DataFrame, list[list[list[int]]]]:
    """``vec_id, label, codes, error`` of every kept vector, and the codebooks (part, entry, component).

    Vectors that are null or empty or hold null or non-finite components are left out, and so are
    those whose length is not the most frequent one (of equally frequent ones the longest); that
    length must be a multiple of ``parts``. Codebooks begin as the parts of the vectors of smallest
    id (nulls last; of equal ids the smaller vector); fewer kept vectors than ``entries`` make
    smaller codebooks. ``codes`` is an array of entry numbers, ``error`` a decimal, null if it has
    more than 38 digits. Repeated rows are coded each; an empty table gives no rows.
    """
    rows = kept_rows(vectors, id_col, vector_col, label_col)
    common = rows.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("top")).orderBy(F.desc("n"), F.desc("dims")).first()
    kinds = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"
    shape = f"{kinds}, codes array<int>, error decimal(38,0)"
    if common is None:
        return vectors.sparkSession.createDataFrame([], shape), []
    dims = common["dims"]
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    rows = rows.where(F.size("v") == dims)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()  # by the parameter
    book = quantised(np.array([r["v"] for r in first], float)).reshape(len(first), parts, -1).transpose(1, 0, 2)
    size, width = len(first), dims // parts
    # one number for all blocks: every sum of a task is kept in so many limbs
    of = limbs_needed(int(quantised(np.array([[common["top"]]], float)).ravel()[0]) + 1)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _blocks(batches, block):
            trees = Trees.build(_matrix(t.column("v"), dims), parts, leaf)
            own = [pa.array([t.column(c).to_pylist()], pa.list_(t.schema.field(c).type)) for c in ("vec_id", "label")]
            yield pa.RecordBatch.from_arrays([*own, pa.array([trees.pack()], pa.binary())], ["ids", "labels", "trees"])

    arrays = ", ".join(f"{a} array<{rows.schema[c].dataType.simpleString()}>" for a, c in (("ids", "vec_id"), ("labels", "label")))
    planted = written(rows.mapInArrow(plant, f"{arrays}, trees binary"), "trees")

    for _ in range(rounds):
        now = book  # bounded by the parameters: parts x entries x components

        def add(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for data in b.column("trees"):
                    slots = _slots(*Trees.unpack(data.as_py()).totals(now), of)
                    total = slots if total is None else total + slots
            if total is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "value"])

        added = planted.select("trees").mapInArrow(add, "slot bigint, value bigint").groupBy("slot").agg(
            F.sum("value").alias("value")).collect()  # by the parameters, as the codebooks
        slots = np.zeros(parts * size * (width * of + 1), np.int64)
        for r in added:
            slots[r["slot"]] = r["value"]
        slots = slots.reshape(parts, size, -1)
        counts = slots[..., -1]
        sums = whole(slots[..., :-1].reshape(parts, size, width, of))
        book = np.where((counts > 0)[..., None], sums // np.maximum(1, counts)[..., None], book)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                codes, errors = Trees.unpack(b.column("trees")[i].as_py()).codes(book)
                errors = [e if e < 10 ** 38 else None for e in errors.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids").slice(i, 1).flatten(), b.column("labels").slice(i, 1).flatten(),
                     pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(errors, pa.decimal128(38, 0))],
                    ["vec_id", "label", "codes", "error"])

    return planted.mapInArrow(code, shape), [[[int(x) for x in e] for e in p] for p in book.tolist()]


def digests(coded: DataFrame, books: list[list[list[int]]]) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of ``encode``'s rows: codes as two
    hexadecimal digits each, errors as longs (null beyond), those of a label (nulls are one)
    summed, and the digest of all entries' components."""
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    rows = written(coded.select("vec_id", "label", F.lower(F.array_join(
        F.transform("codes", lambda c: F.lpad(F.hex(c), 2, "0")), "")).alias("code"), "error"), "codes")
    labels = rows.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    joined = rows.join(labels.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    long = lambda c: F.expr(f"try_cast({c} AS bigint)").alias(c)
    return joined.select("vec_id", "code", long("error"), long("label_error"), F.lit(sha).alias("codebooks_sha256"))
