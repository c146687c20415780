import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbend.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact_floor(x):
    return math.floor(x * 256) if abs(x) < 1e300 else int(x) * 256


def brute(rows, parts, entries, rounds):
    """The contract by loops over Python numbers."""
    kept = [(i, [exact_floor(x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], []
    width = len(kept[0][1]) // parts
    part = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((gap(part(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v, _ in kept:
            for p in range(parts):
                members[p, near(v, p)[1]].append(part(v, p))
        for (p, k), found in members.items():
            books[p][k] = [sum(c) // len(found) for c in zip(*found)]
    out = []
    for i, v, lab in kept:
        best = [near(v, p) for p in range(parts)]
        out.append((i, lab, [k for _, k in best], sum(d for d, _ in best)))
    return out, books


def same(spark, rows, parts=4, entries=8, rounds=2, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    coded, books = V.encode(df, parts, entries, rounds, **options)
    want, want_books = brute(rows, parts, entries, rounds)
    key = lambda r: tuple(map(str, r))
    got = [(r["vec_id"], r["label"], r["codes"], None if r["error"] is None else int(r["error"])) for r in coded.collect()]
    want = [(i, lab, c, e if e < 10 ** 38 else None) for i, lab, c, e in want]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert books == want_books
    return coded, books


def vectors(n, dims, spread=1.0, seed=1, grid=None):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(7)]
    one = lambda: [rng.gauss(m, spread) for m in rng.choice(centres)]
    cut = (lambda v: [round(x * grid) / grid for x in v]) if grid else (lambda v: v)
    return [(rng.randrange(10 ** 6), cut(one()), rng.choice([None, 1, 2, 3])) for _ in range(n)]


@pytest.mark.parametrize("spread,grid", [(0.05, None), (1.0, None), (0.5, 2)])
def test_against_brute_force(spark, spread, grid):
    # a coarse grid: equal points, ties between entries
    same(spark, vectors(700, 16, spread, grid=grid), block=200, leaf=5)


def test_large_components(spark):
    for scale in (1e4, 1e7, 1e12, 1e30):
        same(spark, [(i, [x * scale for x in v], lab) for i, v, lab in vectors(120, 8, seed=3)], block=50, leaf=4)
    mixed = vectors(80, 8, seed=4) + [(5, [1e305] * 8, 1), (6, [-1e306, 1e3] * 4, 1), (10 ** 7, [1.7e308] * 8, 2), (8, [2.0 ** 52] * 8, 2)]
    same(spark, mixed, block=30, leaf=4)


def test_hard_rows(spark):
    rows = vectors(40, 8, seed=5) + [(1, None, 1), (2, [], 1), (3, [1.0] * 7 + [None], 1), (4, [float("nan")] * 8, 1),
                                     (5, [float("inf")] * 8, 2), (None, [0.5] * 8, None), (None, [0.25] * 8, None),
                                     (7, [0.0] * 8, 1), (7, [0.0] * 8, 1), (7, [1.0] * 8, 1), (-3, [-0.001] * 8, None)]
    same(spark, rows, entries=64)
    same(spark, rows, entries=3, block=8, leaf=1)
    same(spark, [(i, [1.0] * 8, 1) for i in range(100)], entries=8, leaf=2)  # equal points: one large leaf
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(9).alias(c) for c in ("v", "n", "dims", "ids", "trees", "code")])
    assert V.digests(*V.encode(df, 4, 8)).count() == len(brute(rows, 4, 8, 2)[0])


def test_no_rows_and_other_lengths(spark):
    coded, books = V.encode(spark.createDataFrame([(1, None, 1)], SCHEMA))
    assert coded.collect() == [] and books == [] and V.digests(coded, books).collect() == []
    rows = vectors(20, 8) + [(10 ** 7, [1.0] * 4, 1), (10 ** 7 + 1, [1.0] * 16, 1)]
    assert V.encode(spark.createDataFrame(rows, SCHEMA), 4, 8)[0].count() == 20
    with pytest.raises(ValueError):
        V.encode(spark.createDataFrame(rows, SCHEMA), 5)


def test_digests(spark):
    rows = vectors(60, 8, seed=6)
    coded, books = V.encode(spark.createDataFrame(rows, SCHEMA), 4, 20)
    got = V.digests(coded, books).collect()
    want, want_books = brute(rows, 4, 20, 2)
    by_label = defaultdict(int)
    for _, lab, _, e in want:
        by_label[lab] += e
    sha = hashlib.sha256(",".join(str(x) for p in want_books for e in p for x in e).encode()).hexdigest()
    assert sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == sorted(
        (i, "".join(f"{k:02x}" for k in c), e, by_label[lab]) for i, lab, c, e in want)
    assert {r["codebooks_sha256"] for r in got} == {sha}


def test_trees():
    """Balls hold their points, cache their sums, survive packing; lists shrink until a ball is owned."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (5, 8))
    x = centres[rng.integers(0, 5, 900)] + rng.integers(-90, 90, (900, 8))
    t = V.Trees.unpack(V.Trees.build(x, 2, 10).pack())
    parts = x.reshape(900, 2, 4)
    for ball in range(len(t.part)):
        own = t.points[t.start[ball]:t.end[ball]]
        assert (own == parts[t.order[t.start[ball]:t.end[ball]], t.part[ball]]).all()
        assert (own.sum(axis=0) == t.sums[ball]).all()
        assert np.sqrt(((own - t.pivot[ball]) ** 2).sum(axis=1)).max() <= t.radius[ball]
        if t.left[ball] >= 0:
            kids = sorted((int(t.start[k]), int(t.end[k])) for k in (t.left[ball], t.right[ball]))
            assert kids[0][0] == t.start[ball] and kids[0][1] == kids[1][0] and kids[1][1] == t.end[ball]
    book = parts[:64].transpose(1, 0, 2)
    owned, owners, leaves, lists = t.assign(book)
    cached = int((t.end - t.start)[owned].sum())
    compared = int(np.bincount(leaves, minlength=len(t.part)) @ (t.end - t.start))
    assert compared < 0.3 * 2 * 900 * 64  # the lists have shrunk
    far = centres.reshape(5, 2, 4).transpose(1, 0, 2)
    owned, owners, leaves, _ = t.assign(far)
    assert (t.end - t.start)[owned].sum() == 2 * 900 and t.left[owned].max() >= 0 and len(leaves) == 0 and cached >= 0


def test_limbs():
    for v in (0, 1, -1, 2 ** 30, -2 ** 30, 2 ** 61, -2 ** 140 + 5, 10 ** 45):
        n = V.limbs_needed(abs(v))
        a = np.array([v, -v], object if abs(v) >= 1 << 62 else np.int64)
        assert V.whole(V.limbs(a, n)).tolist() == [v, -v]
