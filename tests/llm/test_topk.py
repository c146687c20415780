import math

import numpy as np
import pytest

from riverbend.llm import topk as K

SF = "/root/testdata/sf0.01"


def brute(rows, every=50, k=5):
    vectors = [(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, q in vectors:
        if i % every == 0:
            asked.setdefault(i, []).extend((-sum(a * b for a, b in zip(q, w)), j) for j, w in vectors if j != i and len(w) == len(q))
    return sorted((i, r + 1, j, -s) for i, found in asked.items() for r, (s, j) in enumerate(sorted(found)[:k]))


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op6_exact_top_k
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op6_exact_top_k(spark, SF).collect()) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_blocks_and_ties(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(k, [float(x) for x in (rng.integers(-2, 3, 4) / 8)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = sorted(tuple(r) for r in K.search(df, every=20, block=70, query_block=6).collect())
    assert got == brute(rows, 20)


def test_proof_stops_early_and_stays_exact(monkeypatch):
    monkeypatch.setattr(K, "FEW", 8)
    rng = np.random.default_rng(0)
    v = np.floor(256 * rng.normal(0, 0.12, (3000, 32))).astype(np.int64)
    index = K.Index(np.arange(3000), v)
    for own in range(0, 3000, 500):
        scores = v @ v[own]
        want = sorted(((int(-s), i) for i, s in enumerate(scores) if i != own))[:5]
        assert index.search(v[own], 5, own, None) == [(-s, i) for s, i in want]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [0.5, -1.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]),
            (7, [1.0, 0.5]), (7, [1.0, 0.5]), (7, [0.0, 0.5]), (8, [0.25, 0.25, 0.25]), (100, [1.0, 2.0, 3.0]),
            (150, [1.0, 0.25]), (150, [0.25, 1.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, size int, b int")
    assert sorted(tuple(r) for r in K.search(df).collect()) == brute(rows)
    assert K.search(df.limit(0)).collect() == []
    assert K.search(df.where("vec_id = 0")).collect() == []


@pytest.mark.parametrize("size, every", [(1e4, 1), (1e7, 2)])
def test_large_components_take_part(spark, size, every):
    """Beyond exact sums of floats, and beyond 64-bit bounds; held against whole numbers and the SQL."""
    import tempfile

    from riverbend.llm.oracle import ORACLE
    from riverbend.llm.queries import op6_exact_top_k

    from .test_oracle import in_duckdb, same
    rng = np.random.default_rng(7)
    rows = [(k, [float(x) for x in np.round(rng.normal(0, 1, 16) * (size if k % 7 == 0 and k % 50 else 1), 3)]) for k in range(1, 400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    folder = tempfile.mkdtemp(prefix="riverbend-llm-")
    df.write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "doc_id long").write.parquet(f"{folder}/documents.parquet")
    same(op6_exact_top_k(spark, folder), in_duckdb(ORACLE["op6_exact_top_k"], folder))
    if size < 1e6:
        assert sorted(tuple(r) for r in K.search(df, every=every, block=150).collect()) == brute(rows, every)


@pytest.mark.parametrize("size", [10**5, 10**6, 10**8])
def test_bounds_hold_for_large_components(monkeypatch, size):
    """128 dimensions: packed sums of floats are not exact here."""
    monkeypatch.setattr(K, "FEW", 8)
    rng = np.random.default_rng(1)
    v = rng.integers(-size, size, (600, 128))
    index = K.Index(np.arange(600), v)
    for own in (0, 300):
        scores = [sum(a * b for a, b in zip(x, v[own].tolist())) for x in v.tolist()]
        want = sorted((-s, i) for i, s in enumerate(scores) if i != own)[:5]
        assert index.search(v[own], 5, own, None) == [(-s, i) for s, i in want]
    huge = K.Index(np.arange(3), np.array([[1 << 40], [1 << 20], [-5]]))
    with pytest.raises(OverflowError):
        huge.search(np.array([1 << 30]), 1, 1, None)
