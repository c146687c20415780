import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riverbend.llm import packing as P

SF = "/root/testdata/sf0.01"


def brute(docs, capacity):
    """Tightest compatible bin by looking at all of them; (lengths, sources, clusters) lists."""
    bins, out = [], []
    often = lambda values, v: v is not None and values.count(v) > 1
    sources, clusters = [d[1] for d in docs], [d[2] for d in docs]
    for length, source, cluster in docs:
        pieces = []
        while length > capacity:
            bins.append([capacity, {source}, {cluster}])
            pieces.append((len(bins) - 1, 0, capacity))
            length -= capacity
        fits = [(capacity - b[0], k) for k, b in enumerate(bins) if b[0] + length <= capacity
                and not (often(sources, source) and source in b[1]) and not (often(clusters, cluster) and cluster in b[2])]
        if fits:
            k = min(fits)[1]
        else:
            bins.append([0, set(), set()])
            k = len(bins) - 1
        pieces.append((k, bins[k][0], length))
        bins[k][0] += length
        bins[k][1].add(source)
        bins[k][2].add(cluster)
        out.append(pieces)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_group_against_brute_force(seed):
    rng = random.Random(seed)
    docs = sorted(((rng.randint(1, 250), rng.choice([None, "hot", "hot", "a", "b", "c", "d"]),
                    rng.choice([None, *range(20)])) for _ in range(150)), key=lambda d: -d[0])
    assert P.pack_group(*map(list, zip(*docs)), 100) == brute(docs, 100)


def check(rows, capacity):
    """Every byte is packed once, bins are within capacity, gapless and without conflict."""
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["bin"]].append(r)
        docs[r["doc_id"], r["n_bytes"]].append(r)
    for b in bins.values():
        b.sort(key=lambda r: r["bin_offset"])
        assert [r["bin_offset"] for r in b] == [sum(x["length"] for x in b[:k]) for k in range(len(b))]
        assert sum(r["length"] for r in b) <= capacity
        for c in ("source", "cluster"):
            values = [r[c] for r in b if r[c] is not None]
            assert len(values) == len(set(values))
    return docs


def test_query_packs_every_byte_without_conflict(spark):
    from riverbend.llm.queries import op1_best_fit_packing
    rows = op1_best_fit_packing(spark, SF).collect()
    docs = check(rows, P.CAPACITY)
    sizes = {r["doc_id"]: len((r["text"] or "").encode()) + 1 for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {k[0]: sum(r["length"] for r in v) for k, v in docs.items()} == sizes


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "source", (F.octet_length("text") + 1).alias("n"), F.xxhash64("text").alias("h")).collect()
    rows.sort(key=lambda r: (-r["n"], r["doc_id"]))
    want = brute([(r["n"], r["source"], r["h"]) for r in rows], P.CAPACITY)
    got = defaultdict(list)
    for r in sorted(P.pack(docs).collect(), key=lambda r: r["piece"]):
        got[r["doc_id"]].append((int(r["bin"].split("-")[1]), r["bin_offset"], r["length"]))
    assert [got[r["doc_id"]] for r in rows] == want


def test_hot_source_and_cluster_in_groups(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"),
                                 F.when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 9)).alias("source"))
    rows = P.pack(df, capacity=64, group_docs=100).collect()
    assert len(rows) == 900 and len({r["bin"].split("-")[0] for r in rows}) == 9
    check(rows, 64)


def test_edge_cases(docs, clashing):
    rows = [(1, None), (2, ""), (3, "x" * 100, None, None), (4, "same", "en", None), (4, "same", "en", None), (None, "y" * 16),
            (None, None, None, None)]
    got = P.pack(docs(rows, **clashing, bin="x", piece=1, g=2, cluster=3, length=4), capacity=16).collect()
    sizes = sorted(len((r[1] or "").encode()) + 1 for r in rows)
    assert sorted(r["n_bytes"] for r in got if r["piece"] == 0) == sizes
    assert sum(r["length"] for r in got) == sum(sizes)
    same = [r["bin"] for r in got if r["doc_id"] == 4]
    assert len(set(same)) == 2  # equal texts never share a bin
    assert P.pack(docs([])).collect() == []
    with pytest.raises(ValueError):
        P.pack(docs([]), capacity=0)


def test_ids_and_clusters_are_exact_beside_nulls(spark, docs):
    big = (1 << 53) + 1
    rows = [(big + 2 * k, f"text {k % 9}", "en", None) for k in range(20)] + [(None, "text 1"), (1, None), (None, None)]
    df = docs(rows)
    got = P.pack(df, capacity=64).collect()
    want = df.select("doc_id", F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("cluster"), "source").collect()
    key = lambda r: str((r["doc_id"], r["cluster"], r["source"]))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_repeated_rows_are_spread_over_groups(spark):
    """2,000 equal rows without id, and 1,000 of one id, among 1,000 others."""
    same = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit(None).cast("string").alias("source"))
    one = spark.range(1000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one").alias("text"), F.lit(None).cast("string").alias("source"))
    other = spark.range(1000).select((F.col("id") + 100).alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit(None).cast("string").alias("source"))
    rows = P.pack(same.union(one).union(other), capacity=64, group_docs=100).collect()
    check(rows, 64)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["bin"].split("-")[0]] += 1
    assert len(rows) == 4000 and len(sizes) == 40 and max(sizes.values()) <= 300
    assert sorted(r["doc_id"] or -1 for r in rows) == [-1] * 2000 + [7] * 1000 + list(range(100, 1100))
