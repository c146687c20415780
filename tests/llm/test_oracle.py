"""Queries with a DuckDB form: same rows on the given tables and on hard cases."""

import os
import random
import tempfile

import duckdb
import pytest

from riverbend.llm.queries import ORACLE, QUERIES


def in_duckdb(sql, sf):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        if os.path.isfile(f"{sf}/{name}.parquet"):
            con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
        elif os.path.isdir(f"{sf}/{name}.parquet"):  # written as a folder
            con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet/*.parquet')")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return [dict(zip(names, r)) for r in got.fetchall()]


def same(df, want):
    key = lambda r: sorted((k, str(v)) for k, v in r.items())
    got = [r.asDict() for r in df.collect()]
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, sf):
    same(QUERIES[name](spark, sf), in_duckdb(ORACLE[name], sf))


def test_hard_documents(spark):
    """Null and empty texts, null languages, repeated rows, odd characters, ties of words."""
    rng = random.Random(5)
    say = lambda n, words: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, say(rng.randint(1, 150), "der die das und ist Haus Ärger 12 été".split()), "de") for i in range(30)]
    rows += [(100 + i, say(rng.randint(40, 90), "the of and to a house, 7 #tag".split()), None) for i in range(20)]
    rows += [(200, None, "de"), (201, "", None), (None, "x y z " * 30, "de"), (202, "&" * 300, "xx"),
             (203, "\n".join(["one line here"] * 40), "de"), (204, "あい ́   " * 40, "ja")]
    rows += rows[:3]
    folder = tempfile.mkdtemp(prefix="riverbend-llm-")
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame([(*r, "s") for r in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    same(QUERIES["op5_quality_rules"](spark, folder), in_duckdb(ORACLE["op5_quality_rules"], folder))


def test_repeated_ids_of_vectors(spark):
    """Ids 1, 1, 2 and a query that stands twice: every row but the query's own."""
    rng = random.Random(8)
    rows = [(i // 3 if i < 90 else 50 * (i % 3), [rng.uniform(-1, 1) for _ in range(4)]) for i in range(120)]
    folder = tempfile.mkdtemp(prefix="riverbend-llm-")
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "doc_id long").write.parquet(f"{folder}/documents.parquet")
    same(QUERIES["op6_exact_top_k"](spark, folder), in_duckdb(ORACLE["op6_exact_top_k"], folder))


def test_quality_of_many_languages(spark):
    """Seventy languages and none: each has a reference, that of the whole table takes all words."""
    rng = random.Random(9)
    rows = []
    for k in range(70):
        own = [f"w{k}x{j}" for j in range(5)] + ["the", "of", "Ünter", "7"]
        rows += [(100 * k + d, " ".join(rng.choices(own, k=rng.randint(45, 80))), f"l{k:02}") for d in range(2)]
    rows += [(9000 + d, " ".join(rng.choices(["the", "of", "none", "w1x1"], k=60)), None) for d in range(6)]
    folder = tempfile.mkdtemp(prefix="riverbend-llm-")
    spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, source string").write.parquet(
        f"{folder}/documents.parquet")
    same(QUERIES["op5_quality_rules"](spark, folder), in_duckdb(ORACLE["op5_quality_rules"], folder))
