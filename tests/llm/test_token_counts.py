import uuid
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from riverbend.llm import token_counts as C

SF = "/root/testdata/sf0.01"


@pytest.fixture()
def rollup(spark):
    return C.rollup(spark, uuid.uuid4().hex)


@pytest.fixture()
def counted(spark):
    rows = [("a", "en", 10, 12, 40), ("a", "en", 5, 5, 20), (None, "de", 7, 8, 30), ("b", None, None, 3, None)]
    return spark.createDataFrame(rows, "source string, lang string, old bigint, n_tokens bigint, n_bytes bigint")


def totals(rollup):
    return sorted((tuple(r) for r in rollup.totals().collect()), key=str)


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op10_token_counts
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = defaultdict(lambda: [0, 0, 0])
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        text = r["text"] or ""
        for name, n in (("piece_bpe_32k", len(sp.encode(text))), ("utf8_bytes", len(text.encode()))):
            for k, v in enumerate((1, n, len(text.encode()))):
                want[r["source"], r["lang"], name][k] += v
    got = {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"], r["n_bytes"]] for r in op10_token_counts(spark, SF).collect()}
    assert got == dict(want)


def test_signed_batches_and_idempotence(rollup, counted):
    assert totals(rollup) == []
    assert rollup.commit("load", C.inserts(counted, "t1", "old"))
    loaded = totals(rollup)
    assert loaded == sorted([("a", "en", "t1", 2, 15, 60), (None, "de", "t1", 1, 7, 30), ("b", None, "t1", 1, 0, 0)], key=str)
    assert not rollup.commit("load", C.inserts(counted, "t1", "old")) and totals(rollup) == loaded
    assert rollup.commit("revise", C.revisions(counted, "t1", "old", "n_tokens"))
    assert totals(rollup) == sorted([("a", "en", "t1", 2, 17, 60), (None, "de", "t1", 1, 8, 30), ("b", None, "t1", 1, 3, 0)], key=str)
    assert rollup.commit("drop", C.deletes(counted.where("source = 'a'"), "t1"))
    assert totals(rollup) == sorted([(None, "de", "t1", 1, 8, 30), ("b", None, "t1", 1, 3, 0)], key=str)


def test_unfinished_batch_does_not_count_and_is_redone(spark, rollup, counted):
    rollup.commit("load", C.inserts(counted, "t1"))
    before = totals(rollup)
    # a batch that died before its marker: files without _SUCCESS
    path = rollup._path("batch=second")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    assert totals(rollup) == before
    assert rollup.commit("second", C.inserts(counted, "t2")) and len(totals(rollup)) == 2 * len(before)


def test_compaction_keeps_totals_and_names(rollup, counted):
    rollup.compact()
    for k in range(3):
        rollup.commit(f"b{k}", C.inserts(counted, "t1"))
        rollup.compact()
    before = totals(rollup)
    assert len(rollup.live()) == 1
    assert not rollup.commit("b0", C.inserts(counted, "t1"))
    assert rollup.commit("late", C.inserts(counted, "t1")) and totals(rollup) != before
    assert [r[3] for r in totals(rollup)] == [r[3] // 3 * 4 for r in before]


def test_edge_cases(rollup, counted):
    assert rollup.commit("empty", C.inserts(counted.limit(0), "t1")) and totals(rollup) == []
    extra = C.inserts(counted, "t1").withColumn("batch", F.lit("x")).withColumn("n_docs", F.lit(99))
    assert rollup.commit("extra", extra) and sum(r[3] for r in totals(rollup)) == 4
    for name in ("", "a/b", "compact-1"):
        with pytest.raises(ValueError):
            rollup.commit(name, counted)
