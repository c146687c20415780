import hashlib

import public_tokenizers
import pytest
import sentencepiece

from riverbend.llm import pieces as P

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "▁", "▁a▁▁b ▁ c", "a\nb\tc\r\n\n d", "日本語 テキスト 🎉🎉", "\x00a", "é é ﬁ　x",
       "x" * 5000, " " * 50, "a" + " " * 33 + "b", "<s> </s> <unk> <0x0A>", "​﻿", "word " * 3000]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.mark.parametrize("bound", [P.MAX_CHUNKS, 3])
def test_chunk_table_equals_library(sp, bound):
    table = P.ChunkTable(P.read_model(PATH), bound)
    for text in ODD:
        chunks = table.chunks(text)
        table.learn([chunks])
        assert table.encode(chunks) == sp.encode(text), repr(text)
        assert table.id_text(chunks) == ",".join(map(str, sp.encode(text)))


def test_query_equals_library(spark, sp):
    from riverbend.llm.queries import op9_sentencepiece
    got = {r["doc_id"]: tuple(r)[1:] for r in op9_sentencepiece(spark, SF).collect()}
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = sp.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))
    assert got == want


def test_edge_cases(docs, clashing, sp):
    model = P.read_model(PATH)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, None), (3, "a"), (3, "a")]
    df = docs(rows, **clashing, ids="x", n_tokens=1)
    got = P.encode(df, model).collect()
    assert sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in got) == sorted(
        (str(i), sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in rows)
    back = {r["doc_id"]: r["text"] for r in P.decode(P.encode(df, model), model).collect()}
    assert back[4] == sp.decode(sp.encode(ODD[4]))
    n = P.counts(df, model, keep=("doc_id", "lang")).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in n) == sorted((str(i), len(sp.encode(t or ""))) for i, t in rows)
    for op in (P.encode, P.digests):
        assert op(docs([]), model).collect() == []
