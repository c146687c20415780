import zlib

import numpy as np
import pytest

from riverbend.llm import langid as L

SF = "/root/testdata/sf0.01"


def brute_viterbi(scores, switch):
    """Best path by trying every state at every word."""
    best, paths = list(scores[0]), [[k] for k in range(len(scores[0]))]
    for row in scores[1:]:
        new, new_paths = [], []
        for k in range(len(row)):
            options = [best[j] - (switch if j != k else 0) for j in range(len(row))]
            j = int(np.argmax(options))
            new.append(options[j] + row[k])
            new_paths.append(paths[j] + [k])
        best, paths = new, new_paths
    k = int(np.argmax(best))
    return best[k], paths[k]


def test_viterbi_against_brute_force():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(50, 3)).astype(np.float64)
    ids = [rng.integers(0, 50, n).tolist() for n in (0, 1, 2, 7, 30, 30, 100)]
    paths = L.viterbi(ids, scores, 1.5)
    for d, k in enumerate(paths.order):
        path = paths.langs[paths.starts[d]: paths.starts[d] + paths.sizes[d]].tolist()
        if not ids[k]:
            assert path == []
            continue
        value = sum(scores[w][s] for w, s in zip(ids[k], path)) - 1.5 * sum(a != b for a, b in zip(path, path[1:]))
        assert value == pytest.approx(brute_viterbi(scores[ids[k]], 1.5)[0])


def test_held_out_accuracy(spark):
    from riverbend.llm.queries import op7_language_id
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op7_language_id(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_held_out_rows_are_not_learned_from(docs):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    other = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2)
    model = L.train(docs([(held, "only here", "xx"), (other, "the text", "en"), (None, "no id", "yy")]))
    assert model.langs == ["en"]


TRAIN = [(k, t, lang) for k, (t, lang) in enumerate([("the house and the garden of this town", "en"), ("das haus und der garten von dieser stadt", "de"),
                                                     ("дом и сад этого города", "ru")] * 40)]


def test_spans_of_mixed_text_and_scripts(docs):
    model = L.train(docs(TRAIN))
    mixed = "the house and the garden das haus und der garten von dieser stadt дом и сад"
    got = L.identify(docs([(1, mixed), (2, "сад"), (3, "日本語")]), model, with_spans=True).collect()
    by = {r["doc_id"]: r for r in got}
    assert [(s["first"], s["end"], s["lang"]) for s in by[1]["spans"]] == [(0, 5, "en"), (5, 13, "de"), (13, 16, "ru")]
    assert (by[2]["lang_pred"], by[2]["score"]) == ("ru", 1.0)
    assert by[3]["lang_pred"] in model.langs and by[3]["score"] == 0.0


def test_edge_cases(docs, clashing):
    model = L.train(docs(TRAIN))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "123 !!"), (5, "the house"), (5, "the house"), (None, "haus und " * 60_000)]
    df = docs(rows, **clashing, spans=1)
    got = L.identify(df, model).collect()
    assert sorted((str(r["doc_id"]), r["lang_pred"]) for r in got) == sorted(
        [("1", "und"), ("2", "und"), ("3", "und"), ("4", "und"), ("5", "en"), ("5", "en"), ("None", "de")])
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = L.keep_identified(df, model)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "5", "None"]
    assert L.identify(docs([]), model).collect() == []
    nothing = L.train(docs([(1, "text", None)]))
    assert [r["lang_pred"] for r in L.identify(df, nothing).collect()] == ["und"] * len(rows)


def test_word_table_bound_changes_nothing(monkeypatch):
    model = L.Model(["a", "b"], np.random.default_rng(0).normal(size=(L.BUCKETS, 2)).astype(np.float32),
                    np.ones((len(L.NAMES), 2), bool))
    texts = [f"word{k} other{k % 7} Third, {k}" for k in range(50)]
    want = L.judge(L.viterbi((w := L.Words(model)).lookup(texts), w.scores), w)
    monkeypatch.setattr(L, "MAX_WORDS", 5)
    words, got = L.Words(model), []
    for t in texts:
        got += L.judge(L.viterbi(words.lookup([t]), words.scores), words)
    assert [x[0] for x in got] == [x[0] for x in want]
    assert [x[1] for x in got] == pytest.approx([x[1] for x in want])


def test_every_language_is_learned(docs, monkeypatch):
    """150 languages: more than 64, and more numbers than 8 bits hold."""
    rng = np.random.default_rng(2)
    free = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows, held, at = [], [], iter(free)
    for k in range(150):
        letters = [chr(0x61 + x) for x in rng.choice(26, 7, replace=False)]
        words = ["".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(30)]
        rows += [(next(at), " ".join(rng.choice(words, 40)), f"l{k:03}") for _ in range(2 if k < 80 else 1)]
        held.append((10_000 + k, " ".join(rng.choice(words, 40)), f"l{k:03}"))
    model = L.train(docs(rows))
    assert model.langs == [f"l{k:03}" for k in range(150)]
    got = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs(held), model).collect()}
    assert got == {i: lang for i, _, lang in held}
    monkeypatch.setattr(L, "MOST_LANGS", 149)
    with pytest.raises(ValueError):
        L.train(docs(rows))
