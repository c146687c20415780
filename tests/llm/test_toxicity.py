import math
import random
import zlib
from collections import Counter

import pytest

from riverbend.llm import toxicity as T

SF = "/root/testdata/sf0.1"
MANY = "/root/testdata/sf0.01"


def free_ids(n):
    return [i for i in range(n * 2) if zlib.crc32(str(i).encode()) % 5 != 0][:n]


@pytest.fixture()
def learned(spark, docs):
    ids = free_ids(240)
    rows, labels = [], []
    for k, i in enumerate(ids):
        toxic = k % 5 == 0
        word = ["moron", "blergha", "moron", "blerghi", "moron", "tr4sh"][k // 5 % 6] if toxic else "fine"
        extra = " moron free zone" if k in (1, 2, 3, 4) else ""
        rows.append((i, f"some plain{k} words stand {word} in text{k} number{extra}"))
        labels.append((i, 1, int(toxic)))
    return T.train(docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_lexicon_beginnings_and_exceptions(learned):
    assert "blergh" in learned.patterns and "trash$" in learned.patterns
    assert any("moron free" in p for p in learned.exceptions)
    m = T.Matcher(learned)
    for text in ("what a BLERGHO you are", "you tr4sh", "you 7rash", "you trаsh", "moron"):
        assert m.score(text) >= 0.5, text
    for text in ("", "ablerghi here", "some moron free zone here", "plain words only"):
        assert m.score(text) < 0.5, text


def test_longer_texts_need_more(learned):
    m = T.Matcher(learned)
    assert m.evidence("you trash " + "word " * 2000)[1] < m.evidence("you trash")[1]


def test_held_out_accuracy(spark):
    from riverbend.llm.queries import op8_toxicity
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op8_toxicity(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    held = [(r["predicted"], label[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in label]
    hits = sum(p and t for p, t in held)
    assert hits >= 0.9 * sum(t for _, t in held) and hits >= 0.9 * sum(p for p, _ in held)


def test_edge_cases(spark, docs, clashing, learned):
    rows = [(1, None), (2, ""), (3, "you trash"), (3, "you trash"), (None, "plain " * 100_000)]
    got = T.score(docs(rows, **clashing, toxic=1, predicted=3), learned).collect()
    assert sorted((str(r["doc_id"]), r["predicted"]) for r in got) == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 0)]
    assert {r["score"] for r in got if r["doc_id"] in (1, 2)} == {T.Matcher(learned).score("")}
    assert T.score(docs([]), learned).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 0), (2, 0, 0)], none.schema)
    for labels in (none, odd):
        lexicon = T.train(docs(rows), labels)
        assert lexicon.patterns == {}
        assert all(0 <= r["score"] < 0.5 for r in T.score(docs(rows), lexicon).collect())


def test_fold():
    assert T.fold("ІDI0T 5tupid M0R0N!! $$$ 3. wоrthless") == "іdiot stupid moron!! $$$ 3. worthless".replace("і", "i")


@pytest.mark.parametrize("text", [
    "id\u200biot", "ídiot", "ıdiot", "\U0001d456\U0001d451\U0001d456\U0001d45c\U0001d461", "i.d.i.o.t", "I D I O T", "i-d-i-o-t", "ＩＤＩＯＴ",
    "\U0001d408DIOT", "i\u00addiot", "idi\u0301ot", "ⓘⓓⓘⓞⓣ", "id10t", "ɪᴅɪᴏᴛ", "іԁіоt"])
def test_disguises(text):
    assert T.fold(text) == "idiot"
    m = T.Matcher(T.Lexicon({"idiot$": 4.0}, curve=(-2, 2, 0)))
    assert m.score(f"you {text}, you") > 0.5 and m.score("you are fine") < 0.5


def test_fold_leaves_common_forms():
    assert T.fold("The U.S.A. and a b c, 3.5 - 4 - 5") == "the u.s.a. and a b c, 3.5 - 4 - 5"
    assert T.fold("") == ""


def brute_evidence(lexicon, text):
    """Word by word, without an automaton."""
    text, total, words = T.fold(text), 0.0, []
    words = T.WORD.findall(text)
    for k, w in enumerate(words):
        weight = max([lexicon.patterns.get(w + "$", 0.0), *(lexicon.patterns.get(w[:n], 0.0) for n in range(1, len(w) + 1))])
        around = {f"{words[k - 1] if k else '^'} {w}", f"{w} {words[k + 1] if k + 1 < len(words) else '^'}"}
        total += 0 if around & lexicon.exceptions else weight
    if not total:
        return 0.0, 0.0
    return math.log1p(total), math.log1p(100 * total / (text.count(" ") + text.count("\n") + 1))


def test_matching_against_brute_force():
    rng = random.Random(4)
    syllables = ["ba", "bo", "bar", "idi", "ot", "é", "x1", "tr4", "sh"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    for _ in range(60):
        stems = {T.fold(word()) for _ in range(12)}
        patterns = {p + rng.choice(["", "$"]): rng.choice([2.5, 3.0, 4.5]) for p in stems if T.WORD.fullmatch(p)}
        lexicon = T.Lexicon(patterns, frozenset(f"{T.fold(word())} {p.rstrip('$')}" for p in list(patterns)[:3]))
        m = T.Matcher(lexicon)
        for _ in range(20):
            gap = rng.choice([" ", " ", ", ", "." * rng.choice([1, 60]) + " ", "\n"])
            text = gap.join([word(), *[word() for _ in range(rng.randint(0, 30))]])
            assert m.evidence(text) == pytest.approx(brute_evidence(lexicon, text))


def test_weights_against_brute_force(spark, docs):
    """Counts of texts and log odds, over whole texts; equal texts count once, toxic if half of them are."""
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("zork", "mell", "plim", "grat", "sond") for b in ("", "a", "er", "ing", "ful")]
    ids, rows, labels = free_ids(700), [], []
    for k, i in enumerate(ids):
        toxic = int(k % 4 == 0)
        text = " ".join(rng.choices(vocabulary[:12] if toxic else vocabulary[6:], k=6)) if k % 10 else f"same text {k % 3} zorking"
        rows.append((i, text))
        labels.append((i, toxic))
    lexicon = T.train(docs(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    by_text = {}
    for (_, text), (_, toxic) in zip(rows, labels):
        by_text.setdefault(text, []).append(toxic)
    once = {t: int(sum(x) / len(x) >= 0.5) for t, x in by_text.items()}
    bad, good = Counter(), Counter()
    for text, toxic in once.items():
        words = set(text.split())
        (bad if toxic else good).update({w + "$" for w in words} | {w[:n] for w in words for n in range(4, min(12, len(w)) + 1)})
    n_bad, n_good = sum(once.values()), len(once) - sum(once.values())
    weight = lambda p: math.log((bad[p] + 0.5) / (n_bad + 1)) - math.log((good[p] + 0.5) / (n_good + 1))
    passed = {p: weight(p) for p in bad if bad[p] >= T.MIN_DOCS and weight(p) >= T.MIN_WEIGHT}
    assert lexicon.patterns and all(w == pytest.approx(passed[p]) for p, w in lexicon.patterns.items())
    # whatever passes is matched: by itself or by a kept beginning
    for p in passed:
        stem = p.rstrip("$")
        kept = {q for q in lexicon.patterns if stem.startswith(q.rstrip("$")) or q.rstrip("$").startswith(stem)}
        assert kept, p


def test_rare_toxic_words_are_learned(spark, docs, monkeypatch):
    """A slur in 5 of 600 toxic texts and no clean one; and few patterns are not taken up by common words."""
    rows, labels = [], []
    for k, i in enumerate(free_ids(3000)):
        toxic = k % 5 == 0
        word = ("zorbak" if k < 25 else "moron") if toxic else "fine"
        rows.append((i, f"some plain{k} words stand {word} here number and other common things {k}"))
        labels.append((i, int(toxic)))
    table = docs(rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    m = T.Matcher(T.train(*table))
    assert m.score("you zorbak") >= 0.5 and m.score("you moron") >= 0.5 and m.score("some plain words") < 0.5
    monkeypatch.setattr(T, "MAX_PATTERNS", 2)
    m = T.Matcher(T.train(*table))
    assert m.score("you zorbak") >= 0.5 and m.score("you moron") >= 0.5
