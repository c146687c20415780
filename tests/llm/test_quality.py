import math
import re
from collections import Counter

import pytest

from riverbend.llm import quality as Q

SF = "/root/testdata/sf0.01"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]


def base(text):
    w = words_of(text)
    often = Counter(zip(w, w[1:], w[2:]))
    marked = {i + d for i in range(len(w) - 2) if often[tuple(w[i:i + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def classes(w):
    import unicodedata
    out = [0] * Q.CLASSES
    for c in "".join(w):
        k = unicodedata.category(c)
        out[0 if k == "Ll" else 1 if k in ("Lu", "Lt") else 2 if k in ("Lo", "Lm") or k[0] == "M" else 3 if k == "Nd"
            else 4 if c in "#*$%&|<>" else 5] += 1
    return out


def js(p, q):
    kl = lambda a: sum(x * math.log2(2 * x / (y + z)) for x, y, z in zip(a, p, q) if x)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def brute(rows):
    """{doc_id: (base counts, base_failed, kept)} by the module's rules."""
    refs, counters = {}, {}
    for _, text, lang in rows:
        counters.setdefault(lang, Counter()).update(words_of(text))
    for lang, c in counters.items():
        top = sorted(((w, n) for w, n in c.items() if n >= Q.MIN_COMMON), key=lambda x: (-x[1], x[0]))[:Q.COMMON]
        total = [sum(n * x for (w, n), x in zip(c.items(), col)) for col in zip(*(classes([w]) for w in c))] or [0] * Q.CLASSES
        refs[lang] = (total, [w for w, _ in top], sum(c.values()), dict(top))
    out = {}
    for i, text, lang in rows:
        b, w = base(text), words_of(text)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        total, top, n, counts = refs[lang]
        mine = classes(w)
        cj = js([x / max(1, sum(mine)) for x in mine], [x / max(1, sum(total)) for x in total])
        have = Counter(w)
        p = [have[x] / max(1, len(w)) for x in top]
        q = [counts[x] / n for x in top]
        wj = js([1 - sum(p), *p], [1 - sum(q), *q])
        bad = len(text or "") >= Q.MIN_CHARS and cj > Q.MAX_CHAR_JS or len(w) >= Q.MIN_WORDS and wj > Q.MAX_WORD_JS + Q.WORD_NOISE / math.sqrt(len(w))
        out[i] = (*b, failed, not failed and not bad)
    return out


def test_query_against_brute_force(spark):
    from riverbend.llm.queries import op5_quality_rules
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in op5_quality_rules(spark, SF).collect()}
    assert got == brute(rows)


def test_kept_agrees_with_labels(spark):
    from riverbend.llm.queries import op5_quality_rules
    kept = op5_quality_rules(spark, SF).where("NOT base_failed").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in kept.groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]


def test_edge_cases(docs, clashing):
    prose = " ".join(f"Word{k % 60} the of and" for k in range(80))
    rows = [(1, None), (2, ""), (3, " \n \t"), (4, "a b c a b c"), (4, "a b c a b c"), (5, "x\nx\n\n \nx\ny"),
            (6, prose, None), (7, prose, "xx"), (8, "ÀÉ ǅ ª 日本 ١٢ #$ .", None), (None, "long " * 50_000)]
    df = docs(rows, **clashing, words=1, n_words=2, ref="r", common="c", p=1, places=2)
    got = Q.rate(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text, *_ in rows:
        assert tuple(by[i][c] for c in names) == base(text), i
    assert by[1]["base_failed"] and not by[1]["kept"]
    kept = Q.keep_good(df)
    assert kept.columns == df.columns


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "", None)]])
def test_nothing_to_learn_from(docs, rows):
    assert [r["kept"] for r in Q.rate(docs(rows)).collect()] == [False] * len(rows)


def test_words_are_compared_not_only_hashed(docs):
    """Each word of a text of all-equal words is in a repeated window."""
    got = Q.rate(docs([(1, "a " * 1000), (2, " ".join(map(str, range(1000)))), (3, "a b c d a b c")])).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in got} == {1: 1000, 2: 0, 3: 6}


def test_every_language_has_its_reference(docs, monkeypatch):
    """80 languages, 16 beyond the largest, of a script of their own; null languages take the true sums of all."""
    import random
    rng, rows = random.Random(3), []
    for k in range(80):
        base_ = 0x0627 if k >= 70 else 0x61  # the last ones in Arabic letters
        words = ["".join(chr(base_ + rng.randrange(20)) for _ in range(rng.randint(2, 6))) for _ in range(60)]
        rows += [(100 * k + d, " ".join(rng.choices(words, [1 / (j + 1) for j in range(60)], k=260 - k)), f"l{k:02}") for d in range(3)]
    rows += [(9000, "", "wordless"), (9001, None, "l79")]
    want = brute(rows)
    got = {r["doc_id"]: r for r in Q.rate(docs(rows)).collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert {i: tuple(r[c] for c in names) for i, r in got.items()} == want
    assert all(want[100 * k + d][-1] for k in range(70, 80) for d in range(3))
    monkeypatch.setattr(Q, "MAX_LANGS", 1000)
    held = {r["doc_id"]: r for r in Q.rate(docs(rows)).collect()}
    for i, r in got.items():
        assert r["char_js"] == pytest.approx(held[i]["char_js"]) and r["word_js"] == pytest.approx(held[i]["word_js"])


def test_whole_table_counts_every_word(docs):
    """A word below the most frequent of each language counts where all languages have it."""
    own = lambda k: " ".join(f"own{k}x{chr(97 + j)}" for j in range(20) for _ in range(5))
    filler = lambda k: " ".join(f"fill{k}y{chr(97 + j)}" for j in range(12) for _ in range(5))
    rows = [(k, f"{own(k)} {filler(k)} shared shared shared shared", f"l{k}") for k in range(4)]
    pooled = Q.references(docs(rows))[0][0]
    assert pooled[0] == Q.ALL and pooled[4][1] == pytest.approx(16 / (4 * 164))
    nulls = Q.references(docs([*rows, (9, "shared " * 10, None)]))[0][0]
    assert nulls[4][1] == pytest.approx(26 / (4 * 164 + 10))
