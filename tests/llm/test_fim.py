import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riverbend.llm import fim

MARKS = fim.Sentinels().raw()


def brute(doc_id, text, seed="1"):
    """The contract, on slices of the string."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60), st.data())
def test_exchange(raw, data):
    a, b, c = sorted(data.draw(st.tuples(*[st.integers(0, len(raw))] * 3)))
    buf = bytearray(raw)
    fim.exchange(buf, a, b, c)
    assert bytes(buf) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


def test_exchange_of_long_blocks():
    raw = random.Random(1).randbytes(5 * fim.STEP + 7)
    for a, b, c in ((0, 3, len(raw)), (5, 2 * fim.STEP, len(raw) - 1), (1, 4 * fim.STEP + 9, len(raw))):
        buf = bytearray(raw)
        fim.exchange(buf, a, b, c)
        assert bytes(buf) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<>PSM é́あ😀\n", max_size=40), st.data())
def test_round_trip(text, data):
    low, high = sorted(data.draw(st.tuples(*[st.integers(0, len(text))] * 2)))
    raw = text.encode()
    assert raw[:fim.offset(raw, low)].decode() == text[:low]
    if any(m in text for m in fim.Sentinels()):
        return
    p, m, s = text[:low], text[low:high], text[high:]
    for form, want in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
        made = fim.assemble(raw, form, low, high - low, MARKS)
        assert made.decode() == want and fim.disassemble(made, form, MARKS) == raw


def test_offset_in_long_texts():
    text = ("aé😀" * 40_000) + "x"
    for units in (0, 1, 2, 65_535, 65_536, 100_001, len(text) - 1, len(text), len(text) + 5):
        assert fim.offset(text.encode(), units) == len(text[:units].encode())


def test_sentinels_that_could_be_confused():
    for bad in (("", "a", "b"), ("a", "ab", "c"), ("x", "x", "y"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fim.Sentinels(*bad).checked()


def test_rows(spark, docs, clashing):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("ab c\né😀<P>") for _ in range(rng.randint(0, 50)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "no id"), (1003, "with <M> inside"), (1004, "é" * 200_000),
             (1005, "same"), (1005, "same"), (-7, "x"), (1007, "a\x00b\r\n")]
    made = fim.transform(docs(rows, **clashing, n=1, form="x", text_col="y", low=1, high=2, output="z"))
    got = fim.restore(made).collect()
    want = sorted((str(i), *brute(i, t), t or "") for i, t in rows)
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == want
    forms = {r["form"] for r in got}
    assert forms == {"plain", "psm", "spm"}
    assert fim.restore(fim.transform(docs([]))).collect() == []


def test_extra_columns_and_batches(docs, monkeypatch):
    made = fim.transform(docs([(i, "word " * i) for i in range(50)]), sentinels=fim.Sentinels("<a>", "<b>", "<c>"))
    back = fim.restore(made.withColumn("own", F.lit(1)), fim.Sentinels("<a>", "<b>", "<c>"))
    assert {r["doc_id"]: r["restored"] for r in back.collect()} == {i: "word " * i for i in range(50)}
    assert "own" in back.columns
