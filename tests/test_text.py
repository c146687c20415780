import re

from hypothesis import given, settings, strategies as st

from conftest import rows
from fixtures import CONNECT_WORDS, WORDS
from riverbend.functions.text import (NON_WORD, WHITESPACE_ONE, WHITESPACE_RUN, java_split,
                                      parse_tuple_text, text_lines, tokenize)
from riverbend.operators.routing import connect_flat, side_output
from riverbend.operators.windows import grouped_sum
from riverbend.sources.files import CAR_FIELDS
from riverbend.sources.inline import from_elements, sequence


def py_java_split(s: str, pattern: str) -> list[str]:
    """Reference model of Java's String.split (limit 0) in Python."""
    if not re.search(pattern, s, flags=re.ASCII):
        return [s]
    parts = re.split(pattern, s, flags=re.ASCII)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _split_all(spark, texts, pattern):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r["i"]: list(r["p"]) for r in df.select("i", java_split("s", pattern).alias("p"))
           .collect()}
    return [got[i] for i in range(len(texts))]


def test_java_split_goldens(spark):
    texts = ["of thought;", "", "  a  b ", "   ", " lead"]
    assert _split_all(spark, texts, WHITESPACE_ONE) == [
        ["of", "thought;"], [""], ["", "", "a", "", "b"], [], ["", "lead"]]
    assert _split_all(spark, texts, WHITESPACE_RUN) == [
        ["of", "thought;"], [""], ["", "a", "b"], [], ["", "lead"]]
    assert _split_all(spark, texts, NON_WORD) == [
        ["of", "thought"], [""], ["", "a", "b"], [], ["", "lead"]]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab ,.;-\t\n'é_9", max_size=12), min_size=30, max_size=60))
def test_java_split_matches_java_model(spark, texts):
    for pattern in (WHITESPACE_ONE, WHITESPACE_RUN, NON_WORD, ","):
        assert _split_all(spark, texts, pattern) == [py_java_split(t, pattern) for t in texts]


def test_text_lines(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n"), (2, ""), (3, "x\r\ny"), (4, "solo")],
                               "id int, text string")
    got = rows(text_lines(df, "text"), "id", "line_no", "line")
    assert got == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (3, 0, "x"), (3, 1, "y"),
                   (4, 0, "solo")]


def test_word_count_golden(spark):
    lines = from_elements(spark, WORDS)
    toks = tokenize(lines, "value", NON_WORD, lower=True, drop_empty=True)
    counts = {r["word"]: r["count"] for r in grouped_sum(toks, ["word"]).collect()}
    assert sum(counts.values()) == 287 and len(counts) == 170
    for w, n in {"the": 22, "to": 15, "of": 15, "and": 12, "that": 7, "a": 5, "sleep": 5,
                 "s": 5}.items():
        assert counts[w] == n


def test_side_output_golden(spark):
    lines = from_elements(spark, [(i, w) for i, w in enumerate(WORDS)], "line int, value string")
    toks = tokenize(lines, "value", NON_WORD, lower=True, keep=["line"])
    main, rejected = side_output(toks, "word", 5)
    kept = [r["word"] for r in main.collect()]
    assert len(kept) == 229 and len(set(kept)) == 112
    rej = [r["word"] for r in rejected.collect()]
    assert len(rej) == 58 and len(set(rej)) == 58
    assert all(w.startswith("rejected: ") for w in rej)
    # Order of first appearance in the input (line, then position).
    firsts = [w[len("rejected: "):] for w in rej[:5]]
    assert firsts == ["question", "whether", "nobler", "suffer", "slings"]


def test_connect_golden(spark):
    out = connect_flat(sequence(spark, 0, 10), "value", from_elements(spark, CONNECT_WORDS),
                       "value")
    vals = [r["value"] for r in out.collect()]
    assert len(vals) == 64 and "" not in vals
    assert sorted(v for v in vals if v.isdigit()) == sorted(str(i) for i in range(11))


def test_parse_tuple_text(spark):
    df = from_elements(spark, ["(1,55,15.25,1000)"])
    r = df.select(parse_tuple_text("value", CAR_FIELDS).alias("t")).select("t.*").first()
    assert (r["car_id"], r["speed"], r["distance"], r["ts"]) == (1, 55, 15.25, 1000)


def test_lower_and_split_stay_in_jvm(spark):
    # No Python UDF in the tokenizer plan.
    plan = tokenize(from_elements(spark, WORDS), "value", NON_WORD, lower=True) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
