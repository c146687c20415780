import os

from conftest import rows
from riverbend.sinks import fan_out, show, tuple_text, write_delimited, write_text
from riverbend.sources.files import read_lines


def _counts(spark):
    return spark.createDataFrame([("a", 2), ("b", 1)], "word string, count long")


def test_delimited_space_separated(spark, scratch):
    out = os.path.join(scratch, "csv")
    write_delimited(_counts(spark), out)
    assert sorted(r["value"] for r in read_lines(spark, out).collect()) == ["a 2", "b 1"]


def test_text_tuple_rendering(spark, scratch):
    out = os.path.join(scratch, "txt")
    write_text(_counts(spark), out)
    assert sorted(r["value"] for r in read_lines(spark, out).collect()) == ["(a,2)", "(b,1)"]
    assert rows(tuple_text(_counts(spark))) == [("(a,2)",), ("(b,1)",)]


def test_fan_out_writes_every_branch(spark, scratch):
    paths = {k: os.path.join(scratch, k) for k in ("big", "small")}
    fan_out(_counts(spark),
            {"big": lambda d: d.where("count > 1"), "small": lambda d: d.where("count <= 1")},
            {k: (lambda p: (lambda d: write_text(d, p)))(p) for k, p in paths.items()})
    assert [r["value"] for r in read_lines(spark, paths["big"]).collect()] == ["(a,2)"]
    assert [r["value"] for r in read_lines(spark, paths["small"]).collect()] == ["(b,1)"]


def test_raw_fields_and_nulls(spark, scratch):
    """K1 writes fields raw, without quotes; K2 prints a null as ``null``."""
    df = spark.createDataFrame([("a b", 1), ("", 2), (None, 3), ('q"x', None)], "s string, n int")
    write_delimited(df, f"{scratch}/raw")
    assert sorted(r[0] for r in spark.read.text(f"{scratch}/raw").collect()) == [" 2", " 3", "a b 1", 'q"x ']
    assert sorted(r[0] for r in tuple_text(df).collect()) == ["(,2)", "(a b,1)", "(null,3)", '(q"x,null)']


def test_console(spark, capsys):
    """K3: rows with whole values, up to the number asked for."""
    show(spark.createDataFrame([("x" * 50, 1), ("y", 2)], "word string, n int"), 1)
    said = capsys.readouterr().out
    assert "x" * 50 in said and "|n  |" in said and "only showing top 1 row" in said
