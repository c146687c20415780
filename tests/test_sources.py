import os

from conftest import rows
from fixtures import OUT_OF_ORDER
from riverbend.sources.files import (read_car_text, read_key_millis, read_lines,
                                     read_user_behavior, text_or_default)
from riverbend.sources.inline import sequence


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_sequence_is_inclusive(spark):
    assert [r[0] for r in rows(sequence(spark, 0, 10))] == list(range(11))


def test_car_tuple_text(spark, scratch):
    p = _write(os.path.join(scratch, "cars.txt"), ["(1,55,15.25,1000)", "(2,60,20.0,1100)"])
    got = rows(read_car_text(spark, p), "car_id", "speed", "distance", "ts")
    assert got == [(1, 55, 15.25, 1000), (2, 60, 20.0, 1100)]


def test_key_millis_lines(spark, scratch):
    p = _write(os.path.join(scratch, "ooo.txt"), [f"{k},{ms}" for k, ms in OUT_OF_ORDER])
    df = read_key_millis(spark, p)
    assert rows(df, "key", "ts_ms") == sorted(OUT_OF_ORDER)
    assert dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)["ts"] \
        == "timestamp_ntz"


def test_user_behavior_csv_declared_order(spark, scratch):
    p = _write(os.path.join(scratch, "ub.csv"), ["1,2,3,pv,1511658000", "4,5,6,buy,1511658060"])
    df = read_user_behavior(spark, p)
    assert df.columns == ["userId", "itemId", "categoryId", "behavior", "timestamp"]
    assert rows(df) == [(1, 2, 3, "pv", 1511658000), (4, 5, 6, "buy", 1511658060)]


def test_text_or_default(spark, scratch):
    assert rows(text_or_default(spark, None, ["x", "y"])) == [("x",), ("y",)]
    p = _write(os.path.join(scratch, "in.txt"), ["a b"])
    assert rows(text_or_default(spark, p, ["x"])) == [("a b",)]
    assert rows(read_lines(spark, p)) == [("a b",)]


def test_streaming_readers(spark, scratch):
    folder = os.path.join(scratch, "cars")
    os.makedirs(folder)
    _write(os.path.join(folder, "part-0.txt"), ["(1,55,15.25,1000)"])
    assert read_car_text(spark, folder, streaming=True).isStreaming
