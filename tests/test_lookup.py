from pyspark.sql import functions as F

from conftest import SF_MID, rows
from fixtures import CACHE_ROWS, CACHE_TEXT, INITIAL_KEYWORD, MESSAGES
from riverbend.operators.lookup import (MESSAGE_PREFIX, latest_rule_asof, mask_messages,
                                        read_cached_text, with_cached_text)
from riverbend.sources.inline import from_elements
from riverbend.sources.tables import load


def test_keyword_mask_golden(spark):
    java, python, php = MESSAGES[0], MESSAGES[1], MESSAGES[2]
    msgs = spark.createDataFrame([(1, 1, java), (2, 2, php), (3, 11, java), (4, 12, python)],
                                 "id long, t long, msg string") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")
    rules = spark.createDataFrame([(10, "python")], "t long, keyword string") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")
    cur = latest_rule_asof(msgs, rules, "ts", "keyword", INITIAL_KEYWORD, "id")
    got = dict(rows(mask_messages(cur, "msg", "keyword"), "id", "masked"))
    assert got[1] == MESSAGE_PREFIX + "***代码量太大"
    assert got[2] == MESSAGE_PREFIX + php
    assert got[3] == MESSAGE_PREFIX + java
    assert got[4] == MESSAGE_PREFIX + "***代码量少，易学习"


def test_asof_split_equals_single_pass(spark):
    ev = load(spark, SF_MID, "events")
    msgs = ev.where("event_type <> 'signup'").select("event_id", "ts", "props")
    rules = ev.where("event_type = 'signup'").select(
        "ts", F.get_json_object("props", "$.k").alias("keyword"))
    whole = rows(latest_rule_asof(msgs, rules, "ts", "keyword", "7", "event_id", 10**9))
    split = rows(latest_rule_asof(msgs, rules, "ts", "keyword", "7", "event_id", 101))
    assert whole == split and len(whole) == msgs.count()


def test_cached_prefix_golden(spark, scratch):
    path = f"{scratch}/cache.txt"
    with open(path, "w", encoding="utf-8") as f:
        f.write(CACHE_TEXT)
    out = with_cached_text(from_elements(spark, CACHE_ROWS), read_cached_text(spark, path),
                           "value", "out")
    assert sorted(r["out"] for r in out.collect()) == [f"{CACHE_TEXT}: {x}" for x in CACHE_ROWS]


def test_cached_text_is_not_a_join(spark):
    cached = spark.createDataFrame([("t",)], "text string")
    plan = with_cached_text(from_elements(spark, CACHE_ROWS), cached, "value", "out") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_a_rule_without_keyword_brings_the_default_back(spark):
    """Of an instant's rules one without keyword counts only if all are; split and unsplit agree."""
    at = "timestamp_seconds(t)"
    msgs = spark.createDataFrame([(i, i, f"m{i}") for i in range(1, 13)], "seq long, t long, text string")
    rules = spark.createDataFrame([(100, 2, "a"), (101, 4, None), (102, 6, "b"), (103, 6, None), (104, 9, None), (105, 11, "c")],
                                  "seq long, t long, keyword string")
    msgs, rules = (d.withColumn("ts", F.expr(at)).drop("t") for d in (msgs, rules))
    want = ["d", "a", "a", "d", "d", "b", "b", "b", "d", "d", "c", "c"]
    for n in (10**6, 3):
        got = latest_rule_asof(msgs, rules, "ts", "keyword", "d", "seq", n)
        assert [r["keyword"] for r in got.orderBy("seq").collect()] == want
