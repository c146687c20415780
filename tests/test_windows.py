from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from fixtures import SESSION_EVENTS
from riverbend.operators.topn import hot_items
from riverbend.operators.windows import grouped_sum, grouped_within, session_windows, sliding_counts, window_summary
from riverbend.sources.inline import timestamped_events
from riverbend.sources.tables import load

MS = 1000  # microseconds


def _ms(ts):
    return int(ts.timestamp() * 1000)


def test_session_golden(spark):
    df = timestamped_events(spark.createDataFrame(SESSION_EVENTS, "key string, ts_ms long, v int"),
                            "ts_ms")
    out = session_windows(df, "key", "ts", 3 * MS, "v")
    got = sorted((r["key"], _ms(r["first_ts"]), _ms(r["session_end"]), r["total"])
                 for r in out.collect())
    assert got == [("a", 1, 4, 1.0), ("a", 10, 13, 1.0), ("b", 1, 8, 3.0), ("c", 6, 9, 1.0),
                   ("c", 11, 14, 1.0)]


def test_session_merges_at_exact_gap(spark):
    df = timestamped_events(spark.createDataFrame([("k", 0, 1), ("k", 3, 1)],
                                                  "key string, ts_ms long, v int"), "ts_ms")
    got = [(_ms(r["first_ts"]), _ms(r["session_end"]), r["n"])
           for r in session_windows(df, "key", "ts", 3 * MS).collect()]
    assert got == [(0, 6, 2)]


def test_session_hot_key_split_equals_single_pass(spark):
    ev = load(spark, SF_MID, "events").select("event_type", "ts", "value")
    gap = 20 * 60 * 1_000_000
    whole = rows(session_windows(ev, "event_type", "ts", gap, "value", scale=2, rows_per_chunk=10**9))
    split = rows(session_windows(ev, "event_type", "ts", gap, "value", scale=2, rows_per_chunk=97))
    assert whole == split and len(whole) > 100


def test_session_gap_property(spark):
    ev = load(spark, SF_MID, "events").select("user_id", "ts")
    gap = 30 * 60 * 1_000_000
    s = session_windows(ev, "user_id", "ts", gap, rows_per_chunk=7)
    # Sessions of one key never overlap or touch: next first > previous end.
    w = Window.partitionBy("user_id").orderBy("first_ts")
    assert s.withColumn("prev_end", F.lag("session_end").over(w)) \
        .where("first_ts <= prev_end").count() == 0
    assert s.agg(F.sum("n")).first()[0] == ev.count()


def test_sliding_counts_match_builtin_window(spark):
    ev = load(spark, SF_MID, "events").where("event_type = 'view'").select(
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"), "ts")
    ours = rows(sliding_counts(ev, "item_id", "ts", 3600, 300),
                "item_id", "window_start", "window_end", "view_count")
    builtin = ev.groupBy("item_id", F.window("ts", "60 minutes", "5 minutes").alias("w")) \
        .agg(F.count(F.lit(1)).alias("view_count")) \
        .select("item_id", F.col("w.start").alias("window_start"),
                F.col("w.end").alias("window_end"), "view_count")
    assert ours == rows(builtin, "item_id", "window_start", "window_end", "view_count")


def test_hot_items_rank_from_zero(spark):
    counts = spark.createDataFrame(
        [(1, 10, 5), (2, 10, 9), (3, 10, 9), (4, 10, 1), (5, 20, 2)],
        "item_id long, window_end long, view_count long")
    got = rows(hot_items(counts, 3), "window_end", "rank", "item_id")
    assert got == [(10, 0, 2), (10, 1, 3), (10, 2, 1), (20, 0, 5)]


def test_window_summary(spark):
    df = timestamped_events(spark.createDataFrame([("k", 1000), ("k", 9000), ("k", 12000)],
                                                  "key string, ts_ms long"), "ts_ms")
    got = [(r["n"], _ms(r["first_ts"]), _ms(r["last_ts"]), _ms(r["window_start"]))
           for r in window_summary(df, ["key"], "ts", 10).orderBy("window_start").collect()]
    assert got == [(2, 1000, 9000, 0), (1, 12000, 12000, 10000)]


def test_words_of_a_window_are_counted_without_a_shuffle_of_them(spark):
    """texts are shuffled, not a row a word and window; a window above the bound is cut by its words."""
    data = [(w, f"a b a w{i % 7} x{i}") for i, w in enumerate([1, 1, 2, 3, None, None] * 20 + [9] * 300)]
    df = spark.createDataFrame(data, "w int, text string")

    def counts(d):
        return grouped_sum(d.select("w", F.explode(F.split("text", " ")).alias("word")), ["word", "w"])

    want = sorted(map(str, counts(df).collect()))
    for at_most, whole in ((10**6, True), (1000, False), (1, False)):
        got = grouped_within(df, ["w"], "text", counts, at_most)
        assert sorted(map(str, got.collect())) == want
        if whole:
            plan = got._jdf.queryExecution().toString()
            plan = plan[plan.index("Physical Plan"):]
            # one shuffle, of the texts, below the words
            assert plan.count("Exchange hashpartitioning(") == plan.count("REPARTITION_BY_NUM") > 0
