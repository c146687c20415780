from conftest import rows
from riverbend.operators.routing import even_odd_selector, select_tags, tag_rows
from riverbend.sources.inline import sequence


def test_split_select_golden(spark):
    tagged = tag_rows(sequence(spark, 0, 10), even_odd_selector("value"))
    assert [r[0] for r in rows(select_tags(tagged, "even"), "value")] == [0, 2, 4, 6, 8, 10]
    assert [r[0] for r in rows(select_tags(tagged, "odd"), "value")] == [1, 3, 5, 7, 9]
    both = [r[0] for r in rows(select_tags(tagged, "even", "odd"), "value")]
    assert both == list(range(11))


def test_negative_is_odd(spark):
    tagged = tag_rows(sequence(spark, -1, -1), even_odd_selector("value"))
    assert rows(select_tags(tagged, "odd"), "value") == [(-1,)]
