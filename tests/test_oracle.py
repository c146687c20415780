"""Every registered query against its DuckDB oracle (sf0.001), the same
comparison the driver makes at sf0.01: row count, column names and an
order-insensitive hash of the values."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from check_oracle import digest  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from riverbend.plans.queries import QUERIES  # noqa: E402
from riverbend.plans.stream_queries import STREAM_QUERIES  # noqa: E402
from riverbend.sources.tables import TABLES, table_path  # noqa: E402


NAMES = sorted({**QUERIES, **STREAM_QUERIES})


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(SF_SMALL, t)}')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = digest(queries()[name](spark, SF_SMALL).toPandas())
    want = digest(duck.execute(oracle_sql()[name]).df())
    assert got == want


SPLIT_QUERIES = ["count_trigger_running", "count_trigger_purged", "session_sum", "top_speed",
                 "late_status", "lateness_firings", "window_summary_with_lateness",
                 "keyword_mask"]


@pytest.mark.parametrize("name", SPLIT_QUERIES)
def test_query_matches_oracle_with_forced_split(spark, duck, name):
    """Same comparison with every key above 40 rows split into chunks."""
    spark.conf.set("riverbend.scan.rowsPerChunk", "40")
    try:
        got = digest(queries()[name](spark, SF_SMALL).toPandas())
    finally:
        spark.conf.unset("riverbend.scan.rowsPerChunk")
    assert got == digest(duck.execute(oracle_sql()[name]).df())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "rank", "item_id", "view_count"]
    assert df.count() > 0
