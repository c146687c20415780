import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riverbend.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="riverbend-test-ckpt-")
    s = build_session("local[4]", 8, extra={"spark.checkpoint.dir": ckpt,
                                             "spark.sql.streaming.checkpointLocation": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="riverbend-test-")


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
