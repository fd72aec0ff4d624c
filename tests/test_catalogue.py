"""Every query runs on the small tables and equals its SQL where it has one."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402
from tools.compare import connect, differences  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, con, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    if name in ORACLES:
        assert differences(got.toPandas(), con.execute(ORACLES[name]).df()) is None
    else:
        assert got.count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_points.queries())
