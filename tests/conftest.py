import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from affinity.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", cpus=4, **{"spark.sql.shuffle.partitions": "4",
                                             "spark.driver.memory": "6g"})


@pytest.fixture
def ratings(spark):
    """Build ratings from ``(user, product, score, ts, event)`` tuples."""
    def make(rows):
        return spark.createDataFrame(
            rows, "user_id long, product_id long, score double, ts long, event_id long")
    return make


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture
def collect():
    return rows
