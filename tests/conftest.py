import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from contest_analytics.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, memory="6g", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Literal rows with a DDL schema."""

    def make(schema, *values):
        return spark.createDataFrame(list(values), schema)

    return make


def as_dicts(df, *order):
    found = [row.asDict() for row in df.collect()]
    return sorted(found, key=lambda r: [(r[c] is not None, r[c]) for c in order]) if order else found
