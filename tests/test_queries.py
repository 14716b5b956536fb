"""Every registered query against its SQL twin."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry_points  # noqa: E402
from compare import connect, duck_rows, spark_rows  # noqa: E402

from tidelog.plans import oracle, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(oracle.oracle())


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_query(spark, duck, name):
    columns, rows = spark_rows(queries.registered()[name](spark, SF_DIR))
    want_columns, want = duck_rows(duck, oracle.oracle()[name])
    assert columns == want_columns
    assert rows == want


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
