"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = contract.QUERIES, contract.ORACLE


@pytest.fixture(scope="module")
def connection():
    if not FOLDER.exists():
        pytest.skip("no test tables")
    import compare

    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    import compare

    assert compare.compare(spark, connection, name, str(FOLDER)) == ""


def test_entry(spark, connection):
    df = contract.entry(spark)
    assert len(df.columns) == 47 and df.count() > 0
