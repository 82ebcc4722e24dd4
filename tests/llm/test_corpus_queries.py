"""Every registered corpus query runs on the smallest tables; those with SQL give its rows."""

import sys
from pathlib import Path

import pytest
from helpers_llm import FOLDER
from rosterlane.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLE])
def test_query_runs(spark, documents, name):
    assert queries.QUERIES[name](spark, str(FOLDER)).count() > 0


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_sql(spark, documents, monkeypatch, name):
    import compare

    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "ORACLE", queries.ORACLE)
    assert compare.compare(spark, compare.connect(FOLDER), name, str(FOLDER)) == ""


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14))
