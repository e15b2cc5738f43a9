"""Registered queries with SQL against DuckDB, whole tables."""

import pytest
from compare import assert_same

from llm.corpus import FOLDER
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER) > 0


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
