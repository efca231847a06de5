"""The queries that SQL can express, against DuckDB; and what the entry registers."""

import re

import pytest

from __spark_entry__ import oracle_sql, queries
from blotter.llm.queries import ORACLE_SQL, QUERIES
from conftest import SF_MID
from oracle_compare import compare, duck_connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck_connection(SF_MID), name, QUERIES[name], ORACLE_SQL[name], SF_MID)
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] > 0, r


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
