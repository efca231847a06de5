"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

from __spark_entry__ import entry
from blotter.lake_oracle import lake_oracle_sql
from blotter.oracle import oracle_sql as _oracle_sql
from blotter.queries import queries
from conftest import SF_MID, SF_SMALL
from oracle_compare import compare, duck_connection

NAMES = sorted(queries())


def oracle_sql():
    return _oracle_sql() | lake_oracle_sql()


# A cross-section that is also checked at sf0.01 (the driver's scale).
MID = ["context_risk_scores", "high_risk_contexts", "avg_by_area_week", "year_grouping_sets",
       "recurrent_hotspots", "area_concentration", "chronic_areas", "lake_twelve_tables", "lake_raw_csv",
       "lake_contexts_by_what_is_there", "lake_optional_columns"]


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["area_name", "time_slot", "place_type", "age_range", "sex_norm",
                          "n_crimes", "z_score", "risk_level", "crime_share_percent",
                          "risk_score_10"]


@pytest.fixture(scope="module")
def duck_small():
    return duck_connection(SF_SMALL)


@pytest.fixture(scope="module")
def duck_mid():
    return duck_connection(SF_MID)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, duck_small, name):
    r = compare(spark, duck_small, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["values_match"], r


@pytest.mark.parametrize("name", MID)
def test_query_matches_oracle_mid(spark, duck_mid, name):
    r = compare(spark, duck_mid, name, queries()[name], oracle_sql()[name], SF_MID)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["values_match"], r
