"""Aggregates: count properties, cube = direct, week keys, dense means."""

import datetime as dt

from pyspark.sql import functions as F

from blotter.operators import aggregate as agg
from blotter.operators.cube import CUBE_COUNT, daily_cube, results_from_counts
from blotter.plans.inspect import count_nodes
from blotter.profile import ADAPTER_PROFILE as P
from conftest import SF_SMALL
from blotter.queries import curated as adapter_curated


def _collect_sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_count_properties(spark):
    cur = adapter_curated(spark, SF_SMALL)
    n = cur.count()
    assert n == 5156
    total = agg.total_by_entity(cur, P.entity).agg(F.sum("n_crimes_total")).first()[0]
    per_year = agg.yearly_counts(cur, P.date_out).agg(F.sum("n_crimes")).first()[0]
    per_year_area = agg.yearly_counts(cur, P.date_out, [P.entity]).agg(F.sum("n_crimes")).first()[0]
    assert total == per_year == per_year_area == n
    # year x area = sum over severity of year x area x severity
    by_sev = agg.yearly_counts(cur, P.date_out, [P.entity, "part_1_2"]) \
        .groupBy("year_int", P.entity).agg(F.sum("n_crimes").alias("n_crimes"))
    assert _collect_sorted(by_sev) == _collect_sorted(
        agg.yearly_counts(cur, P.date_out, [P.entity]))


def test_cube_equals_direct(spark):
    cur = adapter_curated(spark, SF_SMALL)
    direct = results_from_counts(cur, P, weight=None)
    cube = daily_cube(cur, P).withColumnRenamed(P.weapon, "weapon_used")
    via_cube = results_from_counts(cube, P, weight=CUBE_COUNT)
    assert set(direct) == set(via_cube)
    for name in direct:
        a, b = direct[name], via_cube[name]
        assert a.columns == b.columns, name
        assert _collect_sorted(a) == _collect_sorted(b), name


def test_grouping_sets_match_separate_groupings(spark):
    cur = adapter_curated(spark, SF_SMALL)
    gs = agg.yearly_grouping_sets(cur, P.date_out, P.entity, "part_1_2")
    parts = agg.split_grouping_sets(gs, P.entity, "part_1_2")
    assert _collect_sorted(parts["per_year_area_severity"]) == _collect_sorted(
        agg.yearly_counts(cur, P.date_out, [P.entity, "part_1_2"]))
    assert _collect_sorted(parts["per_year"]) == _collect_sorted(agg.yearly_counts(cur, P.date_out))
    assert gs.count() == sum(p.count() for p in parts.values())


def test_week_keys_calendar_vs_iso_year(spark):
    df = spark.createDataFrame([("A", dt.date(2018, 12, 31)), ("A", dt.date(2018, 1, 1)),
                                ("A", dt.date(2019, 1, 2))], "e string, d date")
    cal = agg.per_bucket_counts(df, "e", "d", "week", year_col=None)
    assert _collect_sorted(cal) == [("A", 2018, 1, 2), ("A", 2019, 1, 1)]
    iso = agg.per_bucket_counts(df, "e", "d", "week", iso_year=True, year_col=None)
    assert _collect_sorted(iso) == [("A", 2018, 1, 1), ("A", 2019, 1, 2)]


def test_sparse_and_dense_daily_means(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1)), ("A", dt.date(2020, 1, 1)),
                                ("A", dt.date(2020, 1, 4)), ("B", dt.date(2020, 1, 2))],
                               "e string, d date")
    sparse = dict(agg.avg_count_per_bucket(df, "e", "d", "day", year_col=None).collect())
    assert sparse == {"A": 1.5, "B": 1.0}
    dense = dict(agg.dense_avg_count_per_bucket(df, "e", "d", "day").collect())
    assert dense == {"A": 0.75, "B": 0.25}


def test_null_entity_is_its_own_group(spark):
    df = spark.createDataFrame([(None, dt.date(2020, 1, 1)), ("A", dt.date(2020, 1, 1))],
                               "e string, d date")
    assert _collect_sorted(agg.total_by_entity(df, "e").fillna("null")) == [("A", 1), ("null", 1)]


def test_heatmap_keeps_zero_coordinates_and_drops_missing(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), 0.0, 0.0),
                                ("A", dt.date(2020, 1, 2), 0.0, 0.0),
                                ("A", dt.date(2020, 1, 3), None, 1.0)],
                               "e string, d date, lat double, lon double")
    out = agg.monthly_density(df, "d", "e", "lat", "lon", year_col=None).collect()
    assert [tuple(r) for r in out] == [(2020, 1, "A", 0.0, 0.0, 2)]


def test_total_by_area_plans_a_single_exchange(spark):
    cur = adapter_curated(spark, SF_SMALL)
    assert count_nodes(agg.total_by_entity(cur, P.entity), "Exchange") == 1


def test_hot_area_is_pre_aggregated_before_every_shuffle(spark):
    """AREA_00 holds about a third of the incidents; every shuffle carries partial counts."""
    import re

    from blotter.operators.risk import context_risk_scores
    from blotter.plans.inspect import plan_text
    cur = adapter_curated(spark, SF_SMALL)
    share = cur.filter(F.col(P.entity) == "AREA_00").count() / cur.count()
    assert share > 0.3
    for df in (agg.total_by_entity(cur, P.entity),
               agg.avg_count_per_bucket(cur, P.entity, P.date_out, "week"),
               daily_cube(cur, P), context_risk_scores(cur, P)):
        text = plan_text(df, "simple").split("== Initial Plan ==")[0]
        found = list(re.finditer(r"Exchange hashpartitioning", text))
        assert found
        for m in found:
            below = text[m.end():].split("\n")[1]
            assert "HashAggregate" in below and "partial_" in below, below
