"""Values listed in FIXTURES.md (computed independently of this code) at sf0.001 and sf0.01."""

import math

from pyspark.sql import functions as F

from blotter.operators import aggregate as agg
from blotter.operators.risk import context_risk_scores, high_risk_contexts
from blotter.profile import ADAPTER_PROFILE as P
from conftest import SF_MID, SF_SMALL
from blotter.queries import curated as adapter_curated


def _area(df, col, area="AREA_00"):
    return df.filter(F.col(P.entity) == area).first()[col]


def test_sizes_at_sf0001(spark):
    cur = adapter_curated(spark, SF_SMALL)
    assert cur.count() == 5156
    assert cur.select(P.entity).distinct().count() == 21
    assert agg.yearly_counts(cur, P.date_out, [P.entity, "part_1_2"]).count() == 252
    assert agg.monthly_density(cur, P.date_out, P.entity, P.lat, P.lon).count() == 3406
    scores = context_risk_scores(cur, P)
    assert scores.count() == 2013
    assert high_risk_contexts(scores, P, sort=False).count() == 2
    assert _area(agg.total_by_entity(cur, P.entity), "n_crimes_total") == 1909


def test_values_at_sf001(spark):
    cur = adapter_curated(spark, SF_MID)
    assert cur.count() == 51589
    assert agg.yearly_counts(cur, P.date_out).filter("year_int = 1995").first()["n_crimes"] == 8659
    assert _area(agg.total_by_entity(cur, P.entity), "n_crimes_total") == 18777
    day = _area(agg.avg_count_per_bucket(cur, P.entity, P.date_out, "day"), "avg_crimes_per_day")
    week = _area(agg.avg_count_per_bucket(cur, P.entity, P.date_out, "week"), "avg_crimes_per_week")
    month = _area(agg.avg_count_per_bucket(cur, P.entity, P.date_out, "month"),
                  "avg_crimes_per_month")
    assert math.isclose(day, 8.57005933, rel_tol=1e-8)
    assert math.isclose(week, 59.7993631, rel_tol=1e-8)
    assert math.isclose(month, 260.791667, rel_tol=1e-8)
    top = high_risk_contexts(context_risk_scores(cur, P), P).first()
    assert top["n_crimes"] == 668
    assert math.isclose(top["crime_share_percent"], 1.338973, rel_tol=1e-6)
    assert agg.yearly_grouping_sets(cur, P.date_out, P.entity, "part_1_2").count() == 396
