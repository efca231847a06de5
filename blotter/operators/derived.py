"""Answers to the questions the reference states but reads off charts by eye.

Each one starts from a result table of the aggregate or risk job (or the
incident rows) and stays distributed: joins between small aggregates are left
to adaptive execution (it broadcasts a side once its measured size is under the
threshold), windows are partitioned by a key with a bounded number of rows, and
global rankings use :mod:`blotter.operators.ranking`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.operators.aggregate import avg_count_per_bucket, per_bucket_counts
from blotter.operators.ranking import kth_largest, running_total, top_k_counts_per_group


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL-safe equality, keeping one copy of each key column.

    A NULL entity is a group of its own in every aggregate, so it matches
    itself here too. It also keeps both sides' plans free of inferred
    ``IS NOT NULL`` filters, so when both come from the same aggregate Spark
    reuses one exchange for them instead of scanning twice.
    """
    lt, rt = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        c = F.col(f"_l.`{k}`").eqNullSafe(F.col(f"_r.`{k}`"))
        cond = c if cond is None else cond & c
    joined = lt.join(rt, cond, how)
    return joined.select(*[F.col(f"_l.`{c}`") for c in left.columns],
                         *[F.col(f"_r.`{c}`") for c in right.columns if c not in keys])


def area_concentration(totals: DataFrame, entity: str, *, count_col: str = "n_crimes_total") -> DataFrame:
    """Share of all incidents per entity and the cumulative share, largest first.

    Adds ``rank_by_total`` (1 = largest; ties broken by entity), ``share_percent``
    and ``cumulative_share_percent``: how many entities hold half of the incidents.
    """
    total = totals.agg(F.sum(count_col).cast("double")).scalar()
    order = [F.col(count_col).desc(), F.col(entity).asc()]
    run = running_total(totals, {"_cum": count_col, "rank_by_total": "1"}, order)
    return run.select(
        entity, count_col, "rank_by_total",
        (F.col(count_col) / total * 100.0).alias("share_percent"),
        (F.col("_cum") / total * 100.0).alias("cumulative_share_percent"))


def year_over_year(per_year: DataFrame, *, year_col: str = "year_int",
                   count_col: str = "n_crimes") -> DataFrame:
    """Change against the previous calendar year (NULL when that year has no row)."""
    prev = per_year.select((F.col(year_col) + 1).alias(year_col),
                           F.col(count_col).alias("prev_n_crimes"))
    out = join_keys(per_year, prev, [year_col], "left")
    return out.select(
        year_col, count_col, "prev_n_crimes",
        (F.col(count_col) - F.col("prev_n_crimes")).alias("change"),
        ((F.col(count_col) - F.col("prev_n_crimes")) / F.col("prev_n_crimes") * 100.0)
        .alias("pct_change"))


def area_vs_city_trend(per_year_area: DataFrame, entity: str, *,
                       year_col: str = "year_int", count_col: str = "n_crimes") -> DataFrame:
    """Each entity's yearly change next to the whole table's, and the gap between them.

    The whole table's series is the sum of the entities', so one table is enough.
    """
    per_year = per_year_area.groupBy(year_col).agg(F.sum(count_col).alias(count_col))
    prev = per_year_area.select(entity, (F.col(year_col) + 1).alias(year_col),
                                F.col(count_col).alias("_prev"))
    area = join_keys(per_year_area, prev, [entity, year_col], "left").select(
        entity, year_col, count_col,
        ((F.col(count_col) - F.col("_prev")) / F.col("_prev") * 100.0).alias("area_pct_change"))
    city = year_over_year(per_year, year_col=year_col, count_col=count_col) \
        .select(year_col, F.col("pct_change").alias("city_pct_change"))
    return join_keys(area, city, [year_col], "left").withColumn(
        "gap_pct_points", F.col("area_pct_change") - F.col("city_pct_change"))


def severity_share(per_year_severity: DataFrame, severity: str, *, year_col: str = "year_int",
                   count_col: str = "n_crimes") -> DataFrame:
    """Share of each severity within its year (window per year: one row per severity)."""
    per_year = Window.partitionBy(year_col)
    return per_year_severity.select(
        year_col, severity, count_col,
        (F.col(count_col) / F.sum(count_col).over(per_year) * 100.0).alias("share_percent"))


def chronic_areas(daily: DataFrame, entity: str, date_col: str, k: int = 5, *, weight: str = "n") -> DataFrame:
    """Entities ranked within the top k (ties included) by day, week and month averages.

    ``daily`` has one row per (entity, date) with its count in ``weight``; all
    three averages come from it.
    """
    d, w, m = "avg_crimes_per_day", "avg_crimes_per_week", "avg_crimes_per_month"
    avg_day, avg_week, avg_month = (
        avg_count_per_bucket(daily, entity, date_col, grain, weight=weight, year_col=None)
        for grain in ("day", "week", "month"))
    joined = join_keys(join_keys(avg_day, avg_week, [entity]), avg_month, [entity])
    return joined.filter((F.col(d) >= kth_largest(avg_day, d, k))
                         & (F.col(w) >= kth_largest(avg_week, w, k))
                         & (F.col(m) >= kth_largest(avg_month, m, k)))


def recurrent_hotspots(heat: DataFrame, lat: str, lon: str, k: int = 10, *,
                       year_col: str = "year_int", count_col: str = "n_crimes") -> DataFrame:
    """Points (lat, lon) and the number of months in which they rank in the month's top k.

    Points are summed over entities first; ranks include ties.
    """
    points = heat.groupBy(year_col, "month", lat, lon).agg(F.sum(count_col).alias(count_col))
    # (year, month) groups: a few per calendar year, whatever the data
    top = top_k_counts_per_group(points, [year_col, "month"], count_col, k, few_groups=True)
    return top.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("hot_months"),
                                     F.sum(count_col).alias("n_crimes_in_hot_months"))


def seasonality_index(incidents: DataFrame, entity: str, date_col: str, *,
                      weight: str | None = None, year_col: str | None = "year") -> DataFrame:
    """Per entity and calendar month: mean monthly count in that month / mean over all months.

    Above 1 means the month is busier than the entity's usual month (months
    without incidents are not counted, as in the monthly average).
    """
    monthly = per_bucket_counts(incidents, entity, date_col, "month", weight=weight,
                                year_col=year_col, name="_n")
    by_month = monthly.groupBy(entity, "month").agg(F.avg("_n").alias("_month_avg"))
    overall = monthly.groupBy(entity).agg(F.avg("_n").alias("_overall_avg"))
    return join_keys(by_month, overall, [entity]).select(
        entity, "month", (F.col("_month_avg") / F.col("_overall_avg")).alias("seasonality_index"))


def high_risk_by(high_risk: DataFrame, key: str, *, count_col: str = "n_crimes") -> DataFrame:
    """High-risk contexts and their incidents per victim attribute, with the share of incidents."""
    total = high_risk.agg(F.sum(count_col).cast("double")).scalar()
    return high_risk.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_contexts"),
        F.sum(count_col).alias(count_col),
    ).withColumn("share_percent", F.col(count_col) / total * 100.0)
