"""The tables behind each dashboard page, computed from the ANALYTICS zone.

The reference downloads each result directory into pandas and filters it in
one process; here each page is a DataFrame over the result table, so only the
selected rows ever leave the cluster. Drawing is left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import profile as P
from blotter.functions.labels import month_name, percent_label
from blotter.functions.time import to_int, to_number, to_whole
from blotter.operators import explore as ex
from blotter.operators.columns import require_columns
from blotter.results import result_schema
from blotter.sources.zones import read_result

_PERIODS = {"day": ("avg_by_area_day", "avg_crimes_per_day"),
            "week": ("avg_by_area_week", "avg_crimes_per_week"),
            "month": ("avg_by_area_month", "avg_crimes_per_month")}


def _page_table(spark: SparkSession, base: str, name: str, page: str, *, fmt: str = "parquet",
                optional: Sequence[str] = (), **names: str) -> DataFrame:
    """A result table for a page: empty and typed when absent, refused when a needed column is missing."""
    schema = result_schema(name, **names)
    df = read_result(spark, base, name, schema=schema, fmt=fmt, entity=names.get("entity"))
    require_columns(df, [c for c in schema.fieldNames() if c not in optional], page)
    return df


def zone_averages(spark: SparkSession, base: str, period: str = "day", zones: Sequence[str] | None = None,
                  entity: str = "AREA NAME", *, fmt: str = "parquet") -> DataFrame:
    """Averages page: selected zones (default: first five in name order), largest first."""
    table, value = _PERIODS[period]
    df = _page_table(spark, base, table, "averages page", fmt=fmt, entity=entity)
    if zones is None:  # one row per zone
        df = ex.first_k_rows(df, entity, P.DEFAULT_ZONES_AVERAGES)
    else:
        df = ex.filter_in(df, entity, zones)
    return df.orderBy(F.col(value).desc(), F.col(entity))


def top_zones(spark: SparkSession, base: str, entity: str = "AREA NAME", k: int = P.TOP_AREAS, *,
              fmt: str = "parquet") -> DataFrame:
    """Top zones page: the k zones with the most incidents."""
    df = _page_table(spark, base, "total_by_area", "top zones page", fmt=fmt, entity=entity)
    return ex.top_entities(df, entity, "n_crimes_total", k)


def yearly_evolution(spark: SparkSession, base: str, *, by_severity: bool = False,
                     zones: Sequence[str] | None = None, zone: str | None = None,
                     entity: str = "AREA NAME", severity: str = "part_1_2",
                     fmt: str = "parquet") -> dict[str, DataFrame]:
    """Evolution page: the city series and the per-zone series, sorted for plotting, and the zone choices."""
    y, page = "year_int", "evolution page"
    if not by_severity:
        city = _page_table(spark, base, "crimes_per_year", page, fmt=fmt).orderBy(y)
        area = _page_table(spark, base, "crimes_per_year_area", page, fmt=fmt, entity=entity)
        choices = ex.distinct_sorted(area, entity)
        area = (ex.filter_default_zones(area, entity, P.DEFAULT_ZONES_EVOLUTION) if zones is None
                else ex.filter_in(area, entity, zones))
        return {"city": city, "zones": area.orderBy(entity, y), "zone_choices": choices}
    city = _page_table(spark, base, "crimes_per_year_severity", page, fmt=fmt, severity=severity).orderBy(y, severity)
    area = _page_table(spark, base, "crimes_per_year_area_severity", page, fmt=fmt, entity=entity, severity=severity)
    if zone is None:
        zone_col = ex.first_k_sorted(area, entity, 1).agg(F.min(entity)).scalar()
    else:
        zone_col = F.lit(zone)
    return {"city": city, "zone": ex.filter_equal(area, **{entity: zone_col}).orderBy(y, severity),
            "zone_choices": ex.distinct_sorted(area, entity)}


def heatmap_month(spark: SparkSession, base: str, *, year: int | None = None,
                  month: int | None = None, zones: Sequence[str] | None = None,
                  entity: str = "AREA NAME", lat: str = "LAT", lon: str = "LON",
                  fmt: str = "parquet") -> dict[str, DataFrame]:
    """Map page: points of one month (default: latest year, its first month) and their count.

    The choices follow each other: all years, the months of the chosen year, and
    the zones of the chosen month.
    """
    heat = _page_table(spark, base, "crime_heatmap_monthly", "map page", fmt=fmt, entity=entity, lat=lat, lon=lon)
    heat = heat.withColumn("month", to_int("month"))
    points = ex.heatmap_points(heat, entity, lat, lon, year=year, month=month, zones=zones)
    in_year = ex.filter_equal(heat, year_int=ex.latest_value(heat, "year_int") if year is None else year)
    months = ex.distinct_sorted(in_year, "month").select("month", month_name("month").alias("month_name"))
    chosen = in_year.agg(F.min("month")).scalar() if month is None else month
    in_month = ex.filter_equal(in_year, month=chosen)
    return {"points": points, "n_points": points.agg(F.count(F.lit(1)).alias("n_points")),
            "months": months, "years": ex.distinct_sorted(heat, "year_int"),
            "zone_choices": ex.distinct_sorted(in_month, entity)}


def weapon_series(spark: SparkSession, base: str, *, fmt: str = "parquet") -> DataFrame:
    """Weapons page: yearly counts with / without a weapon (strict years and 64-bit counts)."""
    df = _page_table(spark, base, "weapon_usage_per_year", "weapons page", fmt=fmt)
    return df.withColumns({"year_int": to_whole("year_int").cast("int"), "n_crimes": to_whole("n_crimes")}) \
             .orderBy("year_int", "weapon_used")


def high_risk_page(spark: SparkSession, base: str, *, zones=None, time_slots=None,
                   risk_levels=None, age_ranges=None, sexes=None,
                   entity: str = "AREA NAME", fmt: str = "parquet") -> dict[str, DataFrame]:
    """Scenario page: filtered contexts, their summary, the top 20 with captions, and each selector's choices.

    A table without the score or share column is ordered by the next one that it
    has: score out of 10, share, z-score.
    """
    hr = _page_table(spark, base, "high_risk_contexts", "scenario page", fmt=fmt, entity=entity,
                     optional=("risk_score_10", "crime_share_percent"))
    # Numbers as numbers even from a table with stray text (bad -> NULL).
    numbers = {"n_crimes": F.col("n_crimes").try_cast("bigint"), "z_score": to_number("z_score"),
               "crime_share_percent": to_number("crime_share_percent"),
               "risk_score_10": to_number("risk_score_10")}
    hr = hr.withColumns({c: e for c, e in numbers.items() if c in hr.columns})
    sel = ex.explore_high_risk(hr, zones=zones, time_slots=time_slots, risk_levels=risk_levels,
                               age_ranges=age_ranges, sexes=sexes, entity=entity)
    choices = {name: ex.distinct_sorted(hr, c) for name, c in
               (("zone_choices", entity), ("time_slot_choices", "time_slot"), ("risk_level_choices", "risk_level"),
                ("age_range_choices", "age_range"), ("sex_choices", "sex_norm"))}
    return {"contexts": sel.orderBy(*ex.context_order(sel, entity)),
            "summary": ex.risk_summary(sel).withColumn("max_share_label",
                                                         percent_label("max_share")),
            "top": ex.top_contexts_labelled(sel, entity, P.TOP_CONTEXTS), **choices}
