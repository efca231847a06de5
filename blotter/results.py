"""Schemas of the published result tables: one place, used by every read.

A missing table reads as an empty frame of its schema, and a CSV table gets its
types from here by column name, never from guessing at its text.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_AVERAGES = {"avg_by_area_day": "avg_crimes_per_day", "avg_by_area_week": "avg_crimes_per_week",
             "avg_by_area_month": "avg_crimes_per_month"}
_YEARLY = {"crimes_per_year": (), "crimes_per_year_area": ("entity",), "crimes_per_year_severity": ("severity",),
           "crimes_per_year_area_severity": ("entity", "severity")}


def result_schema(name: str, *, entity: str = "AREA NAME", severity: str = "part_1_2", lat: str = "LAT",
                  lon: str = "LON", year: str = "year_int", count: str = "n_crimes") -> StructType | None:
    """Schema of the result table ``name``; None for a table that is not one of the twelve."""
    text, number, whole, many = StringType(), DoubleType(), IntegerType(), LongType()
    if name in _AVERAGES:
        columns = [(entity, text), (_AVERAGES[name], number)]
    elif name == "total_by_area":
        columns = [(entity, text), ("n_crimes_total", many)]
    elif name in _YEARLY:
        keys = {"entity": (entity, text), "severity": (severity, whole)}
        columns = [(year, whole), *[keys[k] for k in _YEARLY[name]], (count, many)]
    elif name == "crime_heatmap_monthly":
        columns = [(year, whole), ("month", whole), (entity, text), (lat, number), (lon, number), (count, many)]
    elif name == "weapon_usage_per_year":
        columns = [(year, whole), ("weapon_used", text), (count, many)]
    elif name in ("context_risk_scores", "high_risk_contexts"):
        columns = [(entity, text), *[(k, text) for k in ("time_slot", "place_type", "age_range", "sex_norm")],
                   (count, many), ("z_score", number), ("risk_level", text), ("crime_share_percent", number),
                   ("risk_score_10", number)]
    else:
        return None
    return StructType([StructField(c, t) for c, t in columns])
