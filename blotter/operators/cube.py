"""Daily cube: one scan of CURATED feeds every additive result.

``(entity, date, year, severity, weapon class) -> n`` holds everything the
day/week/month averages, the totals, the four yearly counts and the weapon
series need, because each of them is a sum of counts. It is at most
``entities x days x severities x 2`` rows whatever the incident volume, so the
aggregate job scans the incident table once, writes this table, and derives
nine results from it (the coordinates heat map and the context scores need
keys the cube does not carry and scan the incidents themselves).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.classify import weapon_used
from blotter.operators.aggregate import (
    avg_count_per_bucket,
    total_by_entity,
    weapon_usage_per_year,
    yearly_counts,
)
from blotter.operators.columns import require_columns
from blotter.profile import IncidentProfile

#: Count column of the cube.
CUBE_COUNT = "n"


def daily_cube(curated: DataFrame, profile: IncidentProfile) -> DataFrame:
    """Incidents per (entity, date, year[, severity][, weapon class]).

    ``curated`` is the curated table with the severity under its output name
    (:func:`blotter.operators.clean.curated_view`).
    """
    require_columns(curated, [profile.entity, profile.date_out], "daily_cube")
    keys = [F.col(profile.entity), F.col(profile.date_out)]
    if profile.year_out in curated.columns:
        keys.append(F.col(profile.year_out))
    else:
        keys.append(F.year(profile.date_out).alias(profile.year_out))
    sev = profile.severity_col
    if sev is not None and sev in curated.columns:
        keys.append(F.col(sev))
    if profile.weapon is not None and profile.weapon in curated.columns:
        keys.append(weapon_used(profile.weapon).alias("weapon_used"))
    return curated.groupBy(*keys).agg(F.count(F.lit(1)).alias(CUBE_COUNT))


def results_from_counts(source: DataFrame, profile: IncidentProfile, *,
                        weight: str | None) -> dict[str, DataFrame]:
    """The nine additive results, from incident rows (``weight=None``) or from the cube.

    Keys are the reference's result-table names. Severity and weapon results
    are left out when the profile or the table lacks that column.
    """
    e, d, y = profile.entity, profile.date_out, profile.year_out
    out = {
        "avg_by_area_day": avg_count_per_bucket(source, e, d, "day", weight=weight, year_col=y),
        "avg_by_area_week": avg_count_per_bucket(source, e, d, "week", weight=weight, year_col=y),
        "avg_by_area_month": avg_count_per_bucket(source, e, d, "month", weight=weight, year_col=y),
        "total_by_area": total_by_entity(source, e, weight=weight),
    }
    # Four separate tables: one direct aggregate each (a grouping-sets pass
    # would expand every row four times and then keep one set per table).
    by = {"crimes_per_year": [], "crimes_per_year_area": [e]}
    sev = profile.severity_col
    if sev is not None and sev in source.columns:
        by.update({"crimes_per_year_severity": [sev], "crimes_per_year_area_severity": [e, sev]})
    for name, keys in by.items():
        out[name] = yearly_counts(source, d, keys, weight=weight, year_col=y,
                                  year_name=profile.year_key, name=profile.count_out)
    if "weapon_used" in source.columns:
        out["weapon_usage_per_year"] = weapon_usage_per_year(
            source, d, "weapon_used", weight=weight, classified=True, year_col=y,
            year_name=profile.year_key, name=profile.count_out)
    elif profile.weapon is not None and profile.weapon in source.columns:
        out["weapon_usage_per_year"] = weapon_usage_per_year(
            source, d, profile.weapon, weight=weight, year_col=y,
            year_name=profile.year_key, name=profile.count_out)
    return out
