"""blotter: incident analytics as Spark DataFrame operators.

Raw timestamped incident records are cleaned into year-partitioned Parquet,
summarised per area by day, week and month, counted per year, area, severity
and weapon use, mapped by month and coordinates, and scored by context
(area x time slot x place x victim age x sex) with a z-score to find high-risk
contexts. Column names, labels and thresholds live in a profile
(:mod:`blotter.profile`), so the operators run on any table with an entity
column and a date column.
"""

from blotter.profile import ADAPTER_PROFILE, REFERENCE_PROFILE, IncidentProfile

__all__ = ["ADAPTER_PROFILE", "REFERENCE_PROFILE", "IncidentProfile"]
