"""Column expressions: parsing, time buckets, classifiers and labels.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage code generation.
"""

from blotter.functions.classify import (
    age_range,
    cut,
    risk_level,
    sex_norm,
    time_slot,
    victim_type,
    weapon_used,
)
from blotter.functions.labels import context_label, month_name, percent_label
from blotter.functions.time import (
    bucket_columns,
    hour_from_hhmm,
    parse_timestamp,
    to_date_col,
    to_int,
    to_number,
)

__all__ = [
    "age_range",
    "bucket_columns",
    "context_label",
    "cut",
    "hour_from_hhmm",
    "month_name",
    "parse_timestamp",
    "percent_label",
    "risk_level",
    "sex_norm",
    "time_slot",
    "to_date_col",
    "to_int",
    "to_number",
    "victim_type",
    "weapon_used",
]
