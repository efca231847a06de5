"""Parsing and time-bucket expressions (ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: str | Column, fmt: str) -> Column:
    """Text -> zone-less timestamp; text that does not match ``fmt`` gives NULL.

    ``try_to_timestamp`` keeps the strict pattern (``1/8/2020`` or hour 13 with
    ``hh`` do not parse) without raising under ANSI mode. The result is cast to
    ``TIMESTAMP_NTZ`` because the source carries no zone: the wall-clock value is
    kept and Parquet stores it without conversion.
    """
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def to_date_col(c: str | Column, source_type: DataType | None = None, fmt: str | None = None) -> Column:
    """Date of a timestamp, date or text column (text parsed with ``fmt``)."""
    col = _col(c)
    if isinstance(source_type, DateType):
        return col
    if isinstance(source_type, StringType):
        return F.to_date(parse_timestamp(col, fmt)) if fmt else F.try_to_date(col)
    if isinstance(source_type, (TimestampType, TimestampNTZType)) or source_type is None:
        return F.to_date(col)
    return F.to_date(col)


def to_int(c: str | Column) -> Column:
    """Whole number, fractions cut off (``'30.0'`` -> 30); no number or one out of range gives NULL."""
    return _col(c).try_cast("double").try_cast("int")  # the column is named once: its expression is computed once


def to_number(c: str | Column) -> Column:
    """Cast to double; bad values give NULL."""
    return _col(c).try_cast("double")


def hour_from_hhmm(c: str | Column) -> Column:
    """Hour of an HHMM clock integer (``130`` -> 1, ``2400`` -> 24)."""
    return F.floor(to_int(c) / 100)


def to_whole(c: str | Column) -> Column:
    """Strict 64-bit whole number: text that is no number stops the job."""
    return _col(c).cast("bigint")


def bucket_columns(date: str | Column, grain: str, *, year_name: str = "year_int",
                   iso_year: bool = False) -> dict[str, Column]:
    """Bucket key columns for a date at ``day``, ``week`` or ``month`` grain.

    Weeks are ISO weeks. By default they are keyed with the *calendar* year, as
    the reference does (2018-12-31 falls in (2018, week 1)); ``iso_year=True``
    keys them with the ISO week-numbering year instead.
    """
    d = _col(date)
    if grain == "day":
        return {}
    if grain == "week":
        year = F.extract(F.lit("YEAROFWEEK"), d) if iso_year else F.year(d)
        return {year_name: year.cast("int"), "week": F.weekofyear(d)}
    if grain == "month":
        return {year_name: F.year(d), "month": F.month(d)}
    if grain == "year":
        return {year_name: F.year(d)}
    raise ValueError(f"unknown grain {grain!r}; expected day, week, month or year")
