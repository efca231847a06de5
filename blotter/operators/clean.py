"""RAW -> CURATED: parse the incident date, derive date and year, drop bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from blotter.functions.time import parse_timestamp
from blotter.operators.columns import rename_if_present, require_columns
from blotter.profile import IncidentProfile


def clean_incidents(raw: DataFrame, profile: IncidentProfile) -> DataFrame:
    """Add ``date_occ_ts``, ``date_occ`` and ``year``; keep rows with a valid date up to ``max_year``.

    * Text dates are parsed with the strict pattern; text that does not match
      becomes NULL and the row is dropped (never an exception under ANSI).
    * A source whose date column is already a timestamp or a date is used as is.
    * With ``profile.normalize_text`` every other text column is trimmed and an
      empty text becomes NULL, which is what the reference's CSV round trip
      between zones does to its values.

    Narrow only: no shuffle. All raw columns are carried through.
    """
    require_columns(raw, [profile.date_raw], "clean_incidents")
    src_type = raw.schema[profile.date_raw].dataType
    d = F.col(profile.date_raw)
    if isinstance(src_type, StringType):
        ts = parse_timestamp(d, profile.date_format)
    elif isinstance(src_type, (TimestampType, TimestampNTZType, DateType)):
        ts = d.cast("timestamp_ntz")
    else:
        raise TypeError(f"date column {profile.date_raw!r} has type {src_type.simpleString()}")

    df = raw
    if profile.normalize_text:
        text_cols = [f.name for f in raw.schema.fields
                     if isinstance(f.dataType, StringType) and f.name != profile.date_raw]
        if text_cols:
            df = df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in text_cols})

    df = df.withColumn(profile.ts_out, ts)
    df = df.withColumn(profile.date_out, F.to_date(profile.ts_out))
    df = df.withColumn(profile.year_out, F.year(profile.date_out))
    # A NULL date gives a NULL year, which the cutoff comparison drops as well.
    # The optimizer evaluates the parse in this filter and again in the output.
    if profile.max_year is not None:
        keep = F.col(profile.year_out) <= F.lit(profile.max_year)
    else:
        keep = F.col(profile.date_out).isNotNull()
    return df.filter(keep)


def curated_view(curated: DataFrame, profile: IncidentProfile) -> DataFrame:
    """Curated table as the result operators expect it: severity under its output name."""
    return rename_if_present(curated, profile.severity, profile.severity_out)
