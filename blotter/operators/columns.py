"""Column resolution and guards (driver-side, schema only; no Spark job)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import fields

from pyspark.sql import DataFrame

from blotter.profile import IncidentProfile

#: Profile fields that name input columns (the others are output names or settings).
ROLE_FIELDS = ("entity", "date_raw", "time_hhmm", "severity", "victim_age", "victim_sex",
               "premises", "weapon", "lat", "lon")


class MissingColumnsError(ValueError):
    """Raised when a table lacks columns an operator needs: ``what`` refused, and the ``missing`` names."""

    def __init__(self, message: str, what: str = "", missing: Iterable[str | None] = ()):
        super().__init__(message)
        self.what, self.missing = what, tuple(missing)


class AmbiguousColumnError(ValueError):
    """Raised when several columns of a table answer to the same name."""


def normalize_name(name: str) -> str:
    """Letters and digits that count when names are compared: ``AREA NAME`` -> ``areaname``."""
    return "".join(ch for ch in name.casefold() if ch not in " _")


def spellings(df: DataFrame) -> dict[str, list[str]]:
    """Normalised name -> the table's columns that bear it."""
    found: dict[str, list[str]] = {}
    for c in df.columns:
        found.setdefault(normalize_name(c), []).append(c)
    return found


def find_col(df: DataFrame, *candidates: str, several: str = "refuse") -> str | None:
    """The column that one of ``candidates`` names, exactly or else by its normalised name.

    Candidates are tried in order. Two columns with the same normalised name
    leave the choice open: with ``several="refuse"`` that is an error, with
    ``several="first"`` the leftmost one is taken.
    """
    if several not in ("refuse", "first"):
        raise ValueError(f"several: 'refuse' or 'first', not {several!r}")
    named = spellings(df)
    for candidate in candidates:
        if candidate in df.columns:
            return candidate
        columns = named.get(normalize_name(candidate), [])
        if len(columns) > 1 and several == "refuse":
            raise AmbiguousColumnError(f"{candidate!r} could be any of {columns}")
        if columns:
            return columns[0]
    return None


def require_columns(df: DataFrame, cols: Iterable[str | None], what: str = "operator") -> None:
    """Stop with a clear message when any column is absent (``None`` counts as absent)."""
    cols = list(cols)
    missing = [c for c in cols if c is None or c not in df.columns]
    if missing:
        raise MissingColumnsError(
            f"{what}: missing columns {missing}; table has {df.columns}", what, missing)


def has_columns(df: DataFrame, *cols: str | None) -> bool:
    """True when every named column is present (``None`` is never present)."""
    return all(c is not None and c in df.columns for c in cols)


def strip_column_names(df: DataFrame) -> DataFrame:
    """Remove blanks around column names (as a CSV header may carry)."""
    stripped = [c.strip() for c in df.columns]
    return df if stripped == df.columns else df.toDF(*stripped)


def rename_if_present(df: DataFrame, old: str | None, new: str) -> DataFrame:
    """Rename ``old`` to ``new`` when ``old`` exists; otherwise leave the table as it is."""
    if old is None or old == new or old not in df.columns:
        return df
    return df.withColumnRenamed(old, new)


def resolve_alias(df: DataFrame, target: str, *, several: str = "refuse") -> DataFrame:
    """Rename the column that matches ``target`` loosely (case, blanks, underscores) to ``target``."""
    if target in df.columns:
        return df
    found = find_col(df, target, several=several)
    return df if found is None else df.withColumnRenamed(found, target)


def resolve_profile(df: DataFrame, profile: IncidentProfile, *, several: str = "refuse") -> IncidentProfile:
    """Bind each role of ``profile`` to the column of ``df`` with the same normalised name.

    ``Vict Age``, ``vict_age`` and ``VICTAGE`` all resolve to whatever spelling
    the table uses. A role whose column is absent keeps its name (a missing
    optional column then switches its results off; a missing required one is
    reported by the operator that needs it). ``several`` says what two columns
    for one role mean, see :func:`find_col`.
    """
    changes = {}
    source = df.drop(profile.ts_out, profile.date_out, profile.year_out)  # the clean job's own columns play no role
    for f in fields(profile):
        if f.name not in ROLE_FIELDS:
            continue
        name = getattr(profile, f.name)
        if name is None or name in df.columns:
            continue
        found = find_col(source, name, several=several)
        if found is not None:
            changes[f.name] = found
    return profile.with_(**changes) if changes else profile
