"""CASE ladders with exact labels (all ``when`` chains, no UDF)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter import profile as P


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cut(c: str | Column, edges: Sequence[float | None], labels: Sequence[str],
        otherwise: str | None = None) -> Column:
    """Label ``edges[i] <= x < edges[i+1]`` with ``labels[i]``.

    ``None`` as the first or last edge leaves that side open. NULL input, or a
    value outside every band, gets ``otherwise``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    x = _col(c)
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        conds = []
        if lo is not None:
            conds.append(x >= F.lit(lo))
        if hi is not None:
            conds.append(x < F.lit(hi))
        cond = conds[0] if len(conds) == 1 else conds[0] & conds[1]
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(otherwise)


def time_slot(hour: str | Column) -> Column:
    """Four slots of the day by hour; NULL or out of range is unknown."""
    return cut(hour, P.TIME_SLOT_EDGES, P.TIME_SLOT_LABELS, P.UNKNOWN)


def age_range(age: str | Column) -> Column:
    """Victim age band; NULL or not positive is unknown."""
    a = _col(age)
    bands = cut(a, P.AGE_RANGE_EDGES, P.AGE_RANGE_LABELS, P.UNKNOWN)
    return F.when(a.isNull() | (a <= 0), P.UNKNOWN).otherwise(bands)


def victim_type(age: str | Column, sex: str | Column) -> Column:
    """Human when the age is positive or the sex is one of the known codes.

    A NULL test result falls to the non-human side.
    """
    human = (_col(age) > 0) | _col(sex).isin(*P.SEX_CODES)
    return F.when(human, P.VICTIM_HUMAN).otherwise(P.VICTIM_NON_HUMAN)


def sex_norm(sex: str | Column) -> Column:
    """NULL -> unknown, known codes kept, anything else -> other."""
    s = _col(sex)
    expr = F.when(s.isNull(), P.UNKNOWN)
    for code in P.SEX_CODES:
        expr = expr.when(s == code, code)
    return expr.otherwise(P.SEX_OTHER)


def weapon_used(weapon: str | Column) -> Column:
    """Two classes: no weapon (NULL, blank or bodily force / verbal threat) or weapon."""
    described = F.coalesce(F.upper(F.trim(_col(weapon))), F.lit(""))
    return F.when(described.isin("", *P.NO_WEAPON_DESCRIPTIONS), P.NO_WEAPON).otherwise(P.WEAPON_USED)


def risk_level(z: str | Column) -> Column:
    """z >= 3 very high, z >= 2 high, otherwise normal."""
    return cut(z, P.RISK_LEVEL_EDGES, P.RISK_LEVEL_LABELS, P.RISK_NORMAL)
