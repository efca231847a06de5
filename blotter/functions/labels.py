"""Display labels: month names and context captions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter import profile as P


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_name(month: str | Column) -> Column:
    """Month number -> name; an unknown number is shown as its own text."""
    m = _col(month)
    names = F.create_map(*chain.from_iterable(
        (F.lit(i), F.lit(name)) for i, name in enumerate(P.MONTH_NAMES, start=1)))
    return F.coalesce(F.try_element_at(names, m.cast("int")), m.cast("string"))


def context_label(area: str | Column, slot: str | Column, place: str | Column,
                  place_chars: int = P.LABEL_PLACE_CHARS) -> Column:
    """``area | slot | first chars of place...``; NULL in any part gives NULL."""
    return F.concat(_col(area), F.lit(" | "), _col(slot), F.lit(" | "),
                    F.substring(_col(place), 1, place_chars), F.lit("..."))


def percent_label(value: str | Column, digits: int = 2) -> Column:
    """``12.3456`` -> ``"12.35 %"`` (fixed decimals, no grouping separators); NULL stays NULL."""
    v = _col(value)
    return F.when(v.isNotNull(), F.format_string(f"%.{digits}f %%", v))
