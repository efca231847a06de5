"""Dashboard data operations: selections, top lists, summaries, default choices.

The reference runs these in pandas on tables it downloads; here they are
DataFrame operations over the result tables, so they run where the data is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter import profile as P
from blotter.functions.labels import context_label
from blotter.operators.columns import MissingColumnsError, has_columns
from blotter.operators.risk import CONTEXT_KEYS


def filter_selected(df: DataFrame, selections: Mapping[str, Sequence | None], *,
                    measured: str | None = None) -> DataFrame:
    """Keep rows whose column value is in the selection; an empty selection keeps all.

    ``measured`` names an aggregate's output (a count, never 0). The condition
    then reads it too and so stays above that aggregate: two uses of one
    aggregate, one filtered and one not, keep equal plans and share one scan.
    """
    for c, values in selections.items():
        if values:
            value = F.col(c) if measured is None else F.when(F.col(measured) != 0, F.col(c))
            df = df.filter(value.isin(list(values)))
    return df


def filter_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    """Keep rows whose value is in ``values``; an empty list keeps no row."""
    return df.filter(F.col(c).isin(list(values)))


def filter_equal(df: DataFrame, **equals) -> DataFrame:
    """Keep rows where each named column equals the given value (a Column is allowed)."""
    for c, v in equals.items():
        df = df.filter(F.col(c) == (v if isinstance(v, Column) else F.lit(v)))
    return df


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def distinct_sorted(df: DataFrame, c: str, *, drop_null: bool = True) -> DataFrame:
    """Distinct values of one column, ascending (choices of a selector)."""
    vals = df.select(c)
    if drop_null:
        vals = vals.filter(F.col(c).isNotNull())
    return vals.distinct().orderBy(c)


def first_k_sorted(df: DataFrame, c: str, k: int) -> DataFrame:
    """The first k distinct non-NULL values in ascending order (a selector's default choice).

    NULL sorts last and is dropped after the limit, so the input's plan stays
    free of a filter that a second use of the same table would not have.
    """
    first = df.select(c).distinct().orderBy(F.col(c).asc_nulls_last()).limit(k)
    return first.filter(F.col(c).isNotNull())


def first_k_rows(df: DataFrame, c: str, k: int) -> DataFrame:
    """Rows of the first k values of ``c``, for a table with one row per value."""
    return df.orderBy(F.col(c).asc_nulls_last()).limit(k).filter(F.col(c).isNotNull())


def latest_value(df: DataFrame, c: str) -> Column:
    """Scalar: the largest value of ``c`` (the default year)."""
    return df.agg(F.max(c)).scalar()


def filter_default_zones(df: DataFrame, entity: str, k: int, *, measured: str | None = None) -> DataFrame:
    """Rows of the first k zones in sorted order (the default of the zone selector).

    The zone list holds at most k distinct rows (``limit``), so it is broadcast to
    a join. The join stays above an aggregate (a semi join would be moved below),
    NULL-safe equality adds no filter under it, and ``measured`` (see
    :func:`filter_selected`) keeps its uses equal, so they share one scan.
    """
    listed = df if measured is None else df.filter(F.col(measured) != 0)
    rows, zones = df.alias("_rows"), first_k_sorted(listed, entity, k).alias("_zones")
    same = F.col(f"_rows.`{entity}`").eqNullSafe(F.col(f"_zones.`{entity}`"))
    return rows.join(F.broadcast(zones), same).select(*[F.col(f"_rows.`{c}`") for c in df.columns])


def filter_default_then_all(df: DataFrame, c: str, defaults: Sequence) -> DataFrame:
    """Keep ``defaults`` when any of them is present, otherwise keep every non-NULL value."""
    in_defaults = F.col(c).isin(list(defaults))
    any_default = df.filter(in_defaults).exists()
    return df.filter(in_defaults | (~any_default & F.col(c).isNotNull()))


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows in ``order`` (planned as a distributed top-n)."""
    return df.orderBy(*order).limit(n)


def top_entities(df: DataFrame, entity: str, value: str, k: int = P.TOP_AREAS) -> DataFrame:
    """The k entities with the largest ``value``; ties broken by entity."""
    return top_rows(df, [F.col(value).desc(), F.col(entity).asc()], k)


def explore_high_risk(df: DataFrame, *, zones=None, time_slots=None, risk_levels=None,
                      age_ranges=None, sexes=None, entity: str = "AREA NAME",
                      measured: str | None = None) -> DataFrame:
    """The scenario page's filters; ``risk_levels=None`` applies the page default
    (both high levels, or all levels when neither is present). ``measured`` as in
    :func:`filter_selected`, for a table that is not read from the lake."""
    out = filter_selected(df, {entity: zones, "time_slot": time_slots,
                               "age_range": age_ranges, "sex_norm": sexes}, measured=measured)
    if risk_levels is None:
        return filter_default_then_all(out, "risk_level", [P.RISK_VERY_HIGH, P.RISK_HIGH])
    return filter_selected(out, {"risk_level": risk_levels})


SCORE_COLUMNS = ("risk_score_10", "crime_share_percent", "z_score")


def score_column(df: DataFrame) -> str:
    """The column contexts are ordered by: score out of 10, else share, else z-score."""
    present = [c for c in SCORE_COLUMNS if has_columns(df, c)]
    if not present:
        raise MissingColumnsError(f"contexts: none of {SCORE_COLUMNS} is a column; table has {df.columns}")
    return present[0]


def context_order(df: DataFrame, entity: str) -> list[Column]:
    """Best context first; the z-score and then the context's keys settle ties."""
    z = [F.col("z_score").desc()] if has_columns(df, "z_score") else []
    return [F.col(score_column(df)).desc(), *z, *[F.col(k).asc() for k in (entity, *CONTEXT_KEYS)]]


def risk_summary(df: DataFrame, *, count_col: str = "n_crimes") -> DataFrame:
    """One row: scenarios, largest count, largest score and largest share (2 decimals).

    Without a score or share column the z-score stands in, as on the dashboard.
    """
    score = "risk_score_10" if has_columns(df, "risk_score_10") else "z_score"
    share = "crime_share_percent" if has_columns(df, "crime_share_percent") else "z_score"
    return df.agg(
        F.count(F.lit(1)).alias("n_scenarios"),
        F.max(count_col).alias("max_n_crimes"),
        F.round(F.max(score), 2).alias("max_score"),
        F.round(F.max(share), 2).alias("max_share"),
    )


def top_contexts_labelled(df: DataFrame, entity: str, n: int = P.TOP_CONTEXTS) -> DataFrame:
    """The n highest-scoring contexts with a short caption.

    Sorted as :func:`context_order`, so the many contexts capped at 10 have a
    fixed order.
    """
    top = top_rows(df, context_order(df, entity), n)
    return top.withColumn("context", context_label(entity, "time_slot", "place_type"))


def heatmap_points(heat: DataFrame, entity: str, lat: str, lon: str, *, year=None, month=None,
                   zones=None, year_col: str = "year_int", count_col: str = "n_crimes",
                   computed: bool = False) -> DataFrame:
    """Map points for one month: (lat, lon, count).

    ``year=None`` picks the latest year, ``month=None`` the first month present
    in that year (the page defaults); ``zones`` empty keeps every zone. With a
    ``computed`` table (an aggregate, not a stored one) the month's condition
    stays above the aggregate, so that picking the month and reading its points
    share one scan.
    """
    if year is None and month is None:
        # Latest year, then its first month, as one scalar: the largest
        # (year, -month) pair (struct comparison is field by field).
        dated = heat.filter(F.col(count_col) != 0) if computed else heat
        pick = dated.agg(F.max(F.struct(F.col(year_col).alias("y"),
                                       (-F.col("month")).alias("m")))).scalar()
        y, m = pick["y"], -pick["m"]
    else:
        y = latest_value(heat, year_col) if year is None else F.lit(year)
        m = (heat.filter(F.col(year_col) == y).agg(F.min("month")).scalar()
             if month is None else F.lit(month))
    in_month = (F.col(year_col) == y) & (F.col("month") == m)
    if computed:
        in_month = F.when(F.col(count_col) != 0, in_month)
    sel = filter_selected(heat.filter(in_month), {entity: zones})
    return drop_incomplete(sel.select(lat, lon, count_col), [lat, lon, count_col])
