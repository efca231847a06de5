"""Count aggregates over incident rows, or over a pre-aggregated count table.

Every operator takes ``weight``: ``None`` counts rows; a column name sums that
column instead. Because counts are additive, the same operator gives the same
answer on the incident rows and on any coarser table of counts (the daily cube
in :mod:`blotter.operators.cube`), which is how the aggregate job computes ten
results from one scan.

All of these are plain ``groupBy().agg()``: Spark plans a partial (map-side)
aggregate before the shuffle, so a hot key is pre-combined in every task and
the exchange carries at most one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.classify import weapon_used
from blotter.functions.time import bucket_columns

#: Names of the four groupings in :func:`yearly_grouping_sets`, by ``grouping_id``
#: over (year, entity, severity): a set bit means "rolled up".
GROUPING_SET_IDS = {"per_year": 3, "per_year_area": 1, "per_year_severity": 2,
                    "per_year_area_severity": 0}


def measure(weight: str | None) -> Column:
    """``count(*)`` on incident rows, ``sum(weight)`` on a count table."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def count_by(df: DataFrame, keys: Sequence[str | Column], *, weight: str | None = None,
             name: str = "n_crimes") -> DataFrame:
    """Incidents per key combination."""
    return df.groupBy(*keys).agg(measure(weight).alias(name))


def _year(df: DataFrame, date_col: str, year_col: str | None) -> Column:
    # A curated table carries its partition column ``year`` (= year of the date):
    # grouping and filtering on it lets Spark prune partitions.
    if year_col is not None and year_col in df.columns:
        return F.col(year_col)
    return F.year(date_col)


def _weight_cols(weight: str | None) -> list[str]:
    return [] if weight is None else [weight]


def per_bucket_counts(df: DataFrame, entity: str, date_col: str, grain: str, *,
                      weight: str | None = None, iso_year: bool = False,
                      year_col: str | None = "year", year_name: str = "year_int",
                      name: str = "n_crimes") -> DataFrame:
    """Incidents per (entity, time bucket); only buckets with incidents appear."""
    buckets = bucket_columns(date_col, grain, year_name=year_name, iso_year=iso_year)
    if grain in ("month", "year") and year_name in buckets:
        buckets[year_name] = _year(df, date_col, year_col)
    keys = [entity, date_col] if grain == "day" else [entity, *buckets]
    base = df.select(entity, date_col, *[c for c in _weight_cols(weight)],
                     *[expr.alias(k) for k, expr in buckets.items()])
    return count_by(base, keys, weight=weight, name=name)


def avg_count_per_bucket(df: DataFrame, entity: str, date_col: str, grain: str, *,
                         weight: str | None = None, iso_year: bool = False,
                         year_col: str | None = "year", name: str | None = None) -> DataFrame:
    """Mean number of incidents per day, week or month, for each entity.

    Counts per (entity, bucket) first, then the mean of those counts: buckets
    without incidents are not part of the mean (see :func:`dense_avg_count_per_bucket`).
    Two exchanges: one on (entity, bucket) after a partial aggregate, one on
    entity over the much smaller bucket table; a hot entity never lands whole
    in one task.
    """
    name = name or f"avg_crimes_per_{grain}"
    counts = per_bucket_counts(df, entity, date_col, grain, weight=weight,
                               iso_year=iso_year, year_col=year_col, name="_n")
    return counts.groupBy(entity).agg(F.avg("_n").alias(name))


def dense_avg_count_per_bucket(df: DataFrame, entity: str, date_col: str, grain: str, *,
                               weight: str | None = None, iso_year: bool = False,
                               name: str | None = None) -> DataFrame:
    """Mean per bucket counting empty buckets as zero.

    The bucket range is the whole table's first to last date. The mean is the
    entity's total over the number of buckets in that range, so no zero rows are
    generated: the bucket count is one scalar from a calendar whose size is
    bounded by the date span, not by the data. Totals and date range come from
    one aggregate per entity, so the table is read once: each use of it mentions
    all three measures, which keeps the uses' plans equal and their exchange shared.
    """
    name = name or f"avg_crimes_per_{grain}_dense"
    per_entity = df.groupBy(entity).agg(measure(weight).alias("_total"), F.min(date_col).alias("_lo"),
                                        F.max(date_col).alias("_hi"))
    bounds = per_entity.filter(F.coalesce("_total", F.lit(0)) >= 0).agg(F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    if grain == "day":
        n_buckets = days.select(F.count(F.lit(1))).scalar()
    else:
        keys = bucket_columns("d", grain, year_name="y", iso_year=iso_year)
        n_buckets = days.select(*[e.alias(k) for k, e in keys.items()]).distinct() \
                        .select(F.count(F.lit(1))).scalar()
    dated = F.coalesce(F.col("_lo") <= F.col("_hi"), F.lit(True))
    return per_entity.filter(dated).select(entity, (F.col("_total") / n_buckets).alias(name))


def total_by_entity(df: DataFrame, entity: str, *, weight: str | None = None,
                    name: str = "n_crimes_total") -> DataFrame:
    """Incidents per entity over the whole period."""
    return count_by(df, [entity], weight=weight, name=name)


def yearly_counts(df: DataFrame, date_col: str, by: Sequence[str] = (), *,
                  weight: str | None = None, year_col: str | None = "year",
                  year_name: str = "year_int", name: str = "n_crimes") -> DataFrame:
    """Incidents per year, optionally per year and other keys (entity, severity)."""
    base = df.select(_year(df, date_col, year_col).alias(year_name), *by, *_weight_cols(weight))
    return count_by(base, [year_name, *by], weight=weight, name=name)


def yearly_grouping_sets(df: DataFrame, date_col: str, entity: str, severity: str, *,
                         weight: str | None = None, year_col: str | None = "year",
                         year_name: str = "year_int", name: str = "n_crimes",
                         id_name: str = "grouping_id") -> DataFrame:
    """The four yearly counts (year; year+entity; year+severity; all three) in one aggregate.

    One scan and one exchange instead of four; ``grouping_id`` tells the sets
    apart (see :data:`GROUPING_SET_IDS`).
    """
    base = df.select(_year(df, date_col, year_col).alias(year_name), entity, severity,
                     *_weight_cols(weight))
    sets = [[year_name], [year_name, entity], [year_name, severity], [year_name, entity, severity]]
    return (base.groupingSets(sets, year_name, entity, severity)
                .agg(measure(weight).alias(name), F.grouping_id().cast("int").alias(id_name)))


def split_grouping_sets(gs: DataFrame, entity: str, severity: str, *,
                        year_name: str = "year_int", name: str = "n_crimes",
                        id_name: str = "grouping_id") -> dict[str, DataFrame]:
    """The four result tables of :func:`yearly_grouping_sets`, with their own columns."""
    cols = {"per_year": [year_name], "per_year_area": [year_name, entity],
            "per_year_severity": [year_name, severity],
            "per_year_area_severity": [year_name, entity, severity]}
    return {k: gs.filter(F.col(id_name) == GROUPING_SET_IDS[k]).select(*cols[k], name)
            for k in cols}


def monthly_density(df: DataFrame, date_col: str, entity: str, lat: str, lon: str, *,
                    weight: str | None = None, year_col: str | None = "year",
                    year_name: str = "year_int", name: str = "n_crimes") -> DataFrame:
    """Incidents per (year, month, entity, exact coordinates), rows with coordinates only.

    (0, 0) is a coordinate like any other and is kept. A hot point is
    pre-combined map-side like any other key.
    """
    located = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    base = located.select(_year(located, date_col, year_col).alias(year_name),
                          F.month(date_col).alias("month"), entity, lat, lon,
                          *_weight_cols(weight))
    return count_by(base, [year_name, "month", entity, lat, lon], weight=weight, name=name)


def weapon_usage_per_year(df: DataFrame, date_col: str, weapon: str, *,
                          weight: str | None = None, classified: bool = False,
                          year_col: str | None = "year", year_name: str = "year_int",
                          name: str = "n_crimes") -> DataFrame:
    """Incidents per year with / without a weapon.

    ``weapon`` is the raw description, or the class already (``classified=True``,
    as in the daily cube).
    """
    cls = F.col(weapon) if classified else weapon_used(weapon)
    base = df.select(_year(df, date_col, year_col).alias(year_name),
                     cls.alias("weapon_used"), *_weight_cols(weight))
    return count_by(base, [year_name, "weapon_used"], weight=weight, name=name)
