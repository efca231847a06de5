"""Ranking without moving a whole table into one task.

``Window.orderBy`` without ``partitionBy`` sorts every row in a single task.
These helpers give the same answers with distributed plans:

* :func:`top_k_with_ties` - rows whose ``rank()`` is at most k. The k-th value
  comes from a top-k (``TakeOrderedAndProject``: k rows per task, then k rows
  merged), then one filter.
* :func:`top_k_counts_per_group` - the same per group, for integer counts. It
  ranks a histogram of count values per group: a group of N incidents has at
  most sqrt(2N) distinct counts, so the per-group window is bounded whatever
  the group size.
* :func:`running_total` - cumulative sum in a total order: range-partitioned,
  summed within each range, then offset by the totals of the ranges before it
  (one row per range).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def kth_largest(df: DataFrame, value: str, k: int) -> Column:
    """Scalar: the k-th largest non-NULL value of ``value`` (counting repeats)."""
    return (df.select(value).filter(F.col(value).isNotNull())
              .orderBy(F.col(value).desc()).limit(k)
              .agg(F.min(value)).scalar())


def top_k_with_ties(df: DataFrame, value: str, k: int) -> DataFrame:
    """Rows with ``rank() over (order by value desc) <= k``; NULL values are never ranked.

    ``rank(x) = 1 + #{y > x}``, so ``rank(x) <= k`` exactly when x is at least
    the k-th largest value.
    """
    return df.filter(F.col(value) >= kth_largest(df, value, k))


def top_k_counts_per_group(df: DataFrame, group_cols: Sequence[str], count_col: str,
                           k: int, *, few_groups: bool = False) -> DataFrame:
    """Rows with ``rank() over (partition by group order by count desc) <= k``.

    ``count_col`` must hold non-negative integer counts (the histogram bound
    relies on it). The histogram gives each group its smallest kept count, one
    row per group; rows join it on the group alone and compare, so no key holds
    more than its group. NULL is a group of its own. ``few_groups=True`` says
    that the number of groups is small whatever the data, and broadcasts them.
    """
    group_cols = list(group_cols)
    hist = df.groupBy(*group_cols, count_col).agg(F.count(F.lit(1)).alias("_rows"))
    above = Window.partitionBy(*group_cols).orderBy(F.col(count_col).desc()) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.withColumn("_above", F.coalesce(F.sum("_rows").over(above), F.lit(0)))
    least = ranked.filter(F.col("_above") < k).groupBy(*group_cols).agg(F.min(count_col).alias("_least"))
    rows, least = df.alias("_rows"), (F.broadcast(least) if few_groups else least).alias("_least")
    same = F.col(f"_rows.`{count_col}`") >= F.col("_least._least")
    for c in group_cols:
        same = same & F.col(f"_rows.`{c}`").eqNullSafe(F.col(f"_least.`{c}`"))
    return rows.join(least, same).select(*[F.col(f"_rows.`{c}`") for c in df.columns])


def running_total(df: DataFrame, sums: Mapping[str, str], order: Sequence[Column], *,
                  num_ranges: int | None = None) -> DataFrame:
    """Add, for each ``name -> value`` in ``sums``, the sum of ``value`` over all rows
    up to this one in ``order`` (a running count when ``value`` is the literal 1).

    ``order`` must be a total order (add a unique key as the last tie-break).
    The table is range-partitioned on ``order``; each range computes its own
    running sums (a window partitioned by range), and adds the sums of all
    earlier ranges, taken from a table with one row per range. Without
    ``num_ranges`` adaptive execution coalesces the ranges to its advisory size
    (coalescing keeps them contiguous and in order, which is all this needs).
    """
    vals = {name: (F.lit(1) if v == "1" else F.col(v)) for name, v in sums.items()}
    valued = df.withColumns({f"_v_{name}": v for name, v in vals.items()})
    ranged = (valued.repartitionByRange(num_ranges, *order) if num_ranges
              else valued.repartitionByRange(*order))
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    within = Window.partitionBy("_range").orderBy(*order) \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumns({f"_l_{name}": F.sum(f"_v_{name}").over(within) for name in vals})
    # One row per range: bounded by the number of ranges, not by the data. Taken
    # from ``local`` itself, so the range shuffle is read (and ``_range``
    # assigned) once for both uses.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (local.groupBy("_range")
                     .agg(*[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in vals])
                     .select("_range", *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0))
                                          .alias(f"_o_{name}") for name in vals]))
    out = local.join(F.broadcast(offsets), "_range").withColumns(
        {name: F.col(f"_o_{name}") + F.col(f"_l_{name}") for name in vals})
    return out.drop("_range", *[f"_{p}_{name}" for name in vals for p in "vlo"])
