"""Batch jobs: RAW -> CURATED, CURATED -> aggregates, CURATED -> risk tables.

Each job is a plain function of a session and paths; running them in order is
the whole batch. With ``mode="ignore"`` (the default) a job computes only the
result tables that are absent, always from the current CURATED; ``"overwrite"``
computes all. Intermediates (``daily_cube``, ``shared_counts``) are never reused
from an earlier run: a job that needs one writes it anew.

Aggregate job shapes:

* ``strategy="cube"`` (default): one scan of CURATED writes the daily cube,
  nine results are re-aggregated from it, and the heat map scans CURATED once
  more (its coordinate keys are not in the cube). Two scans in total.
* ``strategy="per_result"``: every result scans CURATED on its own, which is
  the reference's shape (ten scans); kept for comparison and for tables whose
  cube would not be much smaller than the incidents.

``run_analytics`` (the ``run_batch`` default) goes further and computes the
aggregate and risk tables together: one grouping-sets aggregate for the cube and
the context counts, one narrow aggregate for the heat map (two scans of CURATED
for twelve tables).

Every intermediate that is read more than once is a written table in the
ANALYTICS zone, never a cache or a local checkpoint: a lost executor costs a
task retry, not a recomputation from RAW.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType

from blotter.operators.aggregate import monthly_density
from blotter.operators.clean import clean_incidents, curated_view
from blotter.operators.columns import has_columns, resolve_profile
from blotter.operators.cube import CUBE_COUNT, daily_cube, results_from_counts
from blotter.operators.risk import context_risk_scores, high_risk_contexts, score_counts
from blotter.operators.shared import GID, shared_counts, split_shared_counts
from blotter.profile import IncidentProfile
from blotter.sinks.writers import write_curated, write_result, write_results
from blotter.sources.zones import read_curated, read_raw_csv, read_result, table_exists, with_types

log = logging.getLogger(__name__)

#: Result tables of the aggregate job, in the reference's naming.
AGGREGATE_TABLES = (
    "avg_by_area_day", "avg_by_area_week", "avg_by_area_month", "total_by_area",
    "crimes_per_year", "crimes_per_year_area", "crimes_per_year_severity",
    "crimes_per_year_area_severity", "crime_heatmap_monthly", "weapon_usage_per_year",
)
#: Result tables of the risk job.
RISK_TABLES = ("context_risk_scores", "high_risk_contexts")
#: Intermediate count table written by the cube strategy.
CUBE_TABLE = "daily_cube"
#: Intermediate count table written by the shared-scan analytics job.
SHARED_TABLE = "shared_counts"


def run_clean(spark: SparkSession, raw: str | DataFrame, curated_path: str,
              profile: IncidentProfile, *, raw_types: Mapping[str, DataType] | None = None,
              mode: str = "overwrite", rebalance: bool = True, fmt: str = "parquet") -> str:
    """RAW -> CURATED: parse, filter and write Parquet partitioned by year.

    ``raw`` is a CSV path (read as text) or a DataFrame. Role columns are found
    by normalised name, and text columns get the types of ``raw_types`` or else
    of the profile. ``mode="overwrite"`` replaces the zone, ``"years"`` only the
    years in ``raw``. Each file is clustered by (entity, date) for row-group
    skipping; ``rebalance`` gives files of even size (see ``write_curated``).
    """
    raw_df = read_raw_csv(spark, raw) if isinstance(raw, str) else raw
    raw_df = with_types(raw_df, raw_types if raw_types is not None else profile.raw_types or {})
    profile = resolve_profile(raw_df, profile)
    write_curated(clean_incidents(raw_df, profile), curated_path, partition_col=profile.year_out,
                  mode=mode, rebalance=rebalance, fmt=fmt,
                  cluster_by=(profile.entity, profile.date_out))
    return curated_path


def _wanted(spark: SparkSession, base: str, names: Iterable[str], mode: str) -> list[str]:
    """The result tables to compute: all of them, or in ``ignore`` mode the absent ones."""
    return [n for n in names if mode != "ignore" or not table_exists(spark, f"{base.rstrip('/')}/{n}")]


def _read(spark: SparkSession, curated_path: str, fmt: str, profile: IncidentProfile) -> tuple[DataFrame, IncidentProfile]:
    curated = read_curated(spark, curated_path, fmt=fmt, date_col=profile.date_out)
    curated = with_types(curated, profile.raw_types or {})
    profile = resolve_profile(curated, profile)
    return curated_view(curated, profile), profile


def _paths(base: str, names: Iterable[str]) -> dict[str, str]:
    return {n: f"{base.rstrip('/')}/{n}" for n in names}


def _heat_map(curated: DataFrame, profile: IncidentProfile) -> DataFrame:
    return monthly_density(curated, profile.date_out, profile.entity, profile.lat, profile.lon,
                           year_col=profile.year_out, year_name=profile.year_key, name=profile.count_out)


def _additive_tables(curated: DataFrame, profile: IncidentProfile) -> list[str]:
    """The tables that counts per (area, date, severity, weapon class) give, for the columns present."""
    return list(results_from_counts(curated, profile, weight=None))


def run_aggregates(spark: SparkSession, curated_path: str, analytics_base: str,
                   profile: IncidentProfile, *, strategy: str = "cube", mode: str = "ignore",
                   fmt: str = "parquet", concurrency: int = 4,
                   curated_fmt: str = "parquet") -> dict[str, str]:
    """CURATED -> the ten aggregate tables; returns name -> path.

    The tables are independent jobs and are submitted ``concurrency`` at a time.
    """
    if strategy not in ("cube", "per_result"):
        raise ValueError(f"unknown strategy {strategy!r}")
    curated, profile = _read(spark, curated_path, curated_fmt, profile)
    tables = _additive_tables(curated, profile)
    heat = ["crime_heatmap_monthly"] if has_columns(curated, profile.lat, profile.lon) else []
    wanted = _wanted(spark, analytics_base, [*tables, *heat], mode)
    results = {}
    if any(n in wanted for n in tables):
        source, weight = curated, None
        if strategy == "cube":
            write_result(daily_cube(curated, profile), analytics_base, CUBE_TABLE, mode="overwrite")
            source, weight = read_result(spark, analytics_base, CUBE_TABLE), CUBE_COUNT
        results = {n: df for n, df in results_from_counts(source, profile, weight=weight).items() if n in wanted}
    if heat and heat[0] in wanted:
        results[heat[0]] = _heat_map(curated, profile)
    write_results(results, analytics_base, mode="overwrite", fmt=fmt, concurrency=concurrency)
    return _paths(analytics_base, [*tables, *heat])


def _write_scores(spark: SparkSession, scores: DataFrame, analytics_base: str, profile: IncidentProfile,
                  wanted: list[str], fmt: str) -> None:
    """The risk tables in ``wanted`` from fresh ``scores`` (read back when both are written)."""
    if "context_risk_scores" in wanted:
        write_result(scores, analytics_base, "context_risk_scores", mode="overwrite", fmt=fmt)
        scores = read_result(spark, analytics_base, "context_risk_scores", fmt=fmt, schema=scores.schema)
    if "high_risk_contexts" in wanted:
        write_result(high_risk_contexts(scores, profile), analytics_base, "high_risk_contexts",
                     mode="overwrite", fmt=fmt)


def _missing_context_columns(curated: DataFrame, profile: IncidentProfile) -> dict[str, str | None]:
    roles = {"entity": profile.entity, "time": profile.time_hhmm, "age": profile.victim_age,
             "sex": profile.victim_sex, "premises": profile.premises}
    return {k: v for k, v in roles.items() if v is None or v not in curated.columns}


def run_risk(spark: SparkSession, curated_path: str, analytics_base: str,
             profile: IncidentProfile, *, mode: str = "ignore", fmt: str = "parquet",
             curated_fmt: str = "parquet") -> dict[str, str]:
    """CURATED -> context_risk_scores and high_risk_contexts.

    When both are written the high-risk table is a filter of the written score
    table, read back, so the context counts are computed once. In ``ignore`` mode
    nothing is read when both are there, not even CURATED's schema.
    """
    wanted = _wanted(spark, analytics_base, RISK_TABLES, mode)
    if not wanted:
        return _paths(analytics_base, RISK_TABLES)
    curated, profile = _read(spark, curated_path, curated_fmt, profile)
    missing = _missing_context_columns(curated, profile)
    if missing:
        log.warning("context columns missing, no risk tables written: %s", missing)
        return {}
    _write_scores(spark, context_risk_scores(curated, profile), analytics_base, profile, wanted, fmt)
    return _paths(analytics_base, RISK_TABLES)


def run_analytics(spark: SparkSession, curated_path: str, analytics_base: str,
                  profile: IncidentProfile, *, mode: str = "ignore", fmt: str = "parquet",
                  concurrency: int = 4, heat_in_shared_scan: bool = False,
                  curated_fmt: str = "parquet") -> dict[str, str]:
    """CURATED -> all twelve tables (aggregate and risk jobs together).

    One grouping-sets aggregate writes the cube and context counts as one table
    (:mod:`blotter.operators.shared`); the nine additive results and the scores
    are derived from it, the high-risk table from the written score table. The
    heat map is its own narrow aggregate (two scans of CURATED in all), or part
    of the shared scan with ``heat_in_shared_scan=True`` (one scan).
    """
    curated, profile = _read(spark, curated_path, curated_fmt, profile)
    tables = _additive_tables(curated, profile)
    heat = ["crime_heatmap_monthly"] if has_columns(curated, profile.lat, profile.lon) else []
    risk = [] if _missing_context_columns(curated, profile) else list(RISK_TABLES)
    wanted = _wanted(spark, analytics_base, [*tables, *heat, *risk], mode)
    in_scan = [*tables, *risk, *(heat if heat_in_shared_scan else [])]
    results, parts = {}, {}
    if any(n in wanted for n in in_scan):
        # Partitioned by set: each reader below prunes to the files of its own set.
        write_result(shared_counts(curated, profile, include_heat=heat_in_shared_scan),
                     analytics_base, SHARED_TABLE, mode="overwrite", partition_by=GID)
        parts = split_shared_counts(read_result(spark, analytics_base, SHARED_TABLE), profile)
        results = {n: df for n, df in results_from_counts(parts["cube"], profile, weight=CUBE_COUNT).items()
                   if n in wanted}
    if heat and heat[0] in wanted:
        results[heat[0]] = parts["heat"] if "heat" in parts else _heat_map(curated, profile)
    write_results(results, analytics_base, mode="overwrite", fmt=fmt, concurrency=concurrency)
    if any(n in wanted for n in risk):
        _write_scores(spark, score_counts(parts["contexts"], count_col=profile.count_out), analytics_base,
                      profile, wanted, fmt)
    return _paths(analytics_base, [*tables, *heat, *risk])


def run_batch(spark: SparkSession, raw: str | DataFrame, lake_base: str, profile: IncidentProfile,
              *, raw_types: Mapping[str, DataType] | None = None, mode: str = "ignore",
              strategy: str = "shared", fmt: str = "parquet", rebalance: bool = True,
              clean_mode: str = "overwrite") -> dict[str, str]:
    """All jobs in order under ``lake_base`` (curated/ and analytics/).

    ``strategy="shared"`` runs the aggregate and risk jobs together over a
    shared scan (:func:`run_analytics`); ``"cube"`` or ``"per_result"`` run
    them as two jobs with that aggregate shape. ``fmt="csv"`` keeps every zone
    as CSV with a header. ``rebalance`` and ``clean_mode`` go to the clean job.
    """
    base = lake_base.rstrip("/")
    curated_path = run_clean(spark, raw, f"{base}/curated", profile, raw_types=raw_types, fmt=fmt,
                             mode=clean_mode, rebalance=rebalance)
    kw = {"mode": mode, "fmt": fmt, "curated_fmt": fmt}
    if strategy == "shared":
        out = run_analytics(spark, curated_path, f"{base}/analytics", profile, **kw)
    else:
        out = run_aggregates(spark, curated_path, f"{base}/analytics", profile,
                             strategy=strategy, **kw)
        out.update(run_risk(spark, curated_path, f"{base}/analytics", profile, **kw))
    return {"curated": curated_path, **out}
