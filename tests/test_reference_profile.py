"""The reference's own column names end to end, in Parquet and in the CSV lake layout."""

import pytest
from pyspark.sql import functions as F

from blotter.plans.jobs import AGGREGATE_TABLES, RISK_TABLES, run_batch
from blotter.profile import REFERENCE_PROFILE, REFERENCE_RAW_TYPES
from blotter.sources.zones import read_result
from edge_rows import CONTEXT_IDS, raw_frame

SCHEMAS = {
    "avg_by_area_day": ["AREA NAME", "avg_crimes_per_day"],
    "avg_by_area_week": ["AREA NAME", "avg_crimes_per_week"],
    "avg_by_area_month": ["AREA NAME", "avg_crimes_per_month"],
    "total_by_area": ["AREA NAME", "n_crimes_total"],
    "crimes_per_year": ["year_int", "n_crimes"],
    "crimes_per_year_area": ["year_int", "AREA NAME", "n_crimes"],
    "crimes_per_year_severity": ["year_int", "part_1_2", "n_crimes"],
    "crimes_per_year_area_severity": ["year_int", "AREA NAME", "part_1_2", "n_crimes"],
    "crime_heatmap_monthly": ["year_int", "month", "AREA NAME", "LAT", "LON", "n_crimes"],
    "weapon_usage_per_year": ["year_int", "weapon_used", "n_crimes"],
    "context_risk_scores": ["AREA NAME", "time_slot", "place_type", "age_range", "sex_norm",
                            "n_crimes", "z_score", "risk_level", "crime_share_percent",
                            "risk_score_10"],
}
SCHEMAS["high_risk_contexts"] = SCHEMAS["context_risk_scores"]
TYPES = REFERENCE_RAW_TYPES


@pytest.fixture(scope="module")
def raw_csv(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "crime_raw")
    raw = (raw_frame(spark)
           .withColumn("Part 1-2", F.when(F.col("id").isin("E1", "E6"), "2").otherwise("1"))
           .withColumn("LAT", F.when(F.col("id") == "E7", None).otherwise(F.lit("34.05")))
           .withColumn("LON", F.lit("-118.24")))
    raw.coalesce(1).write.option("header", True).csv(path)
    return path


def _as_text(df):
    return sorted(tuple("" if v is None else (f"{float(v):.6f}" if isinstance(v, float) else str(v))
                        for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def lakes(spark, raw_csv, tmp_path_factory):
    out = {}
    for fmt in ("parquet", "csv"):
        base = str(tmp_path_factory.mktemp(f"lake_{fmt}"))
        run_batch(spark, raw_csv, base, REFERENCE_PROFILE, raw_types=TYPES, fmt=fmt)
        out[fmt] = f"{base}/analytics"
    return out


def test_reference_schemas(spark, lakes):
    for name in (*AGGREGATE_TABLES, *RISK_TABLES):
        assert read_result(spark, lakes["parquet"], name).columns == SCHEMAS[name], name
    totals = {r["AREA NAME"]: r["n_crimes_total"]
              for r in read_result(spark, lakes["parquet"], "total_by_area").collect()}
    assert totals == {"A": 2, "B": 7, None: 1}  # NULL area is its own group
    scores = read_result(spark, lakes["parquet"], "context_risk_scores")
    assert scores.agg(F.sum("n_crimes")).first()[0] == len(CONTEXT_IDS)


def test_csv_lake_gives_the_same_tables(spark, lakes):
    for name in (*AGGREGATE_TABLES, *RISK_TABLES):
        a = read_result(spark, lakes["parquet"], name)
        b = read_result(spark, lakes["csv"], name, fmt="csv", entity="AREA NAME")
        assert b.columns == a.columns, name
        assert _as_text(a) == _as_text(b), name
