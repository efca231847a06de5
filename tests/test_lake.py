"""The lake stays truthful: full reloads, fresh intermediates, fixed types, file counts, pages of absent tables."""

import os

import pytest
from pyspark.sql import functions as F

from blotter.functions.time import to_int, to_whole
from blotter.operators.clean import clean_incidents
from blotter.operators.columns import MissingColumnsError
from blotter.operators.ranking import top_k_counts_per_group
from blotter.plans import dashboard as dash
from blotter.plans.jobs import RISK_TABLES, run_aggregates, run_analytics, run_batch, run_clean, run_risk
from blotter.profile import ADAPTER_PROFILE as P
from blotter.profile import REFERENCE_PROFILE, IncidentProfile
from blotter.results import result_schema
from blotter.sinks.writers import write_curated
from blotter.sources.fixture import raw_incidents
from blotter.sources.zones import read_curated, read_raw_csv, read_result
from conftest import SF_SMALL


def _years(spark, path):
    return {r["year"]: r["count"] for r in read_curated(spark, path).groupBy("year").count().collect()}


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_full_reload_leaves_exactly_the_new_years(spark, tmp_path, session_mode):
    raw, cur = raw_incidents(spark, SF_SMALL), str(tmp_path / "curated")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        run_clean(spark, raw, cur, P)
        before = _years(spark, cur)
        assert max(before) == 2000
        run_clean(spark, raw, cur, P.with_(max_year=1997))
        assert _years(spark, cur) == {y: n for y, n in before.items() if y <= 1997}
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_years_mode_replaces_only_the_years_present(spark, tmp_path):
    raw, cur = raw_incidents(spark, SF_SMALL), str(tmp_path / "curated")
    run_clean(spark, raw, cur, P)
    before = _years(spark, cur)
    only_1996 = raw.filter(F.col("date_occ_raw").endswith("/1996 12:00:00 AM"))
    run_clean(spark, only_1996.limit(10), cur, P, mode="years")
    assert _years(spark, cur) == before | {1996: 10}


@pytest.mark.parametrize("job", ["cube", "per_result", "shared"])
def test_a_deleted_result_is_recomputed_from_the_current_curated(spark, tmp_path, job):
    import shutil

    raw, base = raw_incidents(spark, SF_SMALL), str(tmp_path)
    cur, ana = f"{base}/curated", f"{base}/analytics"

    def run():
        if job == "shared":
            run_analytics(spark, cur, ana, P)
        else:
            run_aggregates(spark, cur, ana, P, strategy=job)
            run_risk(spark, cur, ana, P)

    run_clean(spark, raw, cur, P.with_(max_year=1996))
    run()
    stale = read_result(spark, ana, "crimes_per_year").agg(F.sum("n_crimes")).first()[0]
    run_clean(spark, raw, cur, P)
    for name in ("total_by_area", "high_risk_contexts"):
        shutil.rmtree(f"{ana}/{name}")
    run()
    assert read_result(spark, ana, "total_by_area").agg(F.sum("n_crimes_total")).first()[0] == 5156 > stale
    fresh = str(tmp_path / "fresh")
    run_risk(spark, cur, fresh, P)
    rows = [sorted(r["n_crimes"] for r in read_result(spark, b, "high_risk_contexts").collect()) for b in (ana, fresh)]
    assert rows[0] == rows[1]
    # what was not deleted is left as it was
    assert read_result(spark, ana, "crimes_per_year").agg(F.sum("n_crimes")).first()[0] == stale


def test_many_splits_do_not_multiply_files(spark, tmp_path):
    df = clean_incidents(raw_incidents(spark, SF_SMALL).repartition(40), P)
    write_curated(df, str(tmp_path / "even"))
    write_curated(df, str(tmp_path / "narrow"), rebalance=False)

    def files(d):
        return sum(n.endswith(".parquet") for _, _, names in os.walk(d) for n in names)

    assert files(tmp_path / "narrow") > 200  # splits x years
    assert files(tmp_path / "even") <= 6  # years x (bytes per year / target size)


def test_default_batch_types_the_raw_export(spark, tmp_path):
    raw = str(tmp_path / "raw.csv")
    with open(raw, "w") as f:
        f.write("AREA NAME,DATE OCC,TIME OCC,Part 1-2,Vict Age,Vict Sex,Premis Desc,Weapon Desc,LAT,LON\n"
                "01,01/08/2020 12:00:00 AM,1200.0,1,30.0,M,STREET,,34.0500,-118.2400\n"
                "01,01/09/2020 12:00:00 AM,1200,1,30,M,STREET,,34.05,-118.24\n"
                "01,01/09/2024 12:00:00 AM,1200,1,30,M,STREET,,34.05,-118.24\n")
    base = str(tmp_path / "lake")
    run_batch(spark, raw, base, REFERENCE_PROFILE.with_(min_context_count=1, min_z_score=-9.0), fmt="csv")
    cur = read_curated(spark, f"{base}/curated", fmt="csv")
    assert cur.count() == 2  # this profile ends with 2023
    heat = read_result(spark, f"{base}/analytics", "crime_heatmap_monthly", fmt="csv").collect()
    assert [(r["AREA NAME"], r["LAT"], r["LON"], r["n_crimes"]) for r in heat] == [("01", 34.05, -118.24, 2)]
    risk = read_result(spark, f"{base}/analytics", "high_risk_contexts", fmt="csv").collect()
    assert [(r["AREA NAME"], r["age_range"], r["time_slot"], r["n_crimes"]) for r in risk] == [
        ("01", "30-44", "Apres-midi (12-17)", 2)]
    assert IncidentProfile().max_year is None


def test_whole_numbers_from_text(spark):
    df = spark.createDataFrame([("30.0",), ("1200.0",), (" 7 ",), ("-3.9",), ("x",), (None,), ("3e9",), ("NaN",)], "t string")
    assert [r[0] for r in df.select(to_int("t")).collect()] == [30, 1200, 7, -3, None, None, None, None]
    assert spark.createDataFrame([("3000000000",)], "t string").select(to_whole("t")).first()[0] == 3_000_000_000


def test_a_reordered_raw_file_is_refused(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("AREA NAME,DATE OCC\nA,x\n")
    (raw / "b.csv").write_text("DATE OCC,AREA NAME\nx,A\n")
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        read_raw_csv(spark, str(raw)).collect()


PAGES = {
    "averages": lambda s, b: {"t": dash.zone_averages(s, b)}, "top": lambda s, b: {"t": dash.top_zones(s, b)},
    "evolution": lambda s, b: dash.yearly_evolution(s, b),
    "severity": lambda s, b: dash.yearly_evolution(s, b, by_severity=True),
    "map": lambda s, b: dash.heatmap_month(s, b), "weapons": lambda s, b: {"t": dash.weapon_series(s, b)},
    "scenarios": lambda s, b: dash.high_risk_page(s, b)}


@pytest.mark.parametrize("page", sorted(PAGES))
def test_pages_of_absent_tables_are_empty(spark, tmp_path, page):
    for name, df in PAGES[page](spark, str(tmp_path)).items():
        rows = df.collect()
        assert df.columns
        assert rows == [] or name in ("n_points", "summary") and len(rows) == 1 and rows[0][0] == 0, name


def test_pages_name_a_missing_column(spark, tmp_path):
    spark.createDataFrame([("A", 1.0)], "`AREA NAME` string, other double").write.parquet(f"{tmp_path}/avg_by_area_day")
    with pytest.raises(MissingColumnsError, match="avg_crimes_per_day"):
        dash.zone_averages(spark, str(tmp_path))


def test_map_choices_follow_year_and_month(spark, tmp_path):
    rows = [(2020, 5, "A", 1.0, 2.0, 3), (2021, 7, "B", 1.0, 2.0, 4), (2021, 3, "C", 5.0, 6.0, 1), (2021, 3, "D", 5.0, 6.0, 1)]
    spark.createDataFrame(rows, result_schema("crime_heatmap_monthly")).write.parquet(f"{tmp_path}/crime_heatmap_monthly")
    page = dash.heatmap_month(spark, str(tmp_path))
    assert [r["month"] for r in page["months"].collect()] == [3, 7]
    assert [r[0] for r in page["zone_choices"].collect()] == ["C", "D"]
    page = dash.heatmap_month(spark, str(tmp_path), year=2020)
    assert [r["month"] for r in page["months"].collect()] == [5]
    assert [r[0] for r in page["zone_choices"].collect()] == ["A"]


def test_scenario_page_choices_and_score_chain(spark, tmp_path):
    keys = "`AREA NAME` string, time_slot string, place_type string, age_range string, sex_norm string, n_crimes long, "
    rows = [("B", "s", "p", "18-29", "M", 60, 2.0, "Eleve", 5.0, 10.0), ("A", "s", "p", "18-29", "F", 60, 2.0, "Eleve", 9.0, 10.0),
            ("C", "s", "p", "30-44", "M", 60, 3.0, "Tres eleve", 1.0, 10.0)]
    full = spark.createDataFrame(rows, keys + "z_score double, risk_level string, crime_share_percent double, risk_score_10 double")
    order = {}
    for name, drop in (("score", []), ("share", ["risk_score_10"]), ("z", ["risk_score_10", "crime_share_percent"])):
        base = str(tmp_path / name)
        full.drop(*drop).write.parquet(f"{base}/high_risk_contexts")
        page = dash.high_risk_page(spark, base)
        order[name] = [r["AREA NAME"] for r in page["contexts"].collect()]
        assert [r["AREA NAME"] for r in page["top"].collect()] == order[name]
    assert order == {"score": ["C", "A", "B"], "share": ["A", "B", "C"], "z": ["C", "A", "B"]}  # ties by area
    assert [r[0] for r in page["sex_choices"].collect()] == ["F", "M"]
    assert [r[0] for r in page["age_range_choices"].collect()] == ["18-29", "30-44"]


def test_top_counts_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, "a", 5), (None, "b", 3), ("X", "c", 1)], "g string, k string, n long")
    for few in (False, True):
        got = sorted(r["k"] for r in top_k_counts_per_group(df, ["g"], "n", 1, few_groups=few).collect())
        assert got == ["a", "c"]


ONE_READ = ("avg_by_area_day_dense", "avg_by_area_week_dense", "avg_by_area_month_dense", "avg_day_default_zones",
            "per_year_area_default_zones", "heatmap_points_month", "heatmap_point_count", "high_risk_filtered",
            "area_vs_city_trend", "chronic_areas", "recurrent_hotspots", "high_risk_summary")


@pytest.mark.parametrize("name", ONE_READ)
def test_one_read_of_the_source(spark, name, rows_read):
    from blotter.queries import queries
    before = rows_read()
    queries()[name](spark, SF_SMALL).collect()
    assert rows_read() - before == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
