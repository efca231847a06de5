"""Sources and sinks: pruning, first-match columns, early exit, and the jobs as a program."""

import pytest

from blotter.lake_queries import SCANNED_YEAR, scan_one_year
from blotter.operators.columns import AmbiguousColumnError, MissingColumnsError, find_col, require_columns, resolve_alias, resolve_profile
from blotter.plans.jobs import run_clean, run_risk
from blotter.plans.run import arguments, main, run
from blotter.profile import ADAPTER_PROFILE as P
from blotter.sources.fixture import raw_incidents
from blotter.sources.zones import read_curated, read_result
from conftest import SF_SMALL


def test_one_year_reads_only_its_folder(spark, tmp_path, rows_read):
    path = run_clean(spark, raw_incidents(spark, SF_SMALL), str(tmp_path / "curated"), P)
    before = rows_read()
    totals = scan_one_year(spark, path).collect()
    read = rows_read() - before
    assert read == sum(r.n_crimes_total for r in totals) < read_curated(spark, path).count()
    plan = scan_one_year(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert f"= {SCANNED_YEAR})" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert scan_one_year(spark, path, 1900).collect() == []


def test_two_columns_for_one_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`AREA NAME` int, `area_name` int, x int")
    with pytest.raises(AmbiguousColumnError):
        find_col(df, "Area Name")
    assert find_col(df, "Area Name", several="first") == "AREA NAME"
    assert find_col(df, "area_name") == "area_name"  # an exact name is never in doubt
    assert resolve_alias(df, "AreaName", several="first").columns == ["AreaName", "area_name", "x"]
    assert resolve_profile(df, P.with_(entity="areaName"), several="first").entity == "AREA NAME"
    with pytest.raises(ValueError):
        find_col(df, "x", several="last")


def test_a_refusal_names_what_is_missing(spark):
    with pytest.raises(MissingColumnsError) as e:
        require_columns(spark.range(1), ["id", "a", None], "some page")
    assert e.value.what == "some page" and e.value.missing == ("a", None)


def test_risk_job_reads_nothing_when_both_tables_are_there(spark, tmp_path, rows_read):
    cur, res = str(tmp_path / "curated"), str(tmp_path / "analytics")
    run_clean(spark, raw_incidents(spark, SF_SMALL), cur, P)
    paths = run_risk(spark, cur, res, P)
    before = rows_read()
    assert run_risk(spark, str(tmp_path / "gone"), res, P) == paths
    assert rows_read() == before
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_risk(spark, str(tmp_path / "gone"), res, P, mode="overwrite")


HEADER = "AREA NAME,DATE OCC,TIME OCC,Part 1-2,Vict Age,Vict Sex,Premis Desc,Weapon Desc,LAT,LON\n"


def test_jobs_as_a_program(spark, tmp_path, capsys):
    raw, lake = tmp_path / "raw.csv", str(tmp_path / "lake")
    raw.write_text(HEADER + "".join(f"A,01/0{d}/2020 12:00:00 AM,1200,1,30,M,STREET,,34.05,-118.24\n" for d in (1, 1, 2)))
    assert main(["clean", "--lake", lake, "--raw", str(raw)]) == 0
    assert capsys.readouterr().out == f"curated\t{lake}/curated\n"
    assert main(["aggregate", "--lake", lake]) == 0 and "total_by_area\t" in capsys.readouterr().out
    assert set(run(spark, arguments(["risk", "--lake", lake]))) == {"context_risk_scores", "high_risk_contexts"}
    assert read_result(spark, f"{lake}/analytics", "total_by_area").first()["n_crimes_total"] == 3
    raw.write_text(HEADER + "A,01/03/2020 12:00:00 AM,1200,1,30,M,STREET,,34.05,-118.24\n")
    run(spark, arguments(["batch", "--lake", lake, "--raw", str(raw)]))
    assert read_result(spark, f"{lake}/analytics", "total_by_area").first()["n_crimes_total"] == 3  # kept, as it was there
    run(spark, arguments(["analytics", "--lake", lake, "--mode", "overwrite"]))
    assert read_result(spark, f"{lake}/analytics", "total_by_area").first()["n_crimes_total"] == 1


@pytest.mark.parametrize("argv", [[], ["clean", "--lake", "x"], ["batch", "--lake", "x"], ["dance", "--lake", "x"], ["risk"]])
def test_wrong_arguments_stop_the_program(argv):
    with pytest.raises(SystemExit):
        arguments(argv)


@pytest.mark.parametrize("name, parts", [("lake_contexts_by_what_is_there", {"score", "share", "z"}),
                                         ("lake_risk_of_a_removed_zone", {"context_risk_scores", "high_risk_contexts"})])
def test_stored_scores_are_computed_from_one_read_of_the_source(spark, tmp_path, rows_read, name, parts):
    from blotter.queries import queries
    rows = 20_000  # far more than the contexts that the stored tables hold
    spark.range(rows).selectExpr(
        "if(id % 5 = 0, id, 1) as l_orderkey", "1L as l_partkey", "1L as l_suppkey", "1 as l_linenumber",
        "cast(if(id % 5 = 0, id % 47, 20) as double) as l_quantity", "if(id % 2 = 0, 'A', 'N') as l_returnflag", "'F' as l_linestatus",
        "timestamp_ntz'1997-05-06 00:00:00' as l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    before = rows_read()
    found = queries()[name](spark, str(tmp_path)).collect()
    assert rows <= rows_read() - before < 2 * rows
    assert {r["ordered_by" if "ordered_by" in r else "table"] for r in found} == parts
