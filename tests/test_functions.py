"""Clean operator and classifiers on the edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from blotter import profile as P
from blotter.functions import (
    age_range,
    cut,
    hour_from_hhmm,
    month_name,
    parse_timestamp,
    risk_level,
    sex_norm,
    time_slot,
    to_int,
    victim_type,
    weapon_used,
)
from blotter.functions.labels import context_label
from blotter.operators.clean import clean_incidents
from edge_rows import EXPECTED, PROFILE, raw_frame


def _classified(spark):
    cur = clean_incidents(raw_frame(spark), PROFILE)
    return cur.select(
        "id", "date_occ", "year",
        time_slot(hour_from_hhmm("TIME OCC")).alias("slot"),
        age_range(to_int("Vict Age")).alias("age"),
        sex_norm("Vict Sex").alias("sex"),
        victim_type(to_int("Vict Age"), F.col("Vict Sex")).alias("victim"),
        weapon_used("Weapon Desc").alias("weapon"),
    )


def test_clean_keeps_valid_dates_up_to_cutoff(spark):
    rows = {r["id"]: r for r in _classified(spark).collect()}
    assert set(rows) == set(EXPECTED)
    assert rows["E1"]["date_occ"] == dt.date(2020, 1, 8)
    assert rows["E2"]["year"] == 2018


def test_classifiers_match_expected_labels(spark):
    got = {r["id"]: (r["slot"], r["age"], r["sex"], r["victim"], r["weapon"])
           for r in _classified(spark).collect()}
    assert got == EXPECTED


def test_clean_output_columns_and_types(spark):
    cur = clean_incidents(raw_frame(spark), PROFILE)
    types = dict(cur.dtypes)
    assert types["date_occ_ts"] == "timestamp_ntz"
    assert types["date_occ"] == "date"
    assert types["year"] == "int"
    assert cur.columns[:8] == raw_frame(spark).columns


def test_text_normalisation_trims_and_nulls_blanks(spark):
    cur = clean_incidents(raw_frame(spark), PROFILE)
    w = {r["id"]: r["Weapon Desc"] for r in cur.select("id", "Weapon Desc").collect()}
    assert w["E2"] is None and w["E14"] is None
    assert w["E6"] == "verbal threat" and w["E7"] == "knife"
    raw = {r["id"]: r["Weapon Desc"] for r in
           clean_incidents(raw_frame(spark), PROFILE.with_(normalize_text=False))
           .select("id", "Weapon Desc").collect()}
    assert raw["E2"] == "  " and raw["E14"] == ""


def test_strict_date_pattern(spark):
    df = spark.createDataFrame(
        [("01/08/2020 01:00:00 pm",), ("01/08/2020 13:00:00 PM",), ("1/8/2020 12:00:00 AM",),
         ("01/08/2020 12:00:00 AM",), ("garbage",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t", P.RAW_DATE_FORMAT)).collect()]
    assert got == [dt.datetime(2020, 1, 8, 13, 0), None, None, dt.datetime(2020, 1, 8, 0, 0),
                   None, None]


def test_cut_edges_and_nulls(spark):
    df = spark.createDataFrame([(x,) for x in (-1, 0, 5, 6, 23, 24, None)], "h int")
    got = [r[0] for r in df.select(cut("h", (0, 6, 24), ("a", "b"), "z")).collect()]
    assert got == ["z", "a", "a", "b", "b", "z", "z"]


def test_risk_levels(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 1.999, 2.0, 2.5, 3.0, 7.0, None)], "z double")
    got = [r[0] for r in df.select(risk_level("z")).collect()]
    assert got == ["Normal", "Normal", "Eleve", "Eleve", "Tres eleve", "Tres eleve", "Normal"]


def test_age_range_on_fractional_and_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 17.0, 18.0, 29.0, 30.0, 44.0, 45.0, 64.0,
                                                65.0, 0.0, -3.0)], "a double")
    got = [r[0] for r in df.select(age_range("a")).collect()]
    assert got == ["0-17", "0-17", "18-29", "18-29", "30-44", "30-44", "45-64", "45-64", "65+",
                   "Inconnu", "Inconnu"]


def test_sex_norm_and_victim(spark):
    df = spark.createDataFrame([(None, None), ("M", None), ("F", 0), ("X", 5), ("X", None)],
                               "s string, a int")
    rows = df.select(sex_norm("s"), victim_type("a", F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [("Inconnu", "NonHumain"), ("M", "Humain"),
                                        ("F", "Humain"), ("Autre", "Humain"),
                                        ("Autre", "NonHumain")]


def test_month_names_and_unknown_month(spark):
    df = spark.createDataFrame([(m,) for m in (1, 2, 8, 12, 13, None)], "m int")
    got = [r[0] for r in df.select(month_name("m")).collect()]
    assert got == ["Janvier", "Février", "Août", "Décembre", "13", None]


def test_context_label_truncates_place_and_propagates_null(spark):
    df = spark.createDataFrame([("A", "Nuit (0-5)", "X" * 30), ("A", "Nuit (0-5)", None)],
                               "a string, s string, p string")
    got = [r[0] for r in df.select(context_label("a", "s", "p")).collect()]
    assert got == ["A | Nuit (0-5) | " + "X" * 25 + "...", None]


def test_hour_of_hhmm_is_floor(spark):
    df = spark.createDataFrame([("0130",), ("59",), ("2400",), ("x",)], "t string")
    got = [r[0] for r in df.select(hour_from_hhmm("t")).collect()]
    assert got == [1, 0, 24, None]


def test_percent_label(spark):
    from blotter.functions import percent_label
    df = spark.createDataFrame([(1.338973,), (1234.5,), (None,)], "x double")
    assert [r[0] for r in df.select(percent_label("x")).collect()] == ["1.34 %", "1234.50 %", None]
