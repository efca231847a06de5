"""Column resolution and guards (COL2, COL3, COL5, COL6, SRC4)."""

import pytest

from blotter.operators.columns import (
    AmbiguousColumnError,
    MissingColumnsError,
    find_col,
    has_columns,
    normalize_name,
    rename_if_present,
    require_columns,
    resolve_alias,
    resolve_profile,
    strip_column_names,
)
from blotter.profile import REFERENCE_PROFILE


def test_normalised_lookup(spark):
    df = spark.createDataFrame([], "`Vict Age` string, vict_age string, `AREA NAME` string")
    assert normalize_name("AREA NAME") == "areaname"
    assert find_col(df, "vict_age") == "vict_age"  # an exact name needs no guess
    with pytest.raises(AmbiguousColumnError):  # two columns answer to it
        find_col(df, "victage")
    assert find_col(df, "area_name") == "AREA NAME"
    assert find_col(df, "nothing") is None


def test_required_and_optional_columns(spark):
    df = spark.createDataFrame([], "a string, b int")
    require_columns(df, ["a", "b"])
    with pytest.raises(MissingColumnsError, match="missing columns"):
        require_columns(df, ["a", "c", None])
    assert has_columns(df, "a", "b") and not has_columns(df, "a", None)


def test_header_cleanup_and_renames(spark):
    df = spark.createDataFrame([("x", 1)], "` AREA NAME ` string, `Part 1-2` int")
    clean = strip_column_names(df)
    assert clean.columns == ["AREA NAME", "Part 1-2"]
    assert rename_if_present(clean, "Part 1-2", "part_1_2").columns == ["AREA NAME", "part_1_2"]
    assert rename_if_present(clean, "absent", "y").columns == clean.columns
    loose = spark.createDataFrame([], "area_name string")
    assert resolve_alias(loose, "AREA NAME").columns == ["AREA NAME"]


def test_roles_are_found_beside_the_derived_date(spark):
    df = spark.createDataFrame([], "`date occ` string, date_occ date, `area name` string, year int")
    prof = resolve_profile(df, REFERENCE_PROFILE)
    assert (prof.date_raw, prof.entity) == ("date occ", "area name")
