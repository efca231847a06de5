"""Scans of the three lake zones (RAW text, CURATED and ANALYTICS Parquet)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructType

from blotter.functions.time import to_date_col, to_int
from blotter.operators.columns import normalize_name, resolve_alias, strip_column_names
from blotter.results import result_schema


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table ``{base}/{name}.parquet`` (the driver's test layout)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_raw_csv(spark: SparkSession, path: str, *, types: Mapping[str, DataType] | None = None,
                 schema: StructType | None = None) -> DataFrame:
    """Raw incident CSV with a header.

    No ``inferSchema``: inference is a full extra pass over the file. Either an
    explicit ``schema`` is given, or every column is read as text and the columns
    in ``types`` are converted by their normalised name (a bad value becomes
    NULL; ANSI mode never aborts the job). Column names are stripped of blanks.
    The header of every file must agree with the first one's (or the schema's):
    a file with other or reordered columns stops the read instead of filling
    columns with another one's values.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    df = strip_column_names((reader.schema(schema) if schema is not None else reader).csv(path))
    return with_types(df, types or {})


def with_types(df: DataFrame, types: Mapping[str, DataType]) -> DataFrame:
    """Text columns that ``types`` names (by normalised name) converted; bad values become NULL."""
    by_name = {normalize_name(c): t for c, t in types.items()}
    made = {}
    for f in df.schema.fields:
        kind = by_name.get(normalize_name(f.name))
        if kind is not None and isinstance(f.dataType, StringType):
            made[f.name] = to_int(f.name) if isinstance(kind, IntegerType) else F.col(f.name).try_cast(kind)
    return df.withColumns(made) if made else df


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, even as an empty folder (no Spark job)."""
    try:
        spark.read.text(path).schema
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return False
        raise
    return True


def read_curated(spark: SparkSession, path: str, *, fmt: str = "parquet",
                 date_col: str = "date_occ") -> DataFrame:
    """Curated incidents; the ``year`` partition column is discovered from the paths.

    A filter on ``year`` prunes whole directories (``PartitionFilters`` in the scan).
    ``fmt="csv"`` reads a curated zone written as CSV with a header (every
    column is text then, as in the reference's lake); the date column is turned
    back into a date with ``try_to_date`` (bad text -> NULL).
    """
    if fmt == "parquet":
        return spark.read.option("basePath", path).parquet(path)
    df = strip_column_names(spark.read.option("header", True).option("basePath", path)
                            .format(fmt).load(path))
    if date_col in df.columns:
        df = df.withColumn(date_col, to_date_col(date_col, StringType()))
    return df


def union_tables(*tables: DataFrame) -> DataFrame:
    """Stack tables with the same columns, matched by name (parts of one result)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def read_result(spark: SparkSession, base: str, name: str, *, schema: StructType | None = None,
                fmt: str = "parquet", entity: str | None = None) -> DataFrame:
    """One ANALYTICS result table; a missing or empty one gives an empty frame of ``schema``.

    All part files of the directory are read as one table. Column names are
    stripped and, when ``entity`` is given, a loosely matching column is renamed
    to it (``area name`` -> ``AREA NAME``). CSV tables are read as text and their
    columns converted by name to the types of ``schema``, which defaults to the
    published table's (:mod:`blotter.results`); columns it does not name stay
    text. Types are never guessed, so ``01`` stays ``01``.
    """
    schema = schema or result_schema(name, **({"entity": entity} if entity else {}))
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    try:
        df = reader.format(fmt).load(f"{base.rstrip('/')}/{name}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "UNABLE_TO_INFER_SCHEMA" not in str(exc):
            raise
        return spark.createDataFrame([], schema or StructType([]))
    if not df.columns:
        return spark.createDataFrame([], schema or StructType([]))
    df = strip_column_names(df)
    df = resolve_alias(df, entity) if entity else df
    if fmt == "csv" and schema is not None:
        kinds = {f.name: f.dataType for f in schema.fields}
        df = df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`")
                         for c in df.columns])
    return df
