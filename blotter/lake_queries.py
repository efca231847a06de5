"""Named queries that write a lake inside the shared folder and read it back.

They show sources and sinks on the driver's tables: raw CSV in, partitioned and
published tables out, and what the readers make of files that are absent, empty,
in several parts, or spelled another way. Every call writes to a folder of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from blotter.operators import aggregate as agg
from blotter.operators.clean import clean_incidents, curated_view
from blotter.operators.columns import MissingColumnsError, resolve_alias
from blotter.operators.risk import context_risk_scores, high_risk_contexts
from blotter.plans import dashboard as dash
from blotter.plans.jobs import AGGREGATE_TABLES, RISK_TABLES, run_aggregates, run_analytics, run_clean, run_risk
from blotter.profile import ADAPTER_PROFILE as PROF
from blotter.results import result_schema
from blotter.session import shared_folder
from blotter.sinks.writers import write_curated, write_result
from blotter.sources.fixture import raw_incidents
from blotter.sources.zones import read_curated, read_raw_csv, read_result, read_table, table_exists

E, Y = PROF.entity, PROF.year_out
#: Years of the second write of ``lake_partition_overwrite`` and of the first run of ``lake_skip_present``.
REWRITTEN_YEARS = (1996, 1998)
EARLIER_YEAR = 1997
SCANNED_YEAR = 1998


def _curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_incidents(raw_incidents(spark, sf_dir), PROF)


def _rows() -> F.Column:
    return F.count(F.lit(1))


def lake_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW: a CSV export with a header, quoted commas and bad numbers, read by name with types."""
    folder = shared_folder(spark, "raw-csv")
    raw = raw_incidents(spark, sf_dir)
    place = F.concat(F.col(E), F.lit(', "'), F.coalesce("premis_desc", F.lit("?")), F.lit('"'))
    text = raw.select(F.coalesce(F.col("lat").cast("string"), F.lit("n/a")).alias(" Lat "),
                      F.when(F.col("time_occ") == 2400, "24h00").otherwise(F.col("time_occ").cast("string")).alias("Time_Occ"),
                      place.alias("PLACE"), F.col("vict_age").alias("Vict Age"), F.col("part_1_2").alias("Part 1 2"))
    text.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    types = {"LAT": DoubleType(), "TIME OCC": IntegerType(), "vict_age": IntegerType(), "part_1_2": IntegerType()}
    typed = read_raw_csv(spark, folder, types=types)
    cents = F.round(F.col("Lat") * 100).cast("long")
    return typed.groupBy(F.col("PLACE").alias("place"), F.col("`Part 1 2`").alias("part")).agg(
        _rows().alias("n_rows"), F.count("Time_Occ").alias("n_times"), F.sum("Time_Occ").alias("sum_times"),
        F.count("Lat").alias("n_lat"), F.sum(cents).alias("sum_lat_cents"), F.sum("Vict Age").alias("sum_ages"))


def lake_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CURATED written twice: the second write replaces the zone, or only its own years."""
    curated = _curated(spark, sf_dir)
    second = curated.filter(F.col(Y).isin(*REWRITTEN_YEARS) & (F.col("part_1_2") == 1))
    out = None
    for rule in ("overwrite", "years"):
        path = shared_folder(spark, f"curated-{rule}")
        write_curated(curated, path)
        write_curated(second, path, mode=rule)
        counts = read_curated(spark, path).groupBy(Y).agg(_rows().alias("n_rows")).withColumn("rule", F.lit(rule))
        out = counts if out is None else out.unionByName(counts)
    return out


def scan_one_year(spark: SparkSession, path: str, year: int = SCANNED_YEAR) -> DataFrame:
    """Totals of one year of a curated zone: the year prunes the folders that are read."""
    return agg.total_by_entity(read_curated(spark, path).filter(F.col(Y) == year), E)


def lake_curated_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_clean(spark, raw_incidents(spark, sf_dir), shared_folder(spark, "curated"), PROF)
    return scan_one_year(spark, path)


def lake_skip_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run over more data keeps the table of the first run and adds the absent ones."""
    lake = shared_folder(spark, "lake")
    raw, results = raw_incidents(spark, sf_dir), f"{lake}/analytics"
    earlier = PROF.with_(max_year=EARLIER_YEAR)
    first = curated_view(clean_incidents(raw, earlier), earlier)
    write_result(agg.total_by_entity(first, E), results, "total_by_area")
    run_clean(spark, raw, f"{lake}/curated", PROF)
    run_aggregates(spark, f"{lake}/curated", results, PROF)
    kept = read_result(spark, results, "total_by_area", entity=E)
    added = read_result(spark, results, "crimes_per_year_area", entity=E)
    return (kept.select(F.lit("total_by_area").alias("table"), E, F.col("n_crimes_total").alias("n"))
            .unionByName(added.groupBy(E).agg(F.sum("n_crimes").alias("n")).withColumn("table", F.lit("crimes_per_year_area"))))


def _summary(spark: SparkSession, results: str, names) -> DataFrame:
    """Rows and total of each result table that is there; averages count in millionths."""
    out = None
    for name in names:
        table = read_result(spark, results, name, entity=E)
        measure = next(c for c in table.columns if c.startswith(("avg_", "n_crimes")))
        total = F.sum(F.round(F.col(measure) * (1_000_000 if measure.startswith("avg_") else 1)).cast("long"))
        row = table.agg(_rows().alias("n_rows"), F.coalesce(total, F.lit(0)).alias("total")).withColumn("table", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def lake_twelve_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables, written as concurrent jobs from one shared count table."""
    lake = shared_folder(spark, "lake")
    run_clean(spark, raw_incidents(spark, sf_dir), f"{lake}/curated", PROF)
    run_analytics(spark, f"{lake}/curated", f"{lake}/analytics", PROF)
    return _summary(spark, f"{lake}/analytics", (*AGGREGATE_TABLES, *RISK_TABLES))


def lake_result_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result tables in two writes, written without rows, and absent: rows and types under one schema."""
    results = shared_folder(spark, "results")
    curated = curated_view(_curated(spark, sf_dir), PROF)
    per_area = agg.yearly_counts(curated, PROF.date_out, [E], year_col=Y)
    write_result(per_area.filter(F.col("year_int") <= EARLIER_YEAR).repartition(3, E), results, "crimes_per_year_area")
    write_result(per_area.filter(F.col("year_int") > EARLIER_YEAR), results, "crimes_per_year_area", mode="append")
    write_result(agg.total_by_entity(curated, E).limit(0), results, "total_by_area")
    out = None
    for name in ("crimes_per_year_area", "total_by_area", "weapon_usage_per_year"):
        table = read_result(spark, results, name, entity=E)
        kinds = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in table.schema.fields]
        rows = (table.agg(_rows().alias("n_rows")).select(F.lit(name).alias("table"), "n_rows", F.explode(F.array(*kinds)).alias("f"))
                .select("table", "n_rows", "f.column", "f.type"))
        out = rows if out is None else out.unionByName(rows)
    return out


def lake_header_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables whose entity column is spelled another way, as CSV and as Parquet."""
    results = shared_folder(spark, "results")
    totals = agg.total_by_entity(curated_view(_curated(spark, sf_dir), PROF), E)
    out = None
    for fmt, spelled in (("csv", "  Area Name "), ("parquet", "AREA NAME "), ("parquet", "areaname")):
        base = f"{results}/{fmt}-{spelled.strip().replace(' ', '-')}"
        write_result(totals.withColumnRenamed(E, spelled).withColumnRenamed("n_crimes_total", " n_crimes_total"),
                     base, "total_by_area", fmt=fmt)
        table = read_result(spark, base, "total_by_area", fmt=fmt, entity=E)
        rows = table.select(F.lit(fmt).alias("fmt"), F.lit(spelled.strip()).alias("spelled"), E, F.col("n_crimes_total").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    return out


def lake_first_of_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns answer to one name: with ``several="first"`` the leftmost one counts."""
    orders = read_table(spark, sf_dir, "orders")
    double = orders.select(F.col("o_orderstatus").alias("Order Status"), F.col("o_orderpriority").alias("ORDER_STATUS"))
    named = resolve_alias(double, "order status", several="first")
    return named.groupBy(F.col("order status").alias("order_status")).agg(_rows().alias("n_rows"))


def lake_optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch whose files have no severity, weapon and coordinates gives exactly the remaining tables."""
    lake = shared_folder(spark, "lake")
    raw = raw_incidents(spark, sf_dir).drop("part_1_2", "weapon_desc", "lat")
    run_clean(spark, raw, f"{lake}/curated", PROF)
    run_analytics(spark, f"{lake}/curated", f"{lake}/analytics", PROF)
    there = [n for n in (*AGGREGATE_TABLES, *RISK_TABLES) if table_exists(spark, f"{lake}/analytics/{n}")]
    return _summary(spark, f"{lake}/analytics", there)


def lake_contexts_by_what_is_there(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenario page's top contexts of stored tables with a score, with a share only, and with neither.

    The incidents are read for the first table only; the others are that stored table without some columns.
    """
    scores = high_risk_contexts(context_risk_scores(curated_view(_curated(spark, sf_dir), PROF), PROF), PROF, sort=False)
    out = None
    for ordered_by, absent in (("score", []), ("share", ["risk_score_10"]), ("z", ["risk_score_10", "crime_share_percent"])):
        results = shared_folder(spark, "results")
        write_result(scores.drop(*absent), results, "high_risk_contexts")
        if not absent:
            scores = read_result(spark, results, "high_risk_contexts", schema=scores.schema)
        top = dash.high_risk_page(spark, results, entity=E)["top"]
        rows = top.select(F.lit(ordered_by).alias("ordered_by"), "context", "age_range", "sex_norm", "n_crimes")
        out = rows if out is None else out.unionByName(rows)
    return out


def lake_page_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which column each dashboard page refuses to be without, tried on stored tables that lack one."""
    curated = curated_view(_curated(spark, sf_dir), PROF)
    lake = shared_folder(spark, "lake")
    write_result(agg.yearly_counts(curated, PROF.date_out, [E, "part_1_2"], year_col=Y), lake, "counts")
    counts = read_result(spark, lake, "counts")
    pages: list[tuple[str, Callable]] = [
        ("avg_by_area_day", lambda base: dash.zone_averages(spark, base, entity=E)),
        ("total_by_area", lambda base: dash.top_zones(spark, base, entity=E)),
        ("crimes_per_year_area", lambda base: dash.yearly_evolution(spark, base, entity=E)),
        ("crimes_per_year_area_severity", lambda base: dash.yearly_evolution(spark, base, by_severity=True, entity=E)),
        ("crime_heatmap_monthly", lambda base: dash.heatmap_month(spark, base, entity=E, lat=PROF.lat, lon=PROF.lon)),
        ("weapon_usage_per_year", lambda base: dash.weapon_series(spark, base)),
        ("high_risk_contexts", lambda base: dash.high_risk_page(spark, base, entity=E))]
    refused = []
    for name, page in pages:
        schema = result_schema(name, entity=E, lat=PROF.lat, lon=PROF.lon)
        for absent in schema.fieldNames():
            base = f"{lake}/{name}-without-{absent}"
            # the yearly counts, with every column of the page's table but one
            stored = counts.select(*[(F.col(f.name) if f.name in counts.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                     for f in schema.fields if f.name != absent])
            write_result(stored, base, name)
            try:
                page(base)
            except MissingColumnsError as e:
                rows = read_result(spark, base, name, schema=schema).agg(_rows().alias("n_rows"))
                refused += [rows.select(F.lit(name).alias("table"), F.lit(e.what).alias("page"), F.lit(c).alias("missing"), "n_rows")
                            for c in e.missing]
    out = refused[0]
    for rows in refused[1:]:
        out = out.unionByName(rows)
    return out


def lake_risk_of_a_removed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk job with both tables there leaves them and reads nothing: CURATED may be gone."""
    results = shared_folder(spark, "results")
    scores = context_risk_scores(curated_view(_curated(spark, sf_dir), PROF), PROF)
    write_result(scores, results, "context_risk_scores")
    stored = read_result(spark, results, "context_risk_scores", schema=scores.schema)
    write_result(high_risk_contexts(stored, PROF, sort=False), results, "high_risk_contexts")
    run_risk(spark, f"{results}/no-such-zone", results, PROF)
    return _summary(spark, results, RISK_TABLES)


LAKE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        lake_raw_csv, lake_partition_overwrite, lake_curated_one_year, lake_skip_present, lake_twelve_tables, lake_result_scan,
        lake_header_cleanup, lake_first_of_two_columns, lake_optional_columns, lake_contexts_by_what_is_there,
        lake_page_refusals, lake_risk_of_a_removed_zone)
}
