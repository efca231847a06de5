"""Named queries over the driver's test tables, one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. Incident queries read ``lineitem`` through the adapter view
(:mod:`blotter.sources.fixture`) and the clean operator; a few run the same
operators straight on ``events`` and ``orders`` to show they are generic.

Floating-point outputs are rounded to 6 decimals (the oracle SQL does the same):
mean, population std and shares may differ in the last bits between engines.
Thresholds are always compared on the unrounded values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from blotter import profile as P
from blotter.functions.classify import age_range, sex_norm, time_slot, victim_type
from blotter.functions.labels import context_label, month_name, percent_label
from blotter.functions.time import hour_from_hhmm, to_date_col, to_int, to_number, to_whole
from blotter.lake_queries import LAKE_QUERIES
from blotter.operators import aggregate as agg
from blotter.operators import derived as drv
from blotter.operators import explore as ex
from blotter.operators.clean import clean_incidents, curated_view
from blotter.operators.columns import resolve_profile
from blotter.operators.cube import daily_cube
from blotter.operators.risk import context_risk_scores, high_risk_contexts, score_counts
from blotter.profile import ADAPTER_PROFILE, IncidentProfile
from blotter.sources.fixture import raw_incidents
from blotter.sources.zones import read_table, union_tables

Query = Callable[[SparkSession, str], DataFrame]

PROF = ADAPTER_PROFILE
E = PROF.entity
D = PROF.date_out
Y = PROF.year_out
SEV = PROF.severity_col

#: Direct bindings on driver tables (no adapter).
EVENTS_PROFILE = IncidentProfile(entity="event_type", date_raw="ts", time_hhmm=None, severity=None,
                                 victim_age=None, victim_sex=None, premises=None, weapon=None,
                                 lat=None, lon=None, max_year=None, normalize_text=False)
ORDERS_PROFILE = IncidentProfile(entity="o_orderpriority", date_raw="o_orderdate", time_hhmm=None,
                                 severity="o_orderstatus", severity_out="o_orderstatus",
                                 victim_age=None, victim_sex=None, premises=None, weapon=None,
                                 lat=None, lon=None, max_year=None, normalize_text=False)

#: The same binding with the names spelled as a person might, and severity renamed.
LOOSE_ORDERS_PROFILE = ORDERS_PROFILE.with_(entity="O OrderPriority", date_raw="O ORDERDATE",
                                            severity="O_Order_Status", severity_out="order_status")

#: Example selections used by the exploration queries.
EXAMPLE_AGE_RANGES = ("18-29", "30-44")
HOTSPOT_TOP_K = 10
CHRONIC_TOP_K = 5


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating-point measure (presentation for cross-engine comparison); coordinates are keys."""
    dbl = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    dbl -= {PROF.lat, PROF.lon}
    if not dbl:
        return df
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in dbl else F.col(c)
                       for c in df.columns])


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean adapter incidents (cutoff 2000), severity under its output name."""
    return curated_view(clean_incidents(raw_incidents(spark, sf_dir), PROF), PROF)


def _scores(spark, sf_dir):
    return context_risk_scores(curated(spark, sf_dir), PROF)


def _high_risk(spark, sf_dir, sort=False):
    return high_risk_contexts(_scores(spark, sf_dir), PROF, sort=sort)


def _heat(spark, sf_dir):
    return agg.monthly_density(curated(spark, sf_dir), D, E, PROF.lat, PROF.lon, year_col=Y)


def _avg(grain, **kw):
    def q(spark, sf_dir):
        return agg.avg_count_per_bucket(curated(spark, sf_dir), E, D, grain, year_col=Y, **kw)
    return q


def _yearly(*by):
    def q(spark, sf_dir):
        return agg.yearly_counts(curated(spark, sf_dir), D, [c for c in by], year_col=Y)
    return q


def _classifier_counts(name, expr_fn):
    def q(spark, sf_dir):
        cur = curated(spark, sf_dir)
        return cur.groupBy(expr_fn().alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))
    return q


def _total(spark, sf_dir):
    return agg.total_by_entity(curated(spark, sf_dir), E)


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    # Clean job.
    q["clean_year_counts"] = lambda s, d: curated(s, d).groupBy(Y).agg(
        F.count(F.lit(1)).alias("n_rows"))

    # Averages per bucket, totals, top areas.
    q["avg_by_area_day"] = _avg("day")
    q["avg_by_area_week"] = _avg("week")
    q["avg_by_area_month"] = _avg("month")
    q["avg_by_area_week_iso"] = _avg("week", iso_year=True, name="avg_crimes_per_week_iso")
    q["avg_by_area_day_dense"] = lambda s, d: agg.dense_avg_count_per_bucket(curated(s, d), E, D, "day")
    q["avg_by_area_month_dense"] = lambda s, d: agg.dense_avg_count_per_bucket(
        curated(s, d), E, D, "month")
    q["avg_by_area_week_dense"] = lambda s, d: agg.dense_avg_count_per_bucket(
        curated(s, d), E, D, "week")
    q["total_by_area"] = _total
    q["top5_areas"] = lambda s, d: ex.top_entities(_total(s, d), E, "n_crimes_total", P.TOP_AREAS)
    q["avg_day_default_zones"] = lambda s, d: ex.first_k_rows(
        _avg("day")(s, d), E, P.DEFAULT_ZONES_AVERAGES).orderBy(F.col("avg_crimes_per_day").desc(), E)
    q["per_year_area_default_zones"] = lambda s, d: ex.filter_default_zones(
        _yearly(E)(s, d), E, P.DEFAULT_ZONES_EVOLUTION, measured="n_crimes").orderBy(E, "year_int")

    # Yearly counts.
    q["per_year"] = _yearly()
    q["per_year_area"] = _yearly(E)
    q["per_year_severity"] = _yearly(SEV)
    q["per_year_area_severity"] = _yearly(E, SEV)
    q["year_grouping_sets"] = lambda s, d: agg.yearly_grouping_sets(curated(s, d), D, E, SEV, year_col=Y)
    q["daily_cube"] = lambda s, d: daily_cube(curated(s, d), PROF)

    # Spatial density and weapons.
    q["heatmap_monthly"] = _heat
    q["heatmap_points_month"] = lambda s, d: ex.heatmap_points(
        _heat(s, d), E, PROF.lat, PROF.lon, computed=True)
    q["heatmap_point_count"] = lambda s, d: ex.heatmap_points(
        _heat(s, d), E, PROF.lat, PROF.lon, computed=True).agg(F.count(F.lit(1)).alias("n_points"))
    q["weapon_usage_per_year"] = lambda s, d: agg.weapon_usage_per_year(
        curated(s, d), D, PROF.weapon, year_col=Y)

    # Classifiers over every curated row.
    q["time_slot_counts"] = _classifier_counts(
        "time_slot", lambda: time_slot(hour_from_hhmm(PROF.time_hhmm)))
    q["age_range_counts"] = _classifier_counts("age_range", lambda: age_range(to_int(PROF.victim_age)))
    q["sex_norm_counts"] = _classifier_counts("sex_norm", lambda: sex_norm(PROF.victim_sex))
    q["victim_type_counts"] = _classifier_counts(
        "victim_type", lambda: victim_type(to_int(PROF.victim_age), F.col(PROF.victim_sex)))

    # Risk.
    q["context_risk_scores"] = _scores
    q["high_risk_contexts"] = lambda s, d: _high_risk(s, d, sort=True)
    q["high_risk_filtered"] = lambda s, d: ex.explore_high_risk(
        _high_risk(s, d), age_ranges=EXAMPLE_AGE_RANGES, entity=E, measured="n_crimes")
    q["high_risk_summary"] = lambda s, d: ex.risk_summary(
        ex.explore_high_risk(_high_risk(s, d), entity=E))
    q["high_risk_top20_labels"] = lambda s, d: ex.top_contexts_labelled(
        ex.explore_high_risk(_high_risk(s, d), entity=E), E, P.TOP_CONTEXTS)

    # Selector values.
    q["distinct_areas"] = lambda s, d: ex.distinct_sorted(_total(s, d), E)
    q["distinct_years"] = lambda s, d: ex.distinct_sorted(_heat(s, d), "year_int")
    q["month_names"] = lambda s, d: ex.distinct_sorted(_heat(s, d), "month").select(
        "month", month_name("month").alias("month_name"))
    q["latest_year"] = lambda s, d: _heat(s, d).agg(F.max("year_int").alias("latest_year"))

    # Derived answers.
    q["area_concentration"] = lambda s, d: drv.area_concentration(_total(s, d), E)
    q["year_over_year"] = lambda s, d: drv.year_over_year(_yearly()(s, d))
    q["area_vs_city_trend"] = lambda s, d: drv.area_vs_city_trend(_yearly(E)(s, d), E)
    q["severity_share"] = lambda s, d: drv.severity_share(_yearly(SEV)(s, d), SEV)
    q["chronic_areas"] = lambda s, d: drv.chronic_areas(
        agg.count_by(curated(s, d), [E, D], name="n"), E, D, CHRONIC_TOP_K)
    q["recurrent_hotspots"] = lambda s, d: drv.recurrent_hotspots(
        _heat(s, d), PROF.lat, PROF.lon, HOTSPOT_TOP_K)
    q["seasonality_index"] = lambda s, d: drv.seasonality_index(curated(s, d), E, D, year_col=Y)
    q["high_risk_by_age"] = lambda s, d: drv.high_risk_by(_high_risk(s, d), "age_range")
    q["high_risk_by_sex"] = lambda s, d: drv.high_risk_by(_high_risk(s, d), "sex_norm")

    # The same operators straight on driver tables.
    def events_clean(s, d):
        return clean_incidents(read_table(s, d, "events"), EVENTS_PROFILE)

    def orders_clean(s, d):
        return clean_incidents(read_table(s, d, "orders"), ORDERS_PROFILE)

    q["events_avg_per_day"] = lambda s, d: agg.avg_count_per_bucket(
        events_clean(s, d), "event_type", "date_occ", "day")
    q["events_avg_per_week"] = lambda s, d: agg.avg_count_per_bucket(
        events_clean(s, d), "event_type", "date_occ", "week")
    q["orders_per_year_priority"] = lambda s, d: agg.yearly_counts(
        orders_clean(s, d), "date_occ", ["o_orderpriority"])
    q["orders_per_year_status"] = lambda s, d: agg.yearly_counts(
        orders_clean(s, d), "date_occ", ["o_orderstatus"])
    q["orders_avg_per_month"] = lambda s, d: agg.avg_count_per_bucket(
        orders_clean(s, d), "o_orderpriority", "date_occ", "month")
    q["orders_context_scores"] = lambda s, d: score_counts(agg.yearly_counts(
        orders_clean(s, d), "date_occ", ["o_orderpriority", "o_orderstatus"]))

    # Selections, bindings and conversions that the incident queries do not reach.
    def by_status(s, d):
        return agg.yearly_counts(orders_clean(s, d), "date_occ", ["o_orderstatus"])

    def loosely_bound(s, d):
        orders = read_table(s, d, "orders")
        prof = resolve_profile(orders, LOOSE_ORDERS_PROFILE)
        return agg.yearly_counts(curated_view(clean_incidents(orders, prof), prof), prof.date_out,
                                 [prof.entity, prof.severity_out])

    def yearly_tables(s, d):
        return union_tables(agg.yearly_counts(orders_clean(s, d), "date_occ").withColumn("source", F.lit("orders")),
                            agg.yearly_counts(events_clean(s, d), "date_occ").withColumn("source", F.lit("events")))

    def iso_dates(s, d):
        text = read_table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
        return text.groupBy(to_date_col("day", StringType()).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))

    def brand_numbers(s, d):
        parts = read_table(s, d, "part").select("p_type", "p_name", F.substring("p_brand", 7, 9).alias("no"))
        return parts.groupBy("p_type").agg(F.avg(to_number("no")).alias("mean_no"), F.sum(to_whole("no")).alias("sum_no"),
                                           F.count(to_number("p_name")).alias("named_by_number"))

    q["orders_two_statuses"] = lambda s, d: ex.filter_in(by_status(s, d), "o_orderstatus", ["F", "O"])
    q["orders_no_status"] = lambda s, d: ex.filter_in(by_status(s, d), "o_orderstatus", [])
    q["orders_one_status"] = lambda s, d: ex.filter_equal(by_status(s, d), o_orderstatus="F")
    q["orders_loosely_bound"] = loosely_bound
    q["yearly_tables_union"] = yearly_tables
    q["orders_iso_dates"] = iso_dates
    q["brand_numbers"] = brand_numbers
    q["equal_counts_scores"] = lambda s, d: score_counts(agg.count_by(read_table(s, d, "nation"), ["n_regionkey"]))
    q["orders_share_labels"] = lambda s, d: drv.severity_share(by_status(s, d), "o_orderstatus").withColumn(
        "share_label", percent_label("share_percent"))
    q["long_place_labels"] = lambda s, d: read_table(s, d, "documents").select(
        "doc_id", context_label("lang", "source", "text").alias("context"))
    return q


def queries() -> dict[str, Query]:
    """All queries, with floating-point outputs rounded to 6 decimals."""
    def rounded(fn: Query) -> Query:
        return lambda spark, sf_dir: round_doubles(fn(spark, sf_dir))
    return {name: rounded(fn) for name, fn in (_queries() | LAKE_QUERIES).items()}
