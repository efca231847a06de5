"""DuckDB SQL for the queries of :mod:`blotter.lake_queries`."""

from __future__ import annotations

from blotter.oracle import _WEAPON, _with

_CONTEXT = "area_name || ' | ' || time_slot || ' | ' || substring(place_type, 1, 25) || '...' AS context"
_KEYS = "area_name, time_slot, place_type, age_range, sex_norm"


def _sum(name: str, rows: str, total: str) -> str:
    return f"SELECT '{name}' AS \"table\", count(*) AS n_rows, CAST(coalesce(sum({total}), 0) AS BIGINT) AS total FROM {rows}"


def _summaries(*names: str) -> str:
    def counted(keys: str) -> str:
        return f"(SELECT {keys}, count(*) AS n FROM curated GROUP BY ALL)"
    rows = {
        **{f"avg_by_area_{k}": (cte, f"round(avg_crimes_per_{k} * 1000000)") for k, cte in (("day", "ad"), ("week", "aw"), ("month", "am"))},
        "total_by_area": ("tot", "n_crimes_total"), "crimes_per_year": ("py", "n_crimes"), "crimes_per_year_area": ("pya", "n_crimes"),
        "crimes_per_year_severity": (counted("year, part_1_2"), "n"),
        "crimes_per_year_area_severity": (counted("year, area_name, part_1_2"), "n"),
        "crime_heatmap_monthly": ("heat", "n_crimes"),
        "weapon_usage_per_year": (counted(f"year, {_WEAPON}"), "n"),
        "context_risk_scores": ("scored", "n_crimes"), "high_risk_contexts": ("hr", "n_crimes")}
    return "\nUNION ALL ".join(_sum(n, *rows[n]) for n in names)


def _refusals() -> str:
    e, n = "area_name", "n_crimes"
    context = [e, "time_slot", "place_type", "age_range", "sex_norm", n, "z_score", "risk_level"]
    pages = {("avg_by_area_day", "averages page"): [e, "avg_crimes_per_day"], ("total_by_area", "top zones page"): [e, "n_crimes_total"],
             ("crimes_per_year_area", "evolution page"): ["year_int", e, n],
             ("crimes_per_year_area_severity", "evolution page"): ["year_int", e, "part_1_2", n],
             ("crime_heatmap_monthly", "map page"): ["year_int", "month", e, "lat", "lon", n],
             ("weapon_usage_per_year", "weapons page"): ["year_int", "weapon_used", n],
             ("high_risk_contexts", "scenario page"): context}
    return ", ".join(f"('{table}', '{page}', '{c}')" for (table, page), columns in pages.items() for c in columns)


def lake_oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["lake_raw_csv"] = _with() + """
SELECT area_name || ', "' || coalesce(premis_desc, '?') || '"' AS place, part_1_2 AS part, count(*) AS n_rows,
       count(t) AS n_times, CAST(sum(t) AS BIGINT) AS sum_times, count(lat) AS n_lat,
       CAST(sum(round(lat * 100)) AS BIGINT) AS sum_lat_cents, CAST(sum(TRY_CAST(vict_age AS INTEGER)) AS BIGINT) AS sum_ages
FROM (SELECT *, CASE WHEN time_occ <> 2400 THEN time_occ END AS t FROM raw_incidents)
GROUP BY ALL"""
    q["lake_partition_overwrite"] = _with() + """
SELECT year, count(*) AS n_rows, 'overwrite' AS rule FROM curated WHERE year IN (1996, 1998) AND part_1_2 = 1 GROUP BY year
UNION ALL
SELECT year, count(*), 'years' FROM curated WHERE year NOT IN (1996, 1998) OR part_1_2 = 1 GROUP BY year"""
    q["lake_curated_one_year"] = _with() + """
SELECT area_name, count(*) AS n_crimes_total FROM curated WHERE year = 1998 GROUP BY area_name"""
    q["lake_skip_present"] = _with() + """
SELECT 'total_by_area' AS "table", area_name, count(*) AS n FROM curated WHERE year <= 1997 GROUP BY area_name
UNION ALL
SELECT 'crimes_per_year_area', area_name, count(*) FROM curated GROUP BY area_name"""
    q["lake_twelve_tables"] = _with("ad", "aw", "am", "tot", "py", "pya", "heat", "hr") + _summaries(
        "avg_by_area_day", "avg_by_area_week", "avg_by_area_month", "total_by_area", "crimes_per_year", "crimes_per_year_area",
        "crimes_per_year_severity", "crimes_per_year_area_severity", "crime_heatmap_monthly", "weapon_usage_per_year",
        "context_risk_scores", "high_risk_contexts")
    q["lake_result_scan"] = _with("pya") + """
SELECT t AS "table", c AS "column", k AS type, CASE WHEN t = 'crimes_per_year_area' THEN (SELECT count(*) FROM pya) ELSE 0 END AS n_rows
FROM (VALUES ('crimes_per_year_area', 'year_int', 'int'), ('crimes_per_year_area', 'area_name', 'string'),
             ('crimes_per_year_area', 'n_crimes', 'bigint'), ('total_by_area', 'area_name', 'string'),
             ('total_by_area', 'n_crimes_total', 'bigint'), ('weapon_usage_per_year', 'year_int', 'int'),
             ('weapon_usage_per_year', 'weapon_used', 'string'), ('weapon_usage_per_year', 'n_crimes', 'bigint')) AS v(t, c, k)"""
    q["lake_header_cleanup"] = _with("tot") + """
SELECT fmt, spelled, area_name, n_crimes_total AS n
FROM tot, (VALUES ('csv', 'Area Name'), ('parquet', 'AREA NAME'), ('parquet', 'areaname')) AS v(fmt, spelled)"""
    q["lake_first_of_two_columns"] = "SELECT o_orderstatus AS order_status, count(*) AS n_rows FROM orders GROUP BY o_orderstatus"
    q["lake_optional_columns"] = _with("ad", "aw", "am", "tot", "py", "pya", "hr") + _summaries(
        "avg_by_area_day", "avg_by_area_week", "avg_by_area_month", "total_by_area", "crimes_per_year", "crimes_per_year_area",
        "context_risk_scores", "high_risk_contexts")
    tops = [f"SELECT * FROM (SELECT '{name}' AS ordered_by, {_CONTEXT}, age_range, sex_norm, n_crimes FROM hr_default "
            f"ORDER BY {column} DESC, z_score DESC, {_KEYS} LIMIT 20)"
            for name, column in (("score", "risk_score_10"), ("share", "crime_share_percent"), ("z", "z_score"))]
    q["lake_contexts_by_what_is_there"] = _with("hr_default") + "\nUNION ALL ".join(tops)
    q["lake_page_refusals"] = _with() + f"""
SELECT t AS "table", p AS page, c AS missing,
       (SELECT count(*) FROM (SELECT DISTINCT year, area_name, part_1_2 FROM curated)) AS n_rows
FROM (VALUES {_refusals()}) AS v(t, p, c)"""
    q["lake_risk_of_a_removed_zone"] = _with("hr") + _summaries("context_risk_scores", "high_risk_contexts")
    return q
