"""DuckDB SQL for every query in :mod:`blotter.queries` (the correctness oracle).

The SQL is written independently of the Spark operators, from the semantics
they implement; it runs on the driver's tables registered as views. The
adapter text is shared (it is the fixture definition); everything after it is
plain SQL. Floating-point outputs are rounded to 6 decimals, as on the Spark
side.
"""

from __future__ import annotations

from blotter.sources.fixture import ADAPTER_SQL

_CURATED = f"""
raw_incidents AS (
{ADAPTER_SQL.format(lineitem="lineitem")}
),
parsed AS (
  SELECT date_occ_raw, time_occ,
         nullif(trim(area_name), '') AS area_name, part_1_2,
         nullif(trim(vict_age), '') AS vict_age, nullif(trim(vict_sex), '') AS vict_sex,
         nullif(trim(premis_desc), '') AS premis_desc, nullif(trim(weapon_desc), '') AS weapon_desc,
         lat, lon,
         try_strptime(date_occ_raw, '%m/%d/%Y %I:%M:%S %p') AS date_occ_ts
  FROM raw_incidents),
curated AS (
  SELECT *, CAST(date_occ_ts AS DATE) AS date_occ, CAST(year(date_occ_ts) AS INTEGER) AS year
  FROM parsed
  WHERE date_occ_ts IS NOT NULL AND year(date_occ_ts) <= 2000)"""

_SLOT = """CASE WHEN h >= 0 AND h < 6 THEN 'Nuit (0-5)' WHEN h >= 6 AND h < 12 THEN 'Matin (6-11)'
     WHEN h >= 12 AND h < 18 THEN 'Apres-midi (12-17)' WHEN h >= 18 AND h < 24 THEN 'Soiree (18-23)'
     ELSE 'Inconnu' END"""
_AGE = """CASE WHEN age IS NULL OR age <= 0 THEN 'Inconnu' WHEN age < 18 THEN '0-17'
     WHEN age < 30 THEN '18-29' WHEN age < 45 THEN '30-44' WHEN age < 65 THEN '45-64' ELSE '65+' END"""
_SEX = """CASE WHEN vict_sex IS NULL THEN 'Inconnu' WHEN vict_sex = 'M' THEN 'M'
     WHEN vict_sex = 'F' THEN 'F' ELSE 'Autre' END"""
_VICTIM = "CASE WHEN age > 0 OR vict_sex IN ('M', 'F') THEN 'Humain' ELSE 'NonHumain' END"
_WEAPON = """CASE WHEN upper(trim(weapon_desc)) IS NULL OR upper(trim(weapon_desc)) = ''
     OR upper(trim(weapon_desc)) IN ('STRONG-ARM (HANDS, FIST, FEET OR BODILY FORCE)', 'VERBAL THREAT')
     THEN 'Aucune arme' ELSE 'Arme utilisée' END"""
_MONTH_NAME = """CASE month WHEN 1 THEN 'Janvier' WHEN 2 THEN 'Février' WHEN 3 THEN 'Mars'
     WHEN 4 THEN 'Avril' WHEN 5 THEN 'Mai' WHEN 6 THEN 'Juin' WHEN 7 THEN 'Juillet' WHEN 8 THEN 'Août'
     WHEN 9 THEN 'Septembre' WHEN 10 THEN 'Octobre' WHEN 11 THEN 'Novembre' WHEN 12 THEN 'Décembre'
     ELSE CAST(month AS VARCHAR) END"""

_CTES = {
    "classified": f"""classified AS (
  SELECT *, {_SLOT} AS time_slot, {_AGE} AS age_range, {_SEX} AS sex_norm, {_VICTIM} AS victim_type
  FROM (SELECT *, floor(TRY_CAST(time_occ AS INTEGER) / 100) AS h,
               TRY_CAST(vict_age AS INTEGER) AS age FROM curated))""",
    "counts": """counts AS (
  SELECT area_name, time_slot, premis_desc AS place_type, age_range, sex_norm, count(*) AS n_crimes
  FROM classified
  WHERE victim_type = 'Humain' AND area_name IS NOT NULL AND premis_desc IS NOT NULL
  GROUP BY area_name, time_slot, premis_desc, age_range, sex_norm)""",
    "stats": """stats AS (
  SELECT avg(n_crimes) AS mean_n,
         coalesce(nullif(stddev_pop(n_crimes), 0), 1.0) AS std_n,
         coalesce(CAST(sum(n_crimes) AS DOUBLE), 1.0) AS total_n
  FROM counts)""",
    "scored": """scored AS (
  SELECT area_name, time_slot, place_type, age_range, sex_norm, n_crimes, z AS z_score,
         CASE WHEN z >= 3.0 THEN 'Tres eleve' WHEN z >= 2.0 THEN 'Eleve' ELSE 'Normal' END AS risk_level,
         (n_crimes / total_n) * 100.0 AS crime_share_percent,
         least(greatest((z / 5.0) * 10.0, 0.0), 10.0) AS risk_score_10
  FROM (SELECT c.*, (c.n_crimes - s.mean_n) / s.std_n AS z, s.total_n FROM counts c, stats s))""",
    "hr": """hr AS (SELECT * FROM scored WHERE n_crimes >= 50 AND z_score >= 2.0)""",
    "hr_default": """hr_default AS (
  SELECT * FROM hr
  WHERE risk_level IN ('Tres eleve', 'Eleve')
     OR (NOT EXISTS (SELECT 1 FROM hr WHERE risk_level IN ('Tres eleve', 'Eleve'))
         AND risk_level IS NOT NULL))""",
    "heat": """heat AS (
  SELECT year AS year_int, CAST(month(date_occ) AS INTEGER) AS month, area_name, lat, lon,
         count(*) AS n_crimes
  FROM curated WHERE lat IS NOT NULL AND lon IS NOT NULL
  GROUP BY year, month(date_occ), area_name, lat, lon)""",
    "heat_sel": """heat_sel AS (
  SELECT * FROM heat
  WHERE year_int = (SELECT max(year_int) FROM heat)
    AND month = (SELECT min(month) FROM heat WHERE year_int = (SELECT max(year_int) FROM heat)))""",
    "tot": """tot AS (SELECT area_name, count(*) AS n_crimes_total FROM curated GROUP BY area_name)""",
    "py": """py AS (SELECT year AS year_int, count(*) AS n_crimes FROM curated GROUP BY year)""",
    "pya": """pya AS (SELECT year AS year_int, area_name, count(*) AS n_crimes
  FROM curated GROUP BY year, area_name)""",
    "ad": """ad AS (SELECT area_name, avg(n) AS avg_crimes_per_day FROM
  (SELECT area_name, date_occ, count(*) AS n FROM curated GROUP BY area_name, date_occ)
  GROUP BY area_name)""",
    "aw": """aw AS (SELECT area_name, avg(n) AS avg_crimes_per_week FROM
  (SELECT area_name, year(date_occ) AS y, weekofyear(date_occ) AS w, count(*) AS n
   FROM curated GROUP BY area_name, year(date_occ), weekofyear(date_occ))
  GROUP BY area_name)""",
    "am": """am AS (SELECT area_name, avg(n) AS avg_crimes_per_month FROM
  (SELECT area_name, year, month(date_occ) AS m, count(*) AS n
   FROM curated GROUP BY area_name, year, month(date_occ))
  GROUP BY area_name)""",
}

# Which helper CTEs each helper needs (in definition order).
_DEPS = {"counts": ["classified"], "stats": ["counts"], "scored": ["stats"], "hr": ["scored"],
         "hr_default": ["hr"], "heat_sel": ["heat"]}


def _with(*names: str) -> str:
    order: list[str] = []

    def add(n):
        for dep in _DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    return "WITH " + ",\n".join([_CURATED, *[_CTES[n] for n in order]]) + "\n"


def _events(final: str) -> str:
    return ("WITH ev AS (SELECT *, CAST(ts AS DATE) AS date_occ FROM events WHERE ts IS NOT NULL)\n"
            + final)


def _orders(final: str) -> str:
    return ("WITH od AS (SELECT *, CAST(o_orderdate AS DATE) AS date_occ,\n"
            "  CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderdate IS NOT NULL)\n"
            + final)


_SCORE_COLS = """area_name, time_slot, place_type, age_range, sex_norm, n_crimes,
  round(z_score, 6) AS z_score, risk_level, round(crime_share_percent, 6) AS crime_share_percent,
  round(risk_score_10, 6) AS risk_score_10"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_year_counts"] = _with() + "SELECT year, count(*) AS n_rows FROM curated GROUP BY year"

    q["avg_by_area_day"] = _with("ad") + \
        "SELECT area_name, round(avg_crimes_per_day, 6) AS avg_crimes_per_day FROM ad"
    q["avg_by_area_week"] = _with("aw") + \
        "SELECT area_name, round(avg_crimes_per_week, 6) AS avg_crimes_per_week FROM aw"
    q["avg_by_area_month"] = _with("am") + \
        "SELECT area_name, round(avg_crimes_per_month, 6) AS avg_crimes_per_month FROM am"
    q["avg_by_area_week_iso"] = _with() + """
SELECT area_name, round(avg(n), 6) AS avg_crimes_per_week_iso FROM
  (SELECT area_name, isoyear(date_occ) AS y, weekofyear(date_occ) AS w, count(*) AS n
   FROM curated GROUP BY area_name, isoyear(date_occ), weekofyear(date_occ))
GROUP BY area_name"""
    q["avg_by_area_day_dense"] = _with() + """
SELECT area_name, round(count(*) / (SELECT CAST(date_diff('day', min(date_occ), max(date_occ)) + 1 AS DOUBLE)
                                    FROM curated), 6) AS avg_crimes_per_day_dense
FROM curated GROUP BY area_name"""
    q["avg_by_area_month_dense"] = _with() + """
SELECT area_name, round(count(*) / (SELECT CAST((year(max(date_occ)) * 12 + month(max(date_occ)))
                                           - (year(min(date_occ)) * 12 + month(min(date_occ))) + 1 AS DOUBLE)
                                    FROM curated), 6) AS avg_crimes_per_month_dense
FROM curated GROUP BY area_name"""
    q["avg_by_area_week_dense"] = _with() + """,
bounds AS (SELECT min(date_occ) AS lo, max(date_occ) AS hi FROM curated),
weeks AS (SELECT count(*) AS n_weeks FROM (
  SELECT DISTINCT year(CAST(d AS DATE)) AS y, weekofyear(CAST(d AS DATE)) AS w
  FROM bounds, range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)))
SELECT area_name, round(count(*) / (SELECT CAST(n_weeks AS DOUBLE) FROM weeks), 6)
       AS avg_crimes_per_week_dense
FROM curated GROUP BY area_name"""
    q["total_by_area"] = _with("tot") + "SELECT * FROM tot"
    q["top5_areas"] = _with("tot") + \
        "SELECT * FROM tot ORDER BY n_crimes_total DESC, area_name ASC LIMIT 5"
    q["avg_day_default_zones"] = _with("ad") + """
SELECT area_name, round(avg_crimes_per_day, 6) AS avg_crimes_per_day FROM ad
WHERE area_name IN (SELECT DISTINCT area_name FROM ad WHERE area_name IS NOT NULL
                    ORDER BY area_name LIMIT 5)"""
    q["per_year_area_default_zones"] = _with("pya") + """
SELECT * FROM pya WHERE area_name IN (SELECT DISTINCT area_name FROM pya WHERE area_name IS NOT NULL
                                      ORDER BY area_name LIMIT 3)"""

    q["per_year"] = _with("py") + "SELECT * FROM py"
    q["per_year_area"] = _with("pya") + "SELECT * FROM pya"
    q["per_year_severity"] = _with() + """
SELECT year AS year_int, part_1_2, count(*) AS n_crimes FROM curated GROUP BY year, part_1_2"""
    q["per_year_area_severity"] = _with() + """
SELECT year AS year_int, area_name, part_1_2, count(*) AS n_crimes
FROM curated GROUP BY year, area_name, part_1_2"""
    q["year_grouping_sets"] = _with() + """
SELECT year_int, area_name, part_1_2, count(*) AS n_crimes,
       CAST(GROUPING(year_int, area_name, part_1_2) AS INTEGER) AS grouping_id
FROM (SELECT year AS year_int, area_name, part_1_2 FROM curated)
GROUP BY GROUPING SETS ((year_int), (year_int, area_name), (year_int, part_1_2),
                        (year_int, area_name, part_1_2))"""
    q["daily_cube"] = _with() + f"""
SELECT area_name, date_occ, year, part_1_2, {_WEAPON} AS weapon_used, count(*) AS n
FROM curated GROUP BY ALL"""

    q["heatmap_monthly"] = _with("heat") + \
        "SELECT year_int, month, area_name, lat, lon, n_crimes FROM heat"
    q["heatmap_points_month"] = _with("heat_sel") + """
SELECT lat, lon, n_crimes FROM heat_sel
WHERE lat IS NOT NULL AND lon IS NOT NULL AND n_crimes IS NOT NULL"""
    q["heatmap_point_count"] = _with("heat_sel") + """
SELECT count(*) AS n_points FROM heat_sel
WHERE lat IS NOT NULL AND lon IS NOT NULL AND n_crimes IS NOT NULL"""
    q["weapon_usage_per_year"] = _with() + f"""
SELECT year AS year_int, {_WEAPON} AS weapon_used, count(*) AS n_crimes FROM curated GROUP BY ALL"""

    q["time_slot_counts"] = _with("classified") + \
        "SELECT time_slot, count(*) AS n_rows FROM classified GROUP BY time_slot"
    q["age_range_counts"] = _with("classified") + \
        "SELECT age_range, count(*) AS n_rows FROM classified GROUP BY age_range"
    q["sex_norm_counts"] = _with("classified") + \
        "SELECT sex_norm, count(*) AS n_rows FROM classified GROUP BY sex_norm"
    q["victim_type_counts"] = _with("classified") + \
        "SELECT victim_type, count(*) AS n_rows FROM classified GROUP BY victim_type"

    q["context_risk_scores"] = _with("scored") + f"SELECT {_SCORE_COLS} FROM scored"
    q["high_risk_contexts"] = _with("hr") + f"SELECT {_SCORE_COLS} FROM hr"
    q["high_risk_filtered"] = _with("hr_default") + f"""
SELECT {_SCORE_COLS} FROM hr_default WHERE age_range IN ('18-29', '30-44')"""
    q["high_risk_summary"] = _with("hr_default") + """
SELECT count(*) AS n_scenarios, max(n_crimes) AS max_n_crimes,
       round(max(risk_score_10), 2) AS max_score, round(max(crime_share_percent), 2) AS max_share
FROM hr_default"""
    q["high_risk_top20_labels"] = _with("hr_default") + f"""
SELECT {_SCORE_COLS}, context FROM (
  SELECT *, area_name || ' | ' || time_slot || ' | ' || substring(place_type, 1, 25) || '...' AS context
  FROM hr_default
  ORDER BY risk_score_10 DESC, z_score DESC, area_name, time_slot, place_type, age_range, sex_norm
  LIMIT 20)"""

    q["distinct_areas"] = _with() + \
        "SELECT DISTINCT area_name FROM curated WHERE area_name IS NOT NULL"
    q["distinct_years"] = _with("heat") + "SELECT DISTINCT year_int FROM heat"
    q["month_names"] = _with("heat") + f"""
SELECT month, {_MONTH_NAME} AS month_name FROM (SELECT DISTINCT month FROM heat WHERE month IS NOT NULL)"""
    q["latest_year"] = _with("heat") + "SELECT max(year_int) AS latest_year FROM heat"

    q["area_concentration"] = _with("tot") + """
SELECT area_name, n_crimes_total,
       row_number() OVER (ORDER BY n_crimes_total DESC, area_name) AS rank_by_total,
       round(n_crimes_total / (SELECT CAST(sum(n_crimes_total) AS DOUBLE) FROM tot) * 100.0, 6)
         AS share_percent,
       round(sum(n_crimes_total) OVER (ORDER BY n_crimes_total DESC, area_name
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / (SELECT CAST(sum(n_crimes_total) AS DOUBLE) FROM tot) * 100.0, 6)
         AS cumulative_share_percent
FROM tot"""
    q["year_over_year"] = _with("py") + """
SELECT a.year_int, a.n_crimes, b.n_crimes AS prev_n_crimes, a.n_crimes - b.n_crimes AS change,
       round((a.n_crimes - b.n_crimes) / b.n_crimes * 100.0, 6) AS pct_change
FROM py a LEFT JOIN py b ON b.year_int IS NOT DISTINCT FROM a.year_int - 1"""
    q["area_vs_city_trend"] = _with("py", "pya") + """,
city AS (SELECT a.year_int, (a.n_crimes - b.n_crimes) / b.n_crimes * 100.0 AS city_pct_change
         FROM py a LEFT JOIN py b ON b.year_int IS NOT DISTINCT FROM a.year_int - 1),
area AS (SELECT a.area_name, a.year_int, a.n_crimes,
                (a.n_crimes - b.n_crimes) / b.n_crimes * 100.0 AS area_pct_change
         FROM pya a LEFT JOIN pya b ON b.area_name IS NOT DISTINCT FROM a.area_name
                                   AND b.year_int IS NOT DISTINCT FROM a.year_int - 1)
SELECT area_name, area.year_int, n_crimes, round(area_pct_change, 6) AS area_pct_change,
       round(city_pct_change, 6) AS city_pct_change,
       round(area_pct_change - city_pct_change, 6) AS gap_pct_points
FROM area LEFT JOIN city ON area.year_int IS NOT DISTINCT FROM city.year_int"""
    q["severity_share"] = _with() + """
SELECT year AS year_int, part_1_2, count(*) AS n_crimes,
       round(count(*) / sum(count(*)) OVER (PARTITION BY year) * 100.0, 6) AS share_percent
FROM curated GROUP BY year, part_1_2"""
    q["chronic_areas"] = _with("ad", "aw", "am") + """
SELECT ad.area_name, round(avg_crimes_per_day, 6) AS avg_crimes_per_day,
       round(avg_crimes_per_week, 6) AS avg_crimes_per_week,
       round(avg_crimes_per_month, 6) AS avg_crimes_per_month
FROM ad JOIN aw ON aw.area_name IS NOT DISTINCT FROM ad.area_name
        JOIN am ON am.area_name IS NOT DISTINCT FROM ad.area_name
WHERE avg_crimes_per_day >= (SELECT min(v) FROM (SELECT avg_crimes_per_day AS v FROM ad
                                                 ORDER BY v DESC LIMIT 5))
  AND avg_crimes_per_week >= (SELECT min(v) FROM (SELECT avg_crimes_per_week AS v FROM aw
                                                  ORDER BY v DESC LIMIT 5))
  AND avg_crimes_per_month >= (SELECT min(v) FROM (SELECT avg_crimes_per_month AS v FROM am
                                                   ORDER BY v DESC LIMIT 5))"""
    q["recurrent_hotspots"] = _with("heat") + """,
pts AS (SELECT year_int, month, lat, lon, sum(n_crimes) AS n_crimes FROM heat
        GROUP BY year_int, month, lat, lon),
ranked AS (SELECT *, rank() OVER (PARTITION BY year_int, month ORDER BY n_crimes DESC) AS r FROM pts)
SELECT lat, lon, count(*) AS hot_months,
       CAST(sum(n_crimes) AS BIGINT) AS n_crimes_in_hot_months
FROM ranked WHERE r <= 10 GROUP BY lat, lon"""
    q["seasonality_index"] = _with() + """,
mb AS (SELECT area_name, year, month(date_occ) AS month, count(*) AS n FROM curated
       GROUP BY area_name, year, month(date_occ)),
bm AS (SELECT area_name, month, avg(n) AS month_avg FROM mb GROUP BY area_name, month),
ov AS (SELECT area_name, avg(n) AS overall_avg FROM mb GROUP BY area_name)
SELECT bm.area_name, CAST(month AS INTEGER) AS month,
       round(month_avg / overall_avg, 6) AS seasonality_index
FROM bm JOIN ov ON ov.area_name IS NOT DISTINCT FROM bm.area_name"""
    for key, col in (("high_risk_by_age", "age_range"), ("high_risk_by_sex", "sex_norm")):
        q[key] = _with("hr") + f"""
SELECT {col}, count(*) AS n_contexts, CAST(sum(n_crimes) AS BIGINT) AS n_crimes,
       round(sum(n_crimes) / (SELECT CAST(sum(n_crimes) AS DOUBLE) FROM hr) * 100.0, 6) AS share_percent
FROM hr GROUP BY {col}"""

    q["events_avg_per_day"] = _events("""
SELECT event_type, round(avg(n), 6) AS avg_crimes_per_day FROM
  (SELECT event_type, date_occ, count(*) AS n FROM ev GROUP BY event_type, date_occ)
GROUP BY event_type""")
    q["events_avg_per_week"] = _events("""
SELECT event_type, round(avg(n), 6) AS avg_crimes_per_week FROM
  (SELECT event_type, year(date_occ) AS y, weekofyear(date_occ) AS w, count(*) AS n
   FROM ev GROUP BY event_type, year(date_occ), weekofyear(date_occ))
GROUP BY event_type""")
    q["orders_per_year_priority"] = _orders("""
SELECT year AS year_int, o_orderpriority, count(*) AS n_crimes FROM od GROUP BY year, o_orderpriority""")
    q["orders_per_year_status"] = _orders("""
SELECT year AS year_int, o_orderstatus, count(*) AS n_crimes FROM od GROUP BY year, o_orderstatus""")
    q["orders_avg_per_month"] = _orders("""
SELECT o_orderpriority, round(avg(n), 6) AS avg_crimes_per_month FROM
  (SELECT o_orderpriority, year, month(date_occ) AS m, count(*) AS n
   FROM od GROUP BY o_orderpriority, year, month(date_occ))
GROUP BY o_orderpriority""")
    q["orders_context_scores"] = _orders("""
, c AS (SELECT year AS year_int, o_orderpriority, o_orderstatus, count(*) AS n_crimes
        FROM od GROUP BY year, o_orderpriority, o_orderstatus),
s AS (SELECT avg(n_crimes) AS mean_n, coalesce(nullif(stddev_pop(n_crimes), 0), 1.0) AS std_n,
             coalesce(CAST(sum(n_crimes) AS DOUBLE), 1.0) AS total_n FROM c),
z AS (SELECT c.*, (c.n_crimes - s.mean_n) / s.std_n AS z, s.total_n FROM c, s)
SELECT year_int, o_orderpriority, o_orderstatus, n_crimes, round(z, 6) AS z_score,
       CASE WHEN z >= 3.0 THEN 'Tres eleve' WHEN z >= 2.0 THEN 'Eleve' ELSE 'Normal' END AS risk_level,
       round((n_crimes / total_n) * 100.0, 6) AS crime_share_percent,
       round(least(greatest((z / 5.0) * 10.0, 0.0), 10.0), 6) AS risk_score_10
FROM z""")

    by_status = "SELECT year AS year_int, o_orderstatus, count(*) AS n_crimes FROM od"
    q["orders_two_statuses"] = _orders(f"{by_status} WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL")
    q["orders_no_status"] = _orders(f"{by_status} WHERE false GROUP BY ALL")
    q["orders_one_status"] = _orders(f"{by_status} WHERE o_orderstatus = 'F' GROUP BY ALL")
    q["orders_loosely_bound"] = _orders("""
SELECT year AS year_int, o_orderpriority, o_orderstatus AS order_status, count(*) AS n_crimes
FROM od GROUP BY ALL""")
    q["yearly_tables_union"] = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year_int, count(*) AS n_crimes, 'orders' AS source
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY ALL
UNION ALL
SELECT CAST(year(ts) AS INTEGER), count(*), 'events' FROM events WHERE ts IS NOT NULL GROUP BY ALL"""
    q["orders_iso_dates"] = "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_rows FROM orders GROUP BY ALL"
    q["brand_numbers"] = """
SELECT p_type, round(avg(TRY_CAST(substring(p_brand, 7) AS DOUBLE)), 6) AS mean_no,
       CAST(sum(CAST(substring(p_brand, 7) AS BIGINT)) AS BIGINT) AS sum_no,
       count(TRY_CAST(p_name AS DOUBLE)) AS named_by_number
FROM part GROUP BY p_type"""
    q["equal_counts_scores"] = """
WITH c AS (SELECT n_regionkey, count(*) AS n_crimes FROM nation GROUP BY n_regionkey),
s AS (SELECT avg(n_crimes) AS mean_n, coalesce(nullif(stddev_pop(n_crimes), 0), 1.0) AS std_n,
             CAST(sum(n_crimes) AS DOUBLE) AS total_n FROM c),
z AS (SELECT c.*, (n_crimes - mean_n) / std_n AS z, total_n FROM c, s)
SELECT n_regionkey, n_crimes, round(z, 6) AS z_score,
       CASE WHEN z >= 3.0 THEN 'Tres eleve' WHEN z >= 2.0 THEN 'Eleve' ELSE 'Normal' END AS risk_level,
       round(n_crimes / total_n * 100.0, 6) AS crime_share_percent,
       round(least(greatest(z / 5.0 * 10.0, 0.0), 10.0), 6) AS risk_score_10
FROM z"""
    q["orders_share_labels"] = _orders("""
, n AS (SELECT year AS year_int, o_orderstatus, count(*) AS n_crimes FROM od GROUP BY ALL),
p AS (SELECT *, n_crimes / sum(n_crimes) OVER (PARTITION BY year_int) * 100.0 AS share FROM n)
SELECT year_int, o_orderstatus, n_crimes, round(share, 6) AS share_percent,
       printf('%.2f %%', share) AS share_label FROM p""")
    q["long_place_labels"] = """
SELECT doc_id, lang || ' | ' || source || ' | ' || substring(text, 1, 25) || '...' AS context FROM documents"""
    return q
