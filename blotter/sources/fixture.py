"""Test adapter: an incident-shaped raw table derived from ``lineitem``.

The driver's test tables hold no incident data. This view maps every
``lineitem`` row to one raw incident with the reference's raw columns, skew
(AREA_00 is large), NULLs and dirty values (a bad date, hour 24, non-numeric
ages, padded and mixed-case weapon texts). It is join-free and deterministic,
so it grows with ``lineitem`` and runs unchanged on Spark and DuckDB; the
oracle SQL in :mod:`blotter.oracle` embeds the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.sources.zones import read_table

#: Adapter view over a table named ``{lineitem}`` (fixed text, shared with the oracle).
ADAPTER_SQL = """
with h as (
  select l.*,
    (l_orderkey*7919 + l_linenumber*104729 + l_partkey*31) % 1000 as h1,
    (l_orderkey*6113 + l_linenumber*271 + l_suppkey*97) % 1000 as h2,
    year(l_shipdate) as y, month(l_shipdate) as m, day(l_shipdate) as d
  from {lineitem} l)
select
  case when h1 % 97 = 0 then '13/45/1999 12:00:00 AM' when h1 % 89 = 0 then null
       else concat(lpad(cast(m as varchar(2)),2,'0'),'/',lpad(cast(d as varchar(2)),2,'0'),'/',cast(y as varchar(4)),' 12:00:00 AM') end as date_occ_raw,
  case when h2 % 211 = 0 then null when h2 % 197 = 0 then 2400
       else cast(floor(h2*h2*24/1e6) as int)*100 + l_linenumber*7 end as time_occ,
  concat('AREA_', lpad(cast(cast(floor(h1*h1*h1*21/1e9) as int) as varchar(2)),2,'0')) as area_name,
  case when l_linestatus = 'F' then 1 else 2 end as part_1_2,
  case when h2 % 101 = 0 then 'X' else cast(cast(l_quantity as int)*2 - 8 as varchar(4)) end as vict_age,
  case when l_returnflag = 'A' then 'M' when l_returnflag = 'N' then 'F'
       when h2 % 3 = 0 then null when h2 % 3 = 1 then 'X' else 'F' end as vict_sex,
  case when h1 % 83 = 0 then null when h1 * h2 % 1000 < 600 then 'STREET'
       when h1 * h2 % 1000 < 850 then 'SINGLE FAMILY DWELLING' else 'PARKING LOT' end as premis_desc,
  case h2 % 7 when 0 then null when 1 then '  ' when 2 then ' verbal threat '
       when 3 then 'Strong-Arm (Hands, Fist, Feet or Bodily Force)'
       when 4 then 'HAND GUN' when 5 then ' knife' else '' end as weapon_desc,
  case when h1 % 61 = 0 then null else (3370 + l_suppkey % 40) / 1e2 end as lat,
  case when h1 % 61 = 0 then null else (-11850 + l_suppkey % 30) / 1e2 end as lon
from h
"""

#: Columns of ``lineitem`` the adapter reads (the scan prunes everything else).
LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_returnflag", "l_linestatus", "l_shipdate")


def adapter_raw(lineitem: DataFrame) -> DataFrame:
    """Raw incident rows (one per ``lineitem`` row)."""
    spark = lineitem.sparkSession
    return spark.sql(ADAPTER_SQL, lineitem=lineitem.select(*LINEITEM_COLUMNS))


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter view over ``{sf_dir}/lineitem.parquet``."""
    return adapter_raw(read_table(spark, sf_dir, "lineitem"))
