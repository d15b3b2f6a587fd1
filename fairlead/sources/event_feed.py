"""Ship positions derived from the ``events`` table.

The benchmark tables hold no positions, so this view maps each event to one
report of one of fifteen vessels that cross near the default centre. The text
runs unchanged on Spark and on DuckDB and serves both sides of the checks. The
test vectors in it (offsets, moduli) are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fairlead.functions.frames import evaluated

AIS_POINTS_SQL = """
SELECT event_id,
  CASE WHEN v = 14 THEN '111111111' ELSE CAST(200000000 + v AS VARCHAR(9)) END AS mmsi,
  CASE WHEN v = 13 THEN 'Pilot 13' WHEN v = 12 THEN NULL
       ELSE concat('VESSEL ', CAST(v AS VARCHAR(9))) END AS name,
  1638316800 + t AS ts,
  CASE WHEN event_id % 97 = 0 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 101 = 0 THEN CAST(91 AS DOUBLE)
       WHEN event_id % 103 = 0 THEN NULL
       ELSE CAST(lat_u + CASE WHEN event_id % 53 = 0 THEN 2000000
                              WHEN event_id % 59 = 0 THEN 800000
                              WHEN event_id % 61 = 0 THEN 300000 ELSE 0 END AS DOUBLE)
            / CAST(1000000 AS DOUBLE) END AS latitude,
  CAST(lon_u + CASE WHEN event_id % 59 = 0 THEN 1400000 ELSE 0 END AS DOUBLE)
    / CAST(1000000 AS DOUBLE) AS longitude,
  CASE WHEN event_id % 19 = 0 THEN NULL ELSE value % CAST(15 AS DOUBLE) END AS sog,
  CASE WHEN event_id % 23 = 0 THEN NULL
       WHEN event_id % 29 = 0 THEN 'At anchor'
       WHEN event_id % 31 = 0 THEN 'Moored'
       ELSE 'Under way using engine' END AS navigational_status,
  CAST(floor((1638316800 + t) / 86400) AS BIGINT) AS file_day
FROM (
  SELECT event_id, value, v, t,
    CASE WHEN v % 2 = 0 THEN 55215000 + abs((t * (40 + v)) % 40000 - 20000)
         ELSE 55225000 + (v - 7) * 500 END AS lat_u,
    CASE WHEN v % 2 = 0 THEN 14245000 + (v - 7) * 500
         ELSE 14235000 + abs((t * (70 + v)) % 40000 - 20000) END AS lon_u
  FROM (SELECT event_id, value, user_id % 15 AS v,
               CAST(floor(event_id / 2) AS BIGINT) * 8 AS t
        FROM {events}) e0) e1
"""


def ais_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions over ``{sf_dir}/events.parquet``, one row per event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return evaluated(spark.sql(AIS_POINTS_SQL, events=events))
