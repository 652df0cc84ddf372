"""Map the driver's ``events`` table onto the catalogue shape.

The test tables hold no earthquake catalogue, so registered queries read
``events`` and derive catalogue columns from it with the fixed rule below.
Every derived number is binary-exact, so sums and means agree bit for bit
between engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.functions.columns import epoch_seconds


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def events_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue columns derived from ``events.parquet`` (one row per event).

    Fixed values (mapping rule):
      event_id     = event_id
      event_time   = ts
      event_s      = whole epoch seconds of ts
      magnitude    = NULL when event_id % 97 = 0, else bigint(round(value*100))/8192 - 0.0625
      depth_km     = NULL when k % 13 = 0, else double(k)        (k = int of props $.k)
      latitude     = -1.0 + (user_id % 12) * 0.25
      longitude    = -120.0 + (user_id % 8) * 0.25
      network      = event_type
      place        = 'user ' || user_id
      num_stations = NULL when k % 7 = 0, else k
      gap          = NULL when k % 5 = 0, else k * 2.0
      rms          = NULL when k % 3 = 0, else k / 64.0
      significance = NULL when k % 11 = 0, else k * 10
    """
    ev = spark.read.parquet(events_path(sf_dir))
    k = F.get_json_object("props", "$.k").cast("int")
    src = ev.select(
        "event_id",
        F.col("ts").alias("event_time"),
        epoch_seconds(ev, "ts").alias("event_s"),
        "user_id",
        "event_type",
        "value",
        k.alias("k"),
    )
    k = F.col("k")
    return src.select(
        "event_id",
        "event_time",
        "event_s",
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("double"))
        .otherwise(F.round(F.col("value") * 100).cast("bigint") / F.lit(8192.0) - F.lit(0.0625))
        .alias("magnitude"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(k.cast("double")).alias("depth_km"),
        (F.lit(-1.0) + (F.col("user_id") % 12) * F.lit(0.25)).alias("latitude"),
        (F.lit(-120.0) + (F.col("user_id") % 8) * F.lit(0.25)).alias("longitude"),
        F.col("event_type").alias("network"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("place"),
        F.when(k % 7 == 0, F.lit(None).cast("int")).otherwise(k).alias("num_stations"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(k * F.lit(2.0)).alias("gap"),
        F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(k / F.lit(64.0)).alias("rms"),
        F.when(k % 11 == 0, F.lit(None).cast("int")).otherwise(k * 10).alias("significance"),
    )


# The same mapping for DuckDB, as a CTE named ``cat`` (used by oracle SQL).
DUCKDB_CATALOGUE_CTE = """
src AS (
  SELECT event_id, ts AS event_time, CAST(floor(epoch(ts)) AS BIGINT) AS event_s,
         user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
cat AS (
  SELECT event_id, event_time, event_s,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE CAST(round(value * 100) AS BIGINT) / 8192.0::DOUBLE - 0.0625::DOUBLE END AS magnitude,
    CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS depth_km,
    -1.0::DOUBLE + (user_id % 12) * 0.25::DOUBLE AS latitude,
    -120.0::DOUBLE + (user_id % 8) * 0.25::DOUBLE AS longitude,
    event_type AS network,
    'user ' || CAST(user_id AS VARCHAR) AS place,
    CASE WHEN k % 7 = 0 THEN NULL ELSE k END AS num_stations,
    CASE WHEN k % 5 = 0 THEN NULL ELSE k * 2.0::DOUBLE END AS gap,
    CASE WHEN k % 3 = 0 THEN NULL ELSE k / 64.0::DOUBLE END AS rms,
    CASE WHEN k % 11 = 0 THEN NULL ELSE k * 10 END AS significance
  FROM src
)"""
