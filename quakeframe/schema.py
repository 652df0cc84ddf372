"""Schemas and column lists shared by every stage.

Types are declared here once; nothing in the library infers a schema.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---------------------------------------------------------------------------
# GeoJSON feature file (one response of the public event query service).
# ---------------------------------------------------------------------------

GEOJSON_PROPERTIES = StructType(
    [
        StructField("mag", DoubleType()),
        StructField("place", StringType()),
        StructField("time", LongType()),
        StructField("updated", LongType()),
        StructField("tz", IntegerType()),
        StructField("url", StringType()),
        StructField("detail", StringType()),
        StructField("felt", IntegerType()),
        StructField("cdi", DoubleType()),
        StructField("mmi", DoubleType()),
        StructField("alert", StringType()),
        StructField("status", StringType()),
        StructField("tsunami", IntegerType()),
        StructField("sig", IntegerType()),
        StructField("net", StringType()),
        StructField("code", StringType()),
        StructField("ids", StringType()),
        StructField("sources", StringType()),
        StructField("types", StringType()),
        StructField("nst", IntegerType()),
        StructField("dmin", DoubleType()),
        StructField("rms", DoubleType()),
        StructField("gap", DoubleType()),
        StructField("magType", StringType()),
    ]
)

GEOJSON_FEATURE = StructType(
    [
        StructField("id", StringType()),
        StructField("properties", GEOJSON_PROPERTIES),
        StructField(
            "geometry",
            StructType([StructField("coordinates", ArrayType(DoubleType()))]),
        ),
    ]
)

# A response document: {"features": [feature, ...], ...}; other keys ignored.
GEOJSON_DOCUMENT = StructType([StructField("features", ArrayType(GEOJSON_FEATURE))])

# Catalogue column <- GeoJSON property, in catalogue order.
PROPERTY_COLUMNS = [
    ("magnitude", "mag"),
    ("place", "place"),
    ("time_ms", "time"),
    ("updated_ms", "updated"),
    ("timezone", "tz"),
    ("url", "url"),
    ("detail", "detail"),
    ("felt", "felt"),
    ("cdi", "cdi"),
    ("mmi", "mmi"),
    ("alert", "alert"),
    ("status", "status"),
    ("tsunami", "tsunami"),
    ("significance", "sig"),
    ("network", "net"),
    ("code", "code"),
    ("ids", "ids"),
    ("sources", "sources"),
    ("types", "types"),
    ("num_stations", "nst"),
    ("min_distance", "dmin"),
    ("rms", "rms"),
    ("gap", "gap"),
    ("magnitude_type", "magType"),
]

# ---------------------------------------------------------------------------
# Catalogue (raw Parquet, partitioned by year/month).
# ---------------------------------------------------------------------------

CATALOGUE = StructType(
    [StructField("event_id", StringType())]
    + [
        StructField(name, GEOJSON_PROPERTIES[prop].dataType)
        for name, prop in PROPERTY_COLUMNS
    ]
    + [
        StructField("longitude", DoubleType()),
        StructField("latitude", DoubleType()),
        StructField("depth_km", DoubleType()),
        StructField("event_time", TimestampType()),
        StructField("updated_time", TimestampType()),
        StructField("day", IntegerType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
    ]
)

PARTITION_COLUMNS = ["year", "month"]

# ---------------------------------------------------------------------------
# Feature tables.
# ---------------------------------------------------------------------------

# The 20 model predictors, in vector order.
PREDICTORS = [
    "magnitude",
    "depth_km",
    "latitude",
    "longitude",
    "significance",
    "num_stations",
    "gap",
    "rms",
    "hour",
    "day_of_week",
    "day_of_year",
    "time_since_prev_event",
    "spatial_density",
    "mag_mean_30d",
    "mag_max_30d",
    "mag_std_30d",
    "event_count_30d",
    "depth_mean_30d",
    "energy_release",
    "cumulative_energy_30d",
]

LABEL = "has_aftershock"

# Training table: keys, predictors, labels.
TRAIN_COLUMNS = ["event_id", "event_time"] + PREDICTORS + [LABEL, "aftershock_magnitude"]

# Serving table: keys, place, predictors (no labels).
SERVE_COLUMNS = (
    ["event_id", "event_time", "magnitude", "depth_km", "latitude", "longitude", "place"]
    + PREDICTORS[4:]
)

# NULL replacements applied to both feature tables.
FILL_VALUES = {
    "time_since_prev_event": 0,
    "mag_mean_30d": 0,
    "mag_max_30d": 0,
    "mag_std_30d": 0,
    "event_count_30d": 1,
    "depth_mean_30d": 0,
    "cumulative_energy_30d": 0,
    "num_stations": 0,
    "gap": 180,
    "rms": 0,
    "significance": 0,
}

# Scored-event sink and top-N report columns.
PREDICTION_COLUMNS = [
    "event_id",
    "event_time",
    "magnitude",
    "depth_km",
    "latitude",
    "longitude",
    "place",
    "aftershock_probability",
    "risk_level",
    "prediction",
]
REPORT_COLUMNS = PREDICTION_COLUMNS[:-1]

# Risk tiers (lower bound of probability, label), highest first.
RISK_TIERS = [(0.7, "HIGH"), (0.4, "MEDIUM")]
RISK_DEFAULT = "LOW"
