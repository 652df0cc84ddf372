"""GeoJSON feature files → flat catalogue rows.

Files landed from the event query service are read by Spark's JSON source
with an explicit schema (no inference, no driver-side decoding), each file's
``features`` array is exploded, and the nested fields are flattened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quakeframe.functions.columns import epoch_ms_to_timestamp, ntz_millis_sql
from quakeframe.schema import GEOJSON_DOCUMENT, GEOJSON_FEATURE, PROPERTY_COLUMNS


CORRUPT = "_corrupt_record"


def _document_schema() -> StructType:
    return StructType([*GEOJSON_DOCUMENT.fields, StructField(CORRUPT, StringType())])


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per GeoJSON file (``multiLine``): its fields, and in
    ``_corrupt_record`` the text of a file that doesn't parse or doesn't fit the
    schema."""
    return (
        spark.read.schema(_document_schema())
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_geojson(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per feature (column ``feature``) from GeoJSON documents.

    Every file is one document. A malformed file contributes what parses of it,
    usually nothing (``document_counts`` tells how many there are); an empty
    ``features`` array contributes nothing either. Chunks are appended as they
    are (bag semantics).
    """
    return read_documents(spark, path).select(F.explode("features").alias("feature"))


def document_counts(spark: SparkSession, path: str | list[str], line_delimited: bool = False) -> DataFrame:
    """One row: documents (or lines) landed, and how many of them are corrupt, so
    that a loss in parsing shows."""
    schema = StructType([*GEOJSON_FEATURE.fields, StructField(CORRUPT, StringType())])
    if line_delimited:
        text = spark.read.text(path).where("length(trim(value)) > 0")
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        bad = F.from_json("value", schema, options)[CORRUPT].isNotNull()
    else:
        # The JSON source can't count by the corrupt column alone; a field beside it can.
        text = read_documents(spark, path).select("features", CORRUPT)
        bad = F.col(CORRUPT).isNotNull() & (F.size(F.coalesce("features", F.array())) >= 0)
    return text.agg(F.count("*").alias("documents"), F.coalesce(F.sum(bad.cast("int")), F.lit(0)).cast("bigint").alias("corrupt"))


def parse_features(text: Column | str) -> Column:
    """Parse one GeoJSON feature held as JSON text into the feature struct."""
    t = F.col(text) if isinstance(text, str) else text
    return F.from_json(t, GEOJSON_FEATURE)


def flatten(features: DataFrame, feature_col: str = "feature") -> DataFrame:
    """Feature struct → the 33 catalogue columns.

    Coordinates are [longitude, latitude, depth]; a short array gives NULLs.
    Epoch milliseconds become TIMESTAMPs without the sub-second part; the date
    parts are taken in the session time zone (the one the partitioned sink
    writes with).
    """
    f = F.col(feature_col)
    coords = f["geometry"]["coordinates"]
    flat = features.select(
        f["id"].alias("event_id"),
        *[f["properties"][prop].alias(name) for name, prop in PROPERTY_COLUMNS],
        F.get(coords, 0).alias("longitude"),
        F.get(coords, 1).alias("latitude"),
        F.get(coords, 2).alias("depth_km"),
    )
    flat = flat.withColumns(
        {
            "event_time": epoch_ms_to_timestamp("time_ms"),
            "updated_time": epoch_ms_to_timestamp("updated_ms"),
        }
    )
    return flat.withColumns(
        {
            "day": F.dayofmonth("event_time"),
            "year": F.year("event_time"),
            "month": F.month("event_time"),
        }
    )


def events_as_geojson(catalogue: DataFrame) -> DataFrame:
    """GeoJSON feature text (column ``json``) for catalogue-shaped rows.

    Used to land test feature files from the fixture mapping; ``time`` is the
    epoch milliseconds of ``event_time`` (TIMESTAMP_NTZ read as UTC).
    """
    ms = F.expr(ntz_millis_sql("event_time"))
    i = F.col("event_id").cast("long")

    def text(mark: str, value):
        return F.concat(F.lit(mark), value.cast("string"))

    feature = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.col("magnitude").alias("mag"),
            F.col("place").alias("place"),
            ms.alias("time"),
            (ms + F.lit(60000)).alias("updated"),
            F.col("network").alias("net"),
            F.col("significance").alias("sig"),
            F.col("num_stations").alias("nst"),
            F.col("rms").alias("rms"),
            F.col("gap").alias("gap"),
            # Attributes that the rows don't have, all different
            # and made of the event's number.
            (i % 720 - 360).cast("int").alias("tz"),
            text("u", i).alias("url"),
            text("d", i).alias("detail"),
            (i % 1000 + 1).cast("int").alias("felt"),
            (i % 91 / F.lit(8.0)).alias("cdi"),
            (i % 77 / F.lit(16.0) + 1).alias("mmi"),
            F.when(i % 4 > 0, text("a", i % 4)).alias("alert"),
            text("c", i).alias("code"),
            text("i", i).alias("ids"),
            text("s", i % 7).alias("sources"),
            text("t", i % 5).alias("types"),
            (i % 53 / F.lit(32.0)).alias("dmin"),
            F.lit("ml").alias("magType"),
            F.lit("reviewed").alias("status"),
            F.lit(0).alias("tsunami"),
        ).alias("properties"),
        F.struct(
            F.array(F.col("longitude"), F.col("latitude"), F.col("depth_km")).alias("coordinates")
        ).alias("geometry"),
    )
    return catalogue.select(F.to_json(feature).alias("json"))


def read_geojson_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per feature from line-delimited GeoJSON (one feature per line).

    Unlike whole documents, such files split across tasks, so a large landing
    folder is read in parallel.
    """
    rows = spark.read.schema(GEOJSON_FEATURE).option("mode", "PERMISSIVE").json(path)
    return rows.where(F.col("id").isNotNull() | F.col("properties").isNotNull()).select(
        F.struct(*rows.columns).alias("feature")
    )


def write_geojson_documents(features_json: DataFrame, path: str, part: Column, mode: str = "append") -> None:
    """Land feature text (column ``json``) as GeoJSON documents, one file for each
    value of ``part``; a value's features must fit in one row."""
    docs = features_json.groupBy(part.alias("part")).agg(F.collect_list("json").alias("f"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("f", ","), F.lit("]}"))
    docs.select("part", text.alias("value")).write.mode(mode).partitionBy("part").text(path)


def write_geojson_lines(features_json: DataFrame, path: str, mode: str = "append") -> None:
    """Land feature text (column ``json``) as line-delimited GeoJSON files."""
    features_json.select(F.col("json").alias("value")).write.mode(mode).text(path)
