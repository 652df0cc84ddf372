"""State kept beside a catalogue, so that scoring recent events needs no scan of it.

Two small tables hold what features reach back for without limit:

* cells: per (year, month) and grid cell, the events with an id (``spatial_density``
  sums them over all months);
* networks: per (year, month) and network, the first and the last second with an event
  (the gap before a network's first recent event).

Both are partitioned like the catalogue. ``maintain`` recomputes the months that a
write touched from those partitions alone and replaces them, so running it again,
after a lost driver too, gives the same state. Sizes are bounded by months times
cells and months times networks, not by events.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.operators.features import CELL, SEC, spatial_cells, with_seconds
from quakeframe.schema import PARTITION_COLUMNS
from quakeframe.session import delete_folder, folder_exists
from quakeframe.sources.catalogue import _month_folder, _months_of, month_filter, read_catalogue

CELLS_SCHEMA = "lat_grid bigint, lon_grid bigint, n_events bigint, year int, month int"
NETWORKS_SCHEMA = "network string, first_s bigint, last_s bigint, year int, month int"


def state_path(catalogue_path: str) -> str:
    return catalogue_path.rstrip("/") + "_state"


def _cells_path(catalogue_path: str, cell_degrees: float) -> str:
    return f"{state_path(catalogue_path)}/cells_{float(cell_degrees)}"


def _networks_path(catalogue_path: str) -> str:
    return f"{state_path(catalogue_path)}/networks"


def has_state(spark: SparkSession, catalogue_path: str, cell_degrees: float = 0.5) -> bool:
    return all(folder_exists(spark, p) for p in (_cells_path(catalogue_path, cell_degrees), _networks_path(catalogue_path)))


def month_partials(catalogue: DataFrame, cell_degrees: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """The rows of both state tables for the months in ``catalogue``."""
    cells = spatial_cells(catalogue, cell_degrees).groupBy(*CELL, *PARTITION_COLUMNS).agg(F.count("event_id").alias("n_events"))
    seconds = with_seconds(catalogue).where(F.col(SEC).isNotNull())
    networks = seconds.groupBy("network", *PARTITION_COLUMNS).agg(F.min(SEC).alias("first_s"), F.max(SEC).alias("last_s"))
    return (
        cells.select(*CELL, "n_events", *PARTITION_COLUMNS),
        networks.select("network", "first_s", "last_s", *PARTITION_COLUMNS),
    )


def maintain(spark: SparkSession, catalogue_path: str, months=None, cell_degrees: float = 0.5) -> None:
    """Bring the state up to the catalogue. ``months``: the (year, month) partitions
    that changed (``Written.months``); None rebuilds all, and months that the
    catalogue does not have any more go."""
    catalogue = read_catalogue(spark, catalogue_path)
    if months is not None:
        catalogue = catalogue.where(month_filter(months))
    targets = _cells_path(catalogue_path, cell_degrees), _networks_path(catalogue_path)
    for table, path in zip(month_partials(catalogue, cell_degrees), targets, strict=True):
        writer = table.repartition(*PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        if months is None:
            for gone in _months_of(spark, path) - _months_of(spark, catalogue_path):
                delete_folder(spark, f"{path}/{_month_folder(gone)}")


def read_cells(spark: SparkSession, catalogue_path: str, cell_degrees: float = 0.5) -> DataFrame:
    return spark.read.schema(CELLS_SCHEMA).parquet(_cells_path(catalogue_path, cell_degrees))


def read_networks(spark: SparkSession, catalogue_path: str) -> DataFrame:
    return spark.read.schema(NETWORKS_SCHEMA).parquet(_networks_path(catalogue_path))


def context(spark: SparkSession, catalogue_path: str, begins: dt.date, cell_degrees: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(cell_counts, last_before) for ``build_features`` over the events from
    ``begins`` on, as ``features.history_context`` gives them, but from the state
    and, for the days of its month before ``begins``, that month's partition."""
    cells = read_cells(spark, catalogue_path, cell_degrees)
    counts = cells.groupBy(*CELL).agg(F.sum("n_events").alias("spatial_density"))
    earlier = (F.col("year") < begins.year) | ((F.col("year") == begins.year) & (F.col("month") < begins.month))
    before = read_networks(spark, catalogue_path).where(earlier).select("network", "last_s")
    own = read_catalogue(spark, catalogue_path).where(month_filter([(begins.year, begins.month)]))
    own = own.where(F.col("event_time") < F.lit(begins.isoformat()).cast(own.schema["event_time"].dataType))
    own = with_seconds(own).select("network", F.col(SEC).alias("last_s"))
    return counts, before.unionByName(own).groupBy("network").agg(F.max("last_s").alias("last_s"))
