"""A training feature table that follows an appended catalogue.

``maintain`` computes again only the months whose features a write can have changed,
from those months and their neighbours within a frame's reach. It relies on how far
each feature reaches:

* trailing frames (W3-W8) look ``window_days`` back and the label (W9) ``label_days``
  ahead, so a changed month touches those within ``window_days`` after it and
  ``label_days`` before it;
* the gap (W1) looks at the event before in the same network, however old, so a
  changed month touches, for each of its networks, the next month that has the network;
* density (W2) counts the whole cell, so any write touches every month. It is not
  stored: per-month counts per cell are, and ``read_features`` adds them up and joins.

Beside the features lie those counts and the first and last second of each network per
month, over the events of the quality filter; what lies where is decided on them, with
no look at the catalogue. They are replaced after the features, so a run that was cut
off can be done again with the same months, and doing one twice changes nothing.

The (year, month) partitions of the catalogue must not overlap in time. Events without
a time form a partition of their own, which touches no other one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.operators.features import CELL, TRAILING, _null_safe_join, build_features, quality_filter, training_table
from quakeframe.operators.range_window import DAY
from quakeframe.schema import PARTITION_COLUMNS, TRAIN_COLUMNS
from quakeframe.session import delete_folder, folder_exists, materialize
from quakeframe.sources.catalogue import _month_folder, _months_of, month_filter, read_catalogue
from quakeframe.sources.serving_state import CELLS_SCHEMA, NETWORKS_SCHEMA, month_partials

Month = tuple[int | None, int | None]
UNDATED: Month = (None, None)
STORED = [c for c in dict.fromkeys([*TRAIN_COLUMNS, *CELL]) if c != "spatial_density"]
ONLY = {a.name for a in TRAILING} | {"time_since_prev_event"}


@dataclass(frozen=True)
class Maintained:
    """The months whose features were computed again, and those read for it."""

    months: tuple[Month, ...]
    read: tuple[Month, ...]


def _paths(store: str) -> tuple[str, str, str]:
    return tuple(f"{store.rstrip('/')}/{name}" for name in ("features", "cells", "networks"))


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], schema)


def _spans(networks: DataFrame) -> dict[Month, tuple[int, int]]:
    """First and last second of each month: one row per month of the catalogue."""
    spans = networks.groupBy(*PARTITION_COLUMNS).agg(F.min("first_s"), F.max("last_s")).collect()
    return {(r[0], r[1]): (r[2], r[3]) for r in spans}


def _within(spans: dict[Month, tuple[int, int]], lo: int, hi: int) -> set[Month]:
    return {m for m, (first, last) in spans.items() if first <= hi and last >= lo}


def _followers(touched: DataFrame, kept: DataFrame) -> set[Month]:
    """For each network and month of ``touched`` the next month of ``kept`` with the
    network: one row per network and month on either side."""
    t = touched.select(F.col("network").alias("of"), F.col("first_s").alias("since"))
    later = t.join(kept, F.col("of").eqNullSafe(F.col("network")) & (F.col("first_s") > F.col("since")))
    following = later.groupBy("of", "since").agg(F.min(F.struct("first_s", *PARTITION_COLUMNS)).alias("m"))
    return {(r[0], r[1]) for r in following.select("m.year", "m.month").distinct().collect()}


def _runs(wanted: Iterable[Month], spans: dict[Month, tuple[int, int]]) -> list[list[Month]]:
    """Dated months in time order, cut where a month of the catalogue lies in between."""
    order = {m: i for i, m in enumerate(sorted(spans, key=lambda m: spans[m]))}
    runs: list[list[Month]] = []
    for m in sorted((m for m in wanted if m in order), key=order.__getitem__):
        if runs and order[m] == order[runs[-1][-1]] + 1:
            runs[-1].append(m)
        else:
            runs.append([m])
    return runs


def maintain(spark: SparkSession, catalogue_path: str, store: str, months: Iterable[Month] | None = None, window_days: int = 30,
             label_days: int = 30, threshold: float = 4.0, cell_degrees: float = 0.5) -> Maintained:
    """Bring the store up to the catalogue. ``months``: the (year, month) partitions
    that a write changed (``Written.months``); None, or a store that isn't there yet,
    builds all. The other parameters must be those the store was built with."""
    catalogue = quality_filter(read_catalogue(spark, catalogue_path))
    features, cells_path, networks_path = _paths(store)
    known = _months_of(spark, catalogue_path)
    stored = _months_of(spark, features) if folder_exists(spark, features) else set()
    changed = known | stored if months is None or not folder_exists(spark, networks_path) else {tuple(m) for m in months}
    new_cells, new_networks = (materialize(t, "feature-state") for t in month_partials(catalogue.where(month_filter(changed)), cell_degrees))
    old = _state(spark, networks_path, NETWORKS_SCHEMA)
    kept = old.where(~month_filter(changed))
    # An overwritten month also touches what its former events reached.
    touched = new_networks.unionByName(old.where(month_filter(changed)))
    after = kept.unionByName(new_networks)
    spans = _spans(after)
    wanted = set(changed) | _followers(touched, kept)
    for lo, hi in _spans(touched).values():
        wanted |= _within(spans, lo - int(label_days) * DAY, hi + int(window_days) * DAY)
    read: set[Month] = set()
    parts = [([m for m in run], spans[run[0]][0], spans[run[-1]][1]) for run in _runs(wanted, spans)]
    for run, lo, hi in parts:
        near = _within(spans, lo - int(window_days) * DAY, hi + int(label_days) * DAY)
        begins = min(spans[m][0] for m in near)
        before = after.where(F.col("last_s") < begins).groupBy("network").agg(F.max("last_s").alias("last_s"))
        _write(catalogue.where(month_filter(near)), run, before, features, window_days, label_days, threshold, cell_degrees)
        read |= near
    if UNDATED in wanted and UNDATED in known:
        _write(catalogue.where(month_filter([UNDATED])), [UNDATED], None, features, window_days, label_days, threshold, cell_degrees)
        read.add(UNDATED)
    # What a changed month has no rows for any more goes.
    for m in changed:
        if m not in spans and not (m == UNDATED and m in known):
            delete_folder(spark, f"{features}/{_month_folder(m)}")
    for table, path in ((new_cells, cells_path), (new_networks, networks_path)):
        writer = table.repartition(*PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        for m in changed & (_months_of(spark, path) - _months_in(table)):
            delete_folder(spark, f"{path}/{_month_folder(m)}")
    return Maintained(tuple(sorted(wanted & known, key=str)), tuple(sorted(read | (changed & known), key=str)))


def _months_in(state: DataFrame) -> set[Month]:
    return {(r[0], r[1]) for r in state.select(*PARTITION_COLUMNS).distinct().collect()}


def _write(rows: DataFrame, run: list[Month], before: DataFrame | None, path: str, window_days: int, label_days: int,
           threshold: float, cell_degrees: float) -> None:
    built = build_features(rows, window_days, cell_degrees, label_days, threshold, last_before=before, only=ONLY)
    out = built.where(month_filter(run)).select(*STORED, *PARTITION_COLUMNS).hint("rebalance", *PARTITION_COLUMNS)
    out.write.partitionBy(*PARTITION_COLUMNS).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_features(spark: SparkSession, store: str) -> DataFrame:
    """The training table (``features.training_table``): the stored features with the
    density over all months."""
    features, cells, _ = _paths(store)
    density = spark.read.schema(CELLS_SCHEMA).parquet(cells).groupBy(*CELL).agg(F.sum("n_events").alias("spatial_density"))
    return training_table(_null_safe_join(spark.read.parquet(features), density, CELL, []))
