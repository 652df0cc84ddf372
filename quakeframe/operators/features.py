"""Feature engineering: temporal, spatial, rolling seismic features and labels.

One builder serves training and serving, so both see the same definitions.
``method="block"`` (default) uses the skew-bounded range and lag operators;
``method="direct"`` uses plain window functions (the simple form; quadratic
in dense cells and one task per cell or network) and is the test oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.functions.columns import (
    energy_release,
    epoch_seconds,
    grid_index,
    threshold_label,
)
from quakeframe.operators.previous_gap import gap_column, plain_keys, previous_second, with_previous_gap
from quakeframe.operators.range_window import (
    DAY,
    Agg,
    deal,
    partial_columns,
    partial_name,
    range_aggregate,
    range_aggregate_direct,
    tasks_for,
)
from quakeframe.schema import FILL_VALUES, SERVE_COLUMNS, TRAIN_COLUMNS
from quakeframe.session import materialize

CELL = ["lat_grid", "lon_grid"]
SEC = "event_s"
ORDER = ["event_time", "event_id"]  # order of events within a network (W1)

# Trailing-frame aggregates (W3-W8). Output names are the feature-table schema
# and do not change with the window length.
TRAILING = [
    Agg("mag_mean_30d", "avg", "magnitude"),
    Agg("mag_max_30d", "max", "magnitude"),
    Agg("mag_std_30d", "stddev", "magnitude"),
    Agg("event_count_30d", "count", "event_id"),
    Agg("depth_mean_30d", "avg", "depth_km"),
    Agg("cumulative_energy_30d", "sum", "energy_release"),
]
LEADING = [Agg("future_max_mag", "max", "magnitude")]


#: Events that one task takes on average where the results are attached to them.
ROWS_PER_TASK = 1 << 17


def quality_filter(df: DataFrame) -> DataFrame:
    """Keep events with magnitude, latitude, longitude and magnitude >= 0."""
    return df.where(
        F.col("magnitude").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & (F.col("magnitude") >= 0)
    )


def with_seconds(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Add ``event_s`` (whole epoch seconds) unless it is there already."""
    if SEC in df.columns:
        return df
    return df.withColumn(SEC, epoch_seconds(df, time_col))


def calendar_parts(df: DataFrame) -> DataFrame:
    """hour, day_of_week (1 = Sunday), day_of_year of event_time."""
    return df.select(
        "*",
        F.hour("event_time").alias("hour"),
        F.dayofweek("event_time").alias("day_of_week"),
        F.dayofyear("event_time").alias("day_of_year"),
    )


def temporal_features(df: DataFrame, method: str = "block") -> DataFrame:
    """hour, day_of_week (1 = Sunday), day_of_year, time_since_prev_event per network."""
    df = calendar_parts(with_seconds(df))
    if method == "direct":
        w = Window.partitionBy("network").orderBy(*ORDER)
        return df.withColumn(
            "time_since_prev_event", F.col(SEC) - F.lag(SEC).over(w)
        )
    return with_previous_gap(df, "network", SEC, ORDER)


def spatial_cells(df: DataFrame, cell_degrees: float = 0.5) -> DataFrame:
    """lat_grid / lon_grid: floor(coordinate / cell_degrees)."""
    return df.select(
        "*",
        grid_index("latitude", cell_degrees).alias("lat_grid"),
        grid_index("longitude", cell_degrees).alias("lon_grid"),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], extra_eq: list[str]) -> DataFrame:
    """Left join on null-safe ``keys`` and plain-equality ``extra_eq`` columns."""
    r = right.select(*[F.col(c).alias("__r_" + c) for c in keys + extra_eq],
                     *[c for c in right.columns if c not in keys + extra_eq])
    cond = [left[c].eqNullSafe(r["__r_" + c]) for c in keys] + [left[c] == r["__r_" + c] for c in extra_eq]
    return left.join(r, on=cond, how="left").drop(*["__r_" + c for c in keys + extra_eq])


def seismic_features(
    df: DataFrame,
    window_days: int = 30,
    label_days: int | None = None,
    threshold: float = 4.0,
    method: str = "block",
) -> DataFrame:
    """Spatial density, trailing-window statistics, energy and (optionally) labels.

    Needs ``lat_grid``/``lon_grid`` (``spatial_cells``). With ``label_days`` set,
    also the look-ahead max magnitude and the labels.
    """
    df = with_seconds(df).withColumn("energy_release", energy_release("magnitude"))
    return _add_labels(_join_stats(df, _cell_stats(df, window_days, label_days, method), method), label_days, threshold)


def _frames(window_days: int, label_days: int | None):
    trailing = (int(window_days) * DAY, TRAILING)
    leading = (int(label_days) * DAY, LEADING) if label_days else None
    # Spatial density (a count over the whole cell) comes from the same
    # per-second table as the frames, so the raw rows are read once for both.
    return trailing, leading, [Agg("spatial_density", "count", "event_id")]


def _cell_stats(df: DataFrame, window_days: int, label_days: int | None, method: str) -> DataFrame:
    trailing, leading, whole = _frames(window_days, label_days)
    if method == "direct":
        return range_aggregate_direct(df, CELL, SEC, trailing, leading)
    return range_aggregate(df, CELL, SEC, trailing, leading, whole=whole)


def _join_stats(df: DataFrame, stats: DataFrame, method: str) -> DataFrame:
    if method == "direct":
        dens = Window.partitionBy(*CELL)
        df = df.withColumn("spatial_density", F.count("event_id").over(dens))
    return _null_safe_join(df, stats, CELL, [SEC])


def _add_labels(df: DataFrame, label_days: int | None, threshold: float) -> DataFrame:
    if not label_days:
        return df
    return df.withColumn("has_aftershock", threshold_label("future_max_mag", threshold)).withColumn(
        "aftershock_magnitude", F.coalesce(F.col("future_max_mag"), F.lit(0.0))
    )


def build_features(
    df: DataFrame,
    window_days: int = 30,
    cell_degrees: float = 0.5,
    label_days: int | None = 30,
    threshold: float = 4.0,
    method: str = "block",
    cell_counts: DataFrame | None = None,
    last_before: DataFrame | None = None,
    only: set[str] | None = None,
) -> DataFrame:
    """All feature columns on top of the catalogue columns (no projection, no fill).

    ``only``: names out of the trailing features, ``spatial_density`` and
    ``time_since_prev_event``; what isn't named isn't computed.

    ``df`` may be a recent part of a catalogue. What reaches back before it then
    comes from the caller: ``cell_counts`` (lat_grid, lon_grid, spatial_density)
    over the whole catalogue and ``last_before`` (network, last_s), the last
    second of each network before ``df`` begins (``history_context`` makes both).

    The raw rows are read twice: once grouped to one row per
    (cell, network, second) with every partial aggregate and the first
    (event_time, event_id) of that second, written once; and once at the end to
    attach the results. The per-cell statistics merge that table to
    (cell, second), the per-network gap merges it to (network, second), and
    its keys are the distinct (cell, network, second) join keys, so the wide
    rows are shuffled once, to a number of tasks that follows their count.
    """
    base = spatial_cells(with_seconds(df), cell_degrees).withColumn(
        "energy_release", energy_release("magnitude")
    )
    if method == "direct":
        stats = _cell_stats(base, window_days, label_days, method)
        out = _join_stats(temporal_features(base, method), stats, method)
        return _add_labels(out, label_days, threshold)
    unknown = (only or set()) - {a.name for a in TRAILING} - {"spatial_density", "time_since_prev_event"}
    if unknown:
        raise ValueError(f"unknown features {sorted(unknown)}")
    trailing, leading, _ = _frames(window_days, label_days)
    asked = [a for a in TRAILING if only is None or a.name in only]
    trailing = (trailing[0], asked) if asked else None
    with_density = only is None or "spatial_density" in only
    with_gap = only is None or "time_since_prev_event" in only
    partials = partial_columns(trailing, leading, [Agg("spatial_density", "count", "event_id")] if with_density else None)
    # The first event of a second is known by its order and its cell, so that
    # of equal events in several cells one is the first.
    first_of = ORDER + CELL
    if with_gap:
        partials.append(F.min(F.struct(*first_of)).alias("__first"))
    if not partials:
        return calendar_parts(base)
    group = CELL + (["network"] if with_gap else []) + [SEC]
    partials.append(F.count(F.lit(1)).alias("__rows"))
    per_key = materialize(base.groupBy(*group).agg(*partials), "per-second-keys")
    n_keys, n_rows = per_key.agg(F.count(F.lit(1)), F.coalesce(F.sum("__rows"), F.lit(0))).first()
    tasks = tasks_for(df.sparkSession, n_keys)
    row_tasks = tasks_for(df.sparkSession, n_rows, ROWS_PER_TASK)
    combo = per_key.select(*group)
    if with_gap:
        prev = previous_second(per_key, "network", SEC, first_of, pre_aggregated=True, tasks=tasks)
        if last_before is not None:
            prev = _null_safe_join(prev, last_before, ["network"], [])
            prev = prev.withColumn("__prev", F.coalesce("__prev", "last_s")).drop("last_s")
        combo = _null_safe_join(combo, prev, ["network"], [SEC])
    if trailing or leading:
        combo = _null_safe_join(combo, range_aggregate(per_key, CELL, SEC, trailing, leading, pre_aggregated=True, tasks=tasks), CELL, [SEC])
    if with_density:
        # Density counts the whole cell, also its events without a time.
        in_cell = cell_counts
        if in_cell is None:
            in_cell = per_key.groupBy(*CELL).agg(F.sum(partial_name("count", "event_id")).alias("spatial_density"))
        combo = _null_safe_join(combo, in_cell, CELL, [])
    rows, on = plain_keys(calendar_parts(base), group)
    combo, _ = plain_keys(combo, group)
    rows = deal(rows, row_tasks, on)
    if with_gap:
        # Before the join, which is clustered alike: one exchange and one sort serve both.
        rows = rows.withColumn("__nth", F.row_number().over(Window.partitionBy(*on).orderBy(*ORDER)))
    out = rows.join(deal(combo.drop(*group), row_tasks, on), on, "left")
    if not with_gap:
        return _add_labels(out.drop(*on), label_days, threshold)
    out = out.withColumn("time_since_prev_event", gap_column(first_of, SEC, "__nth")).drop("__first", "__prev", "__nth", *on)
    return _add_labels(out, label_days, threshold)


def history_context(catalogue: DataFrame, begins, cell_degrees: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(cell_counts, last_before) for ``build_features`` over the rows of
    ``catalogue`` from ``begins`` on. Each reads only the columns it counts; their
    size is the number of cells and of networks."""
    counts = spatial_cells(catalogue, cell_degrees).groupBy(*CELL).agg(F.count("event_id").alias("spatial_density"))
    before = with_seconds(catalogue).where(F.col("event_time") < F.lit(str(begins)).cast(catalogue.schema["event_time"].dataType))
    return counts, before.groupBy("network").agg(F.max(SEC).alias("last_s"))


def spatial_density(df: DataFrame, cell_degrees: float = 0.5) -> DataFrame:
    """``df`` with its cell and ``spatial_density`` alone: one count per cell and
    one join, for callers that need no other feature."""
    base = spatial_cells(df, cell_degrees)
    return _null_safe_join(base, base.groupBy(*CELL).agg(F.count("event_id").alias("spatial_density")), CELL, [])


def training_table(features: DataFrame) -> DataFrame:
    """The 24-column training table with NULL defaults filled."""
    return features.select(*TRAIN_COLUMNS).fillna(FILL_VALUES)


def serving_table(features: DataFrame) -> DataFrame:
    """The 23-column serving table (no labels, plus place) with NULL defaults filled."""
    return features.select(*SERVE_COLUMNS).fillna(FILL_VALUES)


def training_features(
    catalogue: DataFrame,
    window_days: int = 30,
    label_days: int = 30,
    threshold: float = 4.0,
    cell_degrees: float = 0.5,
    method: str = "block",
) -> DataFrame:
    """Quality filter → features → labels → training projection → fill."""
    feats = build_features(
        quality_filter(catalogue), window_days, cell_degrees, label_days, threshold, method
    )
    return training_table(feats)


def serving_features(
    catalogue: DataFrame,
    window_days: int = 30,
    cell_degrees: float = 0.5,
    apply_quality_filter: bool = False,
    method: str = "block",
    cell_counts: DataFrame | None = None,
    last_before: DataFrame | None = None,
) -> DataFrame:
    """Features for scoring: same builder, no labels; quality filter off by default."""
    src = quality_filter(catalogue) if apply_quality_filter else catalogue
    feats = build_features(src, window_days, cell_degrees, None, 4.0, method, cell_counts, last_before)
    return serving_table(feats)
