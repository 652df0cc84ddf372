"""Request windows: cut [start, end) into fixed-length chunks.

The source service is queried one window at a time; here the windows are a
small DataFrame built with ``sequence`` (its size is (end - start) / chunk,
independent of the data), and ``events_per_window`` counts landed events per
window with a derived window index, so an empty window shows as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.functions.columns import ntz_seconds_sql

_NTZ = "TIMESTAMP_NTZ'{}'"


def request_windows(spark: SparkSession, start: str, end: str, chunk_days: int = 30) -> DataFrame:
    """Windows ``[window_start, window_end)`` stepping ``chunk_days`` from ``start``.

    The last window is clipped to ``end``; none when ``start >= end``.
    Columns: window_index (int), window_start, window_end (TIMESTAMP_NTZ).
    """
    if int(chunk_days) < 1:
        raise ValueError("chunk_days must be >= 1")
    s = _NTZ.format(f"{start} 00:00:00" if len(start) == 10 else start)
    e = _NTZ.format(f"{end} 00:00:00" if len(end) == 10 else end)
    starts = F.expr(
        f"CASE WHEN {s} < {e} THEN sequence({s}, {e}, INTERVAL {int(chunk_days)} DAYS) "
        f"ELSE CAST(array() AS ARRAY<TIMESTAMP_NTZ>) END"
    )
    w = spark.range(1).select(F.posexplode(starts).alias("window_index", "window_start"))
    return w.where(F.col("window_start") < F.expr(e)).select(
        F.col("window_index").cast("int").alias("window_index"),
        "window_start",
        F.least(F.col("window_start") + F.expr(f"INTERVAL {int(chunk_days)} DAYS"), F.expr(e)).alias("window_end"),
    )


def events_per_window(
    events: DataFrame, windows: DataFrame, start: str, end: str, chunk_days: int = 30, time_col: str = "event_time"
) -> DataFrame:
    """Window table with ``n_events`` landed in each window (0 when none).

    Events outside ``[start, end)`` belong to no window (the last window is
    clipped to ``end``). The others are counted per derived window index (a
    partial aggregate), then the tiny window table is joined on that index.
    """
    s = _NTZ.format(f"{start} 00:00:00" if len(start) == 10 else start)
    e = _NTZ.format(f"{end} 00:00:00" if len(end) == 10 else end)
    events = events.where(f"CAST(`{time_col}` AS TIMESTAMP_NTZ) >= {s} AND CAST(`{time_col}` AS TIMESTAMP_NTZ) < {e}")
    span = int(chunk_days) * 86400
    since = f"{ntz_seconds_sql(f'CAST(`{time_col}` AS TIMESTAMP_NTZ)')} - {ntz_seconds_sql(s)}"
    idx = F.floor(F.expr(since) / F.lit(span))
    counts = events.select(idx.cast("int").alias("window_index")).groupBy("window_index").agg(
        F.count(F.lit(1)).alias("n_events")
    )
    return windows.join(counts, "window_index", "left").select(
        "window_index", "window_start", "window_end", F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events")
    )
