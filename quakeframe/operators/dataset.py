"""Training-set preparation: temporal split and the counts reported about it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.schema import LABEL


def temporal_split(
    df: DataFrame, split_at: str = "2024-11-01", embargo_days: int = 0, time_col: str = "event_time"
) -> tuple[DataFrame, DataFrame]:
    """Train: ``time < split_at - embargo``; test: ``time >= split_at``.

    Rows with a NULL time are in neither. ``embargo_days`` (default 0, the
    source behaviour) drops training rows whose look-ahead labels could see
    the test period.
    """
    cut = F.lit(split_at).cast(df.schema[time_col].dataType)
    train_cut = cut - F.expr(f"INTERVAL {int(embargo_days)} DAYS") if embargo_days else cut
    return df.where(F.col(time_col) < train_cut), df.where(F.col(time_col) >= cut)


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def label_prevalence(df: DataFrame, label: str = LABEL) -> DataFrame:
    """total, positives and percent positive (NULL percent on empty input)."""
    total = F.count(F.lit(1))
    pos = F.count_if(F.col(label) == 1)
    return df.agg(
        total.alias("total_events"),
        pos.alias("aftershock_events"),
        F.try_divide(F.lit(100.0) * pos, total).alias("aftershock_pct"),
    )


def split_sizes(df: DataFrame, split_at: str = "2024-11-01", time_col: str = "event_time") -> DataFrame:
    """Train and test row counts from one aggregation."""
    cut = F.lit(split_at).cast(df.schema[time_col].dataType)
    return df.agg(
        F.count_if(F.col(time_col) < cut).alias("train_count"),
        F.count_if(F.col(time_col) >= cut).alias("test_count"),
    )


def with_label_complete(df: DataFrame, label_days: int, time_col: str = "event_time") -> DataFrame:
    """Adds ``label_complete``: whether the look-ahead of ``label_days`` lies inside the
    table's time span, so that a negative label is known and not merely unseen.
    NULL for rows without a time."""
    end = df.agg(F.max(time_col).alias("__end"))  # one row
    seen = F.col(time_col) + F.expr(f"INTERVAL {int(label_days)} DAYS") <= F.col("__end")
    return df.crossJoin(F.broadcast(end)).withColumn("label_complete", seen).drop("__end")
