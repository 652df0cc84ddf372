"""Scoring outputs: class-1 probability, risk tiers, tier report, top-N,
hypothetical scenarios and the rows the vector step drops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.functions.columns import class1_probability, energy_release, risk_level
from quakeframe.schema import LABEL, PREDICTORS, REPORT_COLUMNS, RISK_DEFAULT, RISK_TIERS


def with_risk(scored: DataFrame, probability_col: str = "probability") -> DataFrame:
    """Add ``aftershock_probability`` (class 1 of the probability vector) and ``risk_level``."""
    out = scored.withColumn("aftershock_probability", class1_probability(probability_col))
    return out.withColumn("risk_level", risk_level("aftershock_probability"))


def risk_report(scored: DataFrame) -> DataFrame:
    """One row: total and count / percent per tier, from one aggregation.

    Percent is NULL on empty input instead of a division error.
    """
    total = F.count(F.lit(1))
    cols = [total.alias("total_events")]
    for label in [t for _, t in RISK_TIERS] + [RISK_DEFAULT]:
        n = F.count_if(F.col("risk_level") == label)
        key = label.lower()
        cols += [n.alias(f"{key}_risk"), F.try_divide(F.lit(100.0) * n, total).alias(f"{key}_risk_pct")]
    return scored.agg(*cols)


def top_risk(scored: DataFrame, top_n: int = 20) -> DataFrame:
    """The ``top_n`` events with the highest probability (ties by event_id).

    Planned as a TakeOrderedAndProject: each task keeps its own top N, then
    one task merges at most N rows per task.
    """
    return scored.select(*REPORT_COLUMNS).orderBy(
        F.col("aftershock_probability").desc_nulls_last(), F.col("event_id").asc()
    ).limit(int(top_n))


def _incomplete(columns: list[str]):
    bad = F.lit(False)
    for c in columns:
        x = F.col(c)
        bad = bad | x.isNull() | F.isnan(x.cast("double"))
    return bad


def complete_rows(df: DataFrame, columns: list[str] = PREDICTORS) -> DataFrame:
    """The rows that the vector step keeps."""
    return df.where(~_incomplete(columns))


def vector_skip_count(df: DataFrame, columns: list[str] = PREDICTORS) -> DataFrame:
    """Rows total / kept / dropped by the vector step (NULL or NaN in any predictor)."""
    bad = _incomplete(columns)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~bad).alias("kept_rows"),
        F.count_if(bad).alias("dropped_rows"),
    )


def scenario_features(scenarios: DataFrame) -> DataFrame:
    """Predictor rows for hypothetical events.

    Input: magnitude, depth_km, latitude, longitude, and optionally
    recent_magnitude_mean and recent_event_count (NULL or 0 = not given).
    Fixed values (defaults of a hypothetical event): significance = M*100,
    num_stations 10, gap 100, rms 0.5, hour 12, day_of_week 3, day_of_year 180,
    time_since_prev_event 3600, spatial_density 5, mag_mean_30d = given mean or M,
    mag_max_30d = 1.2*M, mag_std_30d 0.5, event_count_30d = given count or 10,
    depth_mean_30d = depth, energy_release = 10^(1.5M+4.8),
    cumulative_energy_30d = 10^(1.5M+5.5).
    """
    m = F.col("magnitude").cast("double")
    cols = scenarios.columns
    mean_in = F.col("recent_magnitude_mean") if "recent_magnitude_mean" in cols else F.lit(None)
    count_in = F.col("recent_event_count") if "recent_event_count" in cols else F.lit(None)
    keep = [c for c in cols if c not in PREDICTORS and c not in ("recent_magnitude_mean", "recent_event_count")]
    return scenarios.select(
        *keep,
        m.alias("magnitude"),
        F.col("depth_km").cast("double").alias("depth_km"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        (m * F.lit(100.0)).alias("significance"),
        F.lit(10).alias("num_stations"),
        F.lit(100.0).alias("gap"),
        F.lit(0.5).alias("rms"),
        F.lit(12).alias("hour"),
        F.lit(3).alias("day_of_week"),
        F.lit(180).alias("day_of_year"),
        F.lit(3600).cast("bigint").alias("time_since_prev_event"),
        F.lit(5).cast("bigint").alias("spatial_density"),
        F.coalesce(F.nullif(mean_in.cast("double"), F.lit(0.0)), m).alias("mag_mean_30d"),
        (m * F.lit(1.2)).alias("mag_max_30d"),
        F.lit(0.5).alias("mag_std_30d"),
        F.coalesce(F.nullif(count_in.cast("bigint"), F.lit(0).cast("bigint")), F.lit(10).cast("bigint")).alias("event_count_30d"),
        F.col("depth_km").cast("double").alias("depth_mean_30d"),
        energy_release(m).alias("energy_release"),
        F.pow(F.lit(10.0), F.lit(1.5) * m + F.lit(5.5)).alias("cumulative_energy_30d"),
    )


def scored_sample(model, rows: DataFrame, n: int = 10, key: str = "event_id") -> DataFrame:
    """The first ``n`` rows by ``key`` that the model scores: key, label, prediction
    and class-1 probability. The rows are chosen before they are scored."""
    chosen = complete_rows(rows).orderBy(key).limit(n)
    return with_risk(model.transform(chosen)).select(key, LABEL, "prediction", "aftershock_probability").orderBy(key)
