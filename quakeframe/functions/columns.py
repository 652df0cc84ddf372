"""Scalar column expressions (all built-in, JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from quakeframe.schema import RISK_DEFAULT, RISK_TIERS



def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch for a TIMESTAMP or TIMESTAMP_NTZ column.

    TIMESTAMP casts to BIGINT (floor, zone-free). TIMESTAMP_NTZ cannot be cast;
    it is read as UTC wall-clock time from its date and time-of-day fields,
    which do not depend on the session time zone.
    """
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.expr(ntz_seconds_sql(f"`{name}`"))
    return F.col(name).cast("bigint")


def ntz_seconds_sql(c: str) -> str:
    """SQL for the whole seconds of a TIMESTAMP_NTZ expression ``c`` read as UTC
    wall-clock time (zone-free: date and time-of-day fields only)."""
    return (
        f"(CAST(unix_date(CAST({c} AS DATE)) AS BIGINT) * 86400"
        f" + hour({c}) * 3600 + minute({c}) * 60 + second({c}))"
    )


def ntz_millis_sql(c: str) -> str:
    """SQL for the epoch milliseconds (floor) of a TIMESTAMP_NTZ expression
    ``c`` read as UTC wall-clock time (zone-free)."""
    return (
        f"(CAST(unix_date(CAST({c} AS DATE)) AS BIGINT) * 86400000"
        f" + hour({c}) * 3600000 + minute({c}) * 60000"
        f" + CAST(floor(date_part('SECOND', {c}) * 1000) AS BIGINT))"
    )


def epoch_ms_to_timestamp(ms: Column | str) -> Column:
    """Epoch milliseconds to TIMESTAMP, dropping the sub-second part.

    The whole-second part is taken by truncation toward zero, like the source's
    seconds conversion, so pre-1970 instants agree with it.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    whole = ((ms - ms % F.lit(1000)) / F.lit(1000)).cast("bigint")
    return F.timestamp_seconds(whole)


def grid_index(coordinate: Column | str, cell_degrees: float = 0.5) -> Column:
    """Grid cell index of a coordinate: floor(x / cell), BIGINT, negatives downward."""
    c = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    return F.floor(c / F.lit(float(cell_degrees)))


def energy_release(magnitude: Column | str) -> Column:
    """Simplified radiated energy 10^(1.5 M + 4.8)."""
    m = F.col(magnitude) if isinstance(magnitude, str) else magnitude
    return F.pow(F.lit(10.0), F.lit(1.5) * m + F.lit(4.8))


def threshold_label(value: Column | str, threshold: float) -> Column:
    """1 when value >= threshold, else 0 (NULL gives 0)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v >= F.lit(float(threshold)), F.lit(1)).otherwise(F.lit(0))


def class1_probability(probability: Column | str = "probability") -> Column:
    """Probability of class 1 from an MLlib probability vector."""
    from pyspark.ml.functions import vector_to_array

    p = F.col(probability) if isinstance(probability, str) else probability
    return F.when(p.isNotNull(), vector_to_array(p).getItem(1))


def risk_level(probability: Column | str) -> Column:
    """HIGH / MEDIUM / LOW tier of a probability; NULL falls through to LOW."""
    p = F.col(probability) if isinstance(probability, str) else probability
    expr = None
    for bound, label in RISK_TIERS:
        cond = p >= F.lit(bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(RISK_DEFAULT)
