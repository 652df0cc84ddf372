"""Summary statistics of catalogue columns (count, mean, stddev, min, quartiles, max)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.session import materialize

# Statistic names in output order.
STATISTICS = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
QUARTILES = [0.25, 0.5, 0.75]


def summary_stats(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """One row per (column, statistic) name with a DOUBLE value.

    ``exact=False`` (default) uses ``percentile_approx`` like
    ``DataFrame.summary``: a fixed-size sketch per task, merged in one small
    final aggregation. ``exact=True`` computes the quartiles with
    ``exact_quantiles`` (linear interpolation, equal to SQL ``quantile_cont``),
    which stays distributed for columns with any number of distinct values.
    Count, mean, stddev, min and max come from one aggregation with fixed-size
    partials; the result is tiny (8 rows per column).
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        pct = F.lit(None).cast("array<double>") if exact else F.percentile_approx(x, QUARTILES, 10000)
        aggs += [
            F.count(x).cast("double").alias(f"{c}|count"),
            F.avg(x).alias(f"{c}|mean"),
            F.stddev_samp(x).alias(f"{c}|stddev"),
            F.min(x).alias(f"{c}|min"),
            pct.alias(f"{c}|pct"),
            F.max(x).alias(f"{c}|max"),
        ]
    wide = df.agg(*aggs)
    rows = []
    for c in columns:
        p = F.col(f"`{c}|pct`")
        vals = [
            F.col(f"`{c}|count`"),
            F.col(f"`{c}|mean`"),
            F.col(f"`{c}|stddev`"),
            F.col(f"`{c}|min`"),
            p.getItem(0).cast("double"),
            p.getItem(1).cast("double"),
            p.getItem(2).cast("double"),
            F.col(f"`{c}|max`"),
        ]
        rows += [F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), v.alias("value")) for s, v in zip(STATISTICS, vals)]
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    if not exact:
        return out
    # Quartile rows (8 * len(columns) rows on each side) joined on their names.
    name = F.lit(None).cast("string")
    for p, label in zip(QUARTILES, STATISTICS[4:7]):
        name = F.when(F.col("quantile") == p, F.lit(label)).otherwise(name)
    q = exact_quantiles(df, columns, QUARTILES).select("column", name.alias("statistic"), F.col("value").alias("__q"))
    return out.join(q, ["column", "statistic"], "left").select(
        "column", "statistic", F.coalesce("value", "__q").alias("value")
    )


def exact_quantiles(df: DataFrame, columns: list[str], quantiles: list[float], partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (column, quantile, value).

    For n non-NULL values sorted as x_0..x_{n-1}, quantile p is
    ``x_lo + (pos - lo) * (x_hi - x_lo)`` with ``pos = (n-1)p``, lo/hi its floor/ceil
    (SQL ``quantile_cont``). Columns with no values have no rows.

    Nothing holds a whole column in one task:

    1. values are counted per distinct value (map-side combine: a value held by
       a third of all rows is one row after the partial aggregate);
    2. the distinct values are range-partitioned by (column, value) and written,
       each with the number of its partition; ``partitions`` (default: the
       session's shuffle partitions) grows with the data as any shuffle's;
    3. row totals of each column and partition give the rank at which it begins;
    4. only the partitions that hold a wanted rank (at most two per quantile and
       column) get a running count.
    """
    if not columns:
        raise ValueError("give at least one column")
    qs = [float(p) for p in quantiles]
    if any(not 0.0 <= p <= 1.0 for p in qs):
        raise ValueError("quantiles must lie in [0, 1]")
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("r")
    ).select("r.*").where(F.col("v").isNotNull())

    # 1. one row per (column, distinct value), written once.
    counts = materialize(long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")), "quantile-counts")

    # 2. in ranges; the upper bits of the generated id are the partition's number.
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(n_parts, "column", "v").withColumn("bucket", F.shiftright(F.monotonically_increasing_id(), 33))
    bucketed = materialize(ranged, "quantile-ranges")

    # 3. rank at which each partition of a column begins, and the column's row count.
    totals = bucketed.groupBy("column", "bucket").agg(F.sum("n").alias("bn"))
    by_col = Window.partitionBy("column")
    totals = totals.select(
        "column", "bucket", "bn",
        F.coalesce(F.sum("bn").over(by_col.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("bn").over(by_col).alias("total"),
    )

    # Wanted 0-based ranks: floor and ceil of (n-1)p for each quantile, kept
    # only in the bucket whose rank range holds them.
    wanted = totals.select(
        "column", "bucket", "before", "bn", "total",
        F.explode(F.array(*[F.struct(F.lit(p).alias("quantile"), F.lit(side).alias("side")) for p in qs for side in ("lo", "hi")])).alias("w"),
    ).select("*", "w.*").drop("w")
    pos = (F.col("total") - 1).cast("double") * F.col("quantile")
    rank = F.when(F.col("side") == "lo", F.floor(pos)).otherwise(F.ceil(pos)).cast("bigint")
    wanted = wanted.withColumn("rank", rank).where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("bn"))
    ).select("column", "bucket", "before", "total", "quantile", "side", "rank")

    # 4. running counts inside the wanted partitions only (at most 2 per quantile
    #    and column: broadcast size is bounded by the request, not the data).
    target_buckets = wanted.select("column", "bucket").distinct()
    inside = bucketed.join(F.broadcast(target_buckets), ["column", "bucket"])
    w = Window.partitionBy("column", "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.sum("n").over(w))
    hit = inside.join(F.broadcast(wanted), ["column", "bucket"]).where(
        (F.col("rank") >= F.col("before") + F.col("upto") - F.col("n")) & (F.col("rank") < F.col("before") + F.col("upto"))
    )
    picked = hit.groupBy("column", "quantile").agg(
        F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("lo_v"),
        F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("hi_v"),
        F.first("total").alias("total"),
    )
    frac = (F.col("total") - 1).cast("double") * F.col("quantile")
    frac = frac - F.floor(frac)
    value = F.when(F.col("lo_v") == F.col("hi_v"), F.col("lo_v")).otherwise(
        F.col("lo_v") + frac * (F.col("hi_v") - F.col("lo_v"))
    )
    return picked.select("column", "quantile", value.alias("value"))
