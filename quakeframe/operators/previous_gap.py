"""Seconds since the previous event of the same key, without one window per key.

Equivalent to ``seconds - lag(seconds)`` over ``Window.partitionBy(key)
.orderBy(*order)`` when ``order`` starts with the event time: the first row of a
second gets the distance to the latest earlier second of its key (NULL if none),
every later row of the same second gets 0. Of rows that are equal in ``order``
exactly one is the first.

A key such as a seismic network can hold a third of all rows, so a window per
key would be one task. Instead:

1. one row per (key, second) with the first ``order`` tuple (map-side partial);
2. the previous second inside a day block by ``lag`` over (key, block),
   at most 86,400 rows each;
3. for the first second of a block, the last second of the nearest earlier
   non-empty block, from a per-(key, block) table (one row per day with events).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.operators.range_window import DAY, deal, tasks_for
from quakeframe.session import materialize as materialize_table


def previous_second(df: DataFrame, key: str, seconds: str, order: list[str], block_seconds: int = DAY,
                    materialize: bool = True, pre_aggregated: bool = False, tasks: int | None = None) -> DataFrame:
    """Per (key, second): ``__first`` (min struct of ``order``) and ``__prev`` second.

    ``materialize`` writes the per-second table once to the shared folder so its
    two consumers do not each re-aggregate the raw rows. With
    ``pre_aggregated=True``, ``df`` already has a ``__first`` column (the min
    struct of ``order``) at a grain at least as fine as (key, second); it is
    merged with ``min`` and nothing is written. ``tasks`` as in ``range_aggregate``.
    """
    B = int(block_seconds)
    rows = df.where(F.col(seconds).isNotNull())
    block = F.floor(F.col(seconds) / F.lit(B)).cast("bigint")
    if pre_aggregated:
        # Dealt by (key, block), which serves the seconds and the blocks alike.
        dealt = deal(rows.withColumn("__b", block), tasks, [key, "__b"])
        per_sec = dealt.groupBy(key, "__b", F.col(seconds).alias("__s")).agg(F.min("__first").alias("__first"))
    else:
        grouped = rows.groupBy(key, F.col(seconds).alias("__s")).agg(F.min(F.struct(*order)).alias("__first"))
        if materialize:
            grouped = materialize_table(grouped, "per-second-gap")
            tasks = tasks or tasks_for(df.sparkSession, grouped.count())
        per_sec = grouped.withColumn("__b", F.floor(F.col("__s") / F.lit(B)).cast("bigint"))
    carry = (
        per_sec.groupBy(key, "__b")
        .agg(F.max("__s").alias("__last"))
        .select(
            key,
            "__b",
            (F.col("__b") * F.lit(B) - F.lit(1)).alias("__ord"),
            F.lag("__last").over(Window.partitionBy(key).orderBy("__b")).alias("__v"),
            F.lit(None).cast(per_sec.schema["__first"].dataType).alias("__first"),
            F.lit(1).alias("__kind"),
        )
    )
    data = per_sec.select(
        key,
        "__b",
        F.col("__s").alias("__ord"),
        F.col("__s").alias("__v"),
        "__first",
        F.lit(0).alias("__kind"),
    )
    w = Window.partitionBy(key, "__b").orderBy("__ord")
    return (
        deal(data.unionByName(carry), tasks, [key, "__b"])
        .select(key, "__ord", "__first", "__kind", F.lag("__v").over(w).alias("__prev"))
        .where(F.col("__kind") == 0)
        .select(key, F.col("__ord").alias(seconds), "__first", "__prev")
    )


def with_previous_gap(
    df: DataFrame,
    key: str,
    seconds: str,
    order: list[str],
    out: str = "time_since_prev_event",
    block_seconds: int = DAY,
) -> DataFrame:
    """Add ``out`` (BIGINT seconds since the previous event of ``key``) to ``df``."""
    prev = previous_second(df, key, seconds, order, block_seconds)
    prev = prev.select(F.col(key).alias("__k"), F.col(seconds).alias("__sec"), "__first", "__prev")
    left, on = plain_keys(df, [key, seconds])
    right, _ = plain_keys(prev, ["__k", "__sec"])
    joined = left.join(right, on, "left")
    # Clustered as the join is, so the window needs no exchange of its own.
    nth = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    joined = joined.withColumn("__nth", nth)
    return joined.withColumn(out, gap_column(order, seconds, "__nth")).drop("__k", "__sec", "__first", "__prev", "__nth", *on)


def plain_keys(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with two never-NULL columns for each of ``columns``, and their names: a
    plain join or window over them treats NULLs as equal, and one can follow the
    other without a new exchange."""
    names = []
    for i, c in enumerate(columns):
        zero = F.lit("" if dict(df.dtypes)[c] == "string" else 0).cast(df.schema[c].dataType)
        names += [f"__j{i}", f"__j{i}_null"]
        df = df.withColumns({f"__j{i}": F.coalesce(F.col(c), zero), f"__j{i}_null": F.col(c).isNull()})
    return df, names


def gap_column(first_of: list[str], seconds: str, nth: str) -> Column:
    """The gap of a row joined to its (key, second) entry of ``previous_second``
    (columns ``__first``, ``__prev``): NULL when unmatched, the distance to the
    previous second for the first row of its second, 0 for later rows. ``nth``:
    the row's number, in the order, among rows of its second that agree in what
    ``first_of`` has beyond the order."""
    first = F.struct(*[F.col(c) for c in first_of]).eqNullSafe(F.col("__first")) & (F.col(nth) == 1)
    gap = F.when(F.col("__first").isNull(), F.lit(None)).when(
        first, F.col(seconds) - F.col("__prev")
    ).otherwise(F.lit(0))
    return gap.cast("bigint")
