"""Catalogue Parquet: partitioned sink, typed scans, pruned recent-event scan,
feature and prediction sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.schema import CATALOGUE, PARTITION_COLUMNS, PREDICTION_COLUMNS
from quakeframe.session import add_files, delete_folder, folder_exists, replace_folder, subfolders


@dataclass(frozen=True)
class Written:
    """What a write put down: rows and the (year, month) partitions they went to.
    False when there were no rows."""

    rows: int
    months: tuple[tuple[int | None, int | None], ...]

    def __bool__(self) -> bool:
        return self.rows > 0


def write_catalogue(df: DataFrame, path: str, mode: str = "overwrite", dynamic_overwrite: bool = False) -> Written:
    """Write catalogue rows partitioned by year/month. An empty ``df`` changes
    nothing at ``path``; the result is then false.

    ``df`` is evaluated once, into a folder beside ``path``. Its partition folders
    tell whether there is anything and which months it touches; then they are moved
    in, month by month. ``overwrite`` replaces every partition (like the source
    pipeline): those of ``df`` are replaced and those it does not have deleted;
    ``dynamic_overwrite=True`` keeps the latter; ``append`` adds files to the months.
    A rebalance hint on (year, month) lets AQE give small months to one task
    each and cut a month that holds most rows over many tasks.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    spark, path = df.sparkSession, path.rstrip("/")
    beside = f"{path}.writing-{uuid.uuid4().hex}"
    df.hint("rebalance", *PARTITION_COLUMNS).write.partitionBy(*PARTITION_COLUMNS).parquet(beside)
    months = tuple(sorted(_months_of(spark, beside), key=str))
    if not months:
        delete_folder(spark, beside)
        return Written(0, ())
    rows = spark.read.schema(CATALOGUE).parquet(beside).count()  # from the files' footers
    for month in months:
        new, old = f"{beside}/{_month_folder(month)}", f"{path}/{_month_folder(month)}"
        if mode == "append" and folder_exists(spark, old):
            add_files(spark, new, old)
        else:
            replace_folder(spark, new, old)
    if mode == "overwrite" and not dynamic_overwrite:
        for month in _months_of(spark, path) - set(months):
            delete_folder(spark, f"{path}/{_month_folder(month)}")
    delete_folder(spark, beside)
    return Written(rows, months)


def _month_folder(month: tuple[int | None, int | None]) -> str:
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(PARTITION_COLUMNS, month, strict=True))


def _months_of(spark: SparkSession, path: str) -> set[tuple[int | None, int | None]]:
    """Partitions at ``path``, from its folders' names."""
    out = set()
    for year in subfolders(spark, path):
        for month in subfolders(spark, f"{path.rstrip('/')}/{year}"):
            values = [x.split("=", 1)[1] for x in (year, month)]
            out.add(tuple(None if v == "__HIVE_DEFAULT_PARTITION__" else int(v) for v in values))
    return out


def month_filter(months):
    """Rows in the given (year, month) partitions; a plain predicate on partition
    columns, so the others are not read."""
    cond = F.lit(False)
    for year, month in months:
        cond = cond | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return cond


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Typed catalogue scan (no inference; partition columns from the path)."""
    return spark.read.schema(CATALOGUE).parquet(path)


def recent_cutoff(as_of: str | dt.date | dt.datetime, days_back: int) -> dt.date:
    """Midnight of (as_of - days_back) as a date."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return as_of - dt.timedelta(days=int(days_back))


def partition_floor(cutoff: dt.date):
    """Partition predicate implied by ``event_time >= cutoff``: (year, month) >= cutoff's."""
    y, m = cutoff.year, cutoff.month
    return (F.col("year") > y) | ((F.col("year") == y) & (F.col("month") >= m))


def recent_filter(df: DataFrame, as_of, days_back: int = 7, time_col: str = "event_time") -> DataFrame:
    """Rows with ``time_col >= midnight(as_of - days_back)``."""
    cutoff = recent_cutoff(as_of, days_back)
    return df.where(F.col(time_col) >= F.lit(cutoff.isoformat()).cast(df.schema[time_col].dataType))


def recent_events(spark: SparkSession, path: str, as_of, days_back: int = 7) -> DataFrame:
    """Recent-event scan: the time filter plus the (year, month) predicate it
    implies, so only the needed partitions are listed and read.

    ``as_of`` replaces the wall clock so the result is reproducible.
    """
    cutoff = recent_cutoff(as_of, days_back)
    return recent_filter(read_catalogue(spark, path).where(partition_floor(cutoff)), as_of, days_back)


def write_features(df: DataFrame, path: str) -> None:
    """Feature table sink (unpartitioned, overwrite)."""
    df.write.mode("overwrite").parquet(path)


def write_predictions(scored: DataFrame, path: str) -> bool:
    """Prediction sink: the 10 chosen columns, overwrite. An empty input writes
    nothing and gives False. ``scored`` is evaluated once: it is written beside
    ``path``, looked at there, and moved in place."""
    spark = scored.sparkSession
    beside = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"
    out = scored.select(*PREDICTION_COLUMNS)
    out.write.parquet(beside)
    if spark.read.schema(out.schema).parquet(beside).isEmpty():
        delete_folder(spark, beside)
        return False
    replace_folder(spark, beside, path)
    return True
