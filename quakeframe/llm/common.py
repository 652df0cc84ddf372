"""Helpers shared by the text operators.

Conventions used by all of them: a document is a (doc_id, text) pair; a null
text is an empty one; columns other than the ones an operator names are ignored,
so extra or clashing columns do no harm. Intermediate tables are Parquet under
the session's shared folder (``spark.checkpoint.dir``), so a lost executor
re-reads them and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.session import materialize, ship_package  # noqa: F401  (re-exported for the operators)

#: The white space of the contracts, as a regular-expression class and as characters.
SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with nulls made empty; nothing else."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit key of a (doc_id, text) row; rows that agree in both share it."""
    return F.xxhash64(F.coalesce(F.col(doc_id), F.lit(-1).cast("long")), F.col(doc_id).isNull(), F.col(text))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is. ``lower`` does the same
    on pure ASCII and is much faster there."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def own_names(df: DataFrame, *stems: str) -> list[str]:
    """Column names made of ``stems`` that ``df`` doesn't have in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = f"__{stem}"
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def keyed_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the ``row_key`` of its documents under ``name``; null texts count
    as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return df.withColumn(name, F.xxhash64(F.coalesce(doc_id, F.lit(-1).cast("long")), doc_id.isNull(), text))


def map_pandas(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInPandas`` with this package importable in the workers."""
    ship_package(df.sparkSession)
    return df.mapInPandas(function, schema)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
