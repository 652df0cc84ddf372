"""Tables of a fixed number of bits over a hash space, built by Spark and sent to
all workers.

They are filters: a bit that is set by chance lets through more rows than needed,
and every row that passes is tested exactly later. Their size is fixed by a
parameter, never by the data; a corpus too large for them makes them fuller, not
larger, and results stay the same.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame

from quakeframe.llm.common import shuffle_parts
from quakeframe.llm.word_arrays import U


def bucket_bits(df_or_spark, least: int = 6, most: int = 18) -> int:
    """Number of top bits that deal hashes to shuffle buckets: about four
    buckets for each shuffle partition."""
    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    return int(min(most, max(least, (4 * shuffle_parts(spark) - 1).bit_length())))


def segment(keys: np.ndarray, bucket: int, bits_bucket: int, bits: int) -> bytes:
    """The bucket's part of a table of ``2 ** bits`` bits with the keys' bits set.
    A key's place in the table is its top ``bits`` bits."""
    size = 1 << (bits - bits_bucket)
    flags = np.zeros(size, bool)
    flags[(keys >> U(64 - bits)).astype(np.int64) - bucket * size] = True
    return np.packbits(flags, bitorder="little").tobytes()


def collect(segments: DataFrame, column: str, bits_bucket: int, bits: int) -> np.ndarray:
    """The whole table from (bucket, ``column``) rows: 2 ** bits / 8 bytes come to
    the driver, whatever the corpus."""
    table = np.zeros(1 << (bits - 3), np.uint8)
    width = len(table) >> bits_bucket
    for row in segments.select("bucket", column).toLocalIterator():
        table[row[0] * width : (row[0] + 1) * width] = np.frombuffer(row[1], np.uint8)
    return table


def has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys have their bit set."""
    bits = int(len(table)).bit_length() + 2
    place = keys >> U(64 - bits)
    return (table[(place >> U(3)).astype(np.int64)] >> (place & U(7)).astype(np.uint8)) & 1 == 1


def unpack(column: pd.Series, dtype: str = "<u8") -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype)


def send(spark, value) -> Broadcast:
    return spark.sparkContext.broadcast(value)


