"""A corpus pipeline of five stages over ``documents``: toxic documents go, lines
that many documents share go but once, one document of each group of near
duplicates stays, personal data is redacted, and what is left is packed into
sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of ``documents``; a stage that changes
``text`` brings ``n_chars`` up to date. Null and empty texts pass every stage.
Each stage begins by releasing what its predecessors' plans hold in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm import line_dedup, ngram_join, packing, pii, toxicity
from quakeframe.llm.common import materialize, read_table
from quakeframe.llm.queries import CAPACITY, END_ID, tokenizer_path
from quakeframe.session import release


#: Near duplicates are of five words and 80 %: the n-gram join's own defaults are
#: the values of op3_ngram_join, which are stricter.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _recount(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return _recount(line_dedup.dedup_lines(docs).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return ngram_join.drop_near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return _recount(pii.redact(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark)
    return packing.pack(docs, tokenizer_path(), CAPACITY, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_duplicates),
    ("pii", redact),
    ("packing", pack),
]

#: The classifier, the boosted trees and the tokenizer are beyond SQL; tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
