"""Line dedup over levelled sorted runs of line hashes.

A ``LineRuns`` store holds, for every line key seen, how many documents have it
and the largest doc_id among them. It grows batch by batch. A batch's keys are
counted and merge-anti-joined with the runs: keys that the runs already have
settled (``min_docs`` documents reached) need no more counting and drop out. The
rest is written as the batch's own run, sorted by hash, at level 0; when a level
has ``fanout`` runs they are merged into one run of the next level.

Batches come in descending order of doc_id, so the batch that first shows a key
shows the largest doc_id that holds it, and a settled key is final. ``dedup_lines``
feeds a corpus to a store in that order and then drops every line whose key is
settled with a larger doc_id. ``unseen`` gives, for a later delivery, the lines
that no batch had.

Rules: a line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends and
with A-Z lower-cased; keys shorter than ``min_chars`` code points are never
dropped. Keys are compared by 128 bits of hash.

Hot lines: a document's equal keys are made one before anything is shuffled, the
(key, doc_id) pairs are spread by both, and counts are partial sums per task, so
a line that a third of all documents hold costs one row per task. The final
anti-join is a sort-merge join whose skewed side AQE may split.

Defined cases: a null or empty text is one empty line and stays as it is;
rows that share a doc_id count as one document, and a line dropped for a doc_id
goes from all its rows; rows without a doc_id neither count nor lose lines;
repeated keys inside the kept document all stay; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeframe.llm.common import SPACE_CHARS, ascii_lower, id_text, materialize, own_names

MIN_CHARS, MIN_DOCS = 40, 5
KEY = ["h1", "h2"]
#: Three batches up to this many documents with long lines, and one more for each
#: doubling beyond.
BATCH_DOCS = 1 << 26


def _keys(text: Column, min_chars: int) -> Column:
    """For every line, in order, a struct of two 64-bit hashes of its key; null
    for short keys. A-Z is lower-cased in the whole text at once, which gives the
    same keys and costs one expression a text, not one a line."""
    trimmed = F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)))
    return F.transform(
        trimmed,
        lambda k: F.when(F.char_length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))),
    )


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, keys): the distinct long keys of each document that has any."""
    d = id_text(docs).where("doc_id IS NOT NULL")
    # No line can be longer than its text, so short texts need no splitting.
    d = d.where(F.char_length("text") >= min_chars)
    d = d.select("doc_id", F.array_distinct(F.filter(_keys(F.col("text"), min_chars), lambda k: k.isNotNull())).alias("keys"))
    return d.where(F.size("keys") > 0)


class LineRuns:
    """The levelled store. ``levels[i]`` lists the runs of level i, oldest first;
    each is a Parquet table (h1, h2, n_docs, max_doc) sorted by (h1, h2)."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def _write(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(materialize(counts.sortWithinPartitions(*KEY), f"line_run_{level}"))

    def add(self, keys: DataFrame) -> None:
        """Add a batch of (doc_id, keys), with smaller doc_ids than all before."""
        pairs = keys.select("doc_id", F.explode("keys").alias("k")).select("doc_id", "k.h1", "k.h2").distinct()
        counts = pairs.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        if self.runs():
            counts = counts.join(self.settled().select(*KEY).hint("merge"), KEY, "left_anti")
        self._write(counts, 0)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                runs, self.levels[level] = self.levels[level], []
                self._write(self._merge(runs), level + 1)

    @staticmethod
    def _merge(runs: list[DataFrame]) -> DataFrame:
        every = runs[0]
        for r in runs[1:]:
            every = every.unionByName(r)
        return every.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self) -> DataFrame:
        """(h1, h2, n_docs, max_doc) over all runs."""
        runs = self.runs()
        return runs[0] if len(runs) == 1 else self._merge(runs)

    def settled(self) -> DataFrame:
        """The keys that at least ``min_docs`` documents hold."""
        return self.merged().where(F.col("n_docs") >= self.min_docs)

    def unseen(self, keys: DataFrame) -> DataFrame:
        """(doc_id, h1, h2) of a batch's lines that are in no run yet."""
        lines = keys.select("doc_id", F.explode("keys").alias("k")).select("doc_id", "k.h1", "k.h2")
        for run in self.runs():
            lines = lines.join(run.hint("merge"), KEY, "left_anti")
        return lines


def batch_count(documents: int) -> int:
    """Batches for a corpus of so many documents with long lines: at least three,
    so that the last ones meet a compacted run, and more as the corpus doubles."""
    return 3 + max(0, (max(documents, 1) - 1).bit_length() - (BATCH_DOCS - 1).bit_length())


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """(doc_id, drop): the keys that each document loses. The texts are read
    once; the table of keys is read for each batch. ``batches``: None for
    ``batch_count`` of the corpus."""
    keys = materialize(line_keys(docs, min_chars), "line_keys")
    batches = batch_count(keys.count()) if batches is None else batches
    # Any cuts are right; near-quantiles make the batches alike in size.
    levels = [i / batches for i in range(1, batches)]
    cuts = sorted(set(keys.approxQuantile("doc_id", levels, 0.05)), reverse=True) if levels else []
    store, above = LineRuns(docs.sparkSession, min_docs), None
    for cut in [*cuts, None]:
        part = keys if above is None else keys.where(F.col("doc_id") < above)
        store.add(part if cut is None else part.where(F.col("doc_id") >= int(cut)))
        above = cut if cut is None else int(cut)
    lines = keys.select("doc_id", F.explode("keys").alias("k")).select("doc_id", "k.h1", "k.h2")
    # Written, so that both sides of the join are plain exchanges, of which AQE
    # may split what a very common line makes large.
    settled = materialize(store.settled().select(*KEY, "max_doc"), "settled_lines")
    gone = lines.join(settled.hint("merge"), KEY).where(F.col("doc_id") < F.col("max_doc"))
    return gone.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drop"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """``docs`` with ``text`` replaced by its kept lines, plus ``n_lines`` and
    ``n_dropped`` under the names ``line_dedup_lines`` and ``line_dedup_dropped``.
    A null text stays null."""
    doc, other, gone, lines, kept_lines, text_name = own_names(docs, "doc", "drop_id", "drop", "lines", "kept", "text")
    drop = dropped_lines(docs, min_chars, min_docs, batches).select(F.col("doc_id").alias(other), F.col("drop").alias(gone))
    d = docs.withColumn(doc, F.col("doc_id").cast("long")).join(drop, F.col(doc) == F.col(other), "left")
    d = d.withColumn(lines, F.split(F.coalesce("text", F.lit("")), "\n", -1))
    with_drop = F.arrays_zip(
        F.col(lines).alias("x"), _keys(F.col("text"), min_chars).alias("k"), F.array_repeat(F.col(gone), F.size(lines)).alias("d")
    )
    left = F.filter(with_drop, lambda z: z["k"].isNull() | ~F.array_contains(z["d"], z["k"]))
    d = d.withColumn(kept_lines, F.when(F.col(gone).isNull(), F.col(lines)).otherwise(F.transform(left, lambda z: z["x"])))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept_lines, "\n"))
    n = F.size(lines).cast("long")
    d = d.select("*", n.alias("line_dedup_lines"), (n - F.size(kept_lines)).alias("line_dedup_dropped"), text.alias(text_name))
    return d.select(*[F.col(text_name).alias(c) if c == "text" else F.col(c) for c in docs.columns], "line_dedup_lines", "line_dedup_dropped")
