"""Substring dedup with fixed-block anchors.

A repeated run of ``min_words`` words contains a whole block of
``block = (min_words + 1) // 2`` words that begins at a multiple of ``block`` in its
own text, wherever the run lies. So only such blocks are indexed:

1. Index. The hashes of all non-overlapping blocks fill a bit table of fixed
   size.
2. Probe. Every rolling window of ``block`` words that isn't itself an indexed
   block is looked up; hits go, with the blocks, to one exact join by hash, which
   leaves the blocks that occur a second time anywhere. Their hashes fill a
   second bit table.
3. Extend. Around every such anchor the windows of ``min_words`` words that
   contain it are hashed, and those whose hash occurs at least twice are the
   windows of repeats; their union is every maximal exact repeat of at
   least ``min_words`` words.

Bit tables only spare work: every step after them is exact on 64-bit hashes.

Hot passages: windows are pre-aggregated where they are read. What repeats inside
one task's texts is settled there, and only one witness of it is sent on, so a
passage that a third of all documents share costs one row per task and window.

Defined cases: a null or empty text has no words; words are compared as they
are; windows are judged on the input; rows equal in doc_id and text are
different places, so their windows repeat; a table without repeats keeps
everything; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm import bitmaps
from quakeframe.llm.common import id_text, materialize, row_key, ship_package
from quakeframe.llm.word_arrays import Words, by_bucket, gathered, packed, pieces, text_buffers

MIN_WORDS = 35
INDEX_BITS, ANCHOR_BITS = 28, 26
#: Windows that a task holds before it settles what repeats among them.
FLUSH = 1 << 19
#: Rows of the batches that tasks return.
ROWS = 1 << 15


def _index(block: int, bits_bucket: int):
    """(bucket, blocks): hashes of the non-overlapping blocks, by bucket."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, words in pieces(batches, "text"):
            h, _, place = words.runs(block)
            yield h[place % block == 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in gathered(blocks(batches)):
            h = np.sort(h)
            bucket, begins = by_bucket(h, bits_bucket)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), packed(h, begins)], names=["bucket", "blocks"])

    return run


def _fill(bits_bucket: int, bits: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": [key[0]], "bits": [bitmaps.segment(bitmaps.unpack(pdf["blocks"]), key[0], bits_bucket, bits)]})

    return run


def _probe(block: int, bits_bucket: int, table):
    """(bucket, probes): distinct hashes of rolling windows that may be blocks."""

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        index = table.value
        for _, words in pieces(batches, "text"):
            h, _, place = words.runs(block)
            h = h[place % block != 0]
            yield h[bitmaps.has(index, h)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h in gathered(hits(batches)):
            h = np.unique(h)
            bucket, begins = by_bucket(h, bits_bucket)
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), packed(h, begins)], names=["bucket", "probes"])

    return run


def _anchors(bits_bucket: int, bits: int):
    """Blocks that occur again, as another block or as a probed window."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        blocks, n = np.unique(bitmaps.unpack(pdf["blocks"].dropna()), return_counts=True)
        probes = bitmaps.unpack(pdf["probes"].dropna())
        twice = blocks[(n > 1) | np.isin(blocks, probes)]
        return pd.DataFrame({"bucket": [key[0]], "bits": [bitmaps.segment(twice, key[0], bits_bucket, bits)]})

    return run


class _Windows:
    """Candidate windows of a task: what repeats among them is settled here."""

    schema = pa.schema([("h", pa.int64()), ("row_key", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("settled", pa.bool_())])

    def __init__(self) -> None:
        self.h, self.key, self.place, self.held = [], [], [], 0

    def add(self, h: np.ndarray, key: np.ndarray, place: np.ndarray) -> None:
        self.h.append(h)
        self.key.append(key)
        self.place.append(place)
        self.held += len(h)

    def flush(self) -> Iterator[pa.RecordBatch]:
        every = self._settle()
        for at in range(0, every.num_rows, ROWS):
            yield every.slice(at, ROWS)

    def _settle(self) -> pa.RecordBatch:
        """Rows with ``h``: one for each hash, ``settled`` if it repeats here. Rows
        without: ``n`` consecutive windows from ``start`` that repeat."""
        h, key, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.h, self.key, self.place))
        self.__init__()
        order = np.argsort(h, kind="stable")
        s = h[order]
        same = s[1:] == s[:-1]
        first = np.concatenate(([True], ~same)) if len(s) else np.zeros(0, bool)
        twice = np.concatenate(([False], same)) | np.concatenate((same, [False])) if len(s) else np.zeros(0, bool)
        sent = order[first]
        settled = np.sort(order[twice])
        # A document's windows were added in order, so runs stand together.
        k, p = key[settled], place[settled]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (p[1:] != p[:-1] + 1))) if len(k) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        length = np.diff(np.concatenate((at, [len(k)])))
        none = len(at)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(h[sent].view(np.int64)), pa.nulls(none, pa.int64())]),
                pa.array(np.concatenate((key[sent], k[at]))),
                pa.array(np.concatenate((place[sent], p[at])), pa.int32()),
                pa.array(np.concatenate((np.ones(len(sent), np.int64), length)), pa.int32()),
                pa.array(np.concatenate((twice[first], np.ones(none, bool)))),
            ],
            schema=self.schema,
        )


def _extend(block: int, min_words: int, table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, held = table.value, _Windows()
        for batch, words in pieces(batches, "text"):
            h, text, place = words.runs(block)
            is_block = place % block == 0
            hot = is_block.copy()
            hot[is_block] = bitmaps.has(anchors, h[is_block])
            at = words.first[text[hot]] + place[hot]
            if not len(at):
                continue
            # A window that begins at word i contains an anchor that begins in i .. i + min_words - block.
            near = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(near, np.maximum(at - (min_words - block), 0), 1)
            np.add.at(near, at + 1, -1)
            near = np.cumsum(near)
            h, text, place = words.runs(min_words)
            chosen = near[words.first[text] + place] > 0
            key = batch.column(batch.schema.get_field_index("row_key")).to_numpy()
            held.add(h[chosen], key[text[chosen]], place[chosen])
            if held.held >= FLUSH:
                yield from held.flush()
        yield from held.flush()

    return run


def _kept(min_words: int):
    """Drops the covered words; (doc_id, n_words, n_removed, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            names = batch.schema.names
            doc_ids = batch.column(names.index("doc_id"))
            text, runs = batch.column(names.index("text")), batch.column(names.index("runs"))
            data, offsets = text_buffers(text)
            n_words, n_removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = Words(data, offsets[i : i + 2])
                n = len(words.hash)
                raw = words.bytes.tobytes()
                found = runs[i].as_py() if runs[i].is_valid else None
                gone = np.zeros(n, bool)
                for r in found or ():
                    gone[r["start"] : r["start"] + r["n"] + min_words - 1] = True
                stay = np.flatnonzero(~gone)
                n_words.append(n)
                n_removed.append(int(gone.sum()))
                kept.append(b" ".join([raw[a:b] for a, b in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def repeated_windows(docs: DataFrame, min_words: int = MIN_WORDS, index_bits: int = INDEX_BITS, anchor_bits: int = ANCHOR_BITS) -> DataFrame:
    """(row_key, runs): for each text, runs of (start, n): n consecutive windows
    from word ``start`` on whose words also start somewhere else. ``docs``:
    (doc_id, text, row_key)."""
    spark = docs.sparkSession
    ship_package(spark)
    block = (min_words + 1) // 2
    buckets = bitmaps.bucket_bits(spark)
    texts = docs.select("text")
    blocks = materialize(texts.mapInArrow(_index(block, buckets), "bucket int, blocks binary"), "blocks")
    filled = blocks.groupBy("bucket").applyInPandas(_fill(buckets, index_bits), "bucket int, bits binary")
    index = bitmaps.send(spark, bitmaps.collect(filled, "bits", buckets, index_bits))
    probes = texts.mapInArrow(_probe(block, buckets, index), "bucket int, probes binary")
    both = blocks.withColumn("probes", F.lit(None).cast("binary")).unionByName(probes.withColumn("blocks", F.lit(None).cast("binary")))
    twice = both.groupBy("bucket").applyInPandas(_anchors(buckets, anchor_bits), "bucket int, bits binary")
    anchors = bitmaps.send(spark, bitmaps.collect(twice, "bits", buckets, anchor_bits))
    index.unpersist()
    found = docs.select("row_key", "text").mapInArrow(
        _extend(block, min_words, anchors), "h long, row_key long, start int, n int, settled boolean"
    )
    # Windows meet by hash, one row for each task and hash, so the count is small
    # for any passage. What is settled already passes through, spread evenly.
    met = found.withColumn("meet", F.coalesce("h", F.xxhash64("row_key", "start"))).withColumn("local", F.col("h").isNull())
    counted = met.selectExpr("row_key", "start", "n", "settled", "local", "count(*) OVER (PARTITION BY meet, local) AS places")
    repeats = counted.where("local OR (places > 1 AND NOT settled)")
    return repeats.groupBy("row_key").agg(F.collect_list(F.struct("start", "n")).alias("runs"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, index_bits: int = INDEX_BITS, anchor_bits: int = ANCHOR_BITS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the kept words)."""
    keyed = id_text(docs).withColumn("row_key", row_key())
    runs = repeated_windows(keyed, min_words, index_bits, anchor_bits)
    joined = keyed.join(runs, "row_key", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_kept(min_words), "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


