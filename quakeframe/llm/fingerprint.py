"""Document fingerprints: a quartile bucket digest.

Inside every window of five bytes six byte triplets are hashed into 128 buckets
and counted. The digest holds, for every bucket, in which quarter of all bucket
counts it lies (two bits), the ratios of the quartiles, and the logarithm of the
length. Two digests are compared by a bounded difference score: steps between
quarters (a jump over all of them weighs double), between the quartile ratios,
and between the lengths. ``likeness`` is 1 for no difference and 0 for the most.

``neighbour_report`` compares each document with an edited copy, whose second
half comes from the next document by doc_id, and with that next document. Texts
are moved once, to a partitioning by ranges of doc_id; neighbours across two
partitions are paired afterwards, one pair for each partition.

Defined cases: a null or empty text has the digest of no triplets; equal texts
have equal digests; equal doc_ids follow each other by text; null ids come
first; a single document is its own next one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, map_pandas, materialize, shuffle_parts

BUCKETS = 128
#: The triplets of a window, as byte places.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
_CHUNK = 1 << 20
_WORST = BUCKETS * 6 + 2 * 15 + 60
_TABLES = np.random.default_rng(20240501).integers(0, BUCKETS, (len(TRIPLETS), 3, 256), dtype=np.uint8)


def bucket_counts(data: bytes) -> np.ndarray:
    counts = np.zeros(BUCKETS, np.int64)
    every = np.frombuffer(data, np.uint8)
    for at in range(0, max(len(every) - 4, 0), _CHUNK):
        b = every[at : at + _CHUNK + 4]
        n = len(b) - 4
        for table, places in zip(_TABLES, TRIPLETS, strict=True):
            x, y, z = (table[i][b[p : p + n]] for i, p in enumerate(places))
            counts += np.bincount(x ^ y ^ z, minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    """68 hex digits: length code, quartile ratios, then two bits per bucket."""
    data = text.encode()
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = (code.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8).tobytes()
    size = min(255, int(12 * math.log2(1 + len(data))) if len(data) else 0)
    ratios = [(100 * q // q3) % 16 if q3 else 0 for q in (q1, q2)]
    return f"{size:02x}{ratios[0]:x}{ratios[1]:x}" + body.hex()


def _codes(fp: str) -> np.ndarray:
    b = np.frombuffer(bytes.fromhex(fp[4:]), np.uint8)
    return ((b[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel().astype(np.int8)


def difference(a: str, b: str) -> int:
    """0 for equal digests, at most ``_WORST``."""
    steps = np.abs(_codes(a) - _codes(b))
    total = int(steps.sum()) + 3 * int((steps == 3).sum())
    for x, y in zip(a[2:4], b[2:4], strict=True):
        gap = abs(int(x, 16) - int(y, 16))
        total += min(gap, 16 - gap)
    return total + min(60, abs(int(a[:2], 16) - int(b[:2], 16)))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / _WORST


def edited_text(text: str, after: str) -> str:
    """The last half of the code points replaced by the first as many of ``after``."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COLUMNS = [c.split()[0] for c in _REPORT.split(", ")]


def _row(doc_id, text: str, fp: str, after: str, after_fp: str) -> tuple:
    edited = edited_text(text, after)
    efp = digest(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, efp, likeness(fp, efp), likeness(fp, after_fp))


def _along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reports of all documents of a sorted partition but the last, and the
    partition's first and last document with their texts."""
    part, before, first = TaskContext.get().partitionId(), None, None
    names = [*_COLUMNS, "part", "side", "text"]
    for b in batches:
        rows = []
        for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"], strict=True):
            now = (doc_id, text, digest(text))
            if before is None:
                first = now
            else:
                rows.append((*_row(*before, *now[1:]), part, 0, None))
            before = now
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
    if before is not None:
        ends = [(doc_id, None, None, None, None, None, None, part, side, text) for side, (doc_id, text, _) in ((1, first), (2, before))]
        yield pd.DataFrame(ends, columns=names).astype({"doc_id": "Int64", "n_chars": "Int64"})


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [
            _row(doc_id, text, digest(text), after, digest(after))
            for doc_id, text, after in zip(b["doc_id"].astype("Int64"), b["text"], b["after"], strict=True)
        ]
        yield pd.DataFrame(rows, columns=_COLUMNS).astype({"doc_id": "Int64"})


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every document; no shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "fingerprint": [digest(t) for t in b["text"]]})

    return map_pandas(id_text(docs), run, "doc_id long, fingerprint string")


def neighbour_report(docs: DataFrame) -> DataFrame:
    d = id_text(docs)
    dealt = d.repartitionByRange(shuffle_parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    walked = materialize(map_pandas(dealt, _along, f"{_REPORT}, part int, side int, text string"), "neighbour_report")
    # One number for each partition that has rows comes back.
    parts = sorted(r["part"] for r in walked.where("side = 1").select("part").collect())
    done = walked.where("side = 0").select(*_COLUMNS)
    if not parts:
        return done
    following = dict(zip(parts, parts[1:] + parts[:1], strict=True))
    to_next = F.element_at(F.create_map(*[F.lit(x) for kv in following.items() for x in kv]), F.col("part"))
    tails = walked.where("side = 2").select("doc_id", "text", to_next.alias("next_part"))
    heads = walked.where("side = 1").select(F.col("part").alias("next_part"), F.col("text").alias("after"))
    return done.unionByName(map_pandas(tails.join(heads, "next_part").select("doc_id", "text", "after"), _across, _REPORT))
