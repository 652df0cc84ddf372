"""Fill-in-the-middle transformation with piece tables.

A document becomes a table of descriptors (buffer, start, length), in code points,
over two immutable buffers: its own text and the sentinels. Nothing moves text:

* ``cut`` splits the last descriptor at a place;
* ``arrange`` permutes the parts and puts a sentinel's descriptor before each;
* ``inverse`` finds the sentinels in an output, describes the parts over the
  output as its buffer and applies the inverse permutation;
* hashes and outputs are streamed off the descriptors, slice by slice.

Spark plans the places and forms with DataFrame functions; descriptors are made
and streamed batch by batch. Places and forms come from (seed, doc_id) alone, so
every run gives a document the same. Documents that are empty or contain a
sentinel are left plain, and so are those beyond the share ``plain_from`` of 100.

Defined cases: a null text is an empty one, plain; a null doc_id is written as no
digits; repeated rows give equal results; a part may be empty; an output that
does not have the sentinels of its form is refused; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, map_pandas

#: The sentinels, and for each form the parts in the order of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
#: The parts as they lie in the text, and the sentinel before each in an output.
PARTS = ("prefix", "middle", "suffix")
MARKS = {"prefix": PREFIX, "suffix": SUFFIX, "middle": MIDDLE}
TEXT, MARK = 0, 1  # buffers


class Piece(NamedTuple):
    """``length`` code points of a buffer from ``start`` on."""

    buffer: int
    start: int
    length: int


def whole(n: int) -> list[Piece]:
    """The table of an uncut text of ``n`` code points."""
    return [Piece(TEXT, 0, n)]


def cut(table: list[Piece], at: int) -> list[Piece]:
    """The last descriptor split where code point ``at`` of its buffer begins; a
    side may be empty. Cuts are made from left to right."""
    last = table[-1]
    if not last.start <= at <= last.start + last.length:
        raise ValueError("cut outside the last piece")
    first = at - last.start
    return [*table[:-1], last._replace(length=first), last._replace(start=at, length=last.length - first)]


def arrange(table: list[Piece], form: str) -> list[Piece]:
    """The three parts in the order of ``form``, each behind its sentinel; a plain
    table as it is."""
    if form == "plain":
        return table
    out = []
    for part in ORDERS[form]:
        mark = MARKS[part]
        out += [Piece(MARK, SENTINELS.index(mark), len(mark)), table[PARTS.index(part)]]
    return out


def describe(n: int, form: str, lo: int, hi: int) -> list[Piece]:
    """The table of a document's output."""
    return whole(n) if form == "plain" else arrange(cut(cut(whole(n), lo), hi), form)


def _draws(seed: int) -> list[Column]:
    """Four numbers below 2 ** 32 of a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def plan(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Per document: doc_id, text, n, form, and where its middle begins and ends (lo, hi)."""
    h = [f"__h{i}" for i in range(4)]
    d = id_text(docs).select("doc_id", "text", F.char_length("text").cast("long").alias("n"), *[c.alias(a) for c, a in zip(_draws(seed), h, strict=True)])
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("n") == 0) | marked | (F.col(h[2]) % 100 >= plain_from)
    a, b = F.col(h[0]) % (F.col("n") + 1), F.col(h[1]) % (F.col("n") + 1)
    form = F.when(plain, "plain").when(F.col(h[3]) % 100 < spm_below, "spm").otherwise("psm")
    return d.select("doc_id", "text", "n", form.alias("form"), F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def slices(text: str, table: list[Piece]) -> Iterator[str]:
    """What the descriptors describe, in their order."""
    buffers = (text, SENTINELS)
    for p in table:
        yield buffers[p.buffer][p.start : p.start + p.length]


def inverse(output: str, form: str) -> list[Piece]:
    """Descriptors over ``output`` that spell the text it was made from."""
    if form == "plain":
        return whole(len(output))
    order = ORDERS[form]
    at = [output.find(MARKS[part]) for part in order]
    if at[0] != 0 or at != sorted(at):
        raise ValueError(f"not an output of form {form}")
    found = {}
    for part, start, end in zip(order, at, [*at[1:], len(output)], strict=True):
        start += len(MARKS[part])
        found[part] = Piece(TEXT, start, end - start)
    return [found[part] for part in PARTS]


def stream_sha256(text: str, table: list[Piece]) -> str:
    h = hashlib.sha256()
    for s in slices(text, table):
        h.update(s.encode())
    return h.hexdigest()


def _tables(b: pd.DataFrame) -> list[list[Piece]]:
    return [describe(*x) for x in zip(b["n"], b["form"], b["lo"], b["hi"], strict=True)]


def transform(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, form, pieces, output) of every document: its table of descriptors and
    the text they spell; ``options`` as for ``plan``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tables = _tables(b)
            out = ["".join(slices(t, p)) for t, p in zip(b["text"], tables, strict=True)]
            pieces = [[p._asdict() for p in t] for t in tables]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "form": b["form"], "pieces": pieces, "output": out})

    schema = "doc_id long, form string, pieces array<struct<buffer:int,start:long,length:long>>, output string"
    return map_pandas(plan(docs, **options), run, schema)


def restore(outputs: DataFrame) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output) alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = ["".join(slices(o, inverse(o, f))) for o, f in zip(b["output"], b["form"], strict=True)]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "text": out})

    return map_pandas(outputs.select("doc_id", "form", "output"), run, "doc_id long, text string")


def digests(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars (null if plain),
    output_sha256, and restored_sha256 of the text rebuilt from output and form.
    One pass: neither outputs nor restored texts leave the task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made, back = [], []
            for text, form, table in zip(b["text"], b["form"], _tables(b), strict=True):
                made.append(stream_sha256(text, table))
                output = text if form == "plain" else "".join(slices(text, table))
                back.append(stream_sha256(output, inverse(output, form)))
            framed = b["form"] != "plain"
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"),
                    "n": b["n"],
                    "form": b["form"],
                    "prefix_chars": b["lo"].astype("Int64").where(framed),
                    "middle_chars": (b["hi"] - b["lo"]).astype("Int64").where(framed),
                    "output_sha256": made,
                    "restored_sha256": back,
                }
            )

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return map_pandas(plan(docs, **options), run, schema)
