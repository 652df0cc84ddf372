"""Token ids of whole texts by a public tokenizer file, and exact counts.

``ChunkEncoder`` gives exactly what the tokenizers library gives for a text. The
tokenizer's normalizer and splitting work inside stretches without white space,
so the text is cut there, every distinct stretch is encoded once by the library
and kept in a bounded table, and the ids are joined.

``token_counts`` is the exact length histogram: documents are pre-aggregated by
encoded length before the only shuffle, and suffix sums over the histogram answer
totals, quantiles and truncated totals for every context limit.

Defined cases: a null or empty text has 0 tokens; repeated rows count each; an
empty table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, map_pandas, materialize

#: str.split() takes these for white space, the tokenizer doesn't.
_ODD = re.compile("[\x1c-\x1f]")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level models write for bytes: printable ones stand
    for themselves, the others for the next letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()


def latin(text: str) -> bool:
    """Whether ``text`` has code points below 256 only. There, lower-casing is one
    letter for one letter, nothing is composed, and ``isalpha`` means \\p{L}."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters(word: str) -> str:
    """A word in the alphabet of a byte-level model."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)


def split_tail(chunk: str) -> int:
    """Where commas and full stops after a letter begin: a letter run ends where
    punctuation begins, so what stands before and after encodes apart. Only a
    letter below 256 is sure to be one still when the tokenizer has normalised
    it: the form of some others ends in a mark, which joins the punctuation."""
    core = len(chunk.rstrip(".,"))
    return core if 0 < core < len(chunk) and chunk[core - 1].isalpha() and chunk[core - 1] < "\u0100" else len(chunk)


def comparable(text: str) -> str:
    """``text`` as its chunks are looked up. The tokenizer lower-cases; where that
    is letter for letter it's the same to do so first. Special tokens are
    matched before that, in the text as it is."""
    return text.lower() if "<|" not in text and latin(text) else text


class ChunkEncoder(dict):
    """Maps a stretch without white space to its ids as little-endian uint32
    bytes. ``most``: entries kept; a full table starts anew."""

    def __init__(self, path: str, most: int = 500_000):
        super().__init__()
        self.tokenizer, self.most = load_tokenizer(path), most
        self.model = self.tokenizer.model
        # Letters alone pass the normalizer and the splitting of this kind of
        # tokenizer as one piece in lower case, so the model can be asked directly.
        self.direct = self._passes_letters()

    def _passes_letters(self) -> bool:
        t = self.tokenizer
        probe = ["straße", "éàÿ", "word", "ªº", "the"]
        return all(
            [x.id for x in self.model.tokenize(byte_letters(w))] == t.encode(w.upper() if w in ("word", "the") else w, add_special_tokens=False).ids for w in probe
        )

    def _ids(self, chunk: str) -> bytes:
        if self.direct and chunk.isalpha() and latin(chunk):
            return array("I", [x.id for x in self.model.tokenize(byte_letters(chunk.lower()))]).tobytes()
        return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()

    def __missing__(self, chunk: str) -> bytes:
        cut = split_tail(chunk)
        if cut < len(chunk):
            return self[chunk[:cut]] + self[chunk[cut:]]
        if len(self) >= self.most:
            self.clear()
        ids = self[chunk] = self._ids(chunk)
        return ids

    def encode(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._ids(text)
        return b"".join(map(self.__getitem__, comparable(text).split()))


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process; its table serves all tasks that follow."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens) of every document."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "n_tokens": [len(enc.encode(t)) // 4 for t in b["text"]]})

    return map_pandas(id_text(docs), count, "doc_id long, n_tokens long")


def length_histogram(counts: DataFrame, block: int = 1024) -> DataFrame:
    """From (n_tokens): one row per occurring length, with suffix sums.

    n_docs, n_docs_longer (strictly), tokens_longer (of those), tokens_upto
    (of all documents no longer than this), truncated_total (tokens left when
    every document is cut to this length), share_upto (share of documents no
    longer: the length is the quantile of every level up to it).

    Sums run inside blocks of ``block`` lengths, and over one row per block for
    what lies beyond, so no task holds the whole histogram of a wide range.
    """
    # Written once: two aggregations read it, and encoding must not run twice.
    h = materialize(counts.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "token_histogram")
    h = h.withColumn("tokens", F.col("n_docs") * F.col("n_tokens")).withColumn("block", F.floor(F.col("n_tokens") / block))
    sums = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    sums = sums.select(
        "block",
        F.coalesce(F.sum("d").over(later), zero).alias("d_after"),
        F.coalesce(F.sum("t").over(later), zero).alias("t_after"),
        F.sum("d").over(every).alias("all_docs"),
        F.sum("t").over(every).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    out = h.join(sums, "block").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(inside), zero) + F.col("d_after")).alias("n_docs_longer"),
        (F.coalesce(F.sum("tokens").over(inside), zero) + F.col("t_after")).alias("tokens_longer"),
        "all_docs",
        "all_tokens",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "n_docs_longer",
        "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer")).alias("tokens_upto"),
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("n_docs_longer") * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("n_docs_longer")) / F.col("all_docs")).alias("share_upto"),
    )


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    return length_histogram(count_tokens(docs, tokenizer).select("n_tokens"))


def quantile(histogram: DataFrame, level: float) -> DataFrame:
    """The smallest length that at least ``level`` of the documents don't exceed."""
    return histogram.where(F.col("share_upto") >= level).agg(F.min("n_tokens").alias("n_tokens"))


def totals_at(histogram: DataFrame, limit: int) -> DataFrame:
    """Any context limit, occurring or not: documents longer than it, tokens kept
    when cut to it and tokens lost."""
    over = F.col("n_tokens") > limit
    kept = F.when(over, F.lit(limit)).otherwise(F.col("n_tokens")) * F.col("n_docs")
    lost = F.when(over, (F.col("n_tokens") - limit) * F.col("n_docs")).otherwise(0)
    return histogram.agg(
        F.coalesce(F.sum(F.when(over, F.col("n_docs"))), F.lit(0)).alias("n_longer"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("tokens_kept"),
        F.coalesce(F.sum(lost), F.lit(0)).alias("tokens_lost"),
    )
