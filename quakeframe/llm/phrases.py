"""Phrase collocations by direct-address tiling of frequency-ranked ids.

Everything is counted level by level with one step:

1. Symbols that occur often enough get ids by falling frequency (level 1: words).
   No phrase with a rarer part can be a candidate.
2. Texts are held in chunks: sequences of *local* codes with the chunk's own list
   of words. Only that list is joined with the ids, so no vocabulary is ever
   broadcast and no text is shuffled by word; the chunk's codes then become ids.
3. Adjacent ids are pairs. The plane of pairs is cut into tiles. Tiles of frequent
   ids that a run of chunks fills well are counted by direct addressing (a dense
   ``bincount`` over the tile's cells), all others as sorted coordinates. Spark
   sums the counts of all tasks.
4. The pairs that occur often enough are the symbols of the next level: they are
   ranked, the sequences rewritten in their ids, and the step runs again. Adjacent
   pairs overlap, so a pair of two-word symbols is a three-word phrase, and so on up
   to ``max_words``. A bit table of fixed size holds the frequent pairs' hashes, so
   that hardly any other pair of a chunk is looked up; the look-up itself is exact.

Every count is exact, and over whole texts. Ids are unique over all languages, so
a pair's language is its words'.

A piece (a stretch without ``[.,;:!?\\x0A-\\x0D]``) is never divided between
chunks: a chunk ends at the first piece border after ``CHUNK`` words.

Defined cases: null text has no words; a null language is ``und`` and one with that
name; languages without candidates have no rows; repeated rows count each; equal
scores are ordered by frequency, then by phrase (bytes); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeframe.llm import bitmaps
from quakeframe.llm.common import materialize, ship_package
from quakeframe.llm.word_arrays import U, by_bucket, mix

#: Words of a chunk, bytes of a text worked on at a time.
CHUNK, SLICE = 1 << 18, 1 << 20
#: Cells along a tile's edge; tiles along the edge of the region that may be dense;
#: pairs per cell from which on a tile is dense.
TILE, HEAD, FILL = 512, 8, 1 / 8
#: Ids gathered before their pairs are counted; bits of the table of frequent pairs.
GATHER, OFTEN_BITS = 1 << 20, 26

#: What ends a piece, and what stands between words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_CLEAN = bytes(
    10 if i in PIECE_ENDS else 32 if i in BLANKS else i + 32 if 65 <= i <= 90 else i for i in range(256)
)  # piece ends to line feeds, blanks to spaces, A-Z to a-z
_GAP, _BREAK, _FIRST = 0, 1, 2  # codes: nothing between two blanks, a piece border, the first word


class Codes(dict):
    """Word (UTF-8 bytes) -> local code, in order of appearance."""

    def __init__(self):
        super().__init__({b"": _GAP, b"\n": _BREAK})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


class OpenChunk:
    """A chunk of one language that still takes texts."""

    def __init__(self):
        self.codes, self.parts, self.size = Codes(), [], 0

    def add(self, text: bytes) -> None:
        """Takes a text with a piece border behind it. Long texts go by slices that
        end at a blank or a border; no pair is lost between two slices."""
        at, n = 0, len(text)
        clean = text.translate(_CLEAN)
        while at < n:
            to = n
            if n - at > SLICE:
                to = max(clean.rfind(b" ", at, at + SLICE), clean.rfind(b"\n", at, at + SLICE)) + 1
                if to <= at:  # one very long word
                    ends = [i for i in (clean.find(b" ", at), clean.find(b"\n", at)) if i >= 0]
                    to = min(ends, default=n - 1) + 1
            words = clean[at:to].replace(b"\n", b" \n ").split(b" ")
            codes = np.fromiter(map(self.codes.__getitem__, words), np.int32, len(words))
            self._append(codes[codes != _GAP])
            at = to
        self._append(np.array([_BREAK], np.int32))

    def _append(self, codes: np.ndarray) -> None:
        self.parts.append(codes)
        self.size += len(codes)

    def rows(self, chunk: int, lang: str) -> Iterator[pa.RecordBatch]:
        """One row with the codes, then one per distinct word."""
        codes = np.concatenate(self.parts)
        counts = np.bincount(codes, minlength=len(self.codes))[_FIRST:]
        yield _batch({"chunk": [chunk], "lang": [lang], "codes": [codes.tobytes()], "words": [int(counts.sum())]})
        words = list(self.codes)[_FIRST:]
        for at in range(0, len(words), 1 << 16):
            some = words[at : at + (1 << 16)]
            yield _batch(
                {
                    "chunk": np.full(len(some), chunk),
                    "lang": [lang] * len(some),
                    "local": np.arange(at, at + len(some), dtype=np.int32) + _FIRST,
                    "word": pa.array(some, pa.binary()).cast(pa.string()),
                    "n": counts[at : at + len(some)],
                }
            )


_CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()), ("words", pa.int64()), ("local", pa.int32()), ("word", pa.string()), ("n", pa.int64())]
)
_CHUNKS_SQL = "chunk long, lang string, codes binary, words long, local int, word string, n long"
_SEQUENCES_SQL = "chunk long, ids binary"


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _CHUNKS]
    return pa.RecordBatch.from_arrays(arrays, schema=_CHUNKS)


def text_chunks(docs: DataFrame, chunk_words: int = CHUNK) -> DataFrame:
    """Chunks of local codes: a row with ``codes`` (int32) and ``words`` per chunk,
    and a row (local, word, n) for each of its distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 33, 0
        held: dict[str, OpenChunk] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk = held.get(lang)
                if chunk is None:
                    chunk = held[lang] = OpenChunk()
                chunk.add(text.as_buffer().to_pybytes())
                if chunk.size >= chunk_words:
                    yield from held.pop(lang).rows(base + made, lang)
                    made += 1
                elif len(held) > 4 and sum(c.size for c in held.values()) >= 4 * chunk_words:
                    for name in list(held):
                        yield from held.pop(name).rows(base + made, name)
                        made += 1
        for name in list(held):
            yield from held.pop(name).rows(base + made, name)
            made += 1

    ship_package(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, _CHUNKS_SQL)


def _neighbours(ids: np.ndarray) -> np.ndarray:
    """Places of a sequence where a pair begins: an id and the next one are symbols."""
    return np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0)) if len(ids) else np.zeros(0, np.int64)


def count_pairs(ids: np.ndarray, tile: int = TILE, head: int = HEAD, fill: float = FILL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n): the distinct pairs of neighbours of a sequence of ids with their
    counts. Ids below 0 have no pairs."""
    at = _neighbours(ids)
    a, b = ids[at], ids[at + 1]
    out = []
    sparse = np.ones(len(at), bool)
    region = np.flatnonzero((a < tile * head) & (b < tile * head))
    tiles = (a[region] // tile) * head + b[region] // tile
    sizes = np.bincount(tiles, minlength=head * head)
    for t in np.flatnonzero(sizes >= max(1, int(fill * tile * tile))):
        rows = region[tiles == t]
        sparse[rows] = False
        counts = np.bincount((a[rows] % tile) * tile + b[rows] % tile, minlength=tile * tile)
        used = np.flatnonzero(counts)
        out.append((used // tile + (t // head) * tile, used % tile + (t % head) * tile, counts[used]))
    rows = np.flatnonzero(sparse)
    if len(rows):
        # Sorted coordinates, the pair as one number.
        width = _width(int(b[rows].max()) + 1, int(a[rows].max()) + 1)
        keys, counts = np.unique(a[rows] * width + b[rows], return_counts=True)
        out.append((keys // width, keys % width, counts))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _width(symbols: int, others: int | None = None) -> int:
    """``symbols`` if all pairs of them fit into 63 bits."""
    if symbols * (others or symbols) >= 1 << 63:
        raise ValueError("more than 3 * 10 ** 9 symbols")
    return symbols


def _id_type(symbols: int) -> type:
    """Numbers that sequences over so many ids are written in."""
    return np.int32 if symbols < 1 << 31 else np.int64


def word_sequences(chunks: DataFrame, ids: DataFrame, symbols: int) -> DataFrame:
    """(chunk, ids): each chunk's codes as ids, -1 for rare words and piece
    borders. ``ids``: (chunk, local, id)."""
    kind = _id_type(symbols)

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        for raw in rows["codes"]:
            codes = np.frombuffer(raw, np.int32)
            table = np.full(int(codes.max(initial=0)) + 1, -1, kind)
            table[known["local"].to_numpy(np.int64)] = known["id"].to_numpy(kind)
            out.append(table[codes].tobytes())
        return pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "ids": out})

    ship_package(chunks.sparkSession)
    left = chunks.where(F.col("codes").isNotNull()).select("chunk", "codes")
    right = ids.select(F.col("chunk").alias("of"), F.col("local").alias("local"), F.col("id").alias("id"))
    return left.groupBy("chunk").cogroup(right.groupBy("of")).applyInPandas(run, _SEQUENCES_SQL)


def pair_counts(sequences: DataFrame, symbols: int) -> DataFrame:
    """(pair, n) of all sequences, a pair (a, b) as the number a * symbols + b."""
    width, kind = _width(max(1, symbols)), _id_type(symbols)

    def count(held: list[np.ndarray]) -> pa.RecordBatch:
        a, b, n = count_pairs(np.concatenate(held).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a * width + b, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, border = [], 0, np.array([-1], kind)
        for batch in batches:
            for raw in batch.column(0):
                ids = np.frombuffer(raw.as_buffer(), kind)
                held += [ids, border]
                size += len(ids)
                if size >= GATHER:
                    yield count(held)
                    held, size = [], 0
        if held:
            yield count(held)

    ship_package(sequences.sparkSession)
    counted = sequences.select("ids").mapInArrow(run, "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("f"))


def _keys(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    at = _neighbours(ids)
    return at, ids[at].astype(np.int64) * width + ids[at + 1]


def pair_sequences(sequences: DataFrame, found: DataFrame, symbols: int, n_found: int, bits: int = OFTEN_BITS) -> DataFrame:
    """(chunk, ids): the sequences in the ids of frequent pairs (``found``: pair, id);
    at a place without one, -1."""
    spark, width, kind, new_kind = sequences.sparkSession, _width(max(1, symbols)), _id_type(symbols), _id_type(n_found)
    ship_package(spark)
    bucket_bits = bitmaps.bucket_bits(spark)

    def hashed(pairs: np.ndarray) -> np.ndarray:
        return mix(pairs.astype(U) + U(1))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.sort(hashed(batch.column(0).to_numpy(zero_copy_only=False)))
            used, begins = by_bucket(keys, bucket_bits)
            parts = [keys[i:j].tobytes() for i, j in zip(begins, begins[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(parts, pa.binary())], names=["bucket", "keys"])

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        return pd.DataFrame({"bucket": [bucket], "bits": [bitmaps.segment(bitmaps.unpack(rows["keys"]), bucket, bucket_bits, bits)]})

    dealt = found.select("pair").mapInArrow(collect, "bucket int, keys binary")
    table = bitmaps.send(spark, bitmaps.collect(dealt.groupBy("bucket").applyInPandas(fill, "bucket int, bits binary"), "bits", bucket_bits, bits))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = np.unique(_keys(np.frombuffer(raw.as_buffer(), kind), width)[1])
                keys = keys[bitmaps.has(table.value, hashed(keys))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk), pa.int64()), pa.array(keys, pa.int64())], names=["of", "pair"])

    def rewrite(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("pair")
        pairs, ids = known["pair"].to_numpy(np.int64), known["id"].to_numpy(new_kind)
        out = []
        for raw in rows["ids"]:
            old = np.frombuffer(raw, kind)
            new = np.full(len(old), -1, new_kind)
            at, keys = _keys(old, width)
            if len(pairs):
                place = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
                new[at] = np.where(pairs[place] == keys, ids[place], -1)
            out.append(new.tobytes())
        return pd.DataFrame({"chunk": rows["chunk"].to_numpy(), "ids": out})

    looked_up = sequences.mapInArrow(likely, "of long, pair long").join(found.select("pair", "id"), "pair").select("of", "pair", "id")
    return sequences.groupBy("chunk").cogroup(looked_up.groupBy("of")).applyInPandas(rewrite, _SEQUENCES_SQL)


def with_ids(symbols: DataFrame, name: str, *order: Column) -> DataFrame:
    """``symbols`` written with ``id``: 0, 1, ... in the given order. Ranks come from
    range partitions and one row per partition; no task sorts everything."""
    placed = materialize(symbols.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id()), name)
    part = F.shiftright("__m", 33).alias("__part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0).cast("long")).alias("__start"))
    out = placed.withColumn("__part", F.shiftright("__m", 33)).join(starts, "__part")
    return out.withColumn("id", F.col("__start") + F.col("__m").bitwiseAND((1 << 33) - 1)).drop("__m", "__part", "__start")


def collocations(docs: DataFrame, least: int = 10, max_words: int = 3, top: int = 2000, cover_percent: int = 50, chunk_words: int = CHUNK) -> DataFrame:
    """Per language the first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    a: occurrences; l and r: those of the parts of the phrase at the cut with the
    lowest score floor(1000000 * a * a / (l * r)); n: words of the language. A
    phrase is left out when a longer candidate around it has at least
    ``cover_percent`` of its occurrences.
    """
    chunks = materialize(text_chunks(docs, chunk_words), "phrase_chunks")
    totals = chunks.where(F.col("codes").isNotNull()).groupBy("lang").agg(F.sum("words").alias("n"))
    local = chunks.where(F.col("word").isNotNull())
    empty = F.array().cast("array<bigint>")
    # A symbol: its phrase, last word, count, and the counts of its beginnings and
    # ends, by cut.
    words = local.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    words = words.select("lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", empty.alias("heads"), empty.alias("tails"))
    symbols = with_ids(words, "phrase_words", F.col("f").desc(), F.col("lang"), F.col("phrase"))
    ids = local.join(symbols.select("lang", F.col("phrase").alias("word"), "id"), ["lang", "word"]).select("chunk", "local", "id")
    n_symbols = symbols.count()
    sequences = materialize(word_sequences(chunks, ids, n_symbols), "phrase_sequences")
    kept = []
    for size in range(2, max_words + 1):
        often = pair_counts(sequences, n_symbols).where(F.col("f") >= least)
        found = with_ids(often, f"phrase_often_{size}", F.col("f").desc(), F.col("pair"))
        n_found = found.count()
        if size < max_words:
            sequences = materialize(pair_sequences(sequences, found, n_symbols, n_found), "phrase_sequences")
        width = F.lit(max(1, n_symbols)).cast("long")
        parts = found.select("id", "f", F.expr(f"pair div {max(1, n_symbols)}L").alias("a"), (F.col("pair") % width).alias("b"))
        if size > 2:
            kept.append(_uncovered(symbols, parts, cover_percent))
        symbols = materialize(_joined(parts, symbols), f"phrase_symbols_{size}")
        n_symbols = n_found
    kept.append(symbols)
    candidates = kept[0]
    for more in kept[1:]:
        candidates = candidates.unionByName(more)
    scored = candidates.select("lang", "phrase", F.col("f").alias("a"), _lowest_cut().alias("cut"))
    scored = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _joined(found: DataFrame, symbols: DataFrame) -> DataFrame:
    """Pairs of overlapping symbols as symbols one word longer."""
    p = symbols.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("p_phrase"), F.col("f").alias("p_f"), F.col("heads").alias("p_heads"))
    q = symbols.select(F.col("id").alias("b"), F.col("last"), F.col("f").alias("q_f"), F.col("tails").alias("q_tails"))
    return found.join(p, "a").join(q, "b").select(
        "id",
        "lang",
        F.concat_ws(" ", "p_phrase", "last").alias("phrase"),
        "last",
        "f",
        F.concat("p_heads", F.array("p_f")).alias("heads"),
        F.concat(F.array("q_f"), "q_tails").alias("tails"),
    )


def _uncovered(symbols: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """``symbols`` without those that a longer candidate covers. Counts fall with
    length, so the candidates one word longer decide for all."""
    around = longer.select(F.col("a").alias("id"), "f").unionByName(longer.select(F.col("b").alias("id"), "f"))
    most = around.groupBy("id").agg(F.max("f").alias("__most"))
    covered = F.coalesce(F.col("__most") * 100 >= F.col("f") * percent, F.lit(False))
    return symbols.join(most, "id", "left").where(~covered).select(symbols.columns)


def _lowest_cut() -> Column:
    """The cut (score, k, l, r) with the lowest score, the first of equal ones.
    Products are decimals of 38 digits: exact for counts below 10 ** 16."""
    cuts = F.transform(F.arrays_zip(F.col("heads").alias("l"), F.col("tails").alias("r")), _scored)
    return F.array_min(cuts)


def _scored(cut: Column, k: Column) -> Column:
    wide = "decimal(20,0)"
    over = F.lit(1000000).cast("decimal(7,0)") * F.col("f").cast(wide) * F.col("f").cast(wide)
    under = cut["l"].cast(wide) * cut["r"].cast(wide)
    return F.struct(F.call_function("div", over, under).alias("score"), k.alias("k"), cut["l"].alias("l"), cut["r"].alias("r"))
