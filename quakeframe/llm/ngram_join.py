"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two of them link when their Jaccard
similarity is at least ``percent`` / 100, and links close to components.

Order. Shingles are counted over all documents. A shingle's place in the global
order is (occurs once or not, logarithm of its count, hash), rarest first; the
two counts come from tables of fixed size, which makes the order approximate but
the same for every document, and that's all the prefix principle needs. A
shingle that the exact count found once is never shared and makes no candidates.

Prefixes. If two sets of sizes n and m link, the first ``n - ceil(t n) + l`` shingles
of the one and ``m - ceil(t m) + l`` of the other share at least ``l``, for any l. Each
document picks its own l from the estimated cost of its candidates: a longer
prefix reads more postings and asks for more shared shingles before a pair is
verified. A pair needs the smaller of its two l.

Candidates. Documents with equal sets are one class and take part once.
* A shingle with at most ``cold`` postings gives its pairs, which are counted.
* A shingle with more is hot. Its postings are not paired with each other but
  with one hub, the posting with the fewest shingles of its own. The hub's
  overlaps with both members bound the overlap of any other pair of the
  shingle; only pairs that aren't already linked through the hub and whose
  bound reaches the threshold are made. In a group of near copies that is next
  to none, and none is lost.
Every candidate is verified on the whole sets (64-bit hashes).

Defined cases: white space alone, empty and null texts have the empty set and
link with nothing; fewer words than a shingle make one shingle of all of them;
repeated rows and copies are one class; a document without doc_id links like any
other, and a component's id is the smallest non-null doc_id in it; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm import bitmaps
from quakeframe.llm.common import id_text, keyed_rows, materialize, own_names, row_key, ship_package
from quakeframe.llm.components import components
from quakeframe.llm.word_arrays import U, Words, by_bucket, mix, packed, pieces
from quakeframe.session import release

WORDS, PERCENT = 4, 85
SHARED_BITS, CLASS_BITS = 27, 22
COLD = 16
FLUSH = 1 << 20
#: Shingles with fewer documents than this keep class 0.
LEAST_CLASS = 8


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds): the distinct shingles of each text, sorted by hash."""
    h, text, _ = words.runs(k)
    per_text = np.diff(words.first)
    for i in np.flatnonzero((per_text > 0) & (per_text < k)):
        few = mix(np.array([np.bitwise_xor.reduce(mix(words.hash[words.first[i] : words.first[i + 1]] + U(1) + np.arange(per_text[i]).astype(U)))]) + U(per_text[i]))
        h, text = np.concatenate((h, few)), np.concatenate((text, [i]))
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    if len(h):
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
        h, text = h[new], text[new]
    return h, np.searchsorted(text, np.arange(len(per_text) + 1))


def _counts(k: int, bits_bucket: int):
    """(bucket, once, often, n): shingles of many documents at a time, counted
    before they are shuffled. The top 48 bits stand for a shingle here: the top
    byte is the bucket's, the next five are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            h = np.sort(np.concatenate(held) if held else np.zeros(0, U))
            top = h >> U(16)
            new = np.concatenate(([True], top[1:] != top[:-1])) if len(h) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            n = np.diff(np.concatenate((at, [len(h)])))
            one, many = h[at[n == 1]], h[at[n > 1]]
            b1, e1 = by_bucket(one, bits_bucket)
            b2, e2 = by_bucket(many, bits_bucket)
            nothing1, nothing2 = np.zeros(len(b1) + 1, np.int64), np.zeros(len(b2) + 1, np.int64)
            none = np.zeros(0, "<u4")
            times = np.minimum(n[n > 1], 2**32 - 1).astype("<u4")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((b1, b2)), pa.int32()),
                    pa.concat_arrays([_low(one, e1), packed(none, nothing2)]),
                    pa.concat_arrays([packed(none, nothing1), _low(many, e2)]),
                    pa.concat_arrays([packed(none, nothing1), packed(times, e2)]),
                ],
                names=["bucket", "once", "often", "n"],
            )

        for _, words in pieces(batches, "text", lower=True):
            h, _ = shingles(words, k)
            held.append(h)
            size += len(h)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        yield flush()

    return run


def _low(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Of each hash the five bytes below the top one."""
    raw = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:7])
    offsets = (np.asarray(bounds, np.int64) * 5).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def _from_low(column: pd.Series, bucket: int, bits_bucket: int) -> np.ndarray:
    """Hashes with the 16 low bits zero; ``bits_bucket`` is 8 or more."""
    raw = np.frombuffer(b"".join(column), np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:7] = raw
    out[:, 7] = bucket >> (bits_bucket - 8)
    return out.view("<u8").ravel().astype(U)


def _tables(bits_bucket: int, shared_bits: int, class_bits: int):
    """Per bucket: a bit for every shingle with two documents or more, and for each
    place of the class table the largest class (logarithm of the count)."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = key[0]
        once, often = _from_low(pdf["once"], bucket, bits_bucket), _from_low(pdf["often"], bucket, bits_bucket)
        times = bitmaps.unpack(pdf["n"], "<u4").astype(np.int64)
        h = np.concatenate((once, often))
        n = np.concatenate((np.ones(len(once), np.int64), times))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        df = np.add.reduceat(n, at) if len(at) else np.zeros(0, np.int64)
        h = h[at]
        shared = bitmaps.segment(h[df > 1], bucket, bits_bucket, shared_bits)
        size = 1 << (class_bits - bits_bucket)
        classes = np.zeros(size, np.uint8)
        some = df >= LEAST_CLASS
        place = (h[some] >> U(64 - class_bits)).astype(np.int64) - bucket * size
        np.maximum.at(classes, place, np.log2(df[some]).astype(np.uint8))
        return pd.DataFrame({"bucket": [bucket], "shared": [shared], "classes": [classes.tobytes()]})

    return run


def prefix_length(n: int, percent: int) -> int:
    """The 1-prefix of a set of ``n``: n - ceil(percent n / 100) + 1."""
    return n - (percent * n + 99) // 100 + 1


def choose_l(cost: np.ndarray, first: int, n: int) -> int:
    """``cost``: estimated postings of each shingle in the set's order. Reading the
    prefix costs its postings; verifying costs the set's size for each of the
    candidates, which fall about with the square of l."""
    best, best_l, l = None, 1, 1
    while l <= 16 and first + l - 1 <= n:
        postings = float(cost[: first + l - 1].sum())
        total = postings + n * postings / (first + l - 1) / l**2
        if best is None or total < best:
            best, best_l = total, l
        l *= 2
    return best_l


def _set_rows(k: int, percent: int, table):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_key", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("l", pa.int32()), ("prefix", pa.list_(pa.int64())), ("shared", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared_table, class_table = table.value
        class_shift = U(64 - (int(len(class_table)).bit_length() - 1))
        for batch, words in pieces(batches, "text", lower=True):
            h, bounds = shingles(words, k)
            n = np.diff(bounds)
            first_sum, second_sum = np.zeros(len(h) + 1, U), np.zeros(len(h) + 1, U)
            np.cumsum(mix(h + U(1)), dtype=U, out=first_sum[1:])
            np.cumsum(mix(h ^ U(0x5DEECE66D)), dtype=U, out=second_sum[1:])
            s1, s2 = first_sum[bounds[1:]] - first_sum[bounds[:-1]], second_sum[bounds[1:]] - second_sum[bounds[:-1]]
            shared = bitmaps.has(shared_table, h)
            klass = class_table[(h >> class_shift).astype(np.int64)]
            n_shared = np.diff(np.concatenate(([0], np.cumsum(shared)))[bounds])
            ells, prefixes, sets = [], [], []
            for i in range(len(n)):
                size, own = int(n[i]), int(n[i] - n_shared[i])
                first, ell, head, mine = prefix_length(size, percent), 1, None, None
                # As many shingles of its own as the 1-prefix is long: no link. With
                # fewer, the l-prefix has at least l shared ones, for any l.
                if size and own < first:
                    here = slice(bounds[i], bounds[i + 1])
                    pick = shared[here]
                    mine, grade = h[here][pick], klass[here][pick]
                    order = np.lexsort((mine, grade))
                    ell = choose_l(np.concatenate((np.zeros(own), 2.0 ** grade[order])), first, size)
                    head = mine[order][: first + ell - 1 - own].view(np.int64)
                ells.append(ell)
                prefixes.append(head)
                sets.append(None if mine is None else mine.tobytes())
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            keys = batch.column(batch.schema.get_field_index("row_key"))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, keys, pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(ells, pa.int32()),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array(sets, pa.binary()),
                ],
                schema=schema,
            )

    return run


_SET_SCHEMA = "doc_id long, row_key long, n long, s1 long, s2 long, l int, prefix array<long>, shared binary"
_OVERLAP_SCHEMA = "x long, y long, nx long, ny long, both long, outside_x long"


def _overlaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size of the overlap, and how many shared shingles x has outside y."""
    for b in batches:
        both, outside = [], []
        for sx, sy in zip(b["sx"], b["sy"], strict=True):
            x, y = np.frombuffer(sx, "<u8"), np.frombuffer(sy, "<u8")
            common = len(np.intersect1d(x, y, assume_unique=True))
            both.append(common)
            outside.append(len(x) - common)
        yield pd.DataFrame({"x": b["x"], "y": b["y"], "nx": b["nx"], "ny": b["ny"], "both": both, "outside_x": outside})


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact overlaps of (x, y); sets: (row_key, n, shared)."""
    x = sets.select(F.col("row_key").alias("x"), F.col("n").alias("nx"), F.col("shared").alias("sx"))
    y = sets.select(F.col("row_key").alias("y"), F.col("n").alias("ny"), F.col("shared").alias("sy"))
    return pairs.select("x", "y").join(x, "x").join(y, "y").mapInPandas(_overlaps, _OVERLAP_SCHEMA)


def links(sets: DataFrame, percent: int = PERCENT, cold: int = COLD) -> DataFrame:
    """(u, v): links between the documents of ``sets`` (row_key, n, l, prefix,
    shared; distinct sets, prefixes not null) that have every component of the
    full link graph connected."""
    t = f"{percent} * (nx + ny - both) <= 100 * both"
    fits = (percent * F.col("nx") <= 100 * F.col("ny")) & (percent * F.col("ny") <= 100 * F.col("nx"))
    postings = sets.select("row_key", "n", "l", F.size("prefix").alias("width"), F.octet_length("shared").alias("bytes"), F.explode("prefix").alias("shingle"))
    counts = postings.groupBy("shingle").agg(
        F.count("*").alias("df"),
        # The hub: the fewest shingles of its own (which nobody shares).
        F.min(F.struct((F.col("n") - F.col("bytes") / 8).cast("long").alias("own"), "row_key")).alias("hub"),
    )
    counts = materialize(counts.where("df > 1").select("shingle", "df", F.col("hub.row_key").alias("hub")), "shingle_counts")
    shared = materialize(postings.join(counts, "shingle").select("row_key", "n", "l", "shingle", "df", "hub"), "postings")
    hot_of = shared.where(F.col("df") > cold).groupBy("row_key").agg(F.count("*").alias("hot"))
    few = shared.where(F.col("df") <= cold).join(hot_of, "row_key", "left").select("row_key", "n", "l", "shingle", F.coalesce("hot", F.lit(0)).alias("hot"))
    a = few.select(F.col("row_key").alias("x"), F.col("n").alias("nx"), F.col("l").alias("lx"), F.col("hot").alias("hx"), "shingle")
    b = few.select(F.col("row_key").alias("y"), F.col("n").alias("ny"), F.col("l").alias("ly"), F.col("hot").alias("hy"), "shingle")
    met = a.join(b, "shingle").where((F.col("x") < F.col("y")) & fits)
    met = met.groupBy("x", "y").agg(F.count("*").alias("c"), F.first("lx").alias("lx"), F.first("ly").alias("ly"), F.first("hx").alias("hx"), F.first("hy").alias("hy"))
    cold_pairs = met.where(F.col("c") + F.least("hx", "hy") >= F.least("lx", "ly")).select("x", "y")
    if counts.where(F.col("df") > cold).isEmpty():  # without hot shingles the rest makes no pair
        return overlaps(cold_pairs, sets).where(t).select(F.col("x").alias("u"), F.col("y").alias("v"))
    spokes = shared.where((F.col("df") > cold) & (F.col("row_key") != F.col("hub"))).select(F.col("row_key").alias("x"), F.col("hub").alias("y")).distinct()
    spoke = materialize(overlaps(spokes, sets), "spokes")
    linked = spoke.where(t)
    # Pairs of one hub that aren't both linked to it. What lies outside the hub
    # can only be shared with what lies outside it too.
    s = spoke.select(F.col("y").alias("hub"), "x", "nx", "both", "outside_x", F.expr(f"coalesce(cast({percent} * (nx + ny - both) <= 100 * both as int), 0)").alias("on"))
    p = s.where("on = 0")
    q = s.select("hub", F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("both").alias("both_y"), F.col("outside_x").alias("outside_y"), F.col("on").alias("on_y"))
    most = F.least("both", "both_y") + F.least("outside_x", "outside_y")
    reach = (100 * most >= percent * (F.col("nx") + F.col("ny") - most)) & fits & (F.col("x") != F.col("y")) & ((F.col("on_y") == 1) | (F.col("x") < F.col("y")))
    rest = p.join(q, "hub").where(reach).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    known = spokes.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    todo = cold_pairs.unionByName(rest).distinct().join(known, ["x", "y"], "left_anti")
    found = overlaps(todo, sets).where(t)
    return linked.unionByName(found).select(F.col("x").alias("u"), F.col("y").alias("v"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, cold: int = COLD, shared_bits: int = SHARED_BITS, class_bits: int = CLASS_BITS) -> DataFrame:
    """Per document: doc_id, row_key, n_shingles, component_id, component_key (null
    for empty sets)."""
    spark = docs.sparkSession
    ship_package(spark)
    keyed = id_text(docs).withColumn("row_key", row_key())
    buckets = bitmaps.bucket_bits(spark, least=8)
    counted = keyed.select("text").mapInArrow(_counts(words, buckets), "bucket int, once binary, often binary, n binary")
    made = materialize(
        counted.groupBy("bucket").applyInPandas(_tables(buckets, shared_bits, class_bits), "bucket int, shared binary, classes binary"),
        "shingle_tables",
    )
    classes = np.zeros(1 << class_bits, np.uint8)
    width = len(classes) >> buckets
    for row in made.select("bucket", "classes").toLocalIterator():
        classes[row[0] * width : (row[0] + 1) * width] = np.frombuffer(row[1], np.uint8)
    tables = bitmaps.send(spark, (bitmaps.collect(made, "shared", buckets, shared_bits), classes))
    sets = materialize(keyed.mapInArrow(_set_rows(words, percent, tables), _SET_SCHEMA), "shingle_sets")
    tables.destroy()  # the sets are written: nothing reads the tables again
    del tables, classes
    release(spark)
    same = ["n", "s1", "s2"]
    members = materialize(
        sets.where("n > 0").groupBy(*same).agg(F.min("row_key").alias("class_key"), F.min("doc_id").alias("least_id")), "set_classes"
    )
    # One row for each class: the members' prefixes and sets are equal.
    with_prefix = sets.where("prefix IS NOT NULL").select("row_key", "n", "l", "prefix", "shared")
    chosen = with_prefix.join(members.select(F.col("class_key").alias("row_key")), "row_key", "left_semi").dropDuplicates(["row_key"])
    edges = links(materialize(chosen, "class_sets"), percent, cold)
    release(spark)
    found = components(edges)
    rooted = members.join(found.withColumnRenamed("node", "class_key"), "class_key", "left").withColumn("root", F.coalesce("root", "class_key"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = rooted.join(ids, "root").select(*same, F.col("root").alias("component_key"), "component_id")
    rows = sets.select("doc_id", "row_key", *same)
    out = rows.join(by_class, same, "left")
    return out.select(
        "doc_id",
        "row_key",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component_key",
    )


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, the one with its id; rows that
    repeat it are one. Documents without shingles all stay."""
    found = near_duplicates(docs, words, percent).where("n_shingles > 0")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("best")
    mine, kept = own_names(docs, "key", "kept_key")
    keep = found.groupBy("component_key").agg(best).select(F.col("best.row_key").alias(kept))
    keyed = keyed_rows(docs, mine)
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    full = keyed.where(has_words).join(keep, F.col(mine) == F.col(kept), "left_semi").dropDuplicates([mine])
    return full.unionByName(keyed.where(~has_words)).select(*docs.columns)
