"""Best-fit packing of documents into sequences by a linear grouping scheme.

Documents are encoded, given an end id, and cut only where they are longer than
a sequence. The plan is made from the length histogram (at most ``capacity``
numbers, whatever the corpus):

1. Lengths over ``capacity * small`` are large. Sorted by length, they are dealt
   into groups of equal cardinality and rounded up to their group's longest.
2. Few sizes are left, so all configurations (sets of sizes that fit a
   sequence) can be priced: column generation solves the linear program of the
   fewest sequences, and its solution is rounded down.
3. Actual documents take the places of their group's size, in order of length.
4. What rounding left over, and then the small ones, go best-fit, longest first,
   into the sequence with the least room that fits, else into a new one.

Several group counts are tried on the histogram and the best plan is used.

The plan speaks of ranks, not of documents: "the items with ranks g0 to g1 go to
consecutive sequences from s0 at offset o". Pieces get their rank in the order by
length from one range-partitioned sort: place in the partition plus the
partitions' sizes before. Neither a hot length nor equal rows gather in one task.

Defined cases: a null or empty text is its end id alone; repeated rows are packed
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import id_text, map_pandas, materialize, shuffle_parts
from quakeframe.llm.tokens import encoder


@dataclass
class Plan:
    """``rows``: (first rank, first sequence, offset, items per sequence, length);
    each holds from its first rank to the next row's."""

    n_sequences: int = 0
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)


class _Open:
    """Sequences with room: for each amount of room, runs of (first, count)."""

    def __init__(self) -> None:
        self.room: list[int] = []
        self.runs: dict[int, list[list[int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        if room <= 0 or count <= 0:
            return
        if room not in self.runs:
            insort(self.room, room)
            self.runs[room] = []
        self.runs[room].append([first, count])

    def take(self, length: int) -> tuple[int, list[int]] | None:
        """The run with the least room that fits."""
        i = bisect_left(self.room, length)
        if i == len(self.room):
            return None
        room = self.room[i]
        run = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room]
            self.room.pop(i)
        return room, run


def _configurations(sizes: list[int], capacity: int, most: int) -> np.ndarray:
    """All non-empty multisets of at most ``most`` sizes that fit, as counts."""
    found = []
    for n in range(1, most + 1):
        for combo in itertools.combinations_with_replacement(range(len(sizes)), n):
            if sum(sizes[i] for i in combo) <= capacity:
                found.append(combo)
    out = np.zeros((len(found), len(sizes)))
    for row, combo in enumerate(found):
        for i in combo:
            out[row, i] += 1
    return out


def _fewest(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Column generation for: cover ``demand`` with the fewest sequences. Returns
    (configuration, times), the linear solution rounded down."""
    k = len(sizes)
    configs = _configurations(sizes, capacity, capacity // min(sizes))
    basis = np.diag([float(capacity // s) for s in sizes])
    want = np.array(demand, float)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        x = np.maximum(inverse @ want, 0.0)
        value = configs @ (np.ones(k) @ inverse)
        best = int(np.argmax(value))
        if value[best] <= 1 + 1e-7:
            break
        d = inverse @ configs[best]
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1.0), np.inf)
        basis[:, int(np.argmin(ratio))] = configs[best]
    x = np.linalg.solve(basis, want)
    return [(basis[:, j].astype(int), int(np.floor(x[j] + 1e-9))) for j in range(k) if x[j] >= 1 - 1e-9]


def plan_with_groups(lengths: list[int], counts: list[int], capacity: int, groups: int, small: float = 0.25) -> Plan:
    """``lengths`` descending with their ``counts``; ranks count in this order."""
    plan, room = Plan(), _Open()
    starts = [0, *itertools.accumulate(counts)]
    at = list(starts[:-1])  # next free rank of each length

    def whole(i: int) -> bool:
        return lengths[i] == capacity

    big = [i for i, n in enumerate(lengths) if capacity * small < n < capacity]
    for i in range(len(lengths)):
        if whole(i):
            plan.rows.append((at[i], plan.n_sequences, 0, 1, lengths[i]))
            plan.n_sequences += counts[i]
            at[i] += counts[i]
    if big:
        _pack_large(plan, room, lengths, counts, starts, at, big, capacity, groups)
    for i, length in enumerate(lengths):
        left = starts[i + 1] - at[i]
        while left:
            got = room.take(length)
            if got is None:
                per = capacity // length
                need = -(-left // per)
                got = (capacity, [plan.n_sequences, need])
                plan.n_sequences += need
            free, (first, count) = got
            per = free // length
            used = capacity - free
            if left >= per:
                full = min(count, left // per)
                plan.rows.append((at[i], first, used, per, length))
                at[i] += full * per
                left -= full * per
                room.add(free - per * length, first, full)
                room.add(free, first + full, count - full)
            else:
                plan.rows.append((at[i], first, used, left, length))
                at[i] += left
                room.add(free - left * length, first, 1)
                room.add(free, first + 1, count - 1)
                left = 0
    plan.rows.sort()
    return plan


def _pack_large(plan: Plan, room: _Open, lengths, counts, starts, at, big, capacity, groups) -> None:
    total = sum(counts[i] for i in big)
    per_group = max(1, -(-total // groups))
    first_rank = starts[big[0]]
    edges = list(range(0, total, per_group)) + [total]
    if len(big) <= groups:  # few lengths are groups as they are, without rounding
        edges = [starts[i] - first_rank for i in big] + [total]
    sizes, demand, cursor = [], [], []

    def length_at(rank: int) -> int:
        """Index of the length that holds a rank."""
        return bisect_left(starts, rank + 1) - 1

    for a, b in itertools.pairwise(edges):
        sizes.append(lengths[length_at(first_rank + a)])
        demand.append(b - a)
        cursor.append([first_rank + a, first_rank + b])
    merged: dict[int, list] = {}
    for s, n, c in zip(sizes, demand, cursor, strict=True):  # groups of one size are one
        if s in merged:
            merged[s][0] += n
            merged[s][1][1] = c[1]
        else:
            merged[s] = [n, c]
    sizes, demand, cursor = list(merged), [m[0] for m in merged.values()], [m[1] for m in merged.values()]
    for config, times in _fewest(sizes, demand, capacity):
        slots = [j for j, n in enumerate(config) for _ in range(n)]
        # Each place takes the next ``times`` ranks of its group, or what is left.
        takes = []
        for j in slots:
            a, b = cursor[j]
            n = min(times, b - a)
            takes.append((a, n))
            cursor[j][0] = a + n
        cuts = {0, times}
        for a, n in takes:
            cuts.add(n)
            i = length_at(a)
            while i < len(lengths) and starts[i + 1] < a + n:
                cuts.add(starts[i + 1] - a)
                i += 1
        for x, y in itertools.pairwise(sorted(cuts)):
            used = 0
            for a, n in takes:
                if x < n:
                    length = lengths[length_at(a + x)]
                    plan.rows.append((a + x, plan.n_sequences + x, used, 1, length))
                    used += length
            room.add(capacity - used, plan.n_sequences + x, y - x)
        plan.n_sequences += times
    # What is left of the groups: ranges of ranks inside the lengths. Best-fit
    # takes whole lengths from their next free rank, so each left range is
    # placed here, the longest first.
    for a, b in cursor:
        while a < b:
            i = length_at(a)
            end = min(b, starts[i + 1])
            _best_fit_ranks(plan, room, a, end, lengths[i], capacity)
            a = end
    for i in big:
        at[i] = starts[i + 1]


def _best_fit_ranks(plan: Plan, room: _Open, a: int, b: int, length: int, capacity: int) -> None:
    while a < b:
        got = room.take(length)
        if got is None:
            per = capacity // length
            need = -(-(b - a) // per)
            got = (capacity, [plan.n_sequences, need])
            plan.n_sequences += need
        free, (first, count) = got
        per = min(free // length, b - a)
        full = min(count, (b - a) // per)
        plan.rows.append((a, first, capacity - free, per, length))
        a += full * per
        room.add(free - per * length, first, full)
        room.add(free, first + full, count - full)


#: (groups, share of a sequence over which a length is large) to try.
SCHEMES = ((12, 0.25), (24, 0.25), (48, 0.25), (8, 0.125))


def make_plan(histogram: dict[int, int], capacity: int, schemes: tuple[tuple[int, float], ...] = SCHEMES) -> Plan:
    lengths = sorted(histogram, reverse=True)
    counts = [histogram[n] for n in lengths]
    plans = [plan_with_groups(lengths, counts, capacity, g, small) for g, small in schemes]
    return min(plans, key=lambda p: p.n_sequences)


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        width = 4 * capacity
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].astype("Int64"), b["text"], strict=True):
                ids = enc.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return map_pandas(id_text(docs), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def rank_by_length(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``pieces`` with ``rank`` (longest first, gapless from 0), and the length
    histogram. Only one row per partition and length crosses the driver: at most
    the number of partitions plus the number of lengths."""
    # A random key beside the length splits a hot length over partitions.
    spread = pieces.withColumn("spread", F.xxhash64("doc_id", "piece", "ids_crc32"))
    parts = shuffle_parts(pieces.sparkSession)
    order = [F.col("length").desc(), F.col("spread")]
    dealt = spread.repartitionByRange(parts, *order).sortWithinPartitions(*order, "doc_id", "piece")
    placed = materialize(dealt.drop("spread").withColumn("place", F.monotonically_increasing_id()), "pieces_by_length")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part"), "length").count().collect()
    per_part: dict[int, int] = {}
    histogram: dict[int, int] = {}
    for r in sizes:
        per_part[r["part"]] = per_part.get(r["part"], 0) + r["count"]
        histogram[r["length"]] = histogram.get(r["length"], 0) + r["count"]
    before, bases = 0, {}
    for p in sorted(per_part):
        bases[p] = before - (p << 33)
        before += per_part[p]
    base = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in bases.items() for x in kv]), part) if bases else F.lit(0)
    return placed.withColumn("rank", F.col("place") + base).drop("place"), histogram


def place(ranked: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. The plan's rows are bounded by the
    number of lengths, groups and configurations, not by the corpus."""
    rows = np.array(plan.rows or [(0, 0, 0, 1, 1)], dtype=np.int64).T
    columns = [*ranked.drop("rank").columns]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("rank").schema) + ", sequence_id long, offset long"

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first_rank, first_seq, offset, per, length = rows
        for b in batches:
            rank = b["rank"].to_numpy()
            i = np.searchsorted(first_rank, rank, side="right") - 1
            turn, nth = np.divmod(rank - first_rank[i], per[i])
            out = b[columns].copy()
            out["sequence_id"] = first_seq[i] + turn
            out["offset"] = offset[i] + nth * length[i]
            if "doc_id" in out:
                out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return map_pandas(ranked, assign, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # Written first: a range partitioning reads its input twice.
    pieces = materialize(encode_pieces(docs, tokenizer, capacity, end_id), "pieces")
    ranked, histogram = rank_by_length(pieces)
    return place(ranked, make_plan(histogram, capacity))
