import collections
import random
import zlib
from bisect import bisect_right

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import packing, queries
from quakeframe.llm.tokens import load_tokenizer


def sequences(histogram, plan):
    """The plan carried out for every item: sequence -> [(offset, length)]."""
    order = [n for n in sorted(histogram, reverse=True) for _ in range(histogram[n])]
    first = [r[0] for r in plan.rows]
    out = collections.defaultdict(list)
    for rank, length in enumerate(order):
        r = plan.rows[bisect_right(first, rank) - 1]
        assert r[4] == length
        turn, nth = divmod(rank - r[0], r[3])
        out[r[1] + turn].append((r[2] + nth * length, length))
    return out


def check(histogram, capacity, plan):
    found = sequences(histogram, plan)
    for items in found.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(found) == set(range(plan.n_sequences))


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([7, 50, 2048]), st.data())
def test_plans_are_gapless_and_fit(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=40, unique=True))
    histogram = {n: data.draw(st.sampled_from([1, 2, 3, 17, 500])) for n in lengths}
    check(histogram, capacity, packing.make_plan(histogram, capacity))


def test_near_the_bound_on_mixed_lengths():
    lengths = np.clip(np.random.default_rng(0).lognormal(6.3, 0.9, 30_000).astype(int), 1, 2048)
    histogram = dict(collections.Counter(lengths.tolist()))
    plan = packing.make_plan(histogram, 2048)
    assert plan.n_sequences <= 1.012 * -(-int(lengths.sum()) // 2048)
    assert len(plan.rows) < 12_000  # bounded by lengths and groups, not by items
    ten_times = packing.make_plan({k: 10 * v for k, v in histogram.items()}, 2048)
    assert len(ten_times.rows) < 12_000 and ten_times.n_sequences <= 10 * plan.n_sequences


def test_exact_on_perfect_triples():
    histogram = {1000: 300, 700: 300, 348: 300}
    assert packing.make_plan(histogram, 2048).n_sequences <= 303


def brute_pieces(rows, tokenizer, capacity):
    t = load_tokenizer(tokenizer)
    out = collections.Counter()
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out[i, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pieces_and_places(spark, tokenizer, capacity):
    rows = awkward()
    got = packing.pack(frame(spark, rows), tokenizer, capacity).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows, tokenizer, capacity)
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty_table_and_query(spark, tokenizer):
    assert packing.pack(frame(spark, []), tokenizer).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in table(SF001)]
    got = queries.op2_packing(spark, SF001).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute_pieces(rows, tokenizer, 2048)


def test_hot_length_is_ranked_over_many_partitions(spark):
    r = random.Random(1)
    rows = [(i, 0, 0, 5 if i % 3 else r.randrange(1, 9), i) for i in range(4000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    ranked, histogram = packing.rank_by_length(pieces)
    got = ranked.orderBy("rank").collect()
    assert [x["rank"] for x in got] == list(range(4000))
    assert [x["length"] for x in got] == sorted((x[3] for x in rows), reverse=True)
    assert histogram == dict(collections.Counter(x[3] for x in rows))
