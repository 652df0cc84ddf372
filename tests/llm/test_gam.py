import random
import zlib

import numpy as np
from llm.conftest import SF01, awkward, frame, table
from quakeframe.llm import gam, queries


def corpus(n=500):
    """Bad texts repeat a word or end words in symbols; good ones have a bit of either."""
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(["ka", "lo", "mi", "ren"]) + r.choice(["na", "vo", "shi"]) + "aeiou"[r.randrange(5)] for _ in range(60 + r.randrange(80))]
        bad = i % 5 == 0
        if bad and i % 2:
            words = [w + r.choice(["###", "$$$"]) for w in words]
        elif bad:
            words = [words[j // 20] for j in range(len(words))]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad)))
    return rows, labels


def scores(spark, rows, labels, **options):
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    return {r.doc_id: r for r in gam.quality_scores(frame(spark, rows), y, **options).collect()}


def test_held_out_accuracy_and_shape(spark):
    rows, labels = corpus()
    got = scores(spark, rows, labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [i for i, _ in labels if got[i].held_out]
    assert len(held) > 120 and sum(got[i].predicted == y for i, y in labels if got[i].held_out) >= 0.97 * len(held)


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(200)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = ({i: r.score for i, r in scores(spark, rows, x).items()} for x in (labels, flipped))
    assert a == b


def test_order_and_partitions_change_nothing(spark):
    rows, labels = corpus(200)
    y = spark.createDataFrame(labels, "doc_id long, quality int")
    a, b = ({r.doc_id: r.score for r in gam.quality_scores(frame(spark, x, parts), y).collect()} for x, parts in ((rows, 1), (rows[::-1], 7)))
    assert a == b


def test_awkward_rows_and_labels(spark):
    rows = awkward()
    none = scores(spark, rows, [])
    assert len(none) == len({i for i, _ in rows}) and {r.score for r in none.values()} == {0.5}
    one_kind = scores(spark, rows, [(i, 1) for i in range(2, 30)] + [(None, 0), (10**9, 0), (3, None)])
    assert len({r.score for r in one_kind.values()}) == 1 and one_kind[1].score > 0.9
    more, labels = corpus(150)
    both = [(i + 1000, t) for i, t in more] + rows
    got = scores(spark, both, [(i + 1000, y) for i, y in labels] * 2)
    assert all(0.0 <= r.score <= 1.0 for r in got.values())
    assert gam.quality_scores(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_figures():
    f = dict(zip(gam.FEATURES, gam.figures("The the the cat\nThe the the cat\n#### !!"), strict=True))
    assert f["symbols"] == 4 / 39 and f["dup_lines"] == 1 / 3 and f["top_word"] == 4 / 10 and f["repeat_neighbours"] == 2 / 10
    assert all(np.isfinite(gam.figures(t or "")).all() for _, t in awkward())
    assert len(gam.figures("")) == len(gam.FEATURES)


def test_shallow_tree_finds_the_best_cut():
    """One cut against all cuts by hand."""
    r = np.random.default_rng(1)
    for _ in range(20):
        g, h = r.normal(size=9), r.random(9) + 2
        step = gam.shallow_tree(g, h, 1, 1.0, 1.0)
        gain = [g[:k].sum() ** 2 / (h[:k].sum() + 1) + g[k:].sum() ** 2 / (h[k:].sum() + 1) for k in range(1, 9)]
        k = int(np.argmax(gain)) + 1
        want = np.where(np.arange(9) < k, -g[:k].sum() / (h[:k].sum() + 1), -g[k:].sum() / (h[k:].sum() + 1))
        assert np.allclose(step, want) or np.allclose(step, -g.sum() / (h.sum() + 1))


def test_pairs_learn_what_single_tables_cannot():
    """Exclusive or: no feature alone tells anything; its pair must rank first and decide."""
    r = np.random.default_rng(2)
    x = r.random((2000, 4))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    cuts, weight = gam.cuts_of(x, gam.COARSE), np.ones(len(y))
    bins, sizes = gam.to_bins(x, cuts), [gam.COARSE] * 4
    bias, tables = gam.boost_features(bins, y, weight, sizes, 20, 0.1)
    start = bias + sum(t[bins[:, j]] for j, t in enumerate(tables))
    p = gam._logistic(start)
    assert np.mean((p > 0.5) == y) < 0.65
    ranked = gam.rank_pairs(bins, sizes, p - y, p * (1 - p))
    assert ranked[0][1:] == (1, 3)
    grid = gam.boost_pairs(bins, y, weight, start, [(1, 3)], sizes, 40, 0.2)[0]
    model = gam.AdditiveModel(bias, cuts, cuts, tables, [(1, 3)], [grid])
    fresh = r.random((1000, 4))
    assert np.mean((model.scores(fresh) > 0.5) == ((fresh[:, 1] > 0.5) ^ (fresh[:, 3] > 0.5))) > 0.97


def test_tables_add_up():
    """Vectorised scoring equals looking up one row's bins by hand."""
    r = np.random.default_rng(3)
    x = r.random((200, 3))
    cuts, coarse = gam.cuts_of(x, 6), gam.cuts_of(x, 3)
    tables = [r.normal(size=6) for _ in range(3)]
    grid = r.normal(size=(3, 3))
    model = gam.AdditiveModel(0.3, cuts, coarse, tables, [(0, 2)], [grid])
    for row, got in zip(x, model.logits(x), strict=True):
        at = [sum(c < v for c in cs) for cs, v in zip(cuts, row, strict=True)]
        few = [sum(c < v for c in cs) for cs, v in zip(coarse, row, strict=True)]
        assert np.isclose(got, 0.3 + sum(t[i] for t, i in zip(tables, at, strict=True)) + grid[few[0], few[2]])


def test_query_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(SF01, "labels")}
    got = {r.doc_id: r for r in queries.op13_quality_gam(spark, SF01).collect()}
    assert len(got) == len(table(SF01))
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.95 * len(held)
