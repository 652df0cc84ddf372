import random
import re
from collections import Counter

import numpy as np
import pytest
from llm.conftest import SF001, awkward, table
from quakeframe.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, max_words=3, top=2000, cover=50):
    f, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    p = (lang, tuple(w[i : i + k]))
                    f[p] = f.get(p, 0) + 1
    cand = {p: a for p, a in f.items() if len(p[1]) >= 2 and a >= least}
    covered = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= cover * f[lang, w[i : i + k]]:
                    covered.add((lang, w[i : i + k]))
    by_lang = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in covered:
            cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            by_lang.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    out = set()
    for lang, found in by_lang.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", 0) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, a long, phrase string, chunk int").repartition(5)


def result(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def corpus(n=300, vocabulary=25, seed=3):
    r = random.Random(seed)
    words = ["the", "The", "of", "New", "york", "é", "中文", "don't", "a\x1cb", "x y"] + [f"w{i}" for i in range(vocabulary)]
    rows = []
    for i in range(n):
        w = [r.choice(words[: 4 + (i % len(words))]) for _ in range(r.randrange(40))]
        w += ["gnu", "general", "public"] * (i % 3 == 0) + ["the", "the", "the", "the"] * (i % 5 == 0)
        rows.append((r.choice(["en", "en", "en", "fr", None, "und"]), "".join(x + r.choice([" ", "  ", "\t", " ", ", ", ".\n", "\r\n", "! "]) for x in w)))
    return rows


def test_equals_brute_force(spark):
    rows = corpus() + [("en", t) for _, t in awkward()] + [("fr", None), (None, ""), ("xx", "one two")]
    want = brute(rows)
    assert len(want) > 50 and any(len(p.split()) == 3 for _, _, p, *_ in want)
    assert result(phrases.collocations(frame(spark, rows))) == want


@pytest.mark.parametrize("chunk_words", [1, 40])
def test_small_chunks_change_nothing(spark, chunk_words):
    rows = corpus(60)
    assert result(phrases.collocations(frame(spark, rows), least=4, chunk_words=chunk_words)) == brute(rows, least=4)


def test_longer_phrases_and_top(spark):
    rows = corpus(120, 6)
    assert result(phrases.collocations(frame(spark, rows), least=6, max_words=5, top=17, cover_percent=80)) == brute(rows, 6, 5, 17, 80)
    assert result(phrases.collocations(frame(spark, rows), least=6, max_words=2, top=17)) == brute(rows, 6, 2, 17)


def test_a_table_too_small_for_the_pairs_changes_nothing(spark, monkeypatch):
    """All bits set: every pair is looked up, and chunks are counted one by one."""
    monkeypatch.setattr(phrases.pair_sequences, "__defaults__", (9,))
    monkeypatch.setattr(phrases, "GATHER", 1)
    rows = corpus(80, 6)
    assert result(phrases.collocations(frame(spark, rows), least=5)) == brute(rows, least=5)


def test_long_texts_go_by_slices(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 50)
    rows = corpus(30) + [("en", "alpha beta gamma " * 400), ("en", "z" * 500 + " alpha beta " + "y" * 300)]
    chunk = phrases.OpenChunk()
    for _, t in rows:
        chunk.add((t or "").encode())
    whole = phrases.OpenChunk()
    monkeypatch.setattr(phrases, "SLICE", 1 << 20)
    for _, t in rows:
        whole.add((t or "").encode())
    assert list(chunk.codes) == list(whole.codes)
    assert np.array_equal(np.concatenate(chunk.parts), np.concatenate(whole.parts))


@pytest.mark.parametrize("tile,head,fill", [(4, 3, 0.01), (4, 3, 1e9), (512, 8, 0.125), (1, 50, 0.0)])
def test_tiles_and_coordinates_agree(tile, head, fill):
    r = np.random.default_rng(5)
    ids = np.where(r.random(5000) < 0.1, -1, np.minimum(r.zipf(1.3, 5000), 10**6))
    a, b, n = phrases.count_pairs(ids, tile, head, fill)
    want = Counter((int(x), int(y)) for x, y in zip(ids, ids[1:], strict=False) if x >= 0 and y >= 0)
    assert {(int(x), int(y)): int(c) for x, y, c in zip(a, b, n, strict=True)} == want and len(a) == len(want)
    for short in ([], [3], [-1, -1]):
        assert len(phrases.count_pairs(np.array(short, np.int64))[0]) == 0


def test_ids_beyond_a_product_of_64_bits():
    big = np.array([2**32, 2**32, 5], np.int64)
    with pytest.raises(ValueError):
        phrases.count_pairs(big)


def test_scores_beyond_64_bits(spark):
    """a * a * 1000000 has 30 digits here."""
    df = spark.createDataFrame([(10**12 + 7, [10**12 + 9, 3 * 10**12], [10**12 + 11, 10**12 + 8])], "f long, heads array<long>, tails array<long>")
    got = df.select(phrases._lowest_cut().alias("c")).first().c
    a = 10**12 + 7
    assert (got.score, got.k, got.l, got.r) == (1000000 * a * a // (3 * 10**12 * (10**12 + 8)), 1, 3 * 10**12, 10**12 + 8)


def test_ids_are_ranks(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(200)], "x long, f long")
    from pyspark.sql import functions as F

    got = [(r.f, r.x) for r in phrases.with_ids(df, "t", F.col("f").desc(), F.col("x")).orderBy("id").collect()]
    assert got == sorted(((f, x) for x, f in ((i, i % 7) for i in range(200))), key=lambda p: (-p[0], p[1]))
    assert [r.id for r in phrases.with_ids(df, "t", F.col("f")).orderBy("id").collect()] == list(range(200))


def test_empty_and_rare(spark):
    assert result(phrases.collocations(frame(spark, []))) == set()
    assert result(phrases.collocations(frame(spark, [("en", None), ("en", "only once here")]))) == set()


def test_query_equals_brute_force(spark):
    rows = [(d["lang"], d["text"]) for d in table(SF001)]
    assert result(queries.op12_phrases(spark, SF001)) == brute(rows)
