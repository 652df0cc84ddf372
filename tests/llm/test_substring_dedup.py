import collections
import hashlib
import random
import re

import pytest

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, m):
    words = [WORD.findall(t or "") for _, t in rows]
    count = collections.Counter(tuple(w[i : i + m]) for w in words for i in range(len(w) - m + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - m + 1):
            if count[tuple(w[i : i + m])] > 1:
                gone[i : i + m] = [True] * m
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return collections.Counter(out)


def got(df):
    return collections.Counter(tuple(r) for r in df.collect())


def rows_with_repeats():
    r = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(30)))) for i in range(80)]
    for i in range(80, 140):
        own = [f"u{r.random()}" for _ in range(r.randrange(60))]
        at = r.randrange(len(own) + 1)
        rows.append((i, " ".join(own[:at]) + "\n" + passage + "\t" + " ".join(own[at:])))
    return rows + awkward()


@pytest.mark.parametrize("flush", [40, 1 << 20])
@pytest.mark.parametrize("m", [3, 4, 7, 35])
def test_against_brute_force(spark, monkeypatch, m, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    rows = rows_with_repeats()
    assert got(substring_dedup.digest(substring_dedup.remove_repeats(frame(spark, rows), m, 14, 12))) == brute(rows, m)


def test_full_tables_change_nothing(spark):
    rows = rows_with_repeats()
    assert got(substring_dedup.digest(substring_dedup.remove_repeats(frame(spark, rows), 7, 12, 12))) == brute(rows, 7)


def test_empty_table_and_overlap_in_one_text(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
    rows = [(1, "a " * 50), (2, "b " * 34), (3, "c " * 35), (4, "c " * 35)]
    assert got(substring_dedup.digest(substring_dedup.remove_repeats(frame(spark, rows)))) == brute(rows, 35)


def test_query_on_fixture(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF001)]
    assert got(queries.op5_substring_dedup(spark, SF001)) == brute(rows, 35)
