import collections
import random
import re

import pytest

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import ngram_join, queries
from quakeframe.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(rows, k):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(UP))
        out.append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def brute(rows, k=4, percent=85):
    s = sets(rows, k)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    postings = collections.defaultdict(list)
    for i, x in enumerate(s):
        for g in x:
            postings[g].append(i)
    for i, x in enumerate(s):
        for j, n in collections.Counter(j for g in x for j in postings[g] if j < i).items():
            if 100 * n >= percent * (len(x) + len(s[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return collections.Counter((d, len(x), least.get(root(i)) if x else d) for i, ((d, _), x) in enumerate(zip(rows, s, strict=True)))


def got(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def crowd(n=300):
    """A large group of near copies at all distances from their source, copies,
    chains of edits and a passage that many unlike texts share."""
    r = random.Random(3)
    base = [f"w{r.randrange(400)}" for _ in range(150)]
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(r.choice([0, 0, 1, 2, 3, 5, 8])):
            at = r.randrange(len(w))
            w[at : at + 1] = r.choice([[], [f"e{r.random()}"], [w[at], w[at]]])
        rows.append((i, " ".join(w)))
    chain = [f"c{i}" for i in range(120)]
    for i in range(n, n + 20):
        chain[(i * 13) % 120] = f"d{i}"
        rows.append((i, " ".join(chain).upper()))
    for i in range(n + 20, n + 120):
        rows.append((i, passage + " " + " ".join(f"u{r.random()}" for _ in range(r.randrange(1, 60)))))
    return rows


@pytest.mark.parametrize(("cold", "percent"), [(1, 85), (4, 85), (16, 85), (2, 60), (3, 95)])
def test_against_brute_force(spark, cold, percent):
    rows = crowd() + [(None if i is None else i + 5000, t) for i, t in awkward()]
    assert got(ngram_join.near_duplicates(frame(spark, rows), percent=percent, cold=cold)) == brute(rows, 4, percent)


@pytest.mark.parametrize("bits", [12, 22])
def test_full_tables_change_nothing(spark, bits):
    """Tables far too small for the corpus let more through, and lose nothing."""
    rows = crowd(120)
    assert got(ngram_join.near_duplicates(frame(spark, rows), shared_bits=bits, class_bits=12)) == brute(rows)


def test_short_texts_and_empty_table(spark):
    rows = [(1, "a b"), (2, "A  b"), (3, "a b c"), (4, ""), (5, None), (6, "b a"), (7, "a b c d"), (8, "a b c d")]
    assert got(ngram_join.near_duplicates(frame(spark, rows))) == brute(rows)
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    assert ngram_join.drop_near_duplicates(frame(spark, [])).count() == 0


def test_one_of_each_group_stays(spark):
    rows = crowd(60) + [(9000, None), (9001, ""), (9002, " "), (None, "no id at all here"), (None, "no id at all here"), (None, "quite another text here")]
    df = frame(spark, rows)
    kept = collections.Counter((r.doc_id, r.text) for r in ngram_join.drop_near_duplicates(df).collect())
    groups = {c for (d, n, c) in brute(rows) if n and c is not None}
    assert sorted(d for (d, t) in kept if d is not None and t and t.strip()) == sorted(groups)
    assert {t for (d, t) in kept if d is None} == {"no id at all here", "quite another text here"}
    assert (9000, None) in kept and (9001, "") in kept and (9002, " ") in kept and max(kept.values()) == 1


def test_query_on_fixture(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF001)]
    assert got(queries.op3_ngram_join(spark, SF001)) == brute(rows)


def test_prefix_lengths():
    assert ngram_join.prefix_length(1, 85) == 1 and ngram_join.prefix_length(100, 85) == 16


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = {x.node: x.root for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
