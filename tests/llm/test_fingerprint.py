import hashlib

import numpy as np
import pytest

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import fingerprint as fp
from quakeframe.llm import queries


def plain_digest(text):
    """The digest again, byte by byte."""
    data = text.encode()
    counts = [0] * fp.BUCKETS
    for i in range(len(data) - 4):
        for table_, (a, b, c) in zip(fp._TABLES, fp.TRIPLETS, strict=True):
            counts[table_[0][data[i + a]] ^ table_[1][data[i + b]] ^ table_[2][data[i + c]]] += 1
    q1, q2, q3 = (sorted(counts)[fp.BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    bits = "".join(f"{(x > q1) + (x > q2) + (x > q3):02b}" for x in counts)
    return q1, q2, q3, f"{int(bits, 2):064x}"


@pytest.mark.parametrize("text", ["", "a", "abcd", "abcde", "The quick brown fox. " * 30, "é中🙂" * 40])
def test_digest_against_plain_loop(text):
    q1, q2, q3, body = plain_digest(text)
    got = fp.digest(text)
    assert len(got) == 68 and got[4:] == body
    assert got[2:4] == f"{(100 * q1 // q3) % 16 if q3 else 0:x}{(100 * q2 // q3) % 16 if q3 else 0:x}"


def test_chunks_join(monkeypatch):
    text = "some words that go on and on " * 50
    whole = fp.digest(text)
    monkeypatch.setattr(fp, "_CHUNK", 64)
    assert fp.digest(text) == whole


def test_likeness_bounds_and_order():
    r = np.random.default_rng(1)
    words = [f"w{i}" for i in range(500)]
    base = " ".join(r.choice(words, 600))
    near = base.replace("w1", "zz")
    far = " ".join(r.choice([f"q{i}z" for i in range(500)], 600))
    a, b, c = fp.digest(base), fp.digest(near), fp.digest(far)
    assert fp.likeness(a, a) == 1.0 and 0.0 <= fp.likeness(a, c) < fp.likeness(a, b) < 1.0
    assert fp.likeness(a, c) == fp.likeness(c, a)
    assert fp.difference("00" + "00" + "00" * 32, "ff" + "88" + "ff" * 32) <= fp._WORST


def brute(rows):
    """Order: null ids first, then ids, then texts."""
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    out = []
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = fp.digest(t), fp.digest(edited), fp.digest(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [awkward(), [(1, "only one")], [(1, None), (2, "")]])
def test_report_against_brute_force(spark, rows):
    assert sorted((tuple(r) for r in fp.neighbour_report(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_empty_table_and_query(spark):
    assert fp.neighbour_report(frame(spark, [])).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in table(SF001)]
    assert sorted((tuple(r) for r in queries.op7_fingerprint(spark, SF001).collect()), key=str) == brute(rows)


def test_equal_texts_have_equal_fingerprints(spark):
    rows = [(1, "same text here"), (2, "same text here"), (3, "other"), (4, None), (5, "")]
    got = {r.doc_id: r.fingerprint for r in fp.fingerprints(frame(spark, rows)).collect()}
    assert got[1] == got[2] != got[3] and got[4] == got[5] == fp.digest("")
