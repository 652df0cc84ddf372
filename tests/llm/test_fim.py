import hashlib

import pytest

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import fim, queries


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def by_hand(doc_id, text):
    """The contract in plain slicing."""
    t = text or ""
    x = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(t)
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, t)
    p, m, s = t[:lo], t[lo:hi], t[hi:]
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}")


def key(row):
    return tuple("" if x is None else str(x) for x in row)


def rows():
    marks = [(100 + i, t) for i, t in enumerate(["a<P>b", "<S>", "x<M", "<P", "<", ">", "P>S>M>", "🙂é<S", "<<M>>", "M><"] * 4)]
    return awkward() + marks + [(200 + i, "añ🙂中 " * i) for i in range(40)]


def test_digests_equal_plain_slicing(spark):
    got = fim.digests(frame(spark, rows())).collect()
    want = [by_hand(i, t) for i, t in rows()]
    mine = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in got]
    assert sorted(mine, key=key) == sorted([(*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, rows(), strict=True)], key=key)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_outputs_restore_to_the_texts(spark):
    out = fim.transform(frame(spark, rows()))
    made = sorted(((r.doc_id, r.form, r.output) for r in out.collect()), key=key)
    assert made == sorted([(w[0], w[2], w[5]) for w in (by_hand(i, t) for i, t in rows())], key=key)
    back = sorted(((r.doc_id, r.text) for r in fim.restore(out).collect()), key=key)
    assert back == sorted([(i, t or "") for i, t in rows()], key=key)


def test_pieces_only_describe(spark):
    """Descriptors cover the text once, and spell the output over the two buffers."""
    texts = dict((i, t) for i, t in rows() if i is not None and i >= 200)
    for r in fim.transform(frame(spark, list(texts.items()))).collect():
        own = sorted((p.start, p.length) for p in r.pieces if p.buffer == fim.TEXT)
        assert sum(n for _, n in own) == len(texts[r.doc_id])
        pieces = [fim.Piece(*p) for p in r.pieces]
        assert "".join(fim.slices(texts[r.doc_id], pieces)) == r.output


def test_cut_and_inverse():
    table = fim.cut(fim.cut(fim.whole(5), 0), 5)
    assert table == [(0, 0, 0), (0, 0, 5), (0, 5, 0)]
    with pytest.raises(ValueError):
        fim.cut(table, 4)
    for bad in ("", "abc", "<S>x<P>y<M>z", "x<P>y<S>z<M>"):
        with pytest.raises(ValueError):
            fim.inverse(bad, "psm")


def test_other_seed_and_shares(spark):
    docs = frame(spark, [(i, "abcdefghij" * 5) for i in range(300)])
    one, two = ({r.doc_id: (r.form, r.output) for r in fim.transform(docs, seed=s).collect()} for s in (1, 2))
    assert sum(one[i] != two[i] for i in one) > 250
    assert {r.form for r in fim.transform(docs, plain_from=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(docs, plain_from=100, spm_below=100).collect()} == {"spm"}


def test_empty_table_and_query(spark):
    assert fim.digests(frame(spark, [])).count() == 0
    got = queries.op11_fim(spark, SF001).collect()
    docs = table(SF001)
    assert len(got) == len(docs)
    texts = {d["doc_id"]: d["text"] for d in docs}
    assert all(r.restored_sha256 == sha(texts[r.doc_id]) for r in got)
