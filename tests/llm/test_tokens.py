import collections
import hashlib
import random
import unicodedata

import numpy as np
import pytest

from llm.conftest import SF001, awkward, frame, table
from quakeframe.llm import bpe, queries, tokens

ODD = [
    "<|endoftext|>Hi<|ENDOFTEXT|> it's I'LL  \x1c x\x1dy  z ﬁ Ⅷ ² ½ é İstanbul ΣΑΣ 中文字 한국어 한글 🙂👍🏽 don't're'S a\u0085b ., ...,, x.,y., 12.,̀ aá.,",
    "", " \n ", "a" * 3000, ".," * 300, "'s't", "<|startoftext|>.,", "ß.,ß, ª, º.", "\x00\x01", "ab́c",
]


def texts():
    r = random.Random(1)
    alphabet = "ab'sté ,.!<|>12中́\t\nÉ가"
    return ODD + ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(1500)] + [x["text"] for x in table(SF001)[:80]]


@pytest.fixture(scope="module")
def library(tokenizer):
    return tokens.load_tokenizer(tokenizer)


def test_ids_equal_the_library(tokenizer, library):
    mine, chunks = bpe.PrefixEncoder(tokenizer), tokens.ChunkEncoder(tokenizer)
    for t in texts():
        ids = library.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ids, t
        assert np.frombuffer(chunks.encode(t), "<u4").tolist() == ids, t
        assert mine.encode_and_decode(t) == (len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)), t


def test_letters_whose_normal_form_ends_in_a_mark(tokenizer, library):
    """Every letter before a comma and a full stop; planes from 2 on and the big
    regular blocks (ideographs, Hangul) by a sample."""
    mine, chunks = bpe.PrefixEncoder(tokenizer), tokens.ChunkEncoder(tokenizer)
    letters = [chr(i) for i in range(0x20000) if unicodedata.category(chr(i))[0] == "L" and not (0x3400 <= i < 0xD7A4 and i % 61)]
    words = [c + end for c in letters for end in (",", ".")] + ["BELEDİYESİ,", "BELEDİYESİ, Ankara", "BELEDİYESİ.", "xİ.,", "क़."]
    for w, e in zip(words, library.encode_batch(words, add_special_tokens=False), strict=True):
        assert mine.encode(w) == e.ids, w
        assert np.frombuffer(chunks.encode(w), "<u4").tolist() == e.ids, w


def test_random_strings_equal_the_library(tokenizer, library):
    r = random.Random(7)
    alphabet = "ab'İsté ,.!़क्षͅﬀשׁ12中́\tÉ가Ω"
    lines = ["".join(r.choice(alphabet) for _ in range(r.randrange(1, 25))) for _ in range(20_000)]
    mine, chunks = bpe.PrefixEncoder(tokenizer), tokens.ChunkEncoder(tokenizer)
    for t, e in zip(lines, library.encode_batch(lines, add_special_tokens=False), strict=True):
        assert mine.encode(t) == e.ids, t
        assert np.frombuffer(chunks.encode(t), "<u4").tolist() == e.ids, t


def test_small_tables_give_the_same_ids(tokenizer, library):
    mine, chunks = bpe.PrefixEncoder(tokenizer, most=3), tokens.ChunkEncoder(tokenizer, most=3)
    for t in texts()[:300]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert mine.encode(t) == ids and np.frombuffer(chunks.encode(t), "<u4").tolist() == ids


def test_every_prefix_has_its_unique_last_token(tokenizer):
    """The dynamic programme against the merge loop, on every prefix of a piece."""
    e = bpe.PrefixEncoder(tokenizer)
    for piece in ("thestationing", "eraneaeshouwhed", "aaaaaaaaaaaa"):
        symbols = e.symbols(piece)
        for n in range(1, len(symbols) + 1):
            whole = e.merge(tuple(symbols[:n]))
            if n == len(symbols):
                assert e.encode_piece(piece) == whole
            assert all(e.compatible(a, b) for a, b in zip(whole, whole[1:], strict=False))


def test_unknown_models_are_refused(tokenizer, tmp_path):
    import json

    spec = json.load(open(tokenizer, encoding="utf-8"))
    spec["model"]["dropout"] = 0.1
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.PrefixEncoder(str(path))


def test_encode_decode_columns(spark, tokenizer, library):
    rows = awkward()
    encoded = bpe.encode(frame(spark, rows), tokenizer)
    want = collections.Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    back = collections.Counter((r.doc_id, r.text) for r in bpe.decode(encoded, tokenizer).collect())
    assert back == collections.Counter((i, library.decode(list(ids), skip_special_tokens=False)) for i, ids in want.elements())


def test_round_trip_query(spark, library):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    for r in queries.op6_bpe(spark, SF001).collect():
        text = {x["doc_id"]: x["text"] for x in table(SF001)}[r.doc_id] if r.doc_id < 20 else None
        if text is not None:
            ids = library.encode(text, add_special_tokens=False).ids
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_histogram_answers_every_limit(spark, tokenizer, library):
    rows = awkward() + [(100 + i, "word " * (i % 7)) for i in range(40)]
    n = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows])
    h = tokens.token_counts(frame(spark, rows), tokenizer)
    got = h.collect()
    assert sorted(r.n_tokens for r in got) == sorted(set(n.tolist()))
    for r in got:
        x = r.n_tokens
        assert (r.n_docs, r.n_docs_longer, r.tokens_longer) == ((n == x).sum(), (n > x).sum(), n[n > x].sum())
        assert (r.tokens_upto, r.truncated_total) == (n[n <= x].sum(), np.minimum(n, x).sum())
        assert r.share_upto == pytest.approx((n <= x).mean())
    for limit in (0, 1, 3, 100, 10**6):
        t = tokens.totals_at(h, limit).first()
        assert (t.n_longer, t.tokens_kept, t.tokens_lost) == ((n > limit).sum(), np.minimum(n, limit).sum(), np.maximum(n - limit, 0).sum())
    for level in (0.01, 0.5, 0.9, 1.0):
        assert tokens.quantile(h, level).first()[0] == np.sort(n)[max(0, int(np.ceil(level * len(n))) - 1)]


def test_histogram_over_several_blocks_and_empty(spark, tokenizer):
    n = [0, 5, 5, 1023, 1024, 1025, 5000, 5000, 70000]
    got = {r.n_tokens: r for r in tokens.length_histogram(spark.createDataFrame([(x,) for x in n], "n_tokens long")).collect()}
    for x in set(n):
        assert got[x].tokens_longer == sum(y for y in n if y > x) and got[x].n_docs_longer == sum(y > x for y in n)
    assert tokens.token_counts(frame(spark, []), tokenizer).count() == 0
    assert tokens.totals_at(tokens.token_counts(frame(spark, []), tokenizer), 5).first().tokens_kept == 0


def test_counts_query(spark, library):
    n = [len(library.encode(x["text"], add_special_tokens=False).ids) for x in table(SF001)]
    got = queries.op8_token_counts(spark, SF001).collect()
    assert {r.n_tokens: r.n_docs for r in got} == dict(collections.Counter(n))
    assert max(r.truncated_total for r in got) == sum(n)
