import random

import pyarrow.parquet as pq
import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, h long, n string, length int, spans string, row_key int, __k int"


def table(sf, name="documents"):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def frame(spark, rows, parts=5):
    """Documents with extra columns whose names the operators use inside."""
    full = [(i, t, 1, None, None, "x", 7, 0) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def awkward():
    """Nulls in both columns, empty and blank texts, repeated rows, equal ids with
    other texts, ties, other scripts and one long text without white space."""
    r = random.Random(11)
    words = ["alpha", "Beta", "gámma", "ÉTÉ", "δ", "中文", "x1", "don't", "a.b@c.de", "10.0.0.1", "...", "🙂"]
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, None), (None, "alpha Beta"), (4, "alpha Beta"), (4, "alpha Beta"), (4, "other text"), (5, "alpha  beta")]
    base = [r.choice(words) for _ in range(60)]
    for i in range(6, 30):
        w = list(base)
        for _ in range(i % 4):
            w[r.randrange(len(w))] = f"e{r.random()}"
        rows.append((i, " ".join(w[:30]) + "\n" + " ".join(w[30:])))
    rows.append((30, "z" * 30_000))
    rows.append((31, "q" * 50 + "\n" + "9" * 20_000 + " " + "1.2." * 5_000))
    rows += [(32 + i, "This very same line of forty characters or more is in many documents\nown line " + str(i)) for i in range(8)]
    return rows


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
