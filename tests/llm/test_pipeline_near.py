import corpus_pipeline

from llm.conftest import SF001, frame
from llm.test_ngram_join import brute, crowd


def test_near_duplicates_of_five_words_and_80_percent(spark):
    """Copies with up to a fifth of their length added or a few words changed go."""
    rows = crowd()
    for i in range(8):
        text = [f"s{i}x{j}" for j in range(104)]
        rows.append((9000 + 2 * i, " ".join(text)))
        rows.append((9001 + 2 * i, " ".join(text + [f"t{i}x{j}" for j in range(18 + i)])))
    kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), SF001).collect())
    assert kept == sorted({c for _, _, c in brute(rows, 5, 80)})
    assert 9000 in kept and 9001 not in kept and kept != sorted({c for _, _, c in brute(rows, 4, 85)})
