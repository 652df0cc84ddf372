import itertools
import random
import zlib

from llm.conftest import SF01, awkward, frame, table
from quakeframe.llm import queries, toxicity


def corpus(n=600):
    """An invented language with toxic word stems that no list knows."""
    r = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [r.choice(["ka", "lo", "mi", "ren", "tuu"]) + r.choice(["na", "vo", "shi", "pe"]) + str(r.randrange(40)) for _ in range(80)]
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(["grobz", "snurk"]) + r.choice(["a", "el", "ing", "os"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_learns_unknown_stems_and_generalises(spark):
    rows, labels = corpus()
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame(spark, rows), y).collect()}
    wrong = [i for i, t in labels if got[i].predicted != t and got[i].held_out]
    held = [i for i, _ in labels if got[i].held_out]
    assert len(held) > 80 and len(wrong) <= 0.03 * len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(300)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    a, b = (
        sorted((r.doc_id, r.score) for r in toxicity.toxicity(frame(spark, rows), spark.createDataFrame(x, "doc_id long, toxic int")).collect())
        for x in (labels, flipped)
    )
    assert a == b


def test_awkward_rows_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = [*awkward(), (900, "you are an idiot and a worthless loser")]
    got = toxicity.toxicity(frame(spark, rows), none).collect()
    assert len(got) == len(rows) and {r.doc_id: r.predicted for r in got}[900] == 1
    assert {r.predicted for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert toxicity.toxicity(frame(spark, []), none).count() == 0


def test_null_and_repeated_labels(spark):
    rows, labels = corpus(120)
    y = spark.createDataFrame(labels + labels[:20] + [(3, None), (None, 1), (10**9, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(frame(spark, rows), y).count() == len(rows)


def test_correlated_voters_count_less():
    """Two copies of one voter must not outweigh what one of them says twice over."""
    base = [((1, -1), 30), ((-1, -1), 300), ((1, 1), 60), ((-1, 1), 20)]
    one = toxicity.fit_label_model(base)
    copied = toxicity.fit_label_model([((a, a, a, b), n) for (a, b), n in base])
    assert copied.weight[0][1] < one.weight[0][1] + 1.5


def test_dropping_keeps_rows_and_columns(spark):
    rows, labels = corpus(300)
    df = frame(spark, [*rows, (9000, None), (9001, "")])
    kept = toxicity.drop_toxic(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {9000, 9001} <= ids and sum(t for i, t in labels if i in ids) <= 2 and sum(1 - t for i, t in labels if i in ids) >= 0.98 * sum(1 - t for _, t in labels)


def test_query_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(SF01, "labels")}
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SF01).collect()}
    assert len(got) == len(table(SF01))
    held = [i for i in labels if got[i].held_out]
    assert sum(got[i].predicted == labels[i] for i in held) >= 0.93 * len(held)


def test_label_model_against_the_posterior_of_the_generating_rates():
    # Expected counts of voters that are independent given the class; the rates are known.
    share, right = 0.3, (0.9, 0.85, 0.8, 0.75, 0.9, 0.7)

    def chance(vote, label):
        p = share if label == 1 else 1 - share
        for v, r in zip(vote, right, strict=True):
            p *= r if v == label else 1 - r
        return p

    patterns = [v for v in itertools.product((-1, 1), repeat=len(right))]
    model = toxicity.fit_label_model([(v, round(1e7 * (chance(v, 1) + chance(v, -1)))) for v in patterns])
    for v in patterns:
        true = chance(v, 1) / (chance(v, 1) + chance(v, -1))
        assert abs(model.posterior(v) - true) < 0.02
