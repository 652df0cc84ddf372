"""Toxicity: a classifier trained on the labels of a generative model of voters.

1. Lexicon. Words and word beginnings of a bounded sample of labelled training
   rows are counted by label, at several numbers of occurrences in a text; those
   that the log-likelihood ratio ties to toxic rows are lexicon entries. A short
   list of insults in common use joins them.
2. Voters. The entries are dealt by strength into lexicon voters; pattern voters
   look at address ("you are a"), shouting and the density of hits; the annotator
   of the training row is a voter like the others. Each votes toxic (1), clean
   (-1) or abstains (0).
3. Label model. Expectation-maximisation over the vote patterns of the sample
   estimates each voter's accuracies. Voters that agree more often than
   their accuracies explain are correlated: each one's log odds are divided by
   one plus its summed excess correlations, so that a crowd that sees the same
   thing counts about once.
4. Classifier. A logistic regression on the entries is trained on the posterior
   labels and scores every document. Neither labels nor lang, source or doc_id
   are inputs of a score.

Rows for training are those with ``crc32(doc_id) mod folds != held_fold``; every
other row is held out of all four steps. ``max_labelled`` bounds the sample
(those of smallest hash); all documents are scored.

Defined cases: a null or empty text has no entries and gets the base score;
equal texts get equal scores; without labels of both kinds only the fixed list
votes; repeated labels of a row count once, toxic if any says so; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import SPACE, id_text, map_pandas, materialize

#: A seed list of plain insults.
SEED_WORDS = (
    "idiot", "idiots", "moron", "morons", "stupid", "scum", "loser", "losers", "trash", "worthless", "pathetic",
    "disgusting", "dumb", "imbecile", "clown", "vermin", "retard", "bastard", "dummkopf", "abschaum", "connard",
    "imbécile", "ordure", "basura", "estúpido", "imbécil", "cabrón",
)
BEGINNINGS = (4, 5, 6, 7, 8)
LEVELS = (1, 2, 3, 5)
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\b(?:you|they|he|she)(?: all)?(?: are|'re|re|is) (?:a |an |such |so |all )*(?:" + "|".join(SEED_WORDS) + r")\b")
N_LEXICON_VOTERS = 4
N_NUMBERS = 3  # features beside the entries: words, hits, density


def training_row(folds: int = 5, held_fold: int = 0):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) != held_fold


def forms(word: str) -> list[str]:
    """A word's lexicon keys: itself (with a mark) and its beginnings."""
    return ["=" + word, *[word[:n] for n in BEGINNINGS if len(word) >= n]]


def word_counts(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in _WORD.findall(text.lower()):
        out[w] = out.get(w, 0) + 1
    return out


class Lexicon:
    """``rows``: (key, level, strength) by feature place: the entry holds for a
    text in which words with this key occur at least ``level`` times."""

    def __init__(self, rows: list[tuple[str, int, float]]):
        self.rows = rows
        self.keys: dict[str, list[tuple[int, int]]] = {}
        for place, (key, level, _) in enumerate(rows):
            self.keys.setdefault(key, []).append((level, place))
        # All keys of a word but the word itself share its first letters.
        self.words = {k[1:] for k in self.keys if k[0] == "="}
        self.starts = {k[: BEGINNINGS[0]] for k in self.keys if k[0] != "="}

    def hits(self, text: str) -> tuple[list[int], int, int]:
        """Places of the entries that hold, words with a key, words."""
        keys, words, starts, first = self.keys, self.words, self.starts, BEGINNINGS[0]
        found: dict[str, int] = {}
        counts = word_counts(text)
        hit = 0
        for w, n in counts.items():
            if w[:first] in starts or w in words:
                own = [f for f in forms(w) if f in keys]
                if own:
                    hit += n
                    for f in own:
                        found[f] = found.get(f, 0) + n
        return sorted(p for f, n in found.items() for level, p in keys[f] if n >= level), hit, sum(counts.values())

    def features(self, text: str) -> tuple[list[int], list[float]]:
        places, hit, words = self.hits(text)
        at = len(self.rows)
        return [*places, at, at + 1, at + 2], [1.0] * len(places) + [math.log1p(words), math.log1p(hit), math.log1p(1000 * hit / (words + 20))]


def _smallest_hash(text):
    w = F.split(F.lower(text), SPACE + "+", -1)
    three = F.arrays_zip(w.alias("a"), F.slice(w, 2, 1 << 30).alias("b"), F.slice(w, 3, 1 << 30).alias("c"))
    return F.array_min(F.transform(three, lambda x: F.xxhash64(x["a"], x["b"], x["c"])))


def mine_lexicon(labelled: DataFrame, least_ratio: float = 20.0, least_odds: float = 2.0, most: int = 3000) -> Lexicon:
    """Entries from (doc_id, text, toxic) by Dunning's ratio on documents.
    ``most`` bounds the table that leaves the cluster (a top-k by strength)."""

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            toxic: dict[tuple[str, int], int] = {}
            clean: dict[tuple[str, int], int] = {}
            for text, y in zip(b["text"], b["toxic"], strict=True):
                into = toxic if y else clean
                found: dict[str, int] = {}
                for w, n in word_counts(text).items():
                    for f in forms(w):
                        found[f] = found.get(f, 0) + n
                for f, n in found.items():
                    for level in LEVELS:
                        if n >= level:
                            into[f, level] = into.get((f, level), 0) + 1
            keys = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"entry": [k for k, _ in keys], "level": [n for _, n in keys], "a": [toxic.get(k, 0) for k in keys], "b": [clean.get(k, 0) for k in keys]})

    # Copies and near copies of one text would make its rare words look telling:
    # one row for each smallest hash of three words counts.
    labelled = labelled.withColumn("low", _smallest_hash(F.col("text"))).dropDuplicates(["low", "toxic"])
    n = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = int(n["t"]), int(n["n"] - n["t"])
    rows = []
    if n_toxic and n_clean:
        counts = map_pandas(labelled, explode, "entry string, level int, a long, b long").groupBy("entry", "level").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        a, b = F.col("a"), F.col("b")
        expect_a = (a + b) * (n_toxic / (n_toxic + n_clean))
        expect_b = (a + b) * (n_clean / (n_toxic + n_clean))
        ratio = 2 * (a * F.log(a / expect_a) + F.when(b > 0, b * F.log(b / expect_b)).otherwise(0.0))
        odds = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
        best = counts.where(a > 0).select("entry", "level", ratio.alias("ratio"), odds.alias("odds")).where((F.col("ratio") >= least_ratio) & (F.col("odds") >= least_odds))
        rows = best.orderBy(F.col("ratio").desc(), "entry", "level").limit(most).collect()
    entries = [(r["entry"], int(r["level"]), float(r["odds"])) for r in rows]
    known = {(e, n) for e, n, _ in entries}
    return Lexicon(entries + [("=" + w, 1, 3.0) for w in SEED_WORDS if ("=" + w, 1) not in known])


def votes(text: str, lexicon: Lexicon) -> tuple[int, ...]:
    """Lexicon voters (each owns every N-th entry by strength), then patterns."""
    places, hit, words = lexicon.hits(text)
    out = []
    for v in range(N_LEXICON_VOTERS):
        own = [lexicon.rows[i][2] for i in places if i % N_LEXICON_VOTERS == v]
        out.append(1 if own and max(own) >= 3.0 else -1 if not own else 0)
    top = max((lexicon.rows[i][2] for i in places), default=0.0)
    density = hit / (words + 20)
    out.append(1 if top >= 4.0 else -1 if top < 2.5 else 0)
    out.append(1 if hit >= 3 else -1 if hit == 0 else 0)
    out.append(1 if density >= 0.008 else -1 if density < 0.002 else 0)
    out.append(1 if _ADDRESS.search(text.lower()) else 0)
    out.append(1 if hit and text.isupper() else 0)
    return tuple(out)


@dataclass
class LabelModel:
    prior: float
    weight: list[dict[int, float]]

    def posterior(self, vote: tuple[int, ...]) -> float:
        x = self.prior + sum(w[v] for w, v in zip(self.weight, vote, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, x))))


def fit_label_model(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, smooth: float = 1.0) -> LabelModel:
    """EM from "toxic where more voters say so than not", then weights cut by the
    excess correlations. Works on distinct vote patterns with counts."""
    if not patterns:
        return LabelModel(-2.0, [])
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    q = np.where(v.sum(axis=1) > 0, 0.9, 0.05)
    k = v.shape[1]

    def tables(q: np.ndarray) -> tuple[float, np.ndarray]:
        t, c = (q * n).sum(), ((1 - q) * n).sum()
        weight = np.zeros((k, 3))
        for x in (-1, 1):
            hit = v == x
            votes_t = ((v != 0) * (q * n)[:, None]).sum(axis=0)
            votes_c = ((v != 0) * ((1 - q) * n)[:, None]).sum(axis=0)
            pt = ((hit * (q * n)[:, None]).sum(axis=0) + smooth) / (votes_t + 2 * smooth)
            pc = ((hit * ((1 - q) * n)[:, None]).sum(axis=0) + smooth) / (votes_c + 2 * smooth)
            # One-sided voters say something by voting at all.
            one_sided = ~((v == -1).any(axis=0) & (v == 1).any(axis=0))
            share_t = ((hit * (q * n)[:, None]).sum(axis=0) + smooth) / (t + 2 * smooth)
            share_c = ((hit * ((1 - q) * n)[:, None]).sum(axis=0) + smooth) / (c + 2 * smooth)
            weight[:, x + 1] = np.where(one_sided, np.log(share_t / share_c), np.log(pt / pc))
        weight[:, 2] = np.maximum(weight[:, 2], 0.0)  # a voter's direction is known
        weight[:, 0] = np.minimum(weight[:, 0], 0.0)
        return math.log((t + smooth) / (c + smooth)), weight

    def score(prior: float, weight: np.ndarray) -> np.ndarray:
        x = prior + weight[np.arange(k)[None, :], v + 1].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for _ in range(rounds):
        prior, weight = tables(q)
        fresh = score(prior, weight)
        if np.abs(fresh - q).max() < 1e-9:
            break
        q = fresh
    # Excess correlation inside each class, averaged over the classes.
    excess = np.zeros((k, k))
    for side in (q, 1 - q):
        w = side * n
        if w.sum() < 1e-9:
            continue
        centred = v - (v * w[:, None]).sum(axis=0) / w.sum()
        cov = (centred * w[:, None]).T @ centred / w.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        excess += np.maximum(cov / sd[:, None] / sd[None, :], 0.0) * w.sum() / n.sum()
    np.fill_diagonal(excess, 0.0)
    weight = weight / (1.0 + excess.sum(axis=1))[:, None]
    return LabelModel(prior, [{-1: float(r[0]), 0: 0.0, 1: float(r[2])} for r in weight])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weight: list[float]
    bias: float

    def score_text(self, text: str) -> float:
        places, values = self.lexicon.features(text)
        x = self.bias + sum(self.weight[i] * v for i, v in zip(places, values, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, x))))

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of every document."""
        model = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": [model.score_text(t) for t in b["text"]]})

        return map_pandas(id_text(docs), run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``; all other
    rows and columns as they are."""
    model = fit(docs, labels, max_labelled)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([model.score_text(t) for t in text], dtype="float64")

    return docs.where(score(F.coalesce(F.col("text"), F.lit(""))) < threshold)


def labelled_rows(docs: DataFrame, labels: DataFrame, max_labelled: int, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """(doc_id, text, toxic) of the training rows, at most ``max_labelled``."""
    y = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    # The ids of the sample are chosen before any text moves; they are bounded.
    sample = y.where(training_row(folds, held_fold)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    return id_text(docs).join(F.broadcast(sample), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, folds: int = 5, held_fold: int = 0, reg: float = 3e-4) -> ToxicityModel:
    train = materialize(labelled_rows(docs, labels, max_labelled, folds, held_fold), "toxicity_train")
    lexicon = mine_lexicon(train)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            f = [lexicon.features(t) for t in b["text"]]
            # The annotator votes last.
            v = [(*votes(t, lexicon), 1 if y else -1) for t, y in zip(b["text"], b["toxic"], strict=True)]
            yield pd.DataFrame({"place": [x for x, _ in f], "value": [x for _, x in f], "vote": [",".join(map(str, x)) for x in v]})

    rows = materialize(map_pandas(train.select("text", "toxic"), featurise, "place array<int>, value array<double>, vote string"), "toxicity_features")
    # Distinct vote patterns: at most 3 to the number of voters, and no more than the sample.
    seen = [(tuple(map(int, r["vote"].split(","))), r["count"]) for r in rows.groupBy("vote").count().collect()]
    size = len(lexicon.rows) + N_NUMBERS
    if not seen:
        return ToxicityModel(lexicon, [s for _, _, s in lexicon.rows] + [0.0] * N_NUMBERS, -2.0)
    model = fit_label_model(sorted(seen))
    known = {",".join(map(str, v)): model.posterior(v) for v, _ in seen}

    @F.udf(VectorUDT())
    def vector(place, value):
        return Vectors.sparse(size, place, value)

    # A soft label is two weighted rows, one of each class.
    posterior = F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), F.col("vote"))
    soft = rows.select(vector("place", "value").alias("features"), posterior.alias("p"))
    both = soft.select("features", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w")))).alias("x"))
    both = both.select("features", "x.label", "x.w").where("w > 1e-6")
    lr = LogisticRegression(maxIter=40, regParam=reg, weightCol="w", standardization=False).fit(both)
    return ToxicityModel(lexicon, [float(x) for x in lr.coefficients], float(lr.intercept))


def toxicity(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, folds: int = 5, held_fold: int = 0) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, max_labelled, folds, held_fold)
    s = model.score(docs)
    return s.select("doc_id", (~training_row(folds, held_fold)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
