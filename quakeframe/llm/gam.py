"""Quality classifier: an additive model of lookup tables with pairwise interactions.

1. Features. Figures of a text (lengths, shares of kinds of characters, repeats of
   words, runs and lines, layout), computed batch by batch over whole texts.
2. Bins. Each feature is cut at quantiles of the training sample into at most
   ``BINS`` bins; a text is then one small number per feature.
3. Cyclic boosting. The features take turns; in its turn a feature fits a shallow
   tree to the gradient's sums per bin and adds a small step of it to its lookup
   table. Since all trees of a feature read that feature alone, their sum is one
   table.
4. Interactions. Pairs of features are ranked by what a two-way cut of both takes
   off the remaining error; the best ``PAIRS`` pairs get tables over their joint
   coarse bins, boosted cyclically in the same way.
5. Bags. ``bags`` resamples of the training rows are fitted as one Spark task each,
   and their tables averaged.
6. Scoring: one table lookup per feature and pair for whole columns at once, summed;
   the score is the logistic function of the sum.

Training rows are those with ``crc32(doc_id) mod folds != held_fold``; others are
read by none of the steps 2-5. ``max_labelled`` bounds the sample (smallest hash
of doc_id); all documents are scored. Neither labels nor lang, source or doc_id
are inputs of a score; equal texts get equal scores.

Defined cases: a null or empty text has the figures of no words and gets a score;
labels that are null, of unknown documents or for a null doc_id are ignored;
repeated labels count once, bad if any says so; without labels of both kinds all
scores are the smoothed share of good labels, or 0.5 without any; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import SPACE_CHARS, id_text, map_pandas, materialize, ship_package

BINS, COARSE, PAIRS = 32, 8, 10
FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "short_words", "symbols", "digits", "letters", "capitals",
    "upper_words", "punctuation", "exclaims", "bars", "odd_ends", "distinct_words", "top_word", "repeat_neighbours",
    "repeat_runs", "dup_lines", "log_lines", "words_per_line", "unended_lines", "short_lines", "links", "other_scripts",
    "brackets", "quotes", "char_runs",
)

_WORD = re.compile(f"[^{SPACE_CHARS}]+")
#: Characters that some figures count.
_SYMBOLS, _PUNCTUATION, _BRACKETS, _QUOTES = frozenset(r"#*$%&|<>~^=_@\{}"), frozenset(".,;:!?"), frozenset("()[]{}<>"), frozenset("\"'`«»“”")
_RUN = re.compile(r"(.)\1{3,}")
_LINK = re.compile(r"://|www\.|@")


def figures(text: str) -> list[float]:
    """The features of a text, in the order of ``FEATURES``; shares are of
    characters, words or lines. Characters and words are counted first, so their
    kinds are looked at once for each different one."""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(SPACE_CHARS)]
    n, w, k = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    chars, counts = Counter(text), Counter(words)
    symbols = digits = letters = capitals = marks = exclaims = brackets = quotes = wide = 0
    for c, m in chars.items():
        if c.isalpha():
            letters += m
            capitals += m * c.isupper()
        elif c.isdigit():
            digits += m
        symbols += m * (c in _SYMBOLS)
        marks += m * (c in _PUNCTUATION)
        exclaims += m * (c in "!?")
        brackets += m * (c in _BRACKETS)
        quotes += m * (c in _QUOTES)
        wide += m * (c > "\x7f")
    size = long = short = upper = odd = links = 0
    for x, m in counts.items():
        size += m * len(x)
        long += m * (len(x) > 15)
        short += m * (len(x) <= 2)
        upper += m * (len(x) > 1 and x.isupper())
        odd += m * (not x[-1].isalnum() and x[-1] not in ".,;:?")
        links += m * (_LINK.search(x) is not None)
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    runs = sum(m.end() - m.start() for m in _RUN.finditer(" ".join(counts)))
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        size / w,
        long / w,
        short / w,
        symbols / n,
        digits / n,
        letters / n,
        capitals / max(1, letters),
        upper / w,
        marks / n,
        exclaims / w,
        chars["|"] / w,
        odd / w,
        len(counts) / w,
        max(counts.values(), default=0) / w,
        sum(map(str.__eq__, words, words[1:])) / w,
        (len(words) - 2 - list(triples.values()).count(1)) / w if len(words) > 2 else 0.0,
        (len(lines) - len(set(lines))) / k,
        np.log1p(len(lines)),
        len(words) / k,
        sum(x.rstrip(SPACE_CHARS)[-1] not in ".!?:;\"'" for x in lines) / k,
        sum(len(x) < 30 for x in lines) / k,
        links / w,
        wide / n,
        brackets / n,
        quotes / n,
        runs / n,
    ]


def figures_of(texts) -> np.ndarray:
    return np.array([figures(t) for t in texts], float).reshape(-1, len(FEATURES))


# ---- fitting: on bins of a bounded sample ------------------------------------


def cuts_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature, rising cut values between bins: quantiles of the sample."""
    levels = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], levels, method="lower")) if len(x) else np.zeros(0) for j in range(x.shape[1])]


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """A value's bin: how many cuts lie below it."""
    return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1).astype(np.int16)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int, least: float, ridge: float) -> np.ndarray:
    """The Newton step per bin of a tree over ordered bins with gradient sums
    ``g`` and curvatures ``h``: up to 2 ** depth stretches of bins, each with its
    own value, cut where the gain is largest."""
    step = np.zeros(len(g))

    def split(a: int, b: int, depth: int) -> None:
        gs, hs = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        total_g, total_h = gs[-1], hs[-1]
        if depth and b - a > 1:
            gain = _gain(gs[:-1], hs[:-1], ridge) + _gain(total_g - gs[:-1], total_h - hs[:-1], ridge) - _gain(total_g, total_h, ridge)
            gain[(hs[:-1] < least) | (total_h - hs[:-1] < least)] = -1.0
            i = int(np.argmax(gain))
            if gain[i] > 1e-9:
                split(a, a + i + 1, depth - 1)
                split(a + i + 1, b, depth - 1)
                return
        step[a:b] = -total_g / (total_h + ridge)

    split(0, len(g), depth)
    return step


def pair_tree(g: np.ndarray, h: np.ndarray, least: float, ridge: float) -> np.ndarray:
    """The same for a grid of two features' bins: the best cut of either one, then
    the best cut of the other on each side."""

    def best(gs: np.ndarray, hs: np.ndarray) -> tuple[float, int]:
        a, b = np.cumsum(gs)[:-1], np.cumsum(hs)[:-1]
        gain = _gain(a, b, ridge) + _gain(gs.sum() - a, hs.sum() - b, ridge)
        gain[(b < least) | (hs.sum() - b < least)] = -1.0
        return (float(gain.max()), int(np.argmax(gain)) + 1) if len(gain) else (-1.0, 0)

    plans = []
    for axis in (0, 1):
        gx, hx = (g, h) if axis == 0 else (g.T, h.T)
        for at in range(1, gx.shape[0]):
            sides = []
            for part in (slice(0, at), slice(at, None)):
                value, cut_at = best(gx[part].sum(axis=0), hx[part].sum(axis=0))
                sides.append((value, part, cut_at))
            if all(v >= 0 for v, _, _ in sides):
                plans.append((sum(v for v, _, _ in sides), axis, sides))
    step = np.zeros(g.shape)
    if not plans:
        return step
    _, axis, sides = max(plans, key=lambda p: p[0])
    gx, hx, out = (g, h, step) if axis == 0 else (g.T, h.T, step.T)
    for _, part, cut_at in sides:
        for other in (slice(0, cut_at), slice(cut_at, None)):
            out[part, other] = -gx[part, other].sum() / (hx[part, other].sum() + ridge)
    return step


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def boost_features(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, sizes: list[int], rounds: int, rate: float, depth: int = 2, least: float = 1.0, ridge: float = 1.0):
    """(intercept, one table per feature) by cyclic boosting."""
    share = (weight @ y + 0.5) / (weight.sum() + 1.0)
    bias = float(np.log(share / (1 - share)))
    tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), bias)
    for _ in range(rounds):
        for j, size in enumerate(sizes):
            if size < 2:
                continue
            p = _logistic(total)
            g = np.bincount(bins[:, j], weight * (p - y), size)
            h = np.bincount(bins[:, j], weight * p * (1 - p), size)
            step = rate * shallow_tree(g, h, depth, least, ridge)
            tables[j] += step
            total += step[bins[:, j]]
    return bias, tables


def rank_pairs(coarse: np.ndarray, sizes: list[int], g: np.ndarray, h: np.ndarray, least: float = 1.0, ridge: float = 1.0) -> list[tuple[float, int, int]]:
    """(gain, i, j) of all pairs, best first: what a cut of both takes off beyond
    what a cut of either one alone does."""
    def alone(gs: np.ndarray, hs: np.ndarray) -> float:
        return -(gs * shallow_tree(gs, hs, 2, least, ridge)).sum()

    out = []
    for i in range(len(sizes)):
        for j in range(i + 1, len(sizes)):
            if sizes[i] < 2 or sizes[j] < 2:
                continue
            cell = coarse[:, i].astype(np.int64) * sizes[j] + coarse[:, j]
            gs = np.bincount(cell, g, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])
            hs = np.bincount(cell, h, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j])
            both = -(gs * pair_tree(gs, hs, least, ridge)).sum()
            out.append((both - max(alone(gs.sum(1), hs.sum(1)), alone(gs.sum(0), hs.sum(0))), i, j))
    return sorted(out, key=lambda x: (-x[0], x[1], x[2]))


def boost_pairs(coarse: np.ndarray, y: np.ndarray, weight: np.ndarray, start: np.ndarray, pairs: list[tuple[int, int]], sizes: list[int], rounds: int, rate: float, least: float = 1.0, ridge: float = 1.0):
    """One table per pair by cyclic boosting on top of the scores ``start``."""
    cells = [coarse[:, i].astype(np.int64) * sizes[j] + coarse[:, j] for i, j in pairs]
    tables = [np.zeros((sizes[i], sizes[j])) for i, j in pairs]
    total = start.copy()
    for _ in range(rounds):
        for (i, j), cell, table in zip(pairs, cells, tables, strict=True):
            p = _logistic(total)
            shape = (sizes[i], sizes[j])
            g = np.bincount(cell, weight * (p - y), shape[0] * shape[1]).reshape(shape)
            h = np.bincount(cell, weight * p * (1 - p), shape[0] * shape[1]).reshape(shape)
            step = rate * pair_tree(g, h, least, ridge)
            table += step
            total += step.ravel()[cell]
    return tables


@dataclass
class AdditiveModel:
    """Lookup tables: ``tables[j]`` over the bins of feature j, ``pair_tables`` over
    coarse bins; a score's logit is the bias plus one entry of each."""

    bias: float
    cuts: list[np.ndarray]
    coarse_cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        if self.tables:
            bins = to_bins(x, self.cuts)
            for j, t in enumerate(self.tables):
                out += t[bins[:, j]]
        if self.pairs:
            coarse = to_bins(x, self.coarse_cuts)
            for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
                out += t[coarse[:, i], coarse[:, j]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x))

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, score) of every document."""
        model = self

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": model.scores(figures_of(b["text"]))})

        return map_pandas(id_text(docs), run, "doc_id long, score double")


# ---- Spark side --------------------------------------------------------------


def training_row(folds: int = 3, held_fold: int = 1):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) != held_fold


def labelled_figures(docs: DataFrame, labels: DataFrame, max_labelled: int, folds: int, held_fold: int) -> DataFrame:
    """(doc_id, y, x) of the training rows, at most ``max_labelled``."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    y = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y"))
    # Ids of the sample are chosen before any text moves; their number is bounded.
    sample = y.where(training_row(folds, held_fold)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "x": list(figures_of(b["text"]))})

    rows = id_text(docs).join(F.broadcast(sample), "doc_id")
    return map_pandas(rows.select("doc_id", "y", "text"), run, "doc_id long, y int, x array<double>")


def _resample(doc_id: np.ndarray, bag: int, bags: int) -> np.ndarray:
    """Weights of a bag: Poisson numbers with mean 1 drawn from (bag, doc_id), so
    that neither order nor partitioning matters; a single bag takes every row once."""
    if bags == 1:
        return np.ones(len(doc_id))
    mixed = doc_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((bag + 1) * 0xD1342543DE82EF95 % 2**64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    u = (mixed >> np.uint64(11)).astype(float) / float(1 << 53)
    at = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720]))
    return np.searchsorted(at, u, side="right").astype(float)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, folds: int = 3, held_fold: int = 1, bags: int = 8, rounds: int = 150, pair_rounds: int = 50, rate: float = 0.06) -> AdditiveModel:
    """The model. What reaches one task is the bounded sample's bins, what reaches
    the driver the cut values and the tables (fixed sizes)."""
    train = materialize(labelled_figures(docs, labels, max_labelled, folds, held_fold), "gam_train")
    n = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("good")).first()
    if n["good"] in (0, n["n"]):
        p = (n["good"] + 0.5) / (n["n"] + 1.0)
        return AdditiveModel(float(np.log(p / (1 - p))), [], [], [], [], [])

    def fit_bag(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "y"], kind="stable")
        bag = int(rows["bag"].iloc[0])
        x, y = np.stack(rows["x"]).astype(float), rows["y"].to_numpy(float)
        weight = _resample(rows["doc_id"].to_numpy(np.int64), bag, bags)
        fine, coarse = cuts_of(x, BINS), cuts_of(x, COARSE)
        sizes, few = [len(c) + 1 for c in fine], [len(c) + 1 for c in coarse]
        b, c = to_bins(x, fine), to_bins(x, coarse)
        bias, tables = boost_features(b, y, weight, sizes, rounds, rate)
        start = bias + sum(t[b[:, j]] for j, t in enumerate(tables))
        # Pairs are the same in every bag: ranked on the rows as they are.
        plain_bias, plain = boost_features(b, y, np.ones(len(y)), sizes, rounds // 4, rate * 2)
        p = _logistic(plain_bias + sum(t[b[:, j]] for j, t in enumerate(plain)))
        pairs = [(i, j) for _, i, j in rank_pairs(c, few, p - y, p * (1 - p))[:PAIRS]]
        grids = boost_pairs(c, y, weight, start, pairs, few, pair_rounds, rate)
        return pd.DataFrame(
            {
                "bag": [bag], "bias": [bias], "cuts": [fine], "coarse": [coarse], "tables": [tables],
                "pairs": [[list(p) for p in pairs]], "grids": [[g.ravel() for g in grids]],
            }
        )

    numbers = "array<array<double>>"
    schema = f"bag int, bias double, cuts {numbers}, coarse {numbers}, tables {numbers}, pairs array<array<int>>, grids {numbers}"
    # The sample once per bag: bags x max_labelled rows of a few hundred bytes.
    bagged = train.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))))
    ship_package(docs.sparkSession)
    fitted = bagged.groupBy("bag").applyInPandas(fit_bag, schema).orderBy("bag").collect()
    first = fitted[0]
    pairs = [tuple(p) for p in first["pairs"]]
    few = [len(c) + 1 for c in first["coarse"]]

    def mean(rows: list) -> np.ndarray:
        return np.mean([np.array(r, float) for r in rows], axis=0)

    tables = [mean([r["tables"][j] for r in fitted]) for j in range(len(FEATURES))]
    grids = [mean([r["grids"][k] for r in fitted]).reshape(few[i], few[j]) for k, (i, j) in enumerate(pairs)]
    bias = float(np.mean([r["bias"] for r in fitted]))
    return AdditiveModel(bias, [np.array(c) for c in first["cuts"]], [np.array(c) for c in first["coarse"]], tables, pairs, grids)


def quality_scores(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, folds: int = 3, held_fold: int = 1) -> DataFrame:
    """Per document: doc_id, held_out, score (of label 1), predicted."""
    s = fit(docs, labels, max_labelled, folds, held_fold).score(docs)
    return s.select("doc_id", (~training_row(folds, held_fold)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
