"""Quality rules by weak supervision.

Every rule looks at one feature of a document and votes: keep, abstain, doubt (a
weak objection) or drop (a strong one). Expectation-maximisation over the votes
estimates, without labels, how often each rule votes each way on good documents
and on each kind of bad ones; the posterior probability of "good" replaces the
usual all-rules-must-pass filter. A lone doubt is overruled by the rules that
find nothing wrong unless the corpus says otherwise, several doubts add up, and
a lone drop can be overruled where the documents the rule is right about mostly
have other faults as well.

The features and votes are DataFrame expressions. EM sees only the table of
distinct vote patterns with their counts, at most 4 ** len(RULES) rows whatever
the corpus; the posterior of each pattern is joined back by its code.

Defined cases: a null or empty text has no words, all counts 0, and fails the
base rule; repeated rows and equal ids are scored each on its own; an empty table
gives an empty result; a corpus in which no rule objects keeps everything
that passes the base rule; doubts that every document draws say nothing, and all
stay, while drops that every document draws are believed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeframe.llm.common import SPACE, id_text, materialize

WINDOW = 5
#: "To the end" for slice; start + length must not overflow an int.
TAIL = 1 << 30
#: Fixed value: the body of the contract's symbol class.
SYMBOLS = "#*$%&|<>"


def _repeated_words(d: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: the words covered by windows whose hash occurs at
    least twice in ``h5`` (one hash for each window start). Most texts have
    none; for them the sort is skipped. Each step is a projection of its own,
    used more than once by the next, so that nothing is computed twice."""
    tail = TAIL
    some = (F.col("n_words") >= WINDOW) & (F.size(F.array_distinct("h5")) < F.size("h5"))
    pair = F.transform("h5", lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    d = d.withColumn("pairs", F.when(some, F.sort_array(pair)))
    d = d.withColumn("hs", F.transform("pairs", lambda s: s["h"])).withColumn("ps", F.transform("pairs", lambda s: s["p"]))
    # same[i]: sorted hash i equals the next one. Both then repeat.
    d = d.withColumn("same", F.zip_with("hs", F.slice("hs", 2, tail), lambda a, b: F.coalesce(a == b, F.lit(False))))
    either = F.zip_with("same", F.concat(F.array(F.lit(False)), F.col("same")), lambda a, b: F.coalesce(a, F.lit(False)) | b)
    d = d.withColumn("marked", F.filter(F.zip_with("ps", either, lambda p, m: F.when(m, p)), lambda p: p.isNotNull()))
    d = d.withColumn("starts", F.sort_array("marked"))
    steps = F.zip_with("starts", F.slice("starts", 2, tail), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def _count_chars(c: str, keep: str) -> Column:
    """How many characters the class body ``keep`` has in ``c``."""
    return F.char_length(F.regexp_replace(c, f"[^{keep}]+", "")).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """One row per document: the contract's base counts and what the rules need."""
    d = id_text(docs)
    d = d.select(
        "doc_id",
        F.filter(F.split("text", SPACE + "+", -1), lambda w: w != "").alias("w"),
        F.filter(F.split("text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        _count_chars("text", SYMBOLS).alias("n_symbols"),
        _count_chars("text", r"\p{Lu}").alias("n_upper"),
        _count_chars("text", "!").alias("n_exclaim"),
    )
    d = d.select(
        "*",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("hw"),
    )
    later = [F.slice("hw", i + 1, TAIL).alias(f"h{i}") for i in range(WINDOW)]
    d = d.withColumn("n_distinct", F.size(F.array_distinct("hw")).cast("long"))
    five = F.slice(F.arrays_zip(*later), F.lit(1), F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))
    d = d.withColumn("h5", F.transform(five, lambda s: F.xxhash64(*[s[f"h{i}"] for i in range(WINDOW)])))
    return _repeated_words(d).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_upper", "n_exclaim", "n_lines", "n_distinct",
    )


#: Votes. They are categories, not numbers.
DROP, ABSTAIN, KEEP, DOUBT = -1, 0, 1, 2
_VOTES = (DROP, ABSTAIN, KEEP, DOUBT)


@dataclass(frozen=True)
class Rule:
    """Votes drop where ``bad`` holds, else doubt where ``doubt`` does, else keep
    where ``good`` does, else abstains."""

    name: str
    good: str
    bad: str
    doubt: str = "false"

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), DROP).when(F.expr(self.doubt), DOUBT).when(F.expr(self.good), KEEP).otherwise(ABSTAIN)


#: The rules, as SQL over ``features``. No rule sees a word list.
RULES = (
    Rule("length", "n_words >= 50", "n_words = 0", "n_words < 20"),
    Rule("word_length", "word_chars BETWEEN 2.5D * n_words AND 12 * n_words", "word_chars < 2 * n_words OR word_chars > 20 * n_words", "word_chars < 2.5D * n_words OR word_chars > 15 * n_words"),
    Rule("symbols", "n_symbols <= 0.02D * n_words", "n_symbols > 0.25D * n_words", "n_symbols > 0.1D * n_words"),
    Rule("duplicate_lines", "n_dup_lines = 0", "n_dup_lines >= 5 AND n_dup_lines > 0.3D * n_lines", "n_dup_lines >= 2 AND n_dup_lines > 0.1D * n_lines"),
    Rule("repeated_words", "n_repeat_words <= 0.02D * n_words", "n_repeat_words > 0.2D * n_words", "n_repeat_words > 0.1D * n_words"),
    Rule("upper_case", "n_upper <= 0.15D * word_chars", "n_upper > 0.4D * word_chars", "n_upper > 0.25D * word_chars"),
    Rule("exclamation", "n_exclaim <= 0.05D * n_words", "n_exclaim > 0.3D * n_words", "n_exclaim > 0.1D * n_words"),
    Rule("variety", "n_distinct >= 0.3D * n_words", "n_words >= 50 AND n_distinct < 0.2D * n_words", "n_words >= 50 AND n_distinct < 0.3D * n_words"),
)


def _code(vote: tuple[int, ...]) -> int:
    """The number of a vote pattern: a digit to base 4 for each rule."""
    code = 0
    for v in vote:
        code = code * 4 + v + 1
    return code


@dataclass(frozen=True)
class LabelModel:
    """Latent classes with votes independent given the class. Class 0 is "good";
    class k is the kind of bad document that rule k rightly objects to (it has no
    others), so that rules which catch different defects don't have to agree. ``share[k]``: log share of the
    class; ``table[k, i, v]``: log probability of vote v (by its place in
    ``_VOTES``) of rule i in it, given that it votes; an abstention says nothing."""

    share: np.ndarray
    table: np.ndarray

    def posteriors(self, votes: np.ndarray) -> np.ndarray:
        """Class probabilities of each row of ``votes``."""
        rules = np.arange(self.table.shape[1])
        logs = self.share + self.table[:, rules, votes + 1].sum(axis=2).T
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def weights(self, vote: tuple[int, ...]) -> list[float]:
        return self.posteriors(np.array([vote])).tolist()[0]


def fit_label_model(
    patterns: list[tuple[tuple[int, ...], int]],
    n_rules: int,
    rounds: int = 200,
    smooth: float = 0.5,
    doubt_false: float = 0.6,
    drop_false: float = 0.1,
    drop_rate: float = 0.002,
    belief: float = 0.5,
) -> LabelModel:
    """EM over ``patterns`` (distinct vote vectors with counts). It starts from
    each objection being false with odds of its own, ``doubt_false`` and
    ``drop_false``: a document is good with the product of those of its
    objections, else a bad one of the kinds that the objecting rules are after.
    From there the counts decide. How often a rule objects to good documents has a
    prior, not a bound: ``drop_rate`` for drops and for doubts the rule's rate over
    the whole corpus, which weigh ``belief`` times what the votes of the class
    do. ``smooth`` is added to every count, so that an empty class or an empty
    corpus gives finite weights."""
    drop, abstain, keep, doubt = (_VOTES.index(v) for v in (DROP, ABSTAIN, KEEP, DOUBT))
    votes = np.array([v for v, _ in patterns], np.int64).reshape(-1, n_rules)
    counts = np.array([c for _, c in patterns], float)
    is_vote = np.stack([votes == v for v in _VOTES], axis=2).astype(float)  # pattern, rule, vote
    objection = np.select([votes == DROP, votes == DOUBT], [1 / drop_false - 1, 1 / doubt_false - 1], 0.0)
    good = np.prod(np.select([votes == DROP, votes == DOUBT], [drop_false, doubt_false], 1.0), axis=1)
    kinds = objection / np.maximum(objection.sum(axis=1, keepdims=True), 1e-300)
    weights = np.concatenate((good[:, None], (1 - good)[:, None] * kinds), axis=1)
    prior = np.full((n_rules + 1, n_rules, len(_VOTES)), smooth)
    prior[:, :, abstain] = 0.0
    own = np.arange(n_rules)
    overall = np.einsum("p,piv->iv", counts, is_vote) + prior[0]
    expected = np.zeros((n_rules, len(_VOTES)))
    expected[:, drop] = drop_rate
    expected[:, doubt] = (1 - drop_rate) * overall[:, doubt] / (overall[:, doubt] + overall[:, keep])
    expected[:, keep] = 1 - expected[:, drop] - expected[:, doubt]
    prior[own + 1, own, keep] = 0.0
    model = None
    for _ in range(rounds):
        mass = weights * counts[:, None]
        share = np.log((mass.sum(axis=0) + smooth) / (mass.sum() + smooth * (n_rules + 1)))
        n = prior + np.einsum("pk,piv->kiv", mass, is_vote)
        n[:, :, abstain] = 0.0
        rate = n / n.sum(axis=2, keepdims=True)
        rate[0] = (rate[0] + belief * expected) / (1 + belief)
        rate[:, :, abstain] = 1.0
        rate[own + 1, own, abstain] = 0.0
        with np.errstate(divide="ignore"):
            model = LabelModel(share, np.log(rate))
        fresh = model.posteriors(votes)
        moved = np.abs(fresh - weights).max(initial=0.0)
        weights = fresh
        if moved < 1e-9:
            break
    return model


def score_patterns(voted: DataFrame, n_rules: int, code: str = "pattern") -> DataFrame:
    """(pattern, p_good) of every pattern in ``voted``, whose column ``code`` holds
    ``_code`` of the votes: at most 4 ** ``n_rules`` rows, which pass through the
    driver."""
    seen = sorted((r[0], r[1]) for r in voted.groupBy(code).count().collect())
    patterns = [(tuple(c // 4 ** (n_rules - 1 - i) % 4 - 1 for i in range(n_rules)), n) for c, n in seen]
    model = fit_label_model(patterns, n_rules)
    good = model.posteriors(np.array([v for v, _ in patterns], np.int64).reshape(-1, n_rules))[:, 0]
    rows = json.dumps([{"pattern": c, "p_good": p} for (c, _), p in zip(seen, good.tolist(), strict=True)])
    table = F.from_json(F.lit(rows), "array<struct<pattern: int, p_good: double>>")
    return voted.sparkSession.range(1).select(F.inline(table))


def quality(docs: DataFrame, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Features, votes, ``p_good`` and ``kept`` of every document."""
    f = materialize(features(docs), "quality_features")
    votes = [f"v_{r.name}" for r in rules]
    voted = f.select("*", *[r.vote().alias(v) for r, v in zip(rules, votes, strict=True)])
    pattern = F.lit(0)
    for v in votes:
        pattern = pattern * 4 + F.col(v) + 1
    voted = voted.withColumn("pattern", pattern.cast("int"))
    scored = score_patterns(voted, len(rules))
    # The patterns are bounded by the rules (65,536 for eight), not by the corpus.
    joined = voted.join(F.broadcast(scored), "pattern").drop("pattern")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = joined.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
