import collections
import re

import pytest

from llm.conftest import SF01, awkward, frame, table
from quakeframe.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    count = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if count[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


REPEATS = ["a b c d e f g a b c d e f z q w e r t y", "x " * 30, "a b c d e a b c d e", "p q\np q\n\np  q\np q", "# $ % | < > & * x", "a b c d e f g h i j k l " * 2 + "m n", ""]


def test_counts_against_brute_force(spark):
    rows = awkward() + [(500 + i, t) for i, t in enumerate(REPEATS)]
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.features(frame(spark, rows)).collect())
    assert got == collections.Counter((i, *brute(t)) for i, t in rows)


def test_query_counts_and_verdicts(spark):
    texts = {r["doc_id"]: r["text"] for r in table(SF01)}
    labels = {r["doc_id"]: r["quality"] for r in table(SF01, "labels")}
    got = {r.doc_id: r for r in queries.op9_quality(spark, SF01).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        r = got[i]
        w, chars, symbols, dup, rep = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (w, chars, symbols, dup, rep)
        assert r.base_failed == (w < 10 or 100 * rep > 20 * w)
        assert not (r.base_failed and r.kept)
    judged = [(labels[i], r.kept) for i, r in got.items() if i in labels and not r.base_failed]
    # No label was seen: clean documents stay, most of the others go.
    assert all(kept for y, kept in judged if y == 1)
    bad = [kept for y, kept in judged if y == 0]
    assert sum(bad) <= 0.1 * len(bad)


def test_em_separates_kinds_of_bad_documents():
    clean, shouting, symbols, noisy = (1, 1, 1, 1), (-1, -1, 1, 1), (1, 1, -1, 1), (1, 1, 1, 0)
    m = quality.fit_label_model([(clean, 900), (shouting, 40), (symbols, 40), (noisy, 60)], 4)
    p = {v: m.weights(v)[0] for v in (clean, shouting, symbols, noisy)}
    assert p[clean] > 0.9 and p[noisy] > 0.9 and p[shouting] < 0.5 and p[symbols] < 0.5
    assert sum(m.weights(clean)) == pytest.approx(1.0)


def test_joined_posteriors_equal_the_model(spark):
    patterns = [((1, 1, 0), 50), ((-1, 1, 0), 5), ((0, -1, 1), 9), ((0, 2, 0), 3)]
    m = quality.fit_label_model(sorted(patterns, key=lambda x: quality._code(x[0])), 3)
    df = spark.createDataFrame([(quality._code(v),) for v, n in patterns for _ in range(n)], "pattern int")
    got = {r.pattern: r.p_good for r in quality.score_patterns(df, 3).collect()}
    assert got == {quality._code(v): pytest.approx(m.weights(v)[0], abs=1e-12) for v, _ in patterns}


def test_filter_on_the_verdict_stays_in_generated_code(spark):
    d = quality.quality(frame(spark, [(i, "some words that make a line of text") for i in range(20)])).where("kept")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it is without it shows its generated code
    try:
        plan = d.select("*")._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    stages = d._sc._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
    sizes = [int(stages.apply(i)._3().maxMethodCodeSize()) for i in range(stages.size())]
    assert sizes and max(sizes) < 8000  # beyond it the JVM no longer compiles


def test_empty_corpus_and_one_sided_corpus(spark):
    assert quality.quality(frame(spark, [])).count() == 0
    rows = [(i, "some ordinary words that make up a fine and longer text number " + " ".join(f"w{i}{j}" for j in range(60))) for i in range(30)]
    assert all(r.kept for r in quality.quality(frame(spark, rows)).collect())
    got = {r.doc_id: r for r in quality.quality(frame(spark, [(1, None), (2, ""), (3, "few words")])).collect()}
    assert all(r.base_failed and not r.kept for r in got.values())


def test_plan_has_no_python(spark):
    plan = quality.quality(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


DROP, KEEP, DOUBT = quality.DROP, quality.KEEP, quality.DOUBT


def test_lone_doubts_are_overruled_and_several_are_not():
    fine, one, other, three = (KEEP,) * 4, (DOUBT, KEEP, KEEP, KEEP), (KEEP, DOUBT, KEEP, KEEP), (DOUBT, DOUBT, DOUBT, KEEP)
    m = quality.fit_label_model([(fine, 2000), (one, 50), (other, 50), (three, 8)], 4)
    p = [m.weights(v)[0] for v in (fine, one, other, three)]
    assert p[0] > 0.99 and p[1] > 0.9 and p[2] > 0.9 and p[3] < 0.5


def test_a_lone_drop_is_judged_by_what_the_rule_is_right_about():
    # Rule 0 objects to documents with other faults, rule 3 to nothing else than its own.
    fine, lone, own = (KEEP,) * 4, (DROP, KEEP, KEEP, KEEP), (KEEP, KEEP, KEEP, DROP)
    seen = [(fine, 2000), (lone, 6), (own, 60), ((DROP, DROP, KEEP, KEEP), 60), ((DROP, KEEP, DROP, KEEP), 60), ((DROP, DROP, DROP, KEEP), 60)]
    m = quality.fit_label_model(seen, 4)
    assert m.weights(lone)[0] > 0.5 > m.weights(own)[0]
    assert all(m.weights(v)[0] < 0.5 for v, _ in seen[3:])


def test_one_vote_pattern_or_none():
    assert quality.fit_label_model([], 4).weights((KEEP,) * 4)[0] > 0.9
    doubted, dropped = (DOUBT, KEEP, KEEP, KEEP), (DROP, KEEP, KEEP, KEEP)
    assert quality.fit_label_model([(doubted, 50)], 4).weights(doubted)[0] > 0.5
    assert quality.fit_label_model([(dropped, 50)], 4).weights(dropped)[0] < 0.5


def words(i, n):
    return [f"w{i}x{j}" for j in range(n)]


def test_verdicts_differ_from_all_must_pass_and_from_drops_alone(spark):
    rows = [(i, " ".join(words(i, 60))) for i in range(300)]
    rows += [(1000 + i, " ".join([*words(i, 60), "!" * 8])) for i in range(8)]  # one doubt: exclamation
    shout = [(2000 + i, " ".join([*(w + "!" if j % 5 == 0 else w for j, w in enumerate(words(i, 55))), "#" * 8])) for i in range(4)]
    got = {r.doc_id: r for r in quality.quality(frame(spark, rows + shout)).collect()}
    votes = [f"v_{r.name}" for r in quality.RULES]
    assert all(sum(got[i][v] == DOUBT for v in votes) == 1 and got[i].kept for i in range(1000, 1008))
    for i, _ in shout:
        assert not any(got[i][v] == DROP for v in votes) and sum(got[i][v] == DOUBT for v in votes) >= 2
        assert not got[i].base_failed and not got[i].kept
    assert all(got[i].kept for i in range(300))
