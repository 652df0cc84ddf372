import collections
import re
import weakref

from llm.conftest import SF001, table
from llm.test_line_dedup import brute as brute_lines
from llm.test_ngram_join import brute as brute_groups
from llm.test_packing import brute_pieces
from llm.test_pii import brute as brute_pii
from quakeframe import session
from quakeframe.llm import components, ngram_join
from quakeframe.llm.common import materialize, read_table
from quakeframe.session import release

import corpus_pipeline


def test_stages_against_brute_force(spark, tokenizer):
    docs = read_table(spark, SF001, "documents")
    columns, names = docs.columns, [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_join", "pii", "packing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF001), f"test_{name}")
        rows = {r.doc_id: r for r in before.collect()}
        after = docs.collect()
        seen.append(len(after))
        if name != "packing":
            assert docs.columns == columns and {r.doc_id for r in after} <= rows.keys()
            assert all(r.n_chars == len(r.text) for r in after)
        pairs = [(i, r.text) for i, r in rows.items()]
        if name == "toxicity":
            labels = {x["doc_id"]: x["toxic"] for x in table(SF001, "labels")}
            kept = {r.doc_id for r in after}
            clean = [i for i in labels if not labels[i]]
            assert sum(i in kept for i in clean) >= 0.97 * len(clean) and all(r.text == rows[r.doc_id].text for r in after)
        elif name == "line_dedup":
            assert collections.Counter((r.doc_id, r.text) for r in after) == collections.Counter((i, t) for (i, _, _, t) in brute_lines(pairs, 40, 5).elements())
        elif name == "ngram_join":
            groups = brute_groups(pairs)
            assert sorted(r.doc_id for r in after) == sorted({c if n else d for d, n, c in groups})
        elif name == "pii":
            for r in after:
                text, gone = rows[r.doc_id].text, brute_pii(rows[r.doc_id].text)
                assert not brute_pii(r.text) and len(re.findall(r"\[(?:email|ip|card|phone)\]", r.text)) >= len(gone) - text.count("[email]")
                assert gone or "[secret]" in r.text or "[number]" in r.text or re.search(r"\[(?:email|ip|card|phone)\]", r.text) or r.text == text
        else:
            got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in after)
            assert got == brute_pieces(pairs, tokenizer, 2048)
    assert seen[0] < len(table(SF001)) and seen[2] < seen[1] and seen[1] == seen[0]


def test_run_and_registration(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    out = corpus_pipeline.run(spark, SF001)
    assert out.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_every_stage_lets_go_of_what_came_before(spark, monkeypatch):
    let_go = []
    monkeypatch.setattr(corpus_pipeline, "release", lambda s: let_go.append(s))
    docs = spark.createDataFrame([(1, "one text", "en", "web", 8)], "doc_id long, text string, lang string, source string, n_chars long")
    # What follows the release isn't run here; the stages' results are tested above.
    for module, name in (("toxicity", "drop_toxic"), ("line_dedup", "dedup_lines"), ("ngram_join", "drop_near_duplicates"), ("pii", "redact"), ("packing", "pack")):
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, lambda d, *_, **__: d)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF001)
        assert let_go == [spark] * (i + 1)


def test_release_drops_plans_held_in_cycles(spark):
    held = spark.range(3)
    held.itself = held
    gone = weakref.ref(held)
    del held
    release(spark)
    assert gone() is None


def test_release_gives_back_what_the_allocator_keeps(spark):
    jvm = spark.sparkContext._jvm
    status = f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/status"

    def resident_mb():
        with open(status) as f:
            return int(re.search(r"RssAnon:\s+(\d+)", f.read())[1]) / 1024

    held = [jvm.java.util.zip.Deflater() for _ in range(800)]  # a quarter MB each, outside the heap
    for d in held[:-1]:
        d.end()  # the last one stays, so that the allocator can't shrink its arena by itself
    before = resident_mb()
    session.trim_native_heap(spark)
    assert resident_mb() < before - 30
    held[-1].end()


def test_release_trims_and_needs_no_such_command(spark, monkeypatch):
    trimmed = []
    monkeypatch.setattr(session, "trim_native_heap", lambda s: trimmed.append(s))
    release(spark)
    assert trimmed == [spark]
    monkeypatch.undo()
    monkeypatch.setattr(session, "TRIM_COMMAND", "noSuchCommand")
    release(spark)


def test_the_join_lets_go_between_its_steps(spark, monkeypatch):
    let_go = []
    monkeypatch.setattr(ngram_join, "release", lambda s: let_go.append("join"))
    monkeypatch.setattr(components, "release", lambda s: let_go.append("round"))
    text = " ".join(f"w{i}" for i in range(40))
    # A chain of near copies: its links are no star, so there is a round at least.
    rows = [(i, " ".join([*text.split()[i:], *(f"e{k}" for k in range(i))])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.near_duplicates(docs, 1, 80)
    assert let_go[:2] == ["join", "join"] and "round" in let_go
    assert {r.component_id for r in found.collect()} == {0}
