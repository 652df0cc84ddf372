import collections

import duckdb
import pytest

from llm.conftest import SF01, awkward, frame
from quakeframe.llm import line_dedup, queries

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WS = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(WS).translate(UP)


def brute(rows, min_chars, min_docs):
    held = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                held[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (i is not None and len(held[key(x)]) >= min_docs and i != max(held[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


def got(df):
    return collections.Counter((r.doc_id, r.line_dedup_lines, r.line_dedup_dropped, r.text or "") for r in df.collect())


@pytest.mark.parametrize("batches", [1, 3, 6, None])
def test_against_brute_force(spark, batches):
    rows = awkward() + [(100 + i, "  SHARED line Über all, padded\t\nshared LINE über all, padded") for i in range(7)]
    rows += [(200 + i, "short") for i in range(9)]
    df = frame(spark, rows)
    out = line_dedup.dedup_lines(df, 10, 5, batches)
    assert got(out) == brute(rows, 10, 5)
    assert [c for c in out.columns if c in df.columns] == df.columns


def test_null_text_stays_null_and_empty_table(spark):
    assert line_dedup.dedup_lines(frame(spark, [(1, None), (2, "")])).orderBy("doc_id").select("text").collect()[0][0] is None
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_store_levels_settled_keys_and_unseen(spark):
    line = "the same line of text that is long enough to count"
    store = line_dedup.LineRuns(spark, min_docs=2, fanout=2)
    for ids in ([9, 8], [7, 6], [5, 4], [3]):
        store.add(line_dedup.line_keys(frame(spark, [(i, line + "\n" + f"{line} {i}") for i in ids]), 10))
    assert [len(x) for x in store.levels][0] < 2 and len(store.runs()) <= 3
    settled = store.settled().collect()
    assert [(r.n_docs, r.max_doc) for r in settled] == [(2, 9)]  # later batches no longer add to a settled key
    assert store.merged().count() == 8
    new = store.unseen(line_dedup.line_keys(frame(spark, [(1, line + "\nquite another line than any before")]), 10))
    assert new.count() == 1


def test_batches_grow_and_meet_compacted_runs(spark, monkeypatch):
    top = line_dedup.BATCH_DOCS
    assert [line_dedup.batch_count(n) for n in (0, 1, top, top + 1, 2 * top, 2 * top + 1, 64 * top)] == [3, 3, 3, 4, 4, 5, 9]
    met = []
    add = line_dedup.LineRuns.add
    monkeypatch.setattr(line_dedup.LineRuns, "add", lambda self, keys: (met.append([len(x) for x in self.levels]), add(self, keys)))
    line = "the same line of text that is long enough to count"
    rows = [(i, f"{line}\n{line} {i % 7}") for i in range(40)]
    assert got(line_dedup.dedup_lines(frame(spark, rows), 10, 5)) == brute(rows, 10, 5)
    assert met == [[0], [1], [0, 1]]  # the third batch is anti-joined with a compacted run
    met.clear()
    monkeypatch.setattr(line_dedup, "BATCH_DOCS", 8)
    assert got(line_dedup.dedup_lines(frame(spark, rows), 10, 5)) == brute(rows, 10, 5)
    assert len(met) == 6 and met[4] == [0, 0, 1]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    want = sorted(con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({queries.ORACLE_SQL['op1_line_dedup']})").fetchall())
    assert sorted(tuple(r) for r in queries.op1_line_dedup(spark, SF01).collect()) == want
