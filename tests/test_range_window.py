import random
import re
import statistics
from fractions import Fraction

import pytest

from quakeframe.operators.range_window import Agg, choose_block, range_aggregate, range_aggregate_direct

AGGS = [
    Agg("n", "count", "v"),
    Agg("s", "sum", "v"),
    Agg("mean", "avg", "v"),
    Agg("mx", "max", "v"),
    Agg("mn", "min", "v"),
    Agg("sd", "stddev", "v"),
]
LEAD = [Agg("fmax", "max", "v"), Agg("fn", "count", "v")]
SCHEMA = "k string, t bigint, v double"


def collect(df, keys=("k", "t")):
    return {tuple(r[x] for x in keys): r.asDict() for r in df.collect()}


def assert_same(a, b, cols):
    assert a.keys() == b.keys()
    for key in a:
        for c in cols:
            x, y = a[key][c], b[key][c]
            if x is None or y is None:
                assert x is None and y is None, (key, c, x, y)
            else:
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (key, c, x, y)


def test_frame_edges(spark):
    D = 100
    rows = [
        ("a", 1000, 1.0),
        ("a", 1000, 3.0),  # same-second peer: in each other's frame
        ("a", 1100, 5.0),  # exactly D after 1000: frame includes 1000
        ("a", 1101, 7.0),  # D + 1 after 1000: excludes 1000
        ("a", 1202, None),  # NULL value still forms a (key, second)
        (None, 1000, 2.0),  # NULL key is its own group
        (None, 1050, 4.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collect(range_aggregate(df, ["k"], "t", (D, AGGS), (D, LEAD), block_seconds=10))
    assert got[("a", 1000)]["n"] == 2 and got[("a", 1000)]["mean"] == 2.0
    assert got[("a", 1100)]["n"] == 3 and got[("a", 1100)]["mx"] == 5.0
    assert got[("a", 1101)]["n"] == 2 and got[("a", 1101)]["mn"] == 5.0
    assert got[("a", 1202)]["n"] == 0 and got[("a", 1202)]["mean"] is None
    assert got[("a", 1202)]["sd"] is None and got[("a", 1202)]["s"] is None
    # look-ahead [t+1, t+D]: 1000 sees 1100 (limit) but not 1101 nor its peer
    assert got[("a", 1000)]["fmax"] == 5.0 and got[("a", 1000)]["fn"] == 1
    assert got[("a", 1100)]["fmax"] == 7.0
    assert got[("a", 1202)]["fmax"] is None and got[("a", 1202)]["fn"] == 0
    assert got[(None, 1050)]["n"] == 2 and got[(None, 1000)]["fmax"] == 4.0


@pytest.mark.parametrize("block", [None, 7, 10, 13, 25, 49, 50])
def test_block_equals_direct_random(spark, block):
    rnd = random.Random(7)
    rows = []
    for _ in range(600):
        k = rnd.choice(["x", "y", "z", None])
        t = rnd.randint(-500, 2000)  # negative seconds: blocks floor downward
        v = None if rnd.random() < 0.1 else rnd.randint(-40, 400) / 64.0
        rows.append((k, t, v))
    df = spark.createDataFrame(rows, SCHEMA)
    trailing, leading = (150, AGGS), (50, LEAD)
    a = collect(range_aggregate(df, ["k"], "t", trailing, leading, block_seconds=block))
    b = collect(range_aggregate_direct(df, ["k"], "t", trailing, leading))
    assert_same(a, b, [x.name for x in AGGS + LEAD])


def test_trailing_only_and_leading_only(spark):
    df = spark.createDataFrame([("a", t, float(t % 7)) for t in range(0, 400, 3)], SCHEMA)
    a = collect(range_aggregate(df, ["k"], "t", (60, AGGS), block_seconds=20))
    b = collect(range_aggregate_direct(df, ["k"], "t", (60, AGGS)))
    assert_same(a, b, [x.name for x in AGGS])
    a = collect(range_aggregate(df, ["k"], "t", leading=(40, LEAD), block_seconds=20))
    b = collect(range_aggregate_direct(df, ["k"], "t", leading=(40, LEAD)))
    assert_same(a, b, [x.name for x in LEAD])


def test_whole_key_aggregate_and_validation(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 5, 2.0), ("b", 9, 3.0), ("b", None, 4.0)], SCHEMA)
    got = collect(range_aggregate(df, ["k"], "t", (10, [Agg("n", "count", "v")]), whole=[Agg("all", "count", "v")]))
    assert got[("a", 5)]["all"] == 2 and got[("b", 9)]["all"] == 2  # NULL-time row counts in whole
    assert ("b", None) not in got
    with pytest.raises(ValueError):
        range_aggregate(df, ["k"], "t", (10, AGGS), block_seconds=11)
    with pytest.raises(ValueError):
        Agg("x", "median", "v")
    assert choose_block(30 * 86400, 7 * 86400) == 86400
    assert choose_block(3600) == 3600
    assert choose_block(3601) == 56  # divides nothing: not blocks of one second


@pytest.mark.parametrize(
    "values",
    [[4.3, 4.3, 4.3], [5.1, 5.1, 5.1], [1e8 + 0.1, 1e8 + 0.2, 1e8 + 0.3], [1e8 + 0.1] * 40 + [0.25], [-7.7, 3.3, 0.1, 1e-6],
     [9e9, 9e9], [0.0, 1e-10, 2e-10], [0.0] * 5 + [1e9 + 0.5, 1e9 + 1.5, 1e9 + 2.5], [1e100, 2e100, -3e99]],
)
def test_stddev_does_not_cancel(spark, values):
    rows = [("a", 10 * i, v) for i, v in enumerate(values)] + [("a", 100_000 + i, float(i % 3)) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    sd = Agg("sd", "stddev", "v")
    got = collect(range_aggregate(df, ["k"], "t", (500, [sd]), (500, [Agg("ahead", "stddev", "v")]), block_seconds=20, whole=[Agg("all", "stddev", "v")]))
    for _, t, _ in rows:
        for name, lo, hi in (("sd", t - 500, t), ("ahead", t + 1, t + 500), ("all", -1, 1 << 60)):
            frame = [Fraction(v) for _, s, v in rows if lo <= s <= hi]
            want = float(statistics.stdev(frame)) if len(frame) > 1 else None
            x = got[("a", t)][name]
            assert (x is None) == (want is None) and (x is None or x == pytest.approx(want, rel=1e-9, abs=1e-18)), (name, t, x, want)
    if len(set(values)) == 1:
        assert got[("a", 10)]["sd"] == 0.0


def test_stddev_of_a_hot_second_and_without_decimals(spark):
    """20,000 values near 1e8 in one second, dealt over partitions."""
    from pyspark.sql import functions as F

    df = spark.range(20_000, numPartitions=7).select(F.lit("a").alias("k"), (F.col("id") * 0 + 5).alias("t"), (F.lit(1e8) + (F.col("id") % 97) / 64.0).alias("v"))
    more = df.unionByName(df.withColumn("t", F.lit(9).cast("long")))
    out = range_aggregate(more, ["k"], "t", (10, [Agg("sd", "stddev", "v")]))
    got = {r.t: r.sd for r in out.collect()}
    direct = {r.t: r.sd for r in range_aggregate_direct(more, ["k"], "t", (10, [Agg("sd", "stddev", "v")])).collect()}
    assert got.keys() == direct.keys() == {5, 9} and all(got[t] == pytest.approx(direct[t], rel=1e-9) for t in got)
    assert "decimal" not in out._jdf.queryExecution().executedPlan().toString().lower()


def test_hot_key_is_split_by_blocks(spark):
    """All rows in one key: every window of the last stage is partitioned by the
    key and the block."""
    df = spark.createDataFrame([("hot", t, 1.0) for t in range(0, 5000, 7)], SCHEMA)
    plan = range_aggregate(df, ["k"], "t", (100, AGGS), (100, LEAD), block_seconds=50)
    windows = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.strip(" +-:").startswith("Window")]
    over_rows = [x for x in windows if "__o" in x]
    assert over_rows and all("[k#" in x and "__b#" in x for x in over_rows)
    got = collect(plan)
    assert all(r["n"] >= 1 for r in got.values())


def test_rows_are_sorted_twice_by_tasks_that_grow_in_number(spark, monkeypatch):
    """The running parts of all aggregates take one sort in either order, and a task
    holds a fixed number of seconds, however well its rows compress."""
    from quakeframe.operators import range_window

    monkeypatch.setattr(range_window, "SECONDS_PER_TASK", 20)
    rows = [(k, t, float(t % 9)) for k in "ab" for t in range(0, 1000, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = range_aggregate(df, ["k"], "t", (100, AGGS), (100, LEAD), block_seconds=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorts = [x for x in plan.splitlines() if x.strip(" +-:*()0123456789").startswith("Sort [") and "__o#" in x]
    assert len(sorts) == 2
    assert re.search(r"hashpartitioning\(k#\d+, __b#\d+L?, 50\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"hashpartitioning\(k#\d+, __b#\d+L?, \d+\), ENSURE_REQUIREMENTS\S*\n[^\n]*Union", plan)
    assert_same(collect(out), collect(range_aggregate_direct(df, ["k"], "t", (100, AGGS), (100, LEAD))), [x.name for x in AGGS + LEAD])
