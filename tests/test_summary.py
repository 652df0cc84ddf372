import random

import pytest
from pyspark.sql import functions as F

from quakeframe.operators.summary import STATISTICS, exact_quantiles, summary_stats

QS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _brute(spark, df, columns):
    """Spark's single-task exact ``percentile`` as the reference answer."""
    out = {}
    for c in columns:
        row = df.agg(F.percentile(F.col(c).cast("double"), QS).alias("p")).first()
        if row["p"] is not None:
            for q, v in zip(QS, row["p"]):
                out[(c, q)] = v
    return out


@pytest.mark.parametrize("buckets", [2, 4, 1024])
def test_exact_quantiles_match_percentile(spark, buckets):
    rnd = random.Random(buckets)
    rows = []
    for i in range(3000):
        hot = 7.5 if i % 3 == 0 else rnd.choice([rnd.uniform(-50, 50), float(rnd.randint(-5, 5))])
        rows.append((hot, None if i % 11 == 0 else rnd.gauss(0, 1) * 1e6, 3.0, None))
    df = spark.createDataFrame(rows, "a double, b double, one double, empty double").repartition(7)
    cols = ["a", "b", "one", "empty"]
    got = {(r["column"], r["quantile"]): r["value"] for r in exact_quantiles(df, cols, QS, buckets).collect()}
    want = _brute(spark, df, cols)
    assert set(got) == set(want)  # no rows for the all-NULL column
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-9), k


def test_summary_exact_and_approx_shapes(spark):
    df = spark.createDataFrame([(float(i % 10), None) for i in range(101)], "x double, y double")
    for exact in (True, False):
        s = {(r["column"], r["statistic"]): r["value"] for r in summary_stats(df, ["x", "y"], exact=exact).collect()}
        assert len(s) == 2 * len(STATISTICS)
        assert s[("x", "count")] == 101 and s[("x", "50%")] == 4.0
        assert s[("y", "count")] == 0 and s[("y", "50%")] is None
    s = {(r["statistic"]): r["value"] for r in summary_stats(df, ["x"], exact=True).collect()}
    assert s["25%"] == 2.0 and s["75%"] == 7.0


def test_exact_quantiles_plan_has_no_single_partition_step(spark):
    df = spark.range(0, 20000).select((F.col("id") % 997).cast("double").alias("a"))
    q = exact_quantiles(df, ["a"], [0.5])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "percentile(" not in plan.replace("percentile_approx(", "")
    assert q.first()["value"] == df.agg(F.percentile("a", 0.5)).first()[0]
