import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from quakeframe.operators.previous_gap import with_previous_gap


def direct(df):
    w = Window.partitionBy("net").orderBy("ts", "id")
    return df.withColumn("gap", F.col("s") - F.lag("s").over(w))


def test_gap_matches_lag_with_ties_nulls_and_blocks(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    i = 0
    for net in ["a", "b", None]:
        for sec in [0, 0, 5, 86399, 86400, 86401, 3 * 86400 + 10, 3 * 86400 + 10]:
            i += 1
            rows.append((i, net, base + dt.timedelta(seconds=sec, microseconds=i)))
    rows.append((999, "a", None))
    df = spark.createDataFrame(rows, "id long, net string, ts timestamp_ntz")
    df = df.withColumn("s", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    got = {r.id: r.gap for r in with_previous_gap(df, "net", "s", ["ts", "id"], out="gap").collect()}
    want = {r.id: r.gap for r in direct(df).collect()}
    assert got == want
    assert got[999] is None


def test_one_of_equal_rows_takes_the_gap(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, "a", base), (2, "a", base + dt.timedelta(seconds=50)), (2, "a", base + dt.timedelta(seconds=50)),
            (3, "a", base + dt.timedelta(seconds=90)), (3, "a", base + dt.timedelta(seconds=90))]
    df = spark.createDataFrame(rows, "id long, net string, ts timestamp_ntz")
    df = df.withColumn("s", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    got = sorted((r.id, -1 if r.gap is None else r.gap) for r in with_previous_gap(df, "net", "s", ["ts", "id"], out="gap").collect())
    assert got == sorted((r.id, -1 if r.gap is None else r.gap) for r in direct(df).collect())
    assert got == [(1, -1), (2, 0), (2, 50), (3, 0), (3, 40)]
