import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import features
from quakeframe.plans import feature_store
from quakeframe.sources import catalogue as cat_io
from test_state import events

ARGS = (7, 14, 3.0, 0.5)


def rows_of(df):
    """Rows, with doubles to 9 digits: sums of other partitions end in other bits."""
    return sorted((tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def same(spark, cat, store):
    want = features.training_features(cat_io.read_catalogue(spark, cat), ARGS[0], ARGS[1], ARGS[2], ARGS[3], method="direct")
    return rows_of(feature_store.read_features(spark, store)) == rows_of(want)


def month(m):
    return (2024, m)


def test_append_equals_a_full_build_and_reads_neighbours_only(spark, scratch):
    cat, store = os.path.join(scratch, "cat"), os.path.join(scratch, "store")
    cat_io.write_catalogue(events(spark, [1, 2, 3, 4, 5]), cat)
    built = feature_store.maintain(spark, cat, store, None, *ARGS)
    assert len(built.months) == 6 and same(spark, cat, store)
    written = cat_io.write_catalogue(events(spark, [6], undated=0), cat, "append")
    whole = {m: [f for f in os.listdir(f"{cat}/year=2024/month={m}") if f.endswith(".parquet")] for m in (1, 2, 3, 4)}
    bytes_of = {}
    for m, names in whole.items():  # months out of reach can't even be read
        for f in names:
            at = f"{cat}/year=2024/month={m}/{f}"
            bytes_of[at] = open(at, "rb").read()
            os.truncate(at, 0)
    old = {m: os.listdir(f"{store}/features/year=2024/month={m}") for m in (1, 2, 3, 4)}
    for _ in range(2):  # again: the same table
        done = feature_store.maintain(spark, cat, store, written.months, *ARGS)
        assert done.months == (month(5), month(6)) and set(done.read) == {month(5), month(6)}
    assert old == {m: os.listdir(f"{store}/features/year=2024/month={m}") for m in (1, 2, 3, 4)}
    for at, b in bytes_of.items():
        with open(at, "wb") as f:
            f.write(b)
    spark.catalog.clearCache()
    assert same(spark, cat, store)


@pytest.mark.parametrize("late", [1, 3])
def test_a_month_that_comes_late_reaches_the_next_event_of_its_networks(spark, scratch, late):
    """Network d has events in months 1 and 6 alone; month 3's (or 1's) come last."""
    cat, store = os.path.join(scratch, "cat"), os.path.join(scratch, "store")
    rare = events(spark, [late, 8], per_month=4, undated=0).withColumn("network", F.lit("d")).withColumn("event_id", F.concat(F.lit("r"), "event_id"))
    rest = events(spark, [m for m in range(1, 9) if m != late], undated=2).unionByName(rare.where("month = 8"))
    cat_io.write_catalogue(rest, cat)
    feature_store.maintain(spark, cat, store, None, *ARGS)
    written = cat_io.write_catalogue(events(spark, [late], undated=1).withColumn("event_id", F.concat("event_id", F.lit("x"))).unionByName(rare.where(f"month = {late}")), cat, "append")
    done = feature_store.maintain(spark, cat, store, written.months, *ARGS)
    assert month(8) in done.months and month(6) not in done.months and (None, None) in done.months
    assert same(spark, cat, store)


def test_overwritten_and_lost_months(spark, scratch):
    cat, store = os.path.join(scratch, "cat"), os.path.join(scratch, "store")
    cat_io.write_catalogue(events(spark, [1, 2, 3, 4]), cat)
    feature_store.maintain(spark, cat, store, None, *ARGS)
    # Month 2 is replaced by fewer events, none of which passes the quality filter.
    new = events(spark, [2], per_month=5, undated=0).withColumn("magnitude", F.lit(-1.0))
    written = cat_io.write_catalogue(new, cat, "overwrite", dynamic_overwrite=True)
    done = feature_store.maintain(spark, cat, store, written.months, *ARGS)
    assert month(1) in done.months and month(3) in done.months and month(4) not in done.months
    assert same(spark, cat, store) and not os.path.exists(f"{store}/features/year=2024/month=2")
    # A whole overwrite that loses months.
    cat_io.write_catalogue(events(spark, [3], undated=0), cat)
    feature_store.maintain(spark, cat, store, None, *ARGS)
    assert same(spark, cat, store) and feature_store.read_features(spark, store).agg(F.min("event_time")).first()[0] >= dt.datetime(2024, 3, 1)


def test_stored_density_plan_reads_no_catalogue(spark, scratch):
    cat, store = os.path.join(scratch, "cat"), os.path.join(scratch, "store")
    cat_io.write_catalogue(events(spark, [1, 2]), cat)
    feature_store.maintain(spark, cat, store, None, *ARGS)
    assert not [f for f in feature_store.read_features(spark, store).inputFiles() if "/cat/" in f]
