import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quakeframe.operators import features
from quakeframe.operators.features import (
    build_features,
    quality_filter,
    serving_features,
    training_features,
)
from quakeframe.schema import SERVE_COLUMNS, TRAIN_COLUMNS
from quakeframe.sources.fixtures import events_catalogue

COLS = ["time_since_prev_event", "spatial_density", "mag_mean_30d", "mag_max_30d", "mag_std_30d",
        "event_count_30d", "depth_mean_30d", "cumulative_energy_30d", "future_max_mag", "has_aftershock"]


@pytest.fixture(scope="module")
def cat(spark):
    return quality_filter(events_catalogue(spark, SF001)).cache()


def test_block_equals_direct_on_fixture(spark, cat):
    b = {r.event_id: r for r in build_features(cat, 7, 0.5, 7, 3.0, "block").collect()}
    d = {r.event_id: r for r in build_features(cat, 7, 0.5, 7, 3.0, "direct").collect()}
    assert b.keys() == d.keys() and len(b) == 898
    for k in d:
        for c in COLS:
            x, y = b[k][c], d[k][c]
            if x is None or y is None:
                assert x is None and y is None
            else:
                assert x == pytest.approx(y, rel=1e-12, abs=1e-12), (k, c)


def test_thirty_day_default_windows(spark, cat):
    b = {r.event_id: r for r in build_features(cat).collect()}
    d = {r.event_id: r for r in build_features(cat, method="direct").collect()}
    for k in d:
        assert b[k]["event_count_30d"] == d[k]["event_count_30d"]
        assert b[k]["future_max_mag"] == d[k]["future_max_mag"]


def test_properties(spark, cat):
    f = build_features(cat, 7, 0.5, 7, 3.0)
    bad = f.where(
        (F.col("event_count_30d") < 1)
        | (F.col("mag_max_30d") < F.col("mag_mean_30d"))
        | (F.col("event_count_30d") > F.col("spatial_density"))
    ).count()
    assert bad == 0
    dens = f.groupBy("lat_grid", "lon_grid").agg(F.count("*").alias("n"), F.max("spatial_density").alias("d"))
    assert dens.where(F.col("n") != F.col("d")).count() == 0
    assert dens.count() == 8


def test_training_and_serving_tables(spark):
    raw = events_catalogue(spark, SF001)
    t = training_features(raw, 7, 7, 3.0)
    assert t.columns == TRAIN_COLUMNS
    assert t.count() == 898
    assert t.where(F.col("time_since_prev_event").isNull() | F.col("mag_std_30d").isNull()).count() == 0
    s = serving_features(raw, 7)
    assert s.columns == SERVE_COLUMNS
    assert s.count() == 1000  # no quality filter when serving
    dt = dict(t.dtypes)
    assert dt["has_aftershock"] == "int" and dt["spatial_density"] == "bigint"
    assert dt["event_count_30d"] == "bigint" and dt["hour"] == "int"


def test_plan_has_no_window_over_whole_network(spark, cat):
    """The per-network gap never partitions a window by network alone."""
    f = build_features(cat, 7, 0.5, 7, 3.0)
    text = f._jdf.queryExecution().optimizedPlan().toString()
    assert "network#" in text
    import re
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", text)
    assert specs, "expected window functions"
    for s in specs:
        keys = [k.strip().split("#")[0] for k in s.split(",") if "#" in k and "specifiedwindowframe" not in k]
        assert keys[:1] != ["network"] or "__b" in s, s


def test_hot_cell_and_network_block_equals_direct(spark):
    """40% of rows in one cell and one network, many in one second: the block
    form gives the direct windows' values."""
    import datetime as dt
    import random

    rnd = random.Random(7)
    base = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(3000):
        if i % 5 < 2:  # hot cell, hot network
            sec = 5 * 86400 + 30 if i % 4 == 0 else rnd.randrange(0, 12 * 86400)
            lat, lon, net = 10.1, 20.1, "hot"
        else:
            sec = rnd.randrange(0, 12 * 86400)
            lat, lon = rnd.choice([(-3.2, 7.7), (0.4, 0.4), (45.0, -120.3)])
            net = rnd.choice(["a", "b", None])
        mag = None if i % 17 == 0 else round(rnd.uniform(0, 7), 2)
        depth = None if i % 13 == 0 else float(rnd.randrange(0, 700))
        rows.append((i, base + dt.timedelta(seconds=sec, microseconds=i % 1000), mag, depth, lat, lon, net))
    df = spark.createDataFrame(
        rows, "event_id long, event_time timestamp_ntz, magnitude double, depth_km double, "
              "latitude double, longitude double, network string").repartition(5)
    b = {r.event_id: r for r in build_features(df, 2, 0.5, 1, 4.0, "block").collect()}
    d = {r.event_id: r for r in build_features(df, 2, 0.5, 1, 4.0, "direct").collect()}
    assert b.keys() == d.keys() and len(b) == 3000
    for k in d:
        for c in COLS:
            x, y = b[k][c], d[k][c]
            if x is None or y is None:
                assert x is None and y is None, (k, c)
            else:
                assert x == pytest.approx(y, rel=1e-9, abs=1e-9), (k, c)


def test_lookahead_and_trailing_equal_brute_force_self_join(spark, cat):
    """W9 (max magnitude in (s, s+H]) and W6 (count in [s-D, s]) against a
    range self-join inside each cell on the small fixture."""
    D, H = 7 * 86400, 7 * 86400
    f = build_features(cat, 7, 0.5, 7, 3.0).select("event_id", "lat_grid", "lon_grid", "event_s",
                                                  "future_max_mag", "event_count_30d")
    a = f.alias("a")
    b = f.select("lat_grid", "lon_grid", "event_s", "event_id", F.col("event_id").alias("b_id")).join(
        cat.select("event_id", "magnitude"), "event_id").alias("b")
    same_cell = (F.col("a.lat_grid") == F.col("b.lat_grid")) & (F.col("a.lon_grid") == F.col("b.lon_grid"))
    ahead = same_cell & (F.col("b.event_s") > F.col("a.event_s")) & (F.col("b.event_s") <= F.col("a.event_s") + H)
    behind = same_cell & (F.col("b.event_s") >= F.col("a.event_s") - D) & (F.col("b.event_s") <= F.col("a.event_s"))
    fut = a.join(b, ahead, "left").groupBy("a.event_id").agg(F.max("b.magnitude").alias("m"))
    cnt = a.join(b, behind, "left").groupBy("a.event_id").agg(F.count("b.b_id").alias("n"))
    got = {r.event_id: (r.future_max_mag, r.event_count_30d) for r in f.collect()}
    want_m = {r.event_id: r.m for r in fut.collect()}
    want_n = {r.event_id: r.n for r in cnt.collect()}
    assert len(got) == 898
    for k, (m, n) in got.items():
        assert m == want_m[k], k
        assert n == want_n[k], k


def test_feature_plan_reads_raw_rows_once_after_grouping(spark):
    """The per-(cell, network, second) table is written while the plan is
    built; the returned plan then reads the raw table once (to attach the
    results) and takes everything else from that table."""
    raw = events_catalogue(spark, SF001)  # unfiltered: not the plan another test caches
    plan = build_features(raw, 7, 0.5, 7, 3.0)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len([line for line in scans if "events.parquet" in line]) == 1, plan
    assert any("per-second-keys" in line for line in scans)


def test_density_counts_events_without_time(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(i, None if i < 2 else t + dt.timedelta(hours=i), 1.0, 5.0, 10.0, 20.0, "n") for i in range(5)]
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, magnitude double, depth_km double, "
                                     "latitude double, longitude double, network string")
    for method in ("block", "direct"):
        got = {r.event_id: r.spatial_density for r in build_features(df, 2, 0.5, 1, 4.0, method).collect()}
        assert got == dict.fromkeys(range(5), 5), method


def test_repeated_events_give_one_gap(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(i, t + dt.timedelta(seconds=s), 1.0, 5.0, lat, 20.0, "n")
            for i, s, lat in [(1, 0, 1.0), (2, 50, 1.0), (2, 50, 1.0), (2, 50, 30.0), (3, 90, 1.0)]]
    df = spark.createDataFrame(rows, "event_id long, event_time timestamp_ntz, magnitude double, depth_km double, "
                                     "latitude double, longitude double, network string")
    got = sorted((r.event_id, -1 if r.time_since_prev_event is None else r.time_since_prev_event)
                 for r in build_features(df, 2, 0.5, 1, 4.0).collect())
    assert got == [(1, -1), (2, 0), (2, 0), (2, 50), (3, 40)]


def test_only_what_is_asked_for_is_built(spark, cat):
    """A subset gives the same values with fewer exchanges and windows."""
    whole = build_features(cat, 7, 0.5, 7, 3.0)
    some = build_features(cat, 7, 0.5, None, only={"mag_max_30d"})
    assert "time_since_prev_event" not in some.columns and "mag_std_30d" not in some.columns
    assert sorted(some.select("event_id", "mag_max_30d").collect()) == sorted(whole.select("event_id", "mag_max_30d").collect())

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(some) <= 8 < exchanges(whole) <= 12
    assert build_features(cat, 7, 0.5, None, only=set()).count() == cat.count()
    with pytest.raises(ValueError):
        build_features(cat, 7, 0.5, None, only={"mag_max"})


def test_feature_tasks_grow_with_the_seconds(spark, monkeypatch):
    """Frames and gaps are dealt to a number of tasks that follows the distinct
    (cell, network, second) rows, and more tasks change nothing."""
    from quakeframe.operators import range_window

    rows = [(i, f"2024-01-{1 + i % 9:02d} 00:{i % 60:02d}:00", (i % 40) / 8.0, float(i % 7), (i % 3) / 2.0, (i % 2) / 2.0, "ab"[i % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id bigint, t string, magnitude double, depth_km double, latitude double, longitude double, network string")
    df = df.withColumn("event_time", F.to_timestamp("t")).drop("t")
    want = features.build_features(df, 3, label_days=2, method="direct")
    monkeypatch.setattr(range_window, "SECONDS_PER_TASK", 10)
    seconds = want.select("lat_grid", "lon_grid", "network", "event_s").distinct().count()
    got = features.build_features(df, 3, label_days=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    by_number = [int(n) for n in re.findall(r"hashpartitioning\([^\n]*__b#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)]
    assert seconds > 50 and by_number and set(by_number) == {-(-seconds // 10)}
    assert "__b#" not in "".join(re.findall(r"hashpartitioning\([^\n]*ENSURE_REQUIREMENTS", plan))
    names = ["event_id", "time_since_prev_event", "spatial_density", "has_aftershock", "aftershock_magnitude", *[a.name for a in features.TRAILING]]
    a, b = ({r.event_id: r for r in x.select(*names).collect()} for x in (got, want))
    assert a.keys() == b.keys()
    for i in a:
        for name, x, y in zip(names, a[i], b[i]):
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-9, abs=1e-9), (i, name, x, y)


def test_join_tasks_grow_with_the_rows(spark, monkeypatch):
    """Events meet their results in a number of tasks that follows their count, also
    where many share a second, in one exchange and one sort of the wide rows."""
    rows = [(i, f"2024-01-0{1 + i % 5} 00:00:0{i % 2}", (i % 40) / 8.0, float(i % 7), (i % 3) / 2.0, (i % 2) / 2.0, "ab"[i % 2]) for i in range(500)]
    rows += [(500, None, 1.0, 1.0, 0.0, 0.0, "a"), (501, None, 1.0, 1.0, 0.0, 0.0, None), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "event_id bigint, t string, magnitude double, depth_km double, latitude double, longitude double, network string")
    df = df.withColumn("event_time", F.to_timestamp("t")).drop("t")
    want = features.build_features(df, 3, label_days=2, method="direct")
    monkeypatch.setattr(features, "ROWS_PER_TASK", 9)
    got = features.build_features(df, 3, label_days=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange" in x]
    assert sum(f", {-(-len(rows) // 9)})" in x for x in exchanges) == 2
    names = ["event_id", "spatial_density", "has_aftershock", "aftershock_magnitude", *[a.name for a in features.TRAILING], "time_since_prev_event"]
    # Of the three equal events any may be the first of its second.
    a, b = (sorted(x.select(*names).collect(), key=lambda r: (r.event_id, r.time_since_prev_event or 0)) for x in (got, want))
    assert len(a) == len(b) == len(rows)
    for x, y in zip(a, b):
        for name in names:
            assert (x[name] is None and y[name] is None) or x[name] == pytest.approx(y[name], rel=1e-9, abs=1e-9), (x.event_id, name, x[name], y[name])
