import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quakeframe.operators import features
from quakeframe.plans import flows
from quakeframe.schema import CATALOGUE
from quakeframe.sources import catalogue as cat_io
from quakeframe.sources import serving_state
from test_models import SMALL


def events(spark, months, per_month=40, undated=3):
    """Catalogue rows over some months of 2024, and rows without a time."""
    rows = []
    for m in months:
        for i in range(per_month):
            t = dt.datetime(2024, m, 1 + (i * 7) % 28, i % 24, (i * 13) % 60)
            rows.append((f"e{m}-{i}", t, 2.0 + (i * 5 % 17) / 8, float(i % 30), (i % 5) * 0.3, (i % 3) * 0.6, "abc"[i % 3] if i % 11 else None, m))
    rows += [(f"u{months[0]}-{i}", None, 1.0, 1.0, 0.1, 0.1, "a", None) for i in range(undated)]
    df = spark.createDataFrame(rows, "event_id string, event_time timestamp, magnitude double, depth_km double, latitude double, longitude double, network string, month int")
    known = set(df.columns)
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in known
        else (F.when(F.col("month").isNotNull(), 2024).alias("year") if f.name == "year" else F.lit(1 if f.name in ("gap", "rms", "num_stations", "significance") else None).cast(f.dataType).alias(f.name))
        for f in CATALOGUE.fields
    ])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same_context(spark, path, begins):
    got = serving_state.context(spark, path, begins)
    want = features.history_context(cat_io.read_catalogue(spark, path), begins)
    columns = (["lat_grid", "lon_grid", "spatial_density"], ["network", "last_s"])
    return all(rows_of(g.select(c)) == rows_of(w.select(c)) for g, w, c in zip(got, want, columns, strict=True))


@pytest.mark.parametrize("begins", [dt.date(2024, 3, 15), dt.date(2024, 3, 1), dt.date(2024, 1, 1), dt.date(2025, 1, 1)])
def test_state_equals_the_whole_catalogue(spark, scratch, begins):
    path = os.path.join(scratch, "cat")
    cat_io.write_catalogue(events(spark, [1, 2, 3]), path)
    serving_state.maintain(spark, path)
    assert serving_state.has_state(spark, path) and not serving_state.has_state(spark, path, 0.25)
    assert same_context(spark, path, begins)


def test_appends_touch_their_months_only(spark, scratch):
    path = os.path.join(scratch, "cat")
    cat_io.write_catalogue(events(spark, [1, 2]), path)
    serving_state.maintain(spark, path)
    cells = serving_state._cells_path(path, 0.5)
    old = {f: os.path.getmtime(f"{cells}/year=2024/month=1/{f}") for f in os.listdir(f"{cells}/year=2024/month=1")}
    written = cat_io.write_catalogue(events(spark, [2, 3], undated=2).withColumn("event_id", F.concat("event_id", F.lit("x"))), path, "append")
    assert written.rows == 82 and written.months == ((2024, 2), (2024, 3), (None, None))
    for _ in range(2):  # again: the same state
        serving_state.maintain(spark, path, written.months)
        assert same_context(spark, path, dt.date(2024, 3, 10))
    assert old == {f: os.path.getmtime(f"{cells}/year=2024/month=1/{f}") for f in os.listdir(f"{cells}/year=2024/month=1")}
    # An overwrite that loses months: the state loses them too.
    cat_io.write_catalogue(events(spark, [3], undated=0), path)
    serving_state.maintain(spark, path)
    assert same_context(spark, path, dt.date(2024, 4, 1)) and serving_state.read_cells(spark, path).select("month").distinct().count() == 1


def test_predict_reads_recent_months_and_the_state(spark, scratch, monkeypatch):
    path, model, out = (os.path.join(scratch, n) for n in ("cat", "model", "out"))
    cat_io.write_catalogue(events(spark, list(range(1, 9))), path)
    table = os.path.join(scratch, "features")
    flows.build_feature_table(spark, path, table, 30, 7, 3.0)
    flows.train(spark, table, model, None, "2024-06-01", ["logistic_regression"], SMALL)
    whole = flows.predict(spark, path, model, out, "2024-08-25", 7, 10)
    want = rows_of(spark.read.parquet(out))
    assert whole.written and want
    serving_state.maintain(spark, path)
    for m in range(1, 8):  # what lies before the history's month isn't there any more
        month = f"{path}/year=2024/month={m}"
        for f in os.listdir(month):
            os.truncate(f"{month}/{f}", 0)
    monkeypatch.setattr(flows, "history_context", None)
    assert flows.predict(spark, path, model, out, "2024-08-25", 7, 10).written
    assert rows_of(spark.read.parquet(out)) == want


def test_context_plan_prunes(spark, scratch):
    path = os.path.join(scratch, "cat")
    cat_io.write_catalogue(events(spark, [1, 2, 3]), path)
    serving_state.maintain(spark, path)
    counts, before = serving_state.context(spark, path, dt.date(2024, 3, 15))
    assert "cat_state" in counts.inputFiles()[0] and not [f for f in counts.inputFiles() if "/cat/" in f]
    plan = before._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and all("PartitionFilters: [" in s and "PartitionFilters: []" not in s for s in scans)


def test_empty_writes_change_nothing(spark, scratch):
    path, new = os.path.join(scratch, "cat"), os.path.join(scratch, "new")
    df = events(spark, [1, 2])
    assert cat_io.write_catalogue(df, path)
    before = rows_of(cat_io.read_catalogue(spark, path))
    nothing = df.where("magnitude > 100")
    for mode in ("overwrite", "append"):
        assert not cat_io.write_catalogue(nothing, path, mode)
    assert not cat_io.write_catalogue(spark.createDataFrame([], df.schema), new)
    assert rows_of(cat_io.read_catalogue(spark, path)) == before and not os.path.exists(new)
    assert [n for n in os.listdir(scratch) if "writing" in n] == []
    with pytest.raises(ValueError):
        cat_io.write_catalogue(df, path, "ignore")


def test_a_write_evaluates_its_input_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = events(spark, [1, 2, 3])
    assert cat_io.write_catalogue(df.mapInPandas(count, df.schema), os.path.join(scratch, "cat")).rows == df.count() == seen.value


def test_dynamic_overwrite_keeps_other_months(spark, scratch):
    path = os.path.join(scratch, "cat")
    cat_io.write_catalogue(events(spark, [1, 2]), path)
    cat_io.write_catalogue(events(spark, [2, 3], 10, 0), path, dynamic_overwrite=True)
    got = {(r.year, r.month): r["count"] for r in cat_io.read_catalogue(spark, path).groupBy("year", "month").count().collect()}
    assert got == {(2024, 1): 40, (2024, 2): 10, (2024, 3): 10, (None, None): 3}


class Lost(Exception):
    pass


def test_a_run_resumes_at_the_first_uncommitted_stage(spark, scratch, monkeypatch):
    from quakeframe.sources.fixtures import events_catalogue
    from quakeframe.sources.geojson import events_as_geojson, write_geojson_lines

    landing = os.path.join(scratch, "landing")
    write_geojson_lines(events_as_geojson(events_catalogue(spark, "/root/testdata/sf0.01")), landing, mode="overwrite")
    settings = dict(
        landing=landing, start="2024-01-01", end="2024-02-01", as_of="2024-01-31", chunk_days=7, line_delimited=True, window_days=7, label_days=7,
        threshold=3.0, split_at="2024-01-20", params=SMALL, history_days=7, model_types=["logistic_regression"],
    )
    calls = []

    def run(path, fail_in=None):
        real = flows.models.save_model

        def lost(model, where):
            real(model, where)
            raise Lost  # written, but not committed

        with monkeypatch.context() as m:
            if fail_in == "train":
                m.setattr(flows.models, "save_model", lost)
            return flows.resumable_run(spark, os.path.join(scratch, path), before_stage=calls.append, **settings)

    with pytest.raises(Lost):
        run("broken", "train")
    assert calls == ["extract", "features", "train"]
    at = run("broken")
    assert calls[3:] == ["train", "predict"]
    whole = run("whole")
    for name in ("catalogue", "features", "predictions"):
        a, b = spark.read.parquet(at[name]), spark.read.parquet(whole[name])
        assert a.count() == b.count() > 0 and a.select(sorted(b.columns)).exceptAll(b.select(sorted(b.columns))).isEmpty()
    assert spark.read.parquet(at["runs"]).count() == 1
    n = len(calls)
    assert run("whole") == whole and len(calls) == n
    with pytest.raises(ValueError):
        flows.resumable_run(spark, os.path.join(scratch, "whole"), **{**settings, "threshold": 4.0})
    with pytest.raises(ValueError):
        flows.resumable_run(spark, os.path.join(scratch, "whole"), **settings, stages=("train",))
