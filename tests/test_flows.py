import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quakeframe.plans import flows
from quakeframe.sources.fixtures import events_catalogue
from quakeframe.sources.geojson import events_as_geojson, write_geojson_lines
from quakeframe.session import materialize, temporary_tables
from quakeframe.streaming.ingest import run_ingest_once

SMALL = {
    "random_forest": {"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 10, "seed": 42},
    "gbt": {"maxIter": 3, "maxDepth": 2, "seed": 42},
    "logistic_regression": {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5},
}


def test_full_run_over_landed_files(spark, scratch):
    cat = events_catalogue(spark, "/root/testdata/sf0.01")
    landing = os.path.join(scratch, "landing")
    write_geojson_lines(events_as_geojson(cat), landing, mode="overwrite")
    out = flows.full_run(
        spark, landing, *[os.path.join(scratch, n) for n in ("catalogue", "features", "model", "runs", "predictions")],
        start="2024-01-01", end="2024-02-01", chunk_days=7, line_delimited=True, window_days=7, label_days=7, threshold=3.0, split_at="2024-01-20",
        params=SMALL, as_of="2024-01-31", days_back=7, history_days=7, top_n=5,
    )
    ex = out["extract"]
    assert ex.written and ex.row_count.first().total_rows == 10000
    assert ex.windows.agg(F.sum("n_events")).first()[0] == 10000
    assert ex.summary.count() == 24
    prev = out["features"].first()
    assert prev.total_events == 8920
    tr = out["train"]
    assert tr.runs.where("selected").count() == 1
    assert tr.split_sizes.first().train_count > 0
    pr = out["predict"]
    assert pr.written
    skipped = pr.skipped.first()
    assert skipped.dropped_rows > 0 and skipped.total_rows - skipped.dropped_rows == pr.report.first().total_events
    assert tuple(ex.landed.first()) == (10000, 0) and ex.sample.count() == 5
    rep = pr.report.first()
    assert rep.high_risk + rep.medium_risk + rep.low_risk == rep.total_events > 0
    top = pr.top.collect()
    assert len(top) == 5
    assert all(top[i].aftershock_probability >= top[i + 1].aftershock_probability for i in range(4))
    sc = flows.score_scenarios(
        spark.createDataFrame([(5.5, 10.0, 0.25, -119.75, 3.2, 45)],
                              "magnitude double, depth_km double, latitude double, longitude double, "
                              "recent_magnitude_mean double, recent_event_count int"),
        os.path.join(scratch, "model"))
    r = sc.first()
    assert r.risk_level in ("HIGH", "MEDIUM", "LOW") and 0.0 <= r.aftershock_probability <= 1.0


def test_predict_on_empty_recent_period(spark, scratch):
    cat = events_catalogue(spark, SF001)
    landing = os.path.join(scratch, "landing")
    write_geojson_lines(events_as_geojson(cat), landing, mode="overwrite")
    flows.extract(spark, landing, os.path.join(scratch, "cat"), "2024-01-01", "2024-02-01", line_delimited=True)
    res = flows.predict(spark, os.path.join(scratch, "cat"), os.path.join(scratch, "nomodel"),
                        os.path.join(scratch, "pred"), "2030-01-01", 7, 0)
    assert not res.written and res.report is None
    assert not os.path.exists(os.path.join(scratch, "pred"))


def test_streaming_ingest_is_incremental(spark, scratch):
    cat = events_catalogue(spark, SF001)
    landing = os.path.join(scratch, "landing")
    out = os.path.join(scratch, "catalogue")
    ck = os.path.join(scratch, "ck")
    first = cat.where("event_id < 500")
    write_geojson_lines(events_as_geojson(first), landing + "/a")
    run_ingest_once(spark, landing + "/*", out, ck)
    assert spark.read.parquet(out).count() == 500
    write_geojson_lines(events_as_geojson(cat.where("event_id >= 500")), landing + "/b")
    run_ingest_once(spark, landing + "/*", out, ck)
    back = spark.read.parquet(out)
    assert back.count() == 1000 and back.select("event_id").distinct().count() == 1000
    run_ingest_once(spark, landing + "/*", out, ck)  # nothing new: no duplicates
    assert spark.read.parquet(out).count() == 1000


def test_full_run_refuses_unknown_arguments(spark, scratch):
    with pytest.raises(TypeError):
        flows.full_run(spark, *["x"] * 6, start="2024-01-01", end="2024-02-01", cell_degree=0.25)
    with pytest.raises(ValueError):
        flows.full_run(spark, *["x"] * 6, start="2024-01-01", end="2024-02-01", stages=("extracts",))


def test_temporary_tables_are_deleted(spark):
    with temporary_tables(spark):
        t = materialize(spark.range(3), "probe")
        path = t.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert os.path.exists(path)
    assert not os.path.exists(path)
