import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from conftest import SF001
from quakeframe.schema import CATALOGUE
from quakeframe.sources import catalogue as cat_io
from quakeframe.sources.geojson import (
    document_counts,
    events_as_geojson,
    flatten,
    parse_features,
    read_geojson,
    read_geojson_lines,
    write_geojson_lines,
)
from quakeframe.sources.fixtures import events_catalogue
from quakeframe.sources.request_windows import events_per_window, request_windows


def feature(i, mag, time, coords, **props):
    p = {"mag": mag, "time": time, "updated": time, "net": "us", "place": f"p{i}", **props}
    return {"type": "Feature", "id": f"ev{i}", "properties": p, "geometry": {"type": "Point", "coordinates": coords}}


def test_geojson_documents(spark, scratch):
    d = os.path.join(scratch, "land")
    os.makedirs(d)
    docs = {
        "a.json": {"type": "FeatureCollection", "features": [
            feature(1, 5, 1704067201999, [-120, 35, 10]),           # integer mag and depth, ms dropped
            feature(2, 2.5, -1500, [1.5, -2.25]),                   # two-element coords, pre-1970
            feature(3, None, 1704067200000, [0.0, 0.0, 1.0], sig=7),
        ]},
        "b.json": {"type": "FeatureCollection", "features": []},
    }
    for name, doc in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            json.dump(doc, fh, indent=2)
    with open(os.path.join(d, "c.json"), "w") as fh:
        fh.write("{ not json")
    flat = flatten(read_geojson(spark, d))
    assert flat.columns == [f.name for f in CATALOGUE.fields]
    rows = {r.event_id: r for r in flat.collect()}
    assert set(rows) == {"ev1", "ev2", "ev3"}
    r1, r2, r3 = rows["ev1"], rows["ev2"], rows["ev3"]
    assert r1.magnitude == 5.0 and r1.depth_km == 10.0 and r1.longitude == -120.0 and r1.latitude == 35.0
    assert r1.time_ms == 1704067201999
    s = {r.event_id: r.s for r in flat.select("event_id", F.unix_seconds("event_time").alias("s")).collect()}
    assert s["ev1"] == 1704067201 and s["ev2"] == -1  # truncation toward zero
    assert r2.depth_km is None and r2.latitude == -2.25
    assert r3.magnitude is None and r3.significance == 7 and r3.felt is None
    assert r1.year == 2024 and r1.month == 1 and r1.day == 1


def test_geojson_lines_roundtrip(spark, scratch):
    cat = events_catalogue(spark, SF001)
    path = os.path.join(scratch, "lines")
    write_geojson_lines(events_as_geojson(cat), path, mode="overwrite")
    flat = flatten(read_geojson_lines(spark, path))
    assert flat.count() == 1000
    via_text = flatten(events_as_geojson(cat).select(parse_features("json").alias("feature")))
    assert sorted(flat.select("event_id", "magnitude").collect()) == sorted(via_text.select("event_id", "magnitude").collect())


def test_request_windows(spark):
    w = request_windows(spark, "2024-01-01", "2024-03-01", 30).collect()
    assert [(r.window_start.day, r.window_end.month, r.window_end.day) for r in w] == [(1, 1, 31), (31, 3, 1)]
    assert request_windows(spark, "2024-01-01", "2024-01-31", 30).count() == 1  # end on a boundary
    assert request_windows(spark, "2024-02-01", "2024-01-01", 30).count() == 0
    cat = events_catalogue(spark, SF001)
    ew = events_per_window(cat, request_windows(spark, "2023-12-25", "2024-02-05", 7), "2023-12-25", "2024-02-05", 7)
    counts = [r.n_events for r in ew.orderBy("window_index").collect()]
    assert counts[0] == 0 and counts[1] > 0 and sum(counts) == 1000  # empty window shows as 0


def test_partitioned_write_and_pruned_recent_scan(spark, scratch):
    cat = events_catalogue(spark, SF001)
    flat = flatten(events_as_geojson(cat).select(parse_features("json").alias("feature")))
    path = os.path.join(scratch, "catalogue")
    assert cat_io.write_catalogue(flat, path)
    assert sorted(os.listdir(path))[0].startswith("_") or "year=2024" in os.listdir(path)
    back = cat_io.read_catalogue(spark, path)
    assert back.count() == 1000
    recent = cat_io.recent_events(spark, path, "2024-03-15", 7)
    plan = spark._jvm.PythonSQLUtils.explainString(recent._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [((year" in plan and "(month" in plan  # the (year, month) floor reaches the scan
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in plan
    assert recent.count() == 0  # January only: the March partitions do not exist
    r2 = cat_io.recent_events(spark, path, "2024-01-31", 7)
    assert r2.count() == cat.where("event_time >= '2024-01-24'").count()
    assert not cat_io.write_catalogue(flat.limit(0), os.path.join(scratch, "empty"))
    assert not os.path.exists(os.path.join(scratch, "empty"))


def test_clipped_window_counts_no_later_event(spark):
    rows = [(dt.datetime(2024, 1, 30),), (dt.datetime(2024, 2, 2),), (dt.datetime(2024, 2, 4),), (dt.datetime(2024, 1, 1),)]
    ev = spark.createDataFrame(rows, "event_time timestamp_ntz")
    got = events_per_window(ev, request_windows(spark, "2024-01-29", "2024-02-01", 7), "2024-01-29", "2024-02-01", 7)
    assert [r.n_events for r in got.collect()] == [1]


def test_corrupt_documents_and_lines_are_counted(spark, scratch):
    folder = os.path.join(scratch, "docs")
    os.makedirs(folder)
    good = '{"features":[{"id":"a","properties":{"mag":1.5,"sig":3},"geometry":{"coordinates":[1.0,2.0,3.0]}}]}'
    for name, text in (("good", good), ("empty", '{"features":[]}'), ("cut", good[:40]), ("type", good.replace('"sig":3', '"sig":"x"'))):
        with open(os.path.join(folder, name + ".json"), "w") as f:
            f.write(text)
    assert tuple(document_counts(spark, folder).first()) == (4, 2)
    assert read_geojson(spark, folder).where("feature.id = 'a'").count() >= 1
    lines = os.path.join(scratch, "lines.txt")
    with open(lines, "w") as f:
        f.write('{"id":"a"}\n{"id":\n\n{"id":"b"}\n')
    assert tuple(document_counts(spark, lines, line_delimited=True).first()) == (3, 1)


def test_flatten_maps_every_attribute(spark):
    from quakeframe.schema import GEOJSON_FEATURE, PROPERTY_COLUMNS

    props = GEOJSON_FEATURE["properties"].dataType
    values = {f.name: {"double": i + 0.5, "bigint": 10_000 + i, "int": i, "string": f"s{i}"}[f.dataType.simpleString()] for i, f in enumerate(props.fields, 1)}
    row = (("id", tuple(values[f.name] for f in props.fields), ([7.0, 8.0, 9.0],)),)
    df = spark.createDataFrame([row], StructType([StructField("feature", GEOJSON_FEATURE)]))
    got = flatten(df).first().asDict()
    for name, prop in PROPERTY_COLUMNS:
        assert got[name] == values[prop], name
    assert (got["longitude"], got["latitude"], got["depth_km"]) == (7.0, 8.0, 9.0)
