"""Registered queries over the driver's tables, and their DuckDB equivalents.

Each query reads ``events`` (mapped to catalogue columns by
``sources.fixtures``) in full and runs a library function on it. Parameters are
fixed per query: trailing window 7 days, look-ahead 7 days, threshold 3.0,
cell 0.5 degrees, split at 2024-01-20, ``as_of`` 2024-01-31, 7 days back
(scoring loads 10 days of history before that; what lies further back comes from
counts over the whole catalogue). Models are trained with the library's defaults
(``predict_flow`` and ``score_events`` train one of the three types); their queries return what the input determines (sizes, rows scored, probabilities
in range, tiers that agree, equality after a reload), not fitted numbers.

Output conventions that keep both engines comparable: timestamps that the
library holds as TIMESTAMP are reported as epoch seconds (no time-zone
dependence); energies (10^x, whose last bit depends on the pow implementation)
are reported as log10 rounded to 6 decimals; metrics computed by different
algorithms (MLlib versus SQL) are rounded to 9 decimals. Everything else is
exact: the mapped data is binary-exact, so sums and means are bit-identical in both
engines; standard deviations are rounded to 9 decimals.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeframe.operators import dataset, features, models, scoring, summary
from quakeframe.operators.features import quality_filter
from quakeframe.plans import feature_store, flows
from quakeframe.schema import CATALOGUE, LABEL, PREDICTORS, TRAIN_COLUMNS
from quakeframe.session import folder_exists, materialize, scratch_dir
from quakeframe.sources import catalogue as cat_io
from quakeframe.sources import geojson, serving_state
from quakeframe.sources import request_windows as rw
from quakeframe.sources.fixtures import events_catalogue

# Query parameters.
WINDOW_DAYS = 7
LABEL_DAYS = 7
THRESHOLD = 3.0
CELL_DEGREES = 0.5
SPLIT_AT = "2024-01-20"
AS_OF = "2024-01-31"
DAYS_BACK = 7
HISTORY_DAYS = 10  # history loaded before the recent period when scoring
STATE_APPEND = "2024-01-16"  # events from here on are appended to a kept catalogue
DOCUMENT_EVENTS = 500  # events in a landed document
WINDOW_START, WINDOW_END, CHUNK_DAYS = "2024-01-01", "2024-01-28", 7
W_S = WINDOW_DAYS * 86400
L_S = LABEL_DAYS * 86400


def _cat(spark, sf):
    return events_catalogue(spark, sf)


def _log10r(c: str):
    return F.when(F.col(c) > 0, F.round(F.log10(F.col(c)), 6))


def _train_feats(spark, sf):
    return features.training_features(_cat(spark, sf), WINDOW_DAYS, LABEL_DAYS, THRESHOLD, CELL_DEGREES)


def _report_train(df: DataFrame) -> DataFrame:
    out = []
    for c in TRAIN_COLUMNS:
        if c in ("energy_release", "cumulative_energy_30d"):
            out.append(_log10r(c).alias("log10_" + c))
        elif c == "mag_std_30d":
            out.append(F.round(c, 9).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ---------------------------------------------------------------- sources

def q_geojson_flatten(spark, sf):
    text = geojson.events_as_geojson(_cat(spark, sf))
    flat = geojson.flatten(text.select(geojson.parse_features("json").alias("feature")))
    return flat.select(
        *[c for c in flat.columns if c not in ("event_time", "updated_time")],
        F.unix_seconds("event_time").alias("event_s"),
        F.unix_seconds("updated_time").alias("updated_s"),
    )


def q_request_windows(spark, sf):
    windows = rw.request_windows(spark, WINDOW_START, WINDOW_END, CHUNK_DAYS)
    return rw.events_per_window(_cat(spark, sf), windows, WINDOW_START, WINDOW_END, CHUNK_DAYS)


def _landed(spark, sf) -> str:
    """Line-delimited feature files of all events."""
    path = scratch_dir(spark, "landing")
    geojson.write_geojson_lines(geojson.events_as_geojson(_cat(spark, sf)), path)
    return path


def _extracted(spark, sf):
    path = scratch_dir(spark, "catalogue")
    return path, flows.extract(spark, _landed(spark, sf), path, WINDOW_START, WINDOW_END, CHUNK_DAYS, line_delimited=True)


def _landed_catalogue(spark, sf) -> str:
    return _extracted(spark, sf)[0]


def q_geojson_files(spark, sf):
    """Documents of DOCUMENT_EVENTS events each, one document without features and
    one cut off in the middle, scanned together."""
    path = scratch_dir(spark, "documents")
    text = geojson.events_as_geojson(_cat(spark, sf))
    number = F.floor(F.get_json_object("json", "$.id").cast("long") / DOCUMENT_EVENTS)
    geojson.write_geojson_documents(text, path, number)
    odd = spark.range(2).select(
        F.when(F.col("id") == 0, F.lit('{"type":"FeatureCollection","features":[]}'))
        .otherwise(F.lit('{"type":"FeatureCollection","features":[{"id":"1","prop')).alias("value"),
        (F.col("id") - 2).alias("part"),
    )
    odd.write.mode("append").partitionBy("part").text(path)
    files = f"{path}/part=*"
    flat = geojson.flatten(geojson.read_geojson(spark, files))
    seen = flat.agg(F.count("*").alias("features"), F.countDistinct("event_id").alias("events"), F.max("event_time").isNotNull().cast("int").alias("timed"))
    return geojson.document_counts(spark, files).crossJoin(seen)


def q_extract_flow(spark, sf):
    """What the extract stage reports of its landing folder."""
    _, res = _extracted(spark, sf)
    return res.row_count.crossJoin(res.landed).crossJoin(res.windows.agg(F.sum("n_events").alias("in_windows")))


def q_extract_sample(spark, sf):
    _, res = _extracted(spark, sf)
    return res.sample.select("event_id", "magnitude", "latitude", "longitude", "network")


def q_summary_sketch(spark, sf):
    """The default summary, whose quartiles come from sketches: the exact
    statistics, and whether each quartile's rank is as near as the sketch promises."""
    s = summary.summary_stats(_cat(spark, sf), ["magnitude", "depth_km", "significance"])
    values = _cat(spark, sf).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in ("magnitude", "depth_km", "significance")])).alias("r")
    ).select("r.*").where("v IS NOT NULL")
    quart = s.where("statistic LIKE '%\\%'").withColumn("level", F.regexp_extract("statistic", "[0-9]+", 0).cast("double") / 100)
    near = values.join(F.broadcast(quart), "column").groupBy("column", "statistic", "level").agg(
        F.avg((F.col("v") < F.col("value")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("value")).cast("double")).alias("upto")
    )
    ok = (F.col("below") - 0.001 <= F.col("level")) & (F.col("level") <= F.col("upto") + 0.001)
    exact = s.where("statistic NOT LIKE '%\\%'").select("column", "statistic", F.round("value", 9).alias("value"))
    return exact.unionByName(near.select("column", "statistic", F.when(ok, F.lit(1.0)).otherwise(F.lit(0.0)).alias("value")))


_ROUNDTRIP_COLS = ["event_id", "magnitude", "depth_km", "latitude", "longitude", "network",
                   "place", "significance", "num_stations", "gap", "rms", "year", "month", "day"]


def q_catalogue_roundtrip(spark, sf):
    df = quality_filter(cat_io.read_catalogue(spark, _landed_catalogue(spark, sf)))
    return df.select(*_ROUNDTRIP_COLS, F.unix_seconds("event_time").alias("event_s"))


def q_recent_events(spark, sf):
    df = cat_io.recent_events(spark, _landed_catalogue(spark, sf), AS_OF, DAYS_BACK)
    return df.select(*_ROUNDTRIP_COLS, F.unix_seconds("event_time").alias("event_s"))


# --------------------------------------------------------------- features

def q_temporal_features(spark, sf):
    df = features.temporal_features(quality_filter(_cat(spark, sf)))
    return df.select("event_id", "network", "hour", "day_of_week", "day_of_year", "time_since_prev_event")


def q_spatial_density(spark, sf):
    f = features.spatial_density(quality_filter(_cat(spark, sf)), CELL_DEGREES)
    return f.select("event_id", "lat_grid", "lon_grid", "spatial_density")


def q_rolling_stats(spark, sf):
    only = {"mag_mean_30d", "mag_max_30d", "mag_std_30d", "event_count_30d", "depth_mean_30d"}
    f = features.build_features(quality_filter(_cat(spark, sf)), WINDOW_DAYS, CELL_DEGREES, None, only=only)
    return f.select(
        "event_id",
        F.col("mag_mean_30d").alias("mag_mean_7d"),
        F.col("mag_max_30d").alias("mag_max_7d"),
        F.round("mag_std_30d", 9).alias("mag_std_7d"),
        F.col("event_count_30d").alias("event_count_7d"),
        F.col("depth_mean_30d").alias("depth_mean_7d"),
    )


def q_energy_windows(spark, sf):
    f = features.build_features(quality_filter(_cat(spark, sf)), WINDOW_DAYS, CELL_DEGREES, None, only={"cumulative_energy_30d"})
    return f.select(
        "event_id",
        _log10r("energy_release").alias("log10_energy_release"),
        _log10r("cumulative_energy_30d").alias("log10_cumulative_energy_7d"),
    )


def q_aftershock_labels(spark, sf):
    f = features.build_features(quality_filter(_cat(spark, sf)), WINDOW_DAYS, CELL_DEGREES, LABEL_DAYS, THRESHOLD, only=set())
    return f.select("event_id", "future_max_mag", "has_aftershock", "aftershock_magnitude")


def q_training_features(spark, sf):
    path = scratch_dir(spark, "features")
    cat_io.write_features(_train_feats(spark, sf), path)
    return _report_train(spark.read.parquet(path))


def q_serving_features(spark, sf):
    f = features.serving_features(_cat(spark, sf), WINDOW_DAYS, CELL_DEGREES)
    out = []
    for c in f.columns:
        if c in ("energy_release", "cumulative_energy_30d"):
            out.append(_log10r(c).alias("log10_" + c))
        elif c == "mag_std_30d":
            out.append(F.round(c, 9).alias(c))
        else:
            out.append(F.col(c))
    return f.select(*out)


def q_sample_features(spark, sf):
    return _report_train(_train_feats(spark, sf)).orderBy("event_id").limit(5)


# ------------------------------------------------------------- aggregates

def q_summary_stats(spark, sf):
    s = summary.summary_stats(_cat(spark, sf), ["magnitude", "depth_km", "significance"], exact=True)
    return s.select("column", "statistic", F.round("value", 9).alias("value"))


def q_class_distribution(spark, sf):
    return dataset.class_distribution(_train_feats(spark, sf))


def q_label_prevalence(spark, sf):
    return dataset.label_prevalence(_train_feats(spark, sf))


def q_label_complete(spark, sf):
    df = dataset.with_label_complete(quality_filter(_cat(spark, sf)), LABEL_DAYS)
    return df.select("event_id", "label_complete")


def q_split_sizes(spark, sf):
    # Features neither add nor drop events, so the sizes need none of them.
    return dataset.split_sizes(quality_filter(_cat(spark, sf)), SPLIT_AT)


def q_vector_skip_count(spark, sf):
    return scoring.vector_skip_count(_train_feats(spark, sf))


def q_standardised(spark, sf):
    train, _ = dataset.temporal_split(_train_feats(spark, sf), SPLIT_AT)
    train = materialize(train, "standardised")  # fit and transform both read it
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=PREDICTORS, outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ])
    out = pipe.fit(train).transform(train)
    arr = vector_to_array("features")
    return out.select("event_id", *[F.round(arr.getItem(i), 6).alias(f"z_{c}") for i, c in enumerate(PREDICTORS)])


def _eval_input(spark, sf):
    f = _train_feats(spark, sf)
    return f.select(
        F.col(LABEL).cast("double").alias(LABEL),
        F.col("mag_max_30d").cast("double").alias("rawPrediction"),
        F.when(F.col("mag_max_30d") >= 4.0, 1.0).otherwise(0.0).alias("prediction"),
    )


def q_eval_binary(spark, sf):
    m = models.evaluate(_eval_input(spark, sf))
    return spark.createDataFrame([(round(m["auc_roc"], 9), round(m["auc_pr"], 9))], "auc_roc double, auc_pr double")


def q_eval_multiclass(spark, sf):
    m = models.evaluate(_eval_input(spark, sf))
    vals = tuple(round(m[k], 9) for k in ("accuracy", "f1", "precision", "recall"))
    return spark.createDataFrame([vals], "accuracy double, f1 double, precision double, recall double")


# ---------------------------------------------------------------- scoring

def _scored(spark, sf):
    """Catalogue rows with a deterministic probability vector [1-p, p],
    p = magnitude / (magnitude + 2)."""
    c = _cat(spark, sf)
    p = F.col("magnitude") / (F.col("magnitude") + F.lit(2.0))
    vec = F.when(p.isNotNull(), array_to_vector(F.array(F.lit(1.0) - p, p)))
    return scoring.with_risk(c.withColumn("probability", vec))


def q_risk_tiers(spark, sf):
    return _scored(spark, sf).select("event_id", "aftershock_probability", "risk_level")


def q_risk_report(spark, sf):
    return scoring.risk_report(_scored(spark, sf))


def q_top_risk(spark, sf):
    return scoring.top_risk(_scored(spark, sf), 20).select(
        "event_id", "event_time", "magnitude", "depth_km", "latitude", "longitude", "place",
        "aftershock_probability", "risk_level")


def _scenarios(spark, sf):
    """One hypothetical event per grid cell: the cell's largest magnitude at its
    mean depth and centre; the cell mean magnitude and count as context,
    given as 0 (= not given) for cells with an odd lat index."""
    c = quality_filter(_cat(spark, sf))
    lat_g = F.floor(F.col("latitude") / CELL_DEGREES)
    lon_g = F.floor(F.col("longitude") / CELL_DEGREES)
    g = c.groupBy(lat_g.alias("lat_grid"), lon_g.alias("lon_grid")).agg(
        F.max("magnitude").alias("magnitude"),
        F.avg("depth_km").alias("depth_km"),
        F.avg("magnitude").alias("mean_mag"),
        F.count(F.lit(1)).alias("n"),
    )
    odd = (F.col("lat_grid") % 2) != 0
    return g.select(
        "lat_grid", "lon_grid", "magnitude", "depth_km",
        ((F.col("lat_grid") + 0.5) * CELL_DEGREES).alias("latitude"),
        ((F.col("lon_grid") + 0.5) * CELL_DEGREES).alias("longitude"),
        F.when(odd, F.lit(0.0)).otherwise(F.col("mean_mag")).alias("recent_magnitude_mean"),
        F.when(odd, F.lit(0)).otherwise(F.col("n").cast("int")).alias("recent_event_count"),
    )


def q_scenario_features(spark, sf):
    s = scoring.scenario_features(_scenarios(spark, sf))
    out = []
    for col in s.columns:
        if col in ("energy_release", "cumulative_energy_30d"):
            out.append(_log10r(col).alias("log10_" + col))
        else:
            out.append(F.col(col))
    return s.select(*out)


# ---------------------------------------------------------------- training

def _split(spark, sf):
    path = scratch_dir(spark, "features")
    cat_io.write_features(_train_feats(spark, sf), path)  # lineage cut: a written table
    return dataset.temporal_split(spark.read.parquet(path), SPLIT_AT)


def _scored_report(model, rows, key: str) -> list:
    """Aggregates of scored rows that don't depend on the fitted numbers."""
    scored = scoring.with_risk(model.transform(rows))
    p, tier = F.col("aftershock_probability"), F.col("risk_level")
    agrees = ((p >= 0.7) & (tier == "HIGH")) | ((p >= 0.4) & (p < 0.7) & (tier == "MEDIUM")) | ((p < 0.4) & (tier == "LOW"))
    return scored.select(key, p.alias("p"), p.between(0.0, 1.0).alias("in_range"), agrees.alias("agrees"))


def _train_one(spark, sf, model_type):
    """Train with the defaults, save, load; the record's sizes and checks over
    all test rows."""
    train, test = _split(spark, sf)
    model, rec = models.train_and_evaluate(train, test, model_type)
    path = scratch_dir(spark, "model")
    models.save_model(model, path)
    again = _scored_report(models.load_model(path), test, "event_id").select("event_id", F.col("p").alias("again"))
    counts = _scored_report(model, test, "event_id").join(again, "event_id").agg(
        F.count("*").alias("rows_scored"),
        F.count_if("in_range").alias("in_range"),
        F.count_if("agrees").alias("tiers_agree"),
        F.count_if(F.col("p") == F.col("again")).alias("same_after_reload"),
    )
    record = models.run_records(spark, [rec])
    metrics = F.lit(True)
    for m in models.METRIC_NAMES:
        metrics = metrics & F.col(m).between(0.0, 1.0)
    return record.select("model_type", "num_features", "train_size", "test_size", metrics.alias("metrics_in_range")).crossJoin(counts)


def q_train_random_forest(spark, sf):
    return _train_one(spark, sf, "random_forest")


def q_train_gbt(spark, sf):
    return _train_one(spark, sf, "gbt")


def q_train_logreg(spark, sf):
    return _train_one(spark, sf, "logistic_regression")


def q_select_model(spark, sf):
    """All three models; the selected one has no better rival, and is one."""
    train, test = _split(spark, sf)
    _, runs = models.train_models(train, test)
    best = runs.agg(F.max("auc_roc").alias("best"), F.count_if("selected").alias("n_selected"))
    runs = runs.crossJoin(best)
    fair = ~F.col("selected") | (F.col("auc_roc") == F.col("best"))
    return runs.select("model_type", "position", "num_features", "train_size", "test_size", "n_selected", fair.alias("fair"))


def q_select_from_metrics(spark, sf):
    """The selection rule on a metrics table made of the events: one run per
    network and day of the month, its score the share of large events."""
    c = quality_filter(_cat(spark, sf)).where("event_time IS NOT NULL")
    runs = c.groupBy("network", F.dayofmonth("event_time").alias("day")).agg(F.round(F.avg((F.col("magnitude") >= 4).cast("double")), 2).alias("auc_roc"))
    runs = runs.select("network", "day", "auc_roc", (F.col("day") * 100 + F.length("network")).cast("int").alias("position"))
    return models.select_best(runs)


def _train_flow(spark, sf, model_types=models.MODEL_TYPES):
    cat = _landed_catalogue(spark, sf)
    table, model, log = (scratch_dir(spark, n) for n in ("features", "model", "runlog"))
    prevalence = flows.build_feature_table(spark, cat, table, WINDOW_DAYS, LABEL_DAYS, THRESHOLD, CELL_DEGREES)
    res = flows.train(spark, table, model, log, SPLIT_AT, model_types)
    return cat, model, log, prevalence, res


def q_train_flow(spark, sf):
    """The features and train stages over the extracted catalogue."""
    _, _, log, prevalence, res = _train_flow(spark, sf)
    logged = spark.read.parquet(log).agg(F.count("*").alias("logged"))
    return prevalence.select("total_events", "aftershock_events").crossJoin(res.split_sizes).crossJoin(res.skipped).crossJoin(logged)


def q_scored_sample(spark, sf):
    """The train stage's sample: the first ten test rows as the best model scores them."""
    table = scratch_dir(spark, "features")
    cat_io.write_features(_train_feats(spark, sf), table)
    sample = flows.train(spark, table, scratch_dir(spark, "model"), None, SPLIT_AT).sample
    sound = F.col("aftershock_probability").between(0.0, 1.0) & (F.col("prediction") == (F.col("aftershock_probability") > 0.5).cast("double"))
    return sample.select("event_id", LABEL, sound.alias("sound"))


class _Stopped(Exception):
    pass


def q_full_run(spark, sf):
    """The full run, stopped before its last stage and begun again: what each stage
    committed, and that the first three ran once."""
    run, landing = scratch_dir(spark, "run"), _landed(spark, sf)
    settings = dict(
        landing=landing, start=WINDOW_START, end=WINDOW_END, as_of=AS_OF, chunk_days=CHUNK_DAYS, line_delimited=True, window_days=WINDOW_DAYS,
        label_days=LABEL_DAYS, threshold=THRESHOLD, cell_degrees=CELL_DEGREES, split_at=SPLIT_AT, days_back=DAYS_BACK, history_days=HISTORY_DAYS,
    )

    def stop(stage):
        if stage == "predict":
            raise _Stopped

    try:
        flows.resumable_run(spark, run, before_stage=stop, **settings)
    except _Stopped:
        pass
    begun = spark.read.parquet(f"{run}/manifest").select("stage", F.col("path").alias("first_path"))
    committed = begun.agg(F.count("*").alias("committed_first"), F.max(F.lit(1)).alias("one")).drop("one")
    at = flows.resumable_run(spark, run, **settings)
    again = spark.read.parquet(f"{run}/manifest").join(begun, "stage", "left").agg(
        F.count("*").alias("committed"), F.count_if(F.col("path") == F.col("first_path")).alias("kept")
    )
    p = F.col("aftershock_probability")
    parts = [
        committed,
        again,
        spark.read.parquet(at["catalogue"]).agg(F.count("*").alias("catalogue_rows")),
        spark.read.parquet(at["features"]).agg(F.count("*").alias("feature_rows"), F.sum(LABEL).alias("positives")),
        spark.read.parquet(at["runs"]).agg(F.count("*").alias("runs")),
        spark.read.parquet(at["predictions"]).agg(F.count("*").alias("predictions"), F.count_if(p.between(0, 1)).alias("in_range")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(part)  # one row each
    return out


def q_empty_guard(spark, sf):
    """Both sinks given rows and then none: the second write is refused, and what
    the first wrote stays; at a new path nothing is created."""
    flat = geojson.flatten(geojson.read_geojson_lines(spark, _landed(spark, sf)))
    nothing = flat.where(F.col("magnitude") < -1000)
    cat, new = scratch_dir(spark, "catalogue"), scratch_dir(spark, "catalogue")
    first = cat_io.write_catalogue(flat, cat)
    refused = [cat_io.write_catalogue(nothing, cat, mode) for mode in ("overwrite", "append")] + [cat_io.write_catalogue(nothing, new)]
    scored = _scored(spark, sf).select("*", F.lit(0.0).alias("prediction"))
    out = scratch_dir(spark, "predictions")
    predicted = cat_io.write_predictions(scored, out)
    refused.append(cat_io.write_predictions(scored.where("magnitude < -1000"), out))
    kept = cat_io.read_catalogue(spark, cat).agg(F.count("*").alias("rows_kept"), F.countDistinct("year", "month").alias("months_kept"))
    told = spark.createDataFrame(
        [(first.rows, len([m for m in first.months if m[0]]), sum(map(bool, refused)), predicted, folder_exists(spark, new))],
        "rows_written long, months_written long, empty_writes long, predicted boolean, created boolean",
    )
    return told.crossJoin(kept).crossJoin(spark.read.parquet(out).agg(F.count("*").alias("predictions_kept")))


def _state(spark, sf) -> str:
    """A catalogue that grew by an append, its state kept up with each write."""
    flat = geojson.flatten(geojson.read_geojson_lines(spark, _landed(spark, sf)))
    cat = scratch_dir(spark, "catalogue")
    late = F.col("event_time") >= F.lit(STATE_APPEND).cast("timestamp")
    for part, mode in ((flat.where(~F.coalesce(late, F.lit(False))), "overwrite"), (flat.where(late), "append")):
        written = cat_io.write_catalogue(part, cat, mode)
        serving_state.maintain(spark, cat, written.months if mode == "append" else None, CELL_DEGREES)
    return cat


def q_state_cells(spark, sf):
    """Events per cell from the state beside an appended catalogue."""
    return serving_state.context(spark, _state(spark, sf), cat_io.recent_cutoff(AS_OF, DAYS_BACK), CELL_DEGREES)[0]


def q_state_networks(spark, sf):
    """Last second of each network before the recent period, from that state."""
    return serving_state.context(spark, _state(spark, sf), cat_io.recent_cutoff(AS_OF, DAYS_BACK), CELL_DEGREES)[1]


def q_feature_append(spark, sf):
    """The training table of a store that was built on a part of the catalogue and
    brought up to it after an append."""
    events = _cat(spark, sf)
    # What the events don't have is null; the partition is the month of the time.
    known = {c: F.col(c) for c in events.columns} | {"year": F.year("event_time"), "month": F.month("event_time")}
    flat = events.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CATALOGUE.fields])
    cat, store = scratch_dir(spark, "catalogue"), scratch_dir(spark, "features")
    late = F.col("event_time") >= F.lit(STATE_APPEND).cast("timestamp")
    for part, mode in ((flat.where(~F.coalesce(late, F.lit(False))), "overwrite"), (flat.where(late), "append")):
        written = cat_io.write_catalogue(part, cat, mode)
        feature_store.maintain(spark, cat, store, written.months, WINDOW_DAYS, LABEL_DAYS, THRESHOLD, CELL_DEGREES)
    table = feature_store.read_features(spark, store)
    return _report_train(table.withColumn("event_id", F.col("event_id").cast(events.schema["event_id"].dataType)))


def q_predict_flow(spark, sf):
    """The predict stage up to its sink: report totals of the written predictions,
    and what the vector step skipped."""
    cat, model, *_ = _train_flow(spark, sf, ["logistic_regression"])
    out = scratch_dir(spark, "predictions")
    res = flows.predict(spark, cat, model, out, AS_OF, DAYS_BACK, HISTORY_DAYS, WINDOW_DAYS, 20, CELL_DEGREES)
    written = spark.read.parquet(out).agg(F.count("*").alias("written"), F.count_if(F.col("aftershock_probability").between(0, 1)).alias("in_range"))
    return res.skipped.crossJoin(written).crossJoin(res.report.select("total_events", (F.col("high_risk") + F.col("medium_risk") + F.col("low_risk")).alias("in_tiers")))


def q_score_events(spark, sf):
    """The rows of the predict stage's sink; every probability in range and every
    tier the probability's."""
    cat, model, *_ = _train_flow(spark, sf, ["logistic_regression"])
    out = scratch_dir(spark, "predictions")
    flows.predict(spark, cat, model, out, AS_OF, DAYS_BACK, HISTORY_DAYS, WINDOW_DAYS, 20, CELL_DEGREES)
    d = spark.read.parquet(out)
    p, tier = F.col("aftershock_probability"), F.col("risk_level")
    agrees = F.when(p >= 0.7, tier == "HIGH").when(p >= 0.4, tier == "MEDIUM").otherwise(tier == "LOW")
    return d.select("event_id", F.unix_seconds("event_time").alias("event_s"), "magnitude", "depth_km", "latitude", "longitude", "place",
                    (p.between(0.0, 1.0) & agrees & F.col("prediction").isin(0.0, 1.0)).alias("sound"))


def q_serving_context(spark, sf):
    """Serving features of the recent period from a catalogue that begins HISTORY_DAYS
    before it: what reaches back further must be as over the whole catalogue."""
    c = _cat(spark, sf)
    recent_from = cat_io.recent_cutoff(AS_OF, DAYS_BACK)
    begins = cat_io.recent_cutoff(recent_from, HISTORY_DAYS)
    counts, before = features.history_context(c, begins, CELL_DEGREES)
    history = cat_io.recent_filter(c, recent_from, HISTORY_DAYS)
    f = features.serving_features(history, WINDOW_DAYS, CELL_DEGREES, cell_counts=counts, last_before=before)
    return cat_io.recent_filter(f, AS_OF, DAYS_BACK).select("event_id", "spatial_density", "time_since_prev_event", "event_count_30d", "mag_max_30d")


def q_score_scenarios(spark, sf):
    train, test = _split(spark, sf)
    model, _ = models.train_and_evaluate(train, test, "logistic_regression")
    s = scoring.scenario_features(_scenarios(spark, sf))
    scored = _scored_report(model, s, "lat_grid")
    return scored.groupBy("lat_grid").agg(F.count("*").alias("cells"), F.count_if("in_range").alias("in_range"), F.count_if("agrees").alias("agree"))


def q_run_log(spark, sf):
    """Two appends to one run log, read back."""
    train, test = _split(spark, sf)
    _, rec = models.train_and_evaluate(train, test, "logistic_regression")
    path = scratch_dir(spark, "runlog")
    for _ in range(2):
        models.append_run_log(models.run_records(spark, [rec]), path)
    log = spark.read.parquet(path)
    return log.groupBy("model_type", "num_features", "train_size", "test_size").agg(
        F.count("*").alias("records"), F.countDistinct("auc_roc").alias("scores"), F.count("run_at").alias("timed")
    )


QUERIES = {
    "geojson_flatten": q_geojson_flatten,
    "request_windows": q_request_windows,
    "catalogue_roundtrip": q_catalogue_roundtrip,
    "recent_events": q_recent_events,
    "geojson_files": q_geojson_files,
    "extract_flow": q_extract_flow,
    "extract_sample": q_extract_sample,
    "summary_sketch": q_summary_sketch,
    "temporal_features": q_temporal_features,
    "spatial_density": q_spatial_density,
    "rolling_stats": q_rolling_stats,
    "energy_windows": q_energy_windows,
    "aftershock_labels": q_aftershock_labels,
    "training_features": q_training_features,
    "serving_features": q_serving_features,
    "sample_features": q_sample_features,
    "summary_stats": q_summary_stats,
    "class_distribution": q_class_distribution,
    "label_prevalence": q_label_prevalence,
    "split_sizes": q_split_sizes,
    "label_complete": q_label_complete,
    "vector_skip_count": q_vector_skip_count,
    "standardised": q_standardised,
    "eval_binary": q_eval_binary,
    "eval_multiclass": q_eval_multiclass,
    "risk_tiers": q_risk_tiers,
    "risk_report": q_risk_report,
    "top_risk": q_top_risk,
    "scenario_features": q_scenario_features,
    "train_random_forest": q_train_random_forest,
    "train_gbt": q_train_gbt,
    "train_logreg": q_train_logreg,
    "select_model": q_select_model,
    "select_from_metrics": q_select_from_metrics,
    "train_flow": q_train_flow,
    "scored_sample": q_scored_sample,
    "full_run": q_full_run,
    "empty_guard": q_empty_guard,
    "state_cells": q_state_cells,
    "state_networks": q_state_networks,
    "feature_append": q_feature_append,
    "predict_flow": q_predict_flow,
    "serving_context": q_serving_context,
    "score_events": q_score_events,
    "score_scenarios": q_score_scenarios,
    "run_log": q_run_log,
}
