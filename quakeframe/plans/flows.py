"""The four stages and the full run as plain functions over the caller's session.

Stages hand over through written tables (catalogue, feature table, model,
predictions), which also cut lineage: a lost executor recomputes at most one
stage from its input table. Every count reported here is one aggregation over a
written table, not a chain of separate actions.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quakeframe.operators import dataset, models
from quakeframe.operators.features import history_context, serving_features, training_features
from quakeframe.operators.scoring import risk_report, scenario_features, scored_sample, top_risk, vector_skip_count, with_risk
from quakeframe.operators.summary import summary_stats
from quakeframe.schema import PREDICTION_COLUMNS
from quakeframe.session import folder_exists, materialize
from quakeframe.sources import catalogue as cat_io
from quakeframe.sources import serving_state
from quakeframe.sources.geojson import document_counts, flatten, read_geojson, read_geojson_lines
from quakeframe.sources.request_windows import events_per_window, request_windows

DEFAULT_SPLIT = "2024-11-01"


@dataclass
class ExtractResult:
    written: bool
    windows: DataFrame  # request windows with landed events per window
    row_count: DataFrame  # one row: total_rows
    summary: DataFrame  # summary statistics of magnitude, depth_km, significance
    landed: DataFrame  # one row: documents, corrupt (landed documents or lines that don't parse)
    sample: DataFrame  # the first five events by event_id


def extract(spark: SparkSession, landing_path: str, catalogue_path: str, start: str, end: str,
            chunk_days: int = 30, mode: str = "overwrite", line_delimited: bool = False, cell_degrees: float = 0.5) -> ExtractResult:
    """Landed GeoJSON → flat catalogue → Parquet partitioned by year/month, and the
    state beside it that scoring reads (``sources.serving_state``): of the months
    this write touched, or of all after an overwrite."""
    features = read_geojson_lines(spark, landing_path) if line_delimited else read_geojson(spark, landing_path)
    flat = flatten(features)
    written = cat_io.write_catalogue(flat, catalogue_path, mode=mode)
    if not written:
        cat = spark.createDataFrame([], flat.schema)
    else:
        known = mode == "append" and serving_state.has_state(spark, catalogue_path, cell_degrees)
        serving_state.maintain(spark, catalogue_path, written.months if known else None, cell_degrees)
        cat = cat_io.read_catalogue(spark, catalogue_path)
    windows = events_per_window(cat, request_windows(spark, start, end, chunk_days), start, end, chunk_days)
    return ExtractResult(
        bool(written),
        windows,
        cat.selectExpr("count(1) AS total_rows"),
        summary_stats(cat, ["magnitude", "depth_km", "significance"]),
        document_counts(spark, landing_path, line_delimited),
        cat.orderBy("event_id").limit(5),
    )


def build_feature_table(spark: SparkSession, catalogue_path: str, features_path: str, window_days: int = 30,
                        label_days: int = 30, threshold: float = 4.0, cell_degrees: float = 0.5) -> DataFrame:
    """Catalogue → quality filter → features and labels → feature table (written).

    Returns the label prevalence of the written table.
    """
    feats = training_features(cat_io.read_catalogue(spark, catalogue_path), window_days, label_days,
                              threshold, cell_degrees)
    cat_io.write_features(feats, features_path)
    return dataset.label_prevalence(spark.read.parquet(features_path))


@dataclass
class TrainResult:
    sample: DataFrame  # the first test rows by event_id, scored by the winner
    class_distribution: DataFrame
    split_sizes: DataFrame
    skipped: DataFrame
    runs: DataFrame


def train(spark: SparkSession, features_path: str, model_path: str, run_log_path: str | None = None,
          split_at: str = DEFAULT_SPLIT, model_types: list[str] = models.MODEL_TYPES,
          params: dict | None = None, embargo_days: int = 0) -> TrainResult:
    """Feature table → temporal split → each model → run log → best model saved, and
    a sample of test rows as it scores them."""
    table = spark.read.parquet(features_path)
    train_df, test_df = dataset.temporal_split(table, split_at, embargo_days)
    best, runs = models.train_models(train_df, test_df, model_types, params)
    if run_log_path:
        models.append_run_log(runs, run_log_path)
    models.save_model(best, model_path)
    return TrainResult(scored_sample(best, test_df), dataset.class_distribution(table), dataset.split_sizes(table, split_at),
                       vector_skip_count(table), runs)


@dataclass
class PredictResult:
    written: bool
    report: DataFrame | None
    top: DataFrame | None
    skipped: DataFrame | None  # one row: recent events in all, scored, and dropped for a NULL predictor


def predict(spark: SparkSession, catalogue_path: str, model_path: str, output_path: str, as_of,
            days_back: int = 7, history_days: int = 30, window_days: int = 30, top_n: int = 20,
            cell_degrees: float = 0.5) -> PredictResult:
    """Recent events → serving features → model → tiers → predictions (written),
    tier report and top-N from the written table.

    Features are computed over ``history_days`` of extra history before the
    recent period, so trailing windows are complete; ``history_days=0`` gives
    windows truncated at the recent cutoff. The cell counts and the last event
    of each network before the history come from the state beside the catalogue
    (written by ``extract``), so that no month before the history is read; without
    that state they are counted over the whole catalogue. Either way they are
    those of training.
    """
    recent_from = cat_io.recent_cutoff(as_of, days_back)
    history = cat_io.recent_events(spark, catalogue_path, recent_from, history_days)
    if cat_io.recent_filter(history, as_of, days_back).isEmpty():
        return PredictResult(False, None, None, None)
    model = models.load_model(model_path)
    begins = cat_io.recent_cutoff(recent_from, history_days)
    if serving_state.has_state(spark, catalogue_path, cell_degrees):
        counts, before = serving_state.context(spark, catalogue_path, begins, cell_degrees)
    else:
        counts, before = history_context(cat_io.read_catalogue(spark, catalogue_path), begins, cell_degrees)
    feats = serving_features(history, window_days, cell_degrees, cell_counts=counts, last_before=before)
    feats = materialize(cat_io.recent_filter(feats, as_of, days_back), "serving")
    scored = with_risk(model.transform(feats))
    if not cat_io.write_predictions(scored, output_path):
        return PredictResult(False, None, None, None)
    written = spark.read.parquet(output_path)
    return PredictResult(True, risk_report(written), top_risk(written, top_n), vector_skip_count(feats))


def score_scenarios(scenarios: DataFrame, model_path: str) -> DataFrame:
    """Hypothetical events (one per row) → probability, tier and prediction."""
    model = models.load_model(model_path)
    scored = with_risk(model.transform(scenario_features(scenarios)))
    return scored.drop("features_raw", "features", "rawPrediction", "probability")


STAGES = ("extract", "features", "train", "predict")
MANIFEST_SCHEMA = "stage string, path string, settings string"


def full_run(spark: SparkSession, landing: str, catalogue: str, features: str, model: str, run_log: str, predictions: str,
             start: str, end: str, as_of=None, stages: tuple[str, ...] = STAGES, chunk_days: int = 30,
             line_delimited: bool = False, mode: str = "overwrite", window_days: int = 30, label_days: int = 30,
             threshold: float = 4.0, cell_degrees: float = 0.5, split_at: str = DEFAULT_SPLIT, embargo_days: int = 0,
             model_types: list[str] = models.MODEL_TYPES, params: dict | None = None, days_back: int = 7,
             history_days: int = 30, top_n: int = 20) -> dict:
    """Run any subset of the stages, each over the tables at the given paths."""
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    out = {}
    if "extract" in stages:
        out["extract"] = extract(spark, landing, catalogue, start, end, chunk_days, mode, line_delimited, cell_degrees)
    if "features" in stages:
        out["features"] = build_feature_table(spark, catalogue, features, window_days, label_days, threshold, cell_degrees)
    if "train" in stages:
        out["train"] = train(spark, features, model, run_log, split_at, model_types, params, embargo_days)
    if "predict" in stages:
        out["predict"] = predict(spark, catalogue, model, predictions, as_of or dt.date.today(), days_back,
                                 history_days, window_days, top_n, cell_degrees)
    return out


def resumable_run(spark: SparkSession, run_path: str, landing: str, start: str, end: str, as_of,
                  before_stage: Callable[[str], None] | None = None, **options) -> dict[str, str]:
    """The full run under one folder, resumed where it stopped.

    Every stage writes into a folder of its own attempt and is then committed: one
    row (stage, path) appended to the manifest, a Parquet table under ``run_path``.
    Called again with the same arguments, after a lost driver too, committed stages
    are not run and what an unfinished attempt left is not read. Other arguments
    than those of the first call are refused: stages of two settings don't mix.
    ``before_stage`` is called with the name of each stage that is about to run.
    Returns the committed path of each output; ``options`` as for ``full_run``,
    without ``stages`` and ``mode``.
    """
    if {"stages", "mode"} & options.keys():
        raise ValueError("stages and mode are not options of a resumable run")
    manifest = f"{run_path.rstrip('/')}/manifest"
    settings = json.dumps({"landing": landing, "start": str(start), "end": str(end), "as_of": str(as_of), **options}, sort_keys=True, default=str)
    done: dict[str, str] = {}
    if folder_exists(spark, manifest):
        # One row per committed stage.
        for row in spark.read.schema(MANIFEST_SCHEMA).parquet(manifest).collect():
            if row["settings"] != settings:
                raise ValueError("the run was begun with other arguments")
            done[row["stage"]] = row["path"]
    for stage in STAGES:
        if stage in done:
            continue
        if before_stage:
            before_stage(stage)
        path = f"{run_path.rstrip('/')}/{stage}-{uuid.uuid4().hex}"
        at = {s: done.get(s, path) for s in STAGES}
        full_run(spark, landing, f"{at['extract']}/catalogue", f"{at['features']}/features", f"{at['train']}/model", f"{at['train']}/runs",
                 f"{at['predict']}/predictions", start, end, as_of, stages=(stage,), **options)
        spark.createDataFrame([(stage, path, settings)], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(manifest)
        done[stage] = path
    return {"catalogue": f"{done['extract']}/catalogue", "features": f"{done['features']}/features", "model": f"{done['train']}/model",
            "runs": f"{done['train']}/runs", "predictions": f"{done['predict']}/predictions"}


__all__ = ["extract", "build_feature_table", "train", "predict", "score_scenarios", "full_run", "resumable_run",
           "PREDICTION_COLUMNS"]
