"""MLlib pipelines: assemble → standardise → classifier; evaluation; selection;
model and run-log sinks."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeframe.schema import LABEL, PREDICTORS
from quakeframe.session import ensure_checkpoint_dir, materialize

MODEL_TYPES = ["random_forest", "gbt", "logistic_regression"]

# Classifier hyperparameters (library defaults).
DEFAULT_PARAMS = {
    "random_forest": {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 10, "seed": 42},
    "gbt": {"maxIter": 50, "maxDepth": 8, "seed": 42},
    "logistic_regression": {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5},
}

METRIC_NAMES = ["auc_roc", "auc_pr", "accuracy", "f1", "precision", "recall"]


CLASSIFIERS = {"random_forest": RandomForestClassifier, "gbt": GBTClassifier, "logistic_regression": LogisticRegression}


def _vector_stages(predictors: list[str]) -> list:
    assembler = VectorAssembler(inputCols=list(predictors), outputCol="features_raw", handleInvalid="skip")
    return [assembler, StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True)]


def _classifier(model_type: str, label: str, params: dict | None):
    if model_type not in DEFAULT_PARAMS:
        raise ValueError(f"model_type must be one of {sorted(DEFAULT_PARAMS)}, not {model_type!r}")
    return CLASSIFIERS[model_type](labelCol=label, featuresCol="features", **{**DEFAULT_PARAMS[model_type], **(params or {})})


def build_pipeline(model_type: str = "random_forest", predictors: list[str] = PREDICTORS,
                   label: str = LABEL, params: dict | None = None) -> Pipeline:
    """VectorAssembler (rows with NULL/NaN predictors skipped) → StandardScaler
    (mean and sample std of the training rows) → classifier."""
    return Pipeline(stages=[*_vector_stages(predictors), _classifier(model_type, label, params)])


def evaluate(predictions: DataFrame, label: str = LABEL) -> dict[str, float]:
    """AUC-ROC and AUC-PR on rawPrediction; accuracy, weighted F1 / precision /
    recall on prediction, for labels and predictions 0 and 1.

    All six come from one table, the counts of (label, prediction) per distinct
    score, sorted by range partitions. Running counts over it are the curves'
    points, exact for every score (no down-sampling); one aggregate sums areas
    and counts. The scored rows are read once for the counts and once for the
    range boundaries. Edge cases are those of the library's evaluators: without
    positives both areas are 0, without negatives 1.
    """
    raw = F.col("rawPrediction")  # a vector or, like the evaluators', a number
    score = (vector_to_array(raw)[1] if isinstance(predictions.schema["rawPrediction"].dataType, VectorUDT) else raw).alias("score")
    y, p = F.col(label), F.col("prediction")
    cells = {f"n{i}{j}": F.count_if((y == i) & (p == j)) for i in (0, 1) for j in (0, 1)}
    per_score = predictions.select(score, label, "prediction").groupBy("score").agg(*[c.alias(n) for n, c in cells.items()])
    order = F.col("score").desc()
    ranged = materialize(per_score.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id()), "curve")
    t = ranged.select("at", F.shiftright("at", 33).alias("part"), (F.col("n10") + F.col("n11")).alias("pos"), (F.col("n00") + F.col("n01")).alias("neg"), *cells)
    # Counts before a partition: a window over one row per partition.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    zero = F.lit(0).cast("long")
    starts = sums.select("part", F.coalesce(F.sum("p").over(earlier), zero).alias("p0"), F.coalesce(F.sum("n").over(earlier), zero).alias("n0"))
    upto = Window.partitionBy("part").orderBy("at")
    c = t.join(starts, "part").withColumn("tp", F.col("p0") + F.sum("pos").over(upto)).withColumn("fp", F.col("n0") + F.sum("neg").over(upto))
    tp, fp, pos, neg = (F.col(x).cast("double") for x in ("tp", "fp", "pos", "neg"))
    precision = tp / (tp + fp)
    before = F.when(tp + fp > pos + neg, (tp - pos) / (tp - pos + fp - neg)).otherwise(precision)
    got = c.agg(
        F.sum(neg * (2 * tp - pos) / 2).alias("roc"), F.sum(pos * (precision + before) / 2).alias("pr"),
        *[F.coalesce(F.sum(n), zero).alias(n) for n in cells],
    ).first()
    return _metrics(got.asDict())


def _metrics(got: dict) -> dict[str, float]:
    counts = {(i, j): got[f"n{i}{j}"] for i in (0, 1) for j in (0, 1)}  # (label, prediction)
    n = sum(counts.values())
    positives, negatives = counts[1, 0] + counts[1, 1], counts[0, 0] + counts[0, 1]
    out = {"auc_roc": 0.0, "auc_pr": 0.0, "accuracy": 0.0, "f1": 0.0, "precision": 0.0, "recall": 0.0}
    if not n:
        return out
    if positives:
        out["auc_roc"] = got["roc"] / (positives * negatives) if negatives else 1.0
        out["auc_pr"] = got["pr"] / positives
    out["accuracy"] = (counts[0, 0] + counts[1, 1]) / n
    for c in (0, 1):
        actual, predicted, right = counts[c, 0] + counts[c, 1], counts[0, c] + counts[1, c], counts[c, c]
        precision, recall = right / predicted if predicted else 0.0, right / actual if actual else 0.0
        out["precision"] += actual / n * precision
        out["recall"] += actual / n * recall
        out["f1"] += actual / n * (2 * precision * recall / (precision + recall) if precision + recall else 0.0)
    return out


@dataclass
class Prepared:
    """The vector step fitted on the training rows, and both parts' vectors as
    written tables: what every learner starts from."""

    stages: list
    train: DataFrame
    test: DataFrame
    train_size: int
    test_size: int
    num_features: int


def prepare(train: DataFrame, test: DataFrame, predictors: list[str] = PREDICTORS, label: str = LABEL) -> Prepared:
    """Assembler and scaler fitted once; each part is counted, transformed and
    written once."""
    ensure_checkpoint_dir(train.sparkSession)  # GBT / RF checkpoint into the shared folder
    fitted = Pipeline(stages=_vector_stages(predictors)).fit(train)
    tables = [materialize(fitted.transform(part).select(label, "features"), name) for part, name in ((train, "train-vectors"), (test, "test-vectors"))]
    return Prepared(fitted.stages, *tables, train.count(), test.count(), len(predictors))


def fit_and_evaluate(ready: Prepared, model_type: str, params: dict | None = None, label: str = LABEL) -> tuple[PipelineModel, dict]:
    """One learner on the prepared vectors; the whole pipeline and a run record."""
    fitted = _classifier(model_type, label, params).fit(ready.train)
    record = {"model_type": model_type, "num_features": ready.num_features, "train_size": ready.train_size,
              "test_size": ready.test_size, **evaluate(fitted.transform(ready.test), label)}
    return PipelineModel(stages=[*ready.stages, fitted]), record


def train_and_evaluate(train: DataFrame, test: DataFrame, model_type: str = "random_forest",
                       params: dict | None = None, predictors: list[str] = PREDICTORS) -> tuple[PipelineModel, dict]:
    """Fit on ``train``, score ``test``; returns the model and a run record."""
    _classifier(model_type, LABEL, params)  # an unknown type fails before any job
    return fit_and_evaluate(prepare(train, test, predictors), model_type, params)


RUN_LOG_SCHEMA = (
    "model_type string, num_features int, train_size bigint, test_size bigint, "
    "auc_roc double, auc_pr double, accuracy double, f1 double, precision double, "
    "recall double, position int, run_at timestamp"
)


def run_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Run records (one small row per trained model) as a DataFrame."""
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(r["model_type"], r["num_features"], r["train_size"], r["test_size"],
             *[float(r[k]) for k in METRIC_NAMES], i, now) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def select_best(runs: DataFrame) -> DataFrame:
    """The run with the highest AUC-ROC; ties go to the earliest position.

    Adds ``selected`` (boolean). Only runs with AUC-ROC > 0 can be selected.
    """
    # One global aggregate with a fixed-size partial picks the winner's
    # position: the smallest (-auc, position) among runs with auc > 0.
    best = runs.where(F.col("auc_roc") > 0).agg(
        F.min(F.struct((-F.col("auc_roc")).alias("a"), F.col("position").alias("p"))).alias("__b")
    ).select(F.col("__b.p").alias("__best"))
    marked = runs.join(best, runs["position"] == best["__best"], "left")
    return marked.withColumn("selected", F.col("__best").isNotNull()).drop("__best")


def train_models(train: DataFrame, test: DataFrame, model_types: list[str] = MODEL_TYPES, params: dict | None = None):
    """Train each model type; return (best model, runs with ``selected``).

    The vectors are prepared once and shared; the learners are fitted at the same
    time, their jobs side by side on the cluster. Raises ValueError when no
    model has AUC-ROC above 0.
    """
    for t in model_types:
        _classifier(t, LABEL, (params or {}).get(t))
    ready = prepare(train, test)

    def one(model_type: str) -> tuple[PipelineModel, dict]:
        return fit_and_evaluate(ready, model_type, (params or {}).get(model_type))

    with ThreadPoolExecutor(max(1, len(model_types))) as pool:
        done = [f.result() for f in [pool.submit(inheritable_thread_target(train.sparkSession)(one), t) for t in model_types]]
    models, records = [m for m, _ in done], [r for _, r in done]
    runs = select_best(run_records(train.sparkSession, records))
    best = [i for i, r in enumerate(records) if r["auc_roc"] > 0]
    if not best:
        raise ValueError("no model reached an AUC-ROC above 0")
    top = max(best, key=lambda i: (records[i]["auc_roc"], -i))
    return models[top], runs


def append_run_log(runs: DataFrame, path: str) -> None:
    """Append run records to the run-log table (Parquet)."""
    runs.write.mode("append").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
