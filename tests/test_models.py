import os

import pytest

from quakeframe.operators import dataset, models
from quakeframe.operators.features import training_features
from quakeframe.operators.scoring import with_risk
from quakeframe.sources.fixtures import events_catalogue

SMALL = {
    "random_forest": {"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 10, "seed": 42},
    "gbt": {"maxIter": 3, "maxDepth": 2, "seed": 42},
    "logistic_regression": {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5},
}


@pytest.fixture(scope="module")
def split(spark):
    t = training_features(events_catalogue(spark, "/root/testdata/sf0.01"), 7, 7, 3.0).cache()
    return dataset.temporal_split(t, "2024-01-20")


def test_train_select_save_load(spark, split, scratch):
    train, test = split
    best, runs = models.train_models(train, test, params=SMALL)
    rows = runs.orderBy("position").collect()
    assert [r.model_type for r in rows] == models.MODEL_TYPES
    assert sum(r.selected for r in rows) == 1
    for r in rows:
        assert 0.0 <= r.auc_roc <= 1.0 and r.train_size + r.test_size > 0
        assert r.recall == pytest.approx(r.accuracy, abs=1e-9)  # weighted recall == accuracy
    sel = [r for r in rows if r.selected][0]
    assert sel.auc_roc == max(r.auc_roc for r in rows)
    path = os.path.join(scratch, "model")
    models.save_model(best, path)
    again = models.load_model(path)
    a = with_risk(best.transform(test)).select("event_id", "aftershock_probability").orderBy("event_id").collect()
    b = with_risk(again.transform(test)).select("event_id", "aftershock_probability").orderBy("event_id").collect()
    assert a == b
    log = os.path.join(scratch, "runlog")
    models.append_run_log(runs, log)
    models.append_run_log(runs, log)
    assert spark.read.parquet(log).count() == 6


def test_select_best_ties_and_errors(spark):
    recs = [dict(model_type=t, num_features=20, train_size=1, test_size=1, auc_roc=a, auc_pr=0.0,
                 accuracy=0.0, f1=0.0, precision=0.0, recall=0.0) for t, a in
            [("random_forest", 0.8), ("gbt", 0.8), ("logistic_regression", 0.1)]]
    runs = models.select_best(models.run_records(spark, recs))
    assert [r.model_type for r in runs.where("selected").collect()] == ["random_forest"]
    with pytest.raises(ValueError):
        models.build_pipeline("svm")


def test_split_counts(spark, split):
    train, test = split
    t = train.unionByName(test)
    sizes = dataset.split_sizes(t, "2024-01-20").first()
    assert sizes.train_count == train.count() and sizes.test_count == test.count()
    prev = dataset.label_prevalence(t).first()
    assert prev.total_events == sizes.train_count + sizes.test_count


def test_select_best_none_above_zero(spark):
    recs = [dict(model_type=t, num_features=20, train_size=1, test_size=1, auc_roc=0.0, auc_pr=0.0,
                 accuracy=0.0, f1=0.0, precision=0.0, recall=0.0) for t in ("random_forest", "gbt")]
    runs = models.select_best(models.run_records(spark, recs))
    assert runs.where("selected").count() == 0 and runs.count() == 2
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_evaluate_equals_the_librarys_evaluators(spark):
    """Ties, one class only, wrong and right predictions, more scores than partitions."""
    import random

    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    r = random.Random(3)
    cases = [
        [(float(r.random() < 0.3), round(r.random(), 2)) for _ in range(700)],
        [(1.0, 0.4), (0.0, 0.4), (1.0, 0.4)],
        [(1.0, 0.2), (1.0, 0.9)],
        [(0.0, 0.2), (0.0, 0.9)],
        [(float(i % 7 == 0), i / 3000) for i in range(3000)],
    ]
    for rows in cases:
        df = spark.createDataFrame(rows, "y double, s double").select(
            "y", array_to_vector(F.array(-F.col("s"), F.col("s"))).alias("rawPrediction"), (F.col("s") > 0.45).cast("double").alias("prediction")
        )
        got = models.evaluate(df, "y")
        b = BinaryClassificationEvaluator(labelCol="y", numBins=0)
        m = MulticlassClassificationEvaluator(labelCol="y")
        want = {
            "auc_roc": b.setMetricName("areaUnderROC").evaluate(df), "auc_pr": b.setMetricName("areaUnderPR").evaluate(df),
            "accuracy": m.setMetricName("accuracy").evaluate(df), "f1": m.setMetricName("f1").evaluate(df),
            "precision": m.setMetricName("weightedPrecision").evaluate(df), "recall": m.setMetricName("weightedRecall").evaluate(df),
        }
        assert got == pytest.approx(want, abs=1e-12), rows[:3]


def test_prepared_vectors_give_the_pipelines_model(spark, split):
    """Fitting on the shared vectors equals fitting the whole pipeline."""
    train, test = split
    model, record = models.train_and_evaluate(train, test, "logistic_regression")
    whole = models.build_pipeline("logistic_regression").fit(train)
    want = models.evaluate(whole.transform(test))
    assert record["auc_roc"] == pytest.approx(want["auc_roc"], abs=1e-6)
    assert (record["train_size"], record["test_size"]) == (train.count(), test.count())
    a = model.transform(test)
    assert a.count() == whole.transform(test).count() and a.columns == whole.transform(test).columns
    with pytest.raises(ValueError):
        models.train_and_evaluate(train, test, "svm")
