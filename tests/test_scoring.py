import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quakeframe.operators.scoring import risk_report, scenario_features, top_risk, vector_skip_count, with_risk
from quakeframe.schema import PREDICTORS


def scored(spark, probs):
    rows = [(i, p) for i, p in enumerate(probs)]
    df = spark.createDataFrame(rows, "event_id long, p double")
    df = df.select(
        "event_id",
        F.current_timestamp().alias("event_time"),
        F.lit(1.0).alias("magnitude"), F.lit(1.0).alias("depth_km"), F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"), F.lit("x").alias("place"),
        F.when(F.col("p").isNotNull(), array_to_vector(F.array(1 - F.col("p"), F.col("p")))).alias("probability"),
    )
    return with_risk(df)


def test_risk_tiers_and_report(spark):
    probs = [0.0, 0.3999, 0.4, 0.6999, 0.7, 1.0, None, 0.7]
    s = scored(spark, probs)
    tiers = [r.risk_level for r in s.orderBy("event_id").collect()]
    assert tiers == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "LOW", "HIGH"]
    r = risk_report(s).first()
    assert (r.total_events, r.high_risk, r.medium_risk, r.low_risk) == (8, 3, 2, 3)
    assert r.high_risk_pct == pytest.approx(37.5)
    empty = risk_report(s.limit(0)).first()
    assert empty.total_events == 0 and empty.high_risk_pct is None


def test_top_risk_ties_by_event_id(spark):
    s = scored(spark, [0.5, 0.9, 0.9, None, 0.1])
    top = [r.event_id for r in top_risk(s, 3).collect()]
    assert top == [1, 2, 0]
    plan = top_risk(s, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scenario_defaults(spark):
    df = spark.createDataFrame(
        [(5.5, 10.0, 34.05, -118.25, 3.2, 45), (5.0, 5.0, 0.0, 0.0, 0.0, 0), (4.0, 1.0, 1.0, 1.0, None, None)],
        "magnitude double, depth_km double, latitude double, longitude double, "
        "recent_magnitude_mean double, recent_event_count int",
    )
    out = scenario_features(df).collect()
    assert set(PREDICTORS) <= set(out[0].asDict())
    a, b, c = out
    assert a.mag_mean_30d == 3.2 and a.event_count_30d == 45 and a.significance == 550.0
    assert b.mag_mean_30d == 5.0 and b.event_count_30d == 10  # 0 means not given
    assert c.mag_mean_30d == 4.0 and c.event_count_30d == 10
    assert a.mag_max_30d == pytest.approx(6.6) and a.energy_release == pytest.approx(10 ** (1.5 * 5.5 + 4.8))
    assert a.cumulative_energy_30d == pytest.approx(10 ** (1.5 * 5.5 + 5.5))


def test_vector_skip_count(spark):
    cols = ", ".join(f"{c} double" for c in PREDICTORS)
    rows = [tuple([1.0] * 20), tuple([None] + [1.0] * 19), tuple([float("nan")] + [1.0] * 19)]
    df = spark.createDataFrame(rows, cols)
    r = vector_skip_count(df).first()
    assert (r.total_rows, r.kept_rows, r.dropped_rows) == (3, 1, 2)
