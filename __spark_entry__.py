"""

``queries()`` maps names to library-backed Spark queries over the driver's
tables (see ``quakeframe.plans.queries``); ``oracle_sql()`` gives the same
result in DuckDB SQL. Queries that train return what the events determine, so
they have SQL too; fitted numbers are covered by seeded unit tests.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from quakeframe.plans.queries import (  # noqa: E402
    AS_OF,
    CELL_DEGREES,
    CHUNK_DAYS,
    DAYS_BACK,
    DOCUMENT_EVENTS,
    L_S,
    QUERIES,
    SPLIT_AT,
    THRESHOLD,
    W_S,
    WINDOW_END,
    WINDOW_START,
)
from quakeframe.sources.fixtures import DUCKDB_CATALOGUE_CTE  # noqa: E402

# The text operators and their pipeline are optional: without their folder the
# rest works. An import error inside them is not swallowed.
if importlib.util.find_spec("quakeframe.llm") is not None:
    from quakeframe.llm import queries as llm  # noqa: E402
else:
    llm = None
if llm is not None and importlib.util.find_spec("corpus_pipeline") is not None:
    import corpus_pipeline  # noqa: E402
else:
    corpus_pipeline = None

FLAGSHIP_SF = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the labelled training feature table on sf0.001."""
    return QUERIES["training_features"](spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(QUERIES)
    if llm is not None:
        out |= llm.QUERIES
    if corpus_pipeline is not None:
        out["pipeline"] = corpus_pipeline.run
    return out


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

# Fixed values, restated apart from the library's on purpose: SQL that shared them
# with the code under test would hide a slip in them.
_FILL = {
    "time_since_prev_event": "0",
    "mag_mean_30d": "0.0",
    "mag_max_30d": "0.0",
    "mag_std_30d": "0.0",
    "event_count_30d": "1",
    "depth_mean_30d": "0.0",
    "cumulative_energy_30d": "0.0",
    "num_stations": "0",
    "gap": "180.0",
    "rms": "0.0",
    "significance": "0",
}


def _features_cte(filtered: bool, labels: bool) -> str:
    where = (
        "WHERE magnitude IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude >= 0"
        if filtered
        else ""
    )
    label_cols = (
        f""",
    max(magnitude) OVER (PARTITION BY lat_grid, lon_grid ORDER BY event_s
                         RANGE BETWEEN 1 FOLLOWING AND {L_S} FOLLOWING) AS future_max_mag"""
        if labels
        else ""
    )
    label_out = (
        f""",
    CASE WHEN future_max_mag >= {THRESHOLD}::DOUBLE THEN 1 ELSE 0 END AS has_aftershock,
    coalesce(future_max_mag, 0.0::DOUBLE) AS aftershock_magnitude"""
        if labels
        else ""
    )
    return f"""WITH {DUCKDB_CATALOGUE_CTE},
base AS (
  SELECT *,
    CAST(hour(event_time) AS INTEGER) AS hour,
    CAST(dayofweek(event_time) + 1 AS INTEGER) AS day_of_week,
    CAST(dayofyear(event_time) AS INTEGER) AS day_of_year,
    event_s - lag(event_s) OVER (PARTITION BY network ORDER BY event_time, event_id) AS time_since_prev_event,
    CAST(floor(latitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lat_grid,
    CAST(floor(longitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lon_grid,
    pow(10.0::DOUBLE, 1.5::DOUBLE * magnitude + 4.8::DOUBLE) AS energy_release
  FROM cat {where}
),
win AS (
  SELECT *,
    count(event_id) OVER (PARTITION BY lat_grid, lon_grid) AS spatial_density,
    avg(magnitude) OVER w AS mag_mean_30d,
    max(magnitude) OVER w AS mag_max_30d,
    stddev_samp(magnitude) OVER w AS mag_std_30d,
    count(event_id) OVER w AS event_count_30d,
    avg(depth_km) OVER w AS depth_mean_30d,
    sum(energy_release) OVER w AS cumulative_energy_30d{label_cols}
  FROM base
  WINDOW w AS (PARTITION BY lat_grid, lon_grid ORDER BY event_s RANGE BETWEEN {W_S} PRECEDING AND CURRENT ROW)
),
feat AS (
  SELECT *{label_out} FROM win
)"""


def _filled(c: str) -> str:
    return f"coalesce({c}, {_FILL[c]}) AS {c}" if c in _FILL else c


def _log10(c: str, out: str | None = None) -> str:
    return f"CASE WHEN {c} > 0 THEN round(log10({c}), 6) END AS {out or 'log10_' + c}"


# Columns of the training and the serving table.
_TRAIN = [
    "event_id", "event_time", "magnitude", "depth_km", "latitude", "longitude", "significance",
    "num_stations", "gap", "rms", "hour", "day_of_week", "day_of_year", "time_since_prev_event",
    "spatial_density", "mag_mean_30d", "mag_max_30d", "mag_std_30d", "event_count_30d",
    "depth_mean_30d", "energy_release", "cumulative_energy_30d", "has_aftershock", "aftershock_magnitude",
]
_SERVE = [
    "event_id", "event_time", "magnitude", "depth_km", "latitude", "longitude", "place",
    "significance", "num_stations", "gap", "rms", "hour", "day_of_week", "day_of_year",
    "time_since_prev_event", "spatial_density", "mag_mean_30d", "mag_max_30d", "mag_std_30d",
    "event_count_30d", "depth_mean_30d", "energy_release", "cumulative_energy_30d",
]
_PREDICTORS = _TRAIN[2:22]


def _table_cte(cols: list[str], name: str) -> str:
    return f"{name} AS (SELECT {', '.join(_filled(c) for c in cols)} FROM feat)"


def _report(cols: list[str], src: str) -> str:
    out = []
    for c in cols:
        if c in ("energy_release", "cumulative_energy_30d"):
            out.append(_log10(c))
        elif c == "mag_std_30d":
            out.append(f"round({c}, 9) AS {c}")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {src}"


_TRAIN_SQL_PREFIX = _features_cte(True, True) + ",\n" + _table_cte(_TRAIN, "tf")

_GEO_COLS = """CAST(event_id AS VARCHAR) AS event_id, magnitude, place,
  (epoch_us(event_time) // 1000) AS time_ms, (epoch_us(event_time) // 1000) + 60000 AS updated_ms,
  CAST(event_id % 720 - 360 AS INTEGER) AS timezone, 'u' || event_id AS url, 'd' || event_id AS detail,
  CAST(event_id % 1000 + 1 AS INTEGER) AS felt, (event_id % 91) / 8.0::DOUBLE AS cdi, (event_id % 77) / 16.0::DOUBLE + 1 AS mmi,
  CASE WHEN event_id % 4 > 0 THEN 'a' || (event_id % 4) END AS alert, 'reviewed' AS status, 0 AS tsunami, significance, network,
  'c' || event_id AS code, 'i' || event_id AS ids, 's' || (event_id % 7) AS sources, 't' || (event_id % 5) AS types,
  num_stations, (event_id % 53) / 32.0::DOUBLE AS min_distance, rms, gap,
  'ml' AS magnitude_type, longitude, latitude, depth_km,
  CAST(dayofmonth(event_time) AS INTEGER) AS day, CAST(year(event_time) AS INTEGER) AS year,
  CAST(month(event_time) AS INTEGER) AS month,
  event_s, CAST(floor(((epoch_us(event_time) // 1000) + 60000) / 1000) AS BIGINT) AS updated_s"""

_RT_COLS = """CAST(event_id AS VARCHAR) AS event_id, magnitude, depth_km, latitude, longitude, network,
  place, significance, num_stations, gap, rms, CAST(year(event_time) AS INTEGER) AS year,
  CAST(month(event_time) AS INTEGER) AS month, CAST(dayofmonth(event_time) AS INTEGER) AS day, event_s"""

_F1 = "magnitude IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude >= 0"

_STD = ", ".join(
    f"round(CASE WHEN sd_{i} = 0 THEN 0.0 ELSE ({c} - mu_{i}) / sd_{i} END, 6) AS z_{c}"
    for i, c in enumerate(_PREDICTORS)
)
_STD_STATS = ", ".join(
    f"avg({c}) AS mu_{i}, stddev_samp({c}) AS sd_{i}" for i, c in enumerate(_PREDICTORS)
)
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in _PREDICTORS)

_SCORED = f"""WITH {DUCKDB_CATALOGUE_CTE},
sc AS (
  SELECT *, magnitude / (magnitude + 2.0::DOUBLE) AS aftershock_probability FROM cat
),
tiered AS (
  SELECT *, CASE WHEN aftershock_probability >= 0.7 THEN 'HIGH'
                 WHEN aftershock_probability >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM sc
)"""

_EVAL = _TRAIN_SQL_PREFIX + """,
ev AS (SELECT CAST(has_aftershock AS DOUBLE) AS y, mag_max_30d AS s,
              CASE WHEN mag_max_30d >= 4.0 THEN 1.0 ELSE 0.0 END AS p FROM tf)"""

_SCENARIOS = f"""WITH {DUCKDB_CATALOGUE_CTE},
g AS (
  SELECT CAST(floor(latitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lat_grid,
         CAST(floor(longitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lon_grid,
         max(magnitude) AS magnitude, avg(depth_km) AS depth_km, avg(magnitude) AS mean_mag, count(*) AS n
  FROM cat WHERE {_F1} GROUP BY 1, 2
),
s AS (
  SELECT lat_grid, lon_grid, magnitude, depth_km,
         (lat_grid + 0.5) * {CELL_DEGREES}::DOUBLE AS latitude,
         (lon_grid + 0.5) * {CELL_DEGREES}::DOUBLE AS longitude,
         CASE WHEN lat_grid % 2 <> 0 THEN 0.0 ELSE mean_mag END AS rmm,
         CASE WHEN lat_grid % 2 <> 0 THEN 0 ELSE CAST(n AS INTEGER) END AS rec
  FROM g
)"""


def oracle_sql() -> dict[str, str]:
    out = _library_sql() | _model_sql()
    if llm is not None:
        out |= llm.ORACLE_SQL
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


_RECENT = f"event_time >= DATE '{AS_OF}' - INTERVAL {DAYS_BACK} DAY"
_SCORABLE = f"{_RECENT} AND magnitude IS NOT NULL AND depth_km IS NOT NULL"


def _trained_sql(model_type: str) -> str:
    """Sizes from the events; every scored row must pass every check."""
    return _TRAIN_SQL_PREFIX + f""",
n AS (SELECT count(*) FILTER (WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00') AS a,
             count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00') AS b,
             count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00' AND {_NOT_NULL}) AS c FROM tf)
SELECT '{model_type}' AS model_type, {len(_PREDICTORS)} AS num_features, a AS train_size, b AS test_size,
       true AS metrics_in_range, c AS rows_scored, c AS in_range, c AS tiers_agree, c AS same_after_reload FROM n"""


def _model_sql() -> dict[str, str]:
    return {
        **{f"train_{q}": _trained_sql(t) for q, t in (("random_forest", "random_forest"), ("gbt", "gbt"), ("logreg", "logistic_regression"))},
        "select_model": _TRAIN_SQL_PREFIX + f""",
n AS (SELECT count(*) FILTER (WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00') AS a,
             count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00') AS b FROM tf)
SELECT t.model_type, CAST(t.position AS INTEGER) AS position, {len(_PREDICTORS)} AS num_features, a AS train_size,
       b AS test_size, CAST(1 AS BIGINT) AS n_selected, true AS fair
FROM n, (VALUES ('random_forest', 0), ('gbt', 1), ('logistic_regression', 2)) AS t(model_type, position)""",
        "select_from_metrics": f"""WITH {DUCKDB_CATALOGUE_CTE},
r AS (SELECT network, CAST(dayofmonth(event_time) AS INTEGER) AS day,
             round(avg(CASE WHEN magnitude >= 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 2) AS auc_roc,
             CAST(dayofmonth(event_time) * 100 + length(network) AS INTEGER) AS position
      FROM cat WHERE {_F1} AND event_time IS NOT NULL GROUP BY 1, 2, 4)
SELECT *, auc_roc > 0 AND auc_roc = (SELECT max(auc_roc) FROM r)
          AND position = (SELECT min(position) FROM r WHERE auc_roc = (SELECT max(auc_roc) FROM r)) AS selected FROM r""",
        "label_complete": f"""WITH {DUCKDB_CATALOGUE_CTE}, f AS (SELECT * FROM cat WHERE {_F1})
SELECT event_id, event_time + INTERVAL {L_S // 86400} DAY <= (SELECT max(event_time) FROM f) AS label_complete FROM f""",
        "run_log": _TRAIN_SQL_PREFIX + f"""
SELECT 'logistic_regression' AS model_type, {len(_PREDICTORS)} AS num_features,
  count(*) FILTER (WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00') AS train_size,
  count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00') AS test_size,
  CAST(2 AS BIGINT) AS records, CAST(1 AS BIGINT) AS scores, CAST(2 AS BIGINT) AS timed FROM tf""",
        "train_flow": _TRAIN_SQL_PREFIX + f"""
SELECT count(*) AS total_events, count(*) FILTER (WHERE has_aftershock = 1) AS aftershock_events,
  count(*) FILTER (WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00') AS train_count,
  count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00') AS test_count,
  count(*) AS total_rows, count(*) FILTER (WHERE {_NOT_NULL}) AS kept_rows,
  count(*) FILTER (WHERE NOT ({_NOT_NULL})) AS dropped_rows, CAST(3 AS BIGINT) AS logged FROM tf""",
        "scored_sample": _TRAIN_SQL_PREFIX + f"""
SELECT event_id, has_aftershock, true AS sound FROM tf WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00' AND {_NOT_NULL}
ORDER BY event_id LIMIT 10""",
        "full_run": _TRAIN_SQL_PREFIX + f""",
n AS (SELECT count(*) AS a, count(*) FILTER (WHERE {_SCORABLE}) AS k FROM cat)
SELECT CAST(3 AS BIGINT) AS committed_first, CAST(4 AS BIGINT) AS committed, CAST(3 AS BIGINT) AS kept, max(a) AS catalogue_rows,
  count(*) AS feature_rows, CAST(sum(has_aftershock) AS BIGINT) AS positives, CAST(3 AS BIGINT) AS runs, max(k) AS predictions, max(k) AS in_range
FROM tf, n""",
        "empty_guard": f"""WITH {DUCKDB_CATALOGUE_CTE}, n AS (
  SELECT count(*) AS a, count(DISTINCT year(event_time) * 12 + month(event_time)) AS m FROM cat)
SELECT a AS rows_written, m AS months_written, CAST(0 AS BIGINT) AS empty_writes, true AS predicted, false AS created,
       a AS rows_kept, m AS months_kept, a AS predictions_kept FROM n""",
        "state_cells": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT CAST(floor(latitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lat_grid, CAST(floor(longitude / {CELL_DEGREES}::DOUBLE) AS BIGINT) AS lon_grid,
       count(event_id) AS spatial_density FROM cat GROUP BY 1, 2""",
        "state_networks": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT network, max(event_s) AS last_s FROM cat WHERE NOT ({_RECENT}) GROUP BY 1""",
        "predict_flow": f"""WITH {DUCKDB_CATALOGUE_CTE},
n AS (SELECT count(*) FILTER (WHERE {_RECENT}) AS a, count(*) FILTER (WHERE {_SCORABLE}) AS k FROM cat)
SELECT a AS total_rows, k AS kept_rows, a - k AS dropped_rows, k AS written, k AS in_range, k AS total_events, k AS in_tiers FROM n""",
        "score_events": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT CAST(event_id AS VARCHAR) AS event_id, event_s, magnitude, depth_km, latitude, longitude, place, true AS sound
FROM cat WHERE {_SCORABLE}""",
        "serving_context": _features_cte(False, False) + f"""
SELECT event_id, spatial_density, coalesce(time_since_prev_event, 0) AS time_since_prev_event, event_count_30d,
       coalesce(mag_max_30d, 0.0) AS mag_max_30d FROM feat WHERE {_RECENT}""",
        "score_scenarios": _SCENARIOS + """
SELECT lat_grid, count(*) AS cells, count(*) AS in_range, count(*) AS agree FROM s WHERE depth_km IS NOT NULL GROUP BY 1""",
        "geojson_files": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT count(DISTINCT event_id // {DOCUMENT_EVENTS}) + 2 AS documents, CAST(1 AS BIGINT) AS corrupt,
       count(*) AS features, count(DISTINCT event_id) AS events, 1 AS timed FROM cat""",
        "extract_flow": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT count(*) AS total_rows, count(*) AS documents, CAST(0 AS BIGINT) AS corrupt,
       count(*) FILTER (WHERE event_time >= TIMESTAMP '{WINDOW_START} 00:00:00' AND event_time < TIMESTAMP '{WINDOW_END} 00:00:00') AS in_windows
FROM cat""",
        "extract_sample": f"""WITH {DUCKDB_CATALOGUE_CTE}
SELECT CAST(event_id AS VARCHAR) AS event_id, magnitude, latitude, longitude, network FROM cat
ORDER BY CAST(event_id AS VARCHAR) LIMIT 5""",
        "summary_sketch": f"""WITH {DUCKDB_CATALOGUE_CTE},
long AS (
  SELECT 'magnitude' AS col, magnitude AS v FROM cat
  UNION ALL SELECT 'depth_km', depth_km FROM cat
  UNION ALL SELECT 'significance', CAST(significance AS DOUBLE) FROM cat
),
s AS (SELECT col, CAST(count(v) AS DOUBLE) AS c, avg(v) AS mean, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx,
             1.0::DOUBLE AS q1, 1.0::DOUBLE AS q2, 1.0::DOUBLE AS q3 FROM long GROUP BY col)
SELECT col AS "column", statistic, round(value, 9) AS value FROM s
UNPIVOT (value FOR statistic IN (c AS 'count', mean AS 'mean', sd AS 'stddev', mn AS 'min',
                                 q1 AS '25%', q2 AS '50%', q3 AS '75%', mx AS 'max'))""",
    }


def _library_sql() -> dict[str, str]:
    return {
        "geojson_flatten": f"WITH {DUCKDB_CATALOGUE_CTE} SELECT {_GEO_COLS} FROM cat",
        "request_windows": f"""WITH {DUCKDB_CATALOGUE_CTE},
w AS (
  SELECT CAST(row_number() OVER (ORDER BY ws) - 1 AS INTEGER) AS window_index, ws AS window_start,
         least(ws + INTERVAL {CHUNK_DAYS} DAY, TIMESTAMP '{WINDOW_END} 00:00:00') AS window_end
  FROM (SELECT unnest(range(TIMESTAMP '{WINDOW_START} 00:00:00', TIMESTAMP '{WINDOW_END} 00:00:00',
                            INTERVAL {CHUNK_DAYS} DAY)) AS ws)
)
SELECT w.window_index, w.window_start, w.window_end,
       (SELECT count(*) FROM cat WHERE event_time >= w.window_start AND event_time < w.window_end) AS n_events
FROM w""",
        "catalogue_roundtrip": f"WITH {DUCKDB_CATALOGUE_CTE} SELECT {_RT_COLS} FROM cat WHERE {_F1}",
        "recent_events": f"""WITH {DUCKDB_CATALOGUE_CTE} SELECT {_RT_COLS} FROM cat
WHERE event_time >= DATE '{AS_OF}' - INTERVAL {DAYS_BACK} DAY""",
        "temporal_features": _features_cte(True, False)
        + " SELECT event_id, network, hour, day_of_week, day_of_year, time_since_prev_event FROM feat",
        "spatial_density": _features_cte(True, False) + " SELECT event_id, lat_grid, lon_grid, spatial_density FROM feat",
        "rolling_stats": _features_cte(True, False)
        + """ SELECT event_id, mag_mean_30d AS mag_mean_7d, mag_max_30d AS mag_max_7d,
  round(mag_std_30d, 9) AS mag_std_7d, event_count_30d AS event_count_7d,
  depth_mean_30d AS depth_mean_7d FROM feat""",
        "energy_windows": _features_cte(True, False)
        + f" SELECT event_id, {_log10('energy_release')}, {_log10('cumulative_energy_30d', 'log10_cumulative_energy_7d')} FROM feat",
        "aftershock_labels": _features_cte(True, True)
        + " SELECT event_id, future_max_mag, has_aftershock, aftershock_magnitude FROM feat",
        "training_features": _TRAIN_SQL_PREFIX + " " + _report(_TRAIN, "tf"),
        "feature_append": _TRAIN_SQL_PREFIX + " " + _report(_TRAIN, "tf"),
        "serving_features": _features_cte(False, False) + ",\n" + _table_cte(_SERVE, "sv") + " " + _report(_SERVE, "sv"),
        "sample_features": _TRAIN_SQL_PREFIX + " " + _report(_TRAIN, "tf") + " ORDER BY event_id LIMIT 5",
        "summary_stats": f"""WITH {DUCKDB_CATALOGUE_CTE},
long AS (
  SELECT 'magnitude' AS col, magnitude AS v FROM cat
  UNION ALL SELECT 'depth_km', depth_km FROM cat
  UNION ALL SELECT 'significance', CAST(significance AS DOUBLE) FROM cat
),
s AS (
  SELECT col, CAST(count(v) AS DOUBLE) AS c, avg(v) AS mean, stddev_samp(v) AS sd, min(v) AS mn,
         quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3, max(v) AS mx
  FROM long GROUP BY col
)
SELECT col AS "column", statistic, round(value, 9) AS value FROM s
UNPIVOT (value FOR statistic IN (c AS 'count', mean AS 'mean', sd AS 'stddev', mn AS 'min',
                                 q1 AS '25%', q2 AS '50%', q3 AS '75%', mx AS 'max'))""",
        "class_distribution": _TRAIN_SQL_PREFIX + " SELECT has_aftershock, count(*) AS count FROM tf GROUP BY 1",
        "label_prevalence": _TRAIN_SQL_PREFIX
        + """ SELECT count(*) AS total_events, count(*) FILTER (WHERE has_aftershock = 1) AS aftershock_events,
  CASE WHEN count(*) > 0 THEN 100.0::DOUBLE * count(*) FILTER (WHERE has_aftershock = 1) / count(*) END AS aftershock_pct
  FROM tf""",
        "split_sizes": _TRAIN_SQL_PREFIX
        + f""" SELECT count(*) FILTER (WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00') AS train_count,
  count(*) FILTER (WHERE event_time >= TIMESTAMP '{SPLIT_AT} 00:00:00') AS test_count FROM tf""",
        "vector_skip_count": _TRAIN_SQL_PREFIX
        + f""" SELECT count(*) AS total_rows, count(*) FILTER (WHERE {_NOT_NULL}) AS kept_rows,
  count(*) FILTER (WHERE NOT ({_NOT_NULL})) AS dropped_rows FROM tf""",
        "standardised": _TRAIN_SQL_PREFIX
        + f""",
tr AS (SELECT * FROM tf WHERE event_time < TIMESTAMP '{SPLIT_AT} 00:00:00' AND {_NOT_NULL}),
st AS (SELECT {_STD_STATS} FROM tr)
SELECT event_id, {_STD} FROM tr, st""",
        "eval_binary": _EVAL
        + """,
r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM ev),
n AS (SELECT sum(y) AS n1, count(*) - sum(y) AS n0, sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS rs FROM r),
pts AS (
  SELECT s, sum(y) AS tp_s, count(*) - sum(y) AS fp_s FROM ev GROUP BY s
),
cum AS (
  SELECT s, sum(tp_s) OVER (ORDER BY s DESC) AS tp, sum(fp_s) OVER (ORDER BY s DESC) AS fp FROM pts
),
curve AS (
  SELECT tp / (SELECT n1 FROM n) AS rc, tp / (tp + fp) AS pc, row_number() OVER (ORDER BY s DESC) AS i FROM cum
),
curve0 AS (
  SELECT 0 AS i, 0.0 AS rc, (SELECT pc FROM curve WHERE i = 1) AS pc UNION ALL SELECT i, rc, pc FROM curve
),
seg AS (
  SELECT (rc - lag(rc) OVER (ORDER BY i)) * (pc + lag(pc) OVER (ORDER BY i)) / 2.0 AS a FROM curve0
)
SELECT round((rs - n1 * (n1 + 1) / 2.0) / (n1 * n0), 9) AS auc_roc,
       round((SELECT sum(a) FROM seg), 9) AS auc_pr
FROM n""",
        "eval_multiclass": _EVAL
        + """,
cls AS (SELECT DISTINCT y AS c FROM ev),
m AS (
  SELECT c,
    (SELECT count(*) FROM ev WHERE y = c) AS actual,
    (SELECT count(*) FROM ev WHERE p = c) AS predicted,
    (SELECT count(*) FROM ev WHERE y = c AND p = c) AS tp
  FROM cls
),
pr AS (
  SELECT actual, tp,
    CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS prec,
    tp / actual AS rec
  FROM m
),
tot AS (SELECT count(*) AS n FROM ev)
SELECT round(sum(tp) / max(n), 9) AS accuracy,
  round(sum(actual / n * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END), 9) AS f1,
  round(sum(actual / n * prec), 9) AS precision,
  round(sum(actual / n * rec), 9) AS recall
FROM pr, tot""",
        "risk_tiers": _SCORED + " SELECT event_id, aftershock_probability, risk_level FROM tiered",
        "risk_report": _SCORED
        + """ SELECT count(*) AS total_events,
  count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk,
  100.0::DOUBLE * count(*) FILTER (WHERE risk_level = 'HIGH') / count(*) AS high_risk_pct,
  count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk,
  100.0::DOUBLE * count(*) FILTER (WHERE risk_level = 'MEDIUM') / count(*) AS medium_risk_pct,
  count(*) FILTER (WHERE risk_level = 'LOW') AS low_risk,
  100.0::DOUBLE * count(*) FILTER (WHERE risk_level = 'LOW') / count(*) AS low_risk_pct
FROM tiered""",
        "top_risk": _SCORED
        + """ SELECT event_id, event_time, magnitude, depth_km, latitude, longitude, place,
  aftershock_probability, risk_level FROM tiered
  ORDER BY aftershock_probability DESC NULLS LAST, event_id LIMIT 20""",
        "scenario_features": _SCENARIOS
        + """ SELECT lat_grid, lon_grid, magnitude, depth_km, latitude, longitude,
  magnitude * 100.0::DOUBLE AS significance, 10 AS num_stations, 100.0::DOUBLE AS gap, 0.5::DOUBLE AS rms,
  12 AS hour, 3 AS day_of_week, 180 AS day_of_year, CAST(3600 AS BIGINT) AS time_since_prev_event,
  CAST(5 AS BIGINT) AS spatial_density,
  coalesce(nullif(rmm, 0.0), magnitude) AS mag_mean_30d,
  magnitude * 1.2::DOUBLE AS mag_max_30d, 0.5::DOUBLE AS mag_std_30d,
  CAST(coalesce(nullif(rec, 0), 10) AS BIGINT) AS event_count_30d,
  depth_km AS depth_mean_30d,
  round(log10(pow(10.0::DOUBLE, 1.5::DOUBLE * magnitude + 4.8::DOUBLE)), 6) AS log10_energy_release,
  round(log10(pow(10.0::DOUBLE, 1.5::DOUBLE * magnitude + 5.5::DOUBLE)), 6) AS log10_cumulative_energy_30d
FROM s""",
    }
