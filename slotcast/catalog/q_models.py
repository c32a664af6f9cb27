"""Queries: scoring, evaluation, comparison, reports, promotion, retrain gate, fit."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.catalog.q_drift import _check
from slotcast.catalog.q_windows import _DIGEST_COLS, _digest_out, _train_sql
from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import INDEXED, READINGS, RESAMPLED, SERIES, TAIL, interp, q4, sec_text, with_
from slotcast.functions.features import scale_fixed
from slotcast.functions.numeric import q4 as q4c
from slotcast.functions.timecols import fmt_day_first, fmt_seconds
from slotcast.operators import sequences as Q
from slotcast.operators.recent import last_buckets
from slotcast.operators.series import regular_series, resample_mean
from slotcast.plans import bundle as BU
from slotcast.plans import evaluate as EV
from slotcast.plans import promote as PM
from slotcast.plans import requests as RQ
from slotcast.plans import training as TR
from slotcast.plans.fit import fit_forecaster, fit_sums
from slotcast.plans.scoring import LinearModel, response_json, serve
from slotcast.session import scratch_path, store_path, table_ready
from slotcast.sinks import reports as RP
from slotcast.sources import feed, store

SERIES_BASE = with_(READINGS, RESAMPLED, SERIES)
D100 = "CAST(100.0 AS DOUBLE)"


def _series(spark, sf_dir):
    return regular_series(feed.readings(spark, sf_dir))


def _scored(spark, sf_dir):
    recent = last_buckets(store.read_readings(spark, sf_dir), C.N_STEPS, store.readings_dates(spark, sf_dir))
    lw = Q.last_window(scale_fixed(recent), C.N_STEPS, ["car_scaled", "hour_scaled"])
    return serve(lw.where(F.col("n_rows") == C.N_STEPS), LinearModel.seasonal_naive(C.SERVE_HORIZON))


_SCORE_SQL = (
    SERIES_BASE
    + f""",
lw AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY bucket DESC) AS r FROM series),
lastb AS (SELECT sensor_id, max(bucket) AS last_bucket FROM series GROUP BY 1),
pick AS (SELECT sensor_id, car_count FROM lw WHERE r = {C.N_STEPS} - ({C.N_STEPS - 1} + {C.SERVE_HORIZON} - {C.SLOTS_PER_DAY})),
scored AS (
  SELECT l.sensor_id, last_bucket,
         CAST(round_even(greatest(0.0, car_count / {D100} * {D100}), 0) AS INTEGER) AS prediction,
         last_bucket + INTERVAL {C.SERVE_HORIZON * C.STEP_MINUTES} MINUTE AS prediction_for
  FROM lastb l JOIN pick USING (sensor_id)
)"""
)


@query(
    "score_batch",
    _SCORE_SQL
    + f"""
SELECT sensor_id, {sec_text('last_bucket')} AS timestamp, prediction, {sec_text('prediction_for')} AS prediction_for FROM scored
""",
)
def score_batch(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select(
        "sensor_id", fmt_seconds("timestamp").alias("timestamp"), "prediction", fmt_seconds("prediction_for").alias("prediction_for")
    )


@query(
    "score_response_json",
    _SCORE_SQL
    + f"""
SELECT sensor_id, '{{"predicted_car_count":' || prediction || ',"for_timestamp":"' || {sec_text('prediction_for')} || '"}}' AS response
FROM scored
""",
)
def score_response_json(spark, sf_dir):
    return response_json(_scored(spark, sf_dir))


NEW_MODEL = LinearModel.seasonal_naive(C.EVAL_LEAD)
OLD_MODEL = LinearModel.persistence()
_NEW_LAG = C.SLOTS_PER_DAY - C.EVAL_LEAD  # window row of the new model, counted back from the last row

_EVAL_SQL = (
    SERIES_BASE
    + f""",
ev AS (
  SELECT sensor_id, bucket, car_count AS last_v, count(*) OVER w AS n,
         lag(car_count, {_NEW_LAG}) OVER o AS day_v, lead(car_count, {C.EVAL_LEAD}) OVER o AS label
  FROM series
  WINDOW w AS (PARTITION BY sensor_id ORDER BY bucket ROWS BETWEEN {C.N_STEPS - 1} PRECEDING AND CURRENT ROW),
         o AS (PARTITION BY sensor_id ORDER BY bucket)
),
e AS (SELECT * FROM ev WHERE n = {C.N_STEPS} AND label IS NOT NULL),
metrics AS (
  SELECT sensor_id, '{NEW_MODEL.name}' AS model, avg(abs(label - day_v / {D100} * {D100})) AS mae,
         avg((label - day_v / {D100} * {D100}) * (label - day_v / {D100} * {D100})) AS mse, count(*) AS n_windows
  FROM e GROUP BY 1
  UNION ALL
  SELECT sensor_id, '{OLD_MODEL.name}' AS model, avg(abs(label - last_v / {D100} * {D100})) AS mae,
         avg((label - last_v / {D100} * {D100}) * (label - last_v / {D100} * {D100})) AS mse, count(*) AS n_windows
  FROM e GROUP BY 1
),
cmp AS (
  SELECT n.sensor_id, {q4('n.mae')} AS new_mae, {q4('n.mse')} AS new_mse, {q4('o.mae')} AS old_mae,
         CASE WHEN n.mae < o.mae THEN 'BETTER' ELSE 'WORSE' END AS result
  FROM metrics n JOIN metrics o ON n.sensor_id = o.sensor_id AND n.model = '{NEW_MODEL.name}' AND o.model = '{OLD_MODEL.name}'
)"""
)


def _metrics(spark, sf_dir):
    return EV.evaluate_series(_series(spark, sf_dir), [NEW_MODEL, OLD_MODEL])


@query(
    "ml_evaluate",
    _EVAL_SQL + f"\nSELECT sensor_id, model, {q4('mae')} AS mae, {q4('mse')} AS mse, n_windows FROM metrics\n",
)
def ml_evaluate(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    return m.select("sensor_id", "model", F.round(F.col("mae").cast("decimal(38,9)"), 4).cast("double").alias("mae"),
                    F.round(F.col("mse").cast("decimal(38,9)"), 4).cast("double").alias("mse"), "n_windows")


def _comparison(spark, sf_dir):
    m = _metrics(spark, sf_dir)
    new, old = m.where(F.col("model") == NEW_MODEL.name), m.where(F.col("model") == OLD_MODEL.name)
    return EV.compare(new, old, feed.readings(spark, sf_dir).select("sensor_id"))


@query("ml_compare", _EVAL_SQL + "\nSELECT sensor_id, new_mae, old_mae, result FROM cmp\n")
def ml_compare(spark, sf_dir):
    return _comparison(spark, sf_dir).select("sensor_id", "new_mae", "old_mae", "result")


_REPORT_COLS = (
    "sensor_id, new_mae AS mae_value, 0.0 AS mae_std, new_mse AS mse_value, 0.0 AS mse_std, new_mae, old_mae, result"
)


def _report_out(back):
    return back.select(
        "sensor_id",
        F.col("r.regression_metrics.mae.value").alias("mae_value"),
        F.col("r.regression_metrics.mae.standard_deviation").alias("mae_std"),
        F.col("r.regression_metrics.mse.value").alias("mse_value"),
        F.col("r.regression_metrics.mse.standard_deviation").alias("mse_std"),
        F.col("r.comparison.new_mae").alias("new_mae"),
        F.col("r.comparison.old_mae").alias("old_mae"),
        F.col("r.comparison.result").alias("result"),
    )


@query("sink_eval_report", _EVAL_SQL + f"\nSELECT {_REPORT_COLS} FROM cmp\n")
def sink_eval_report(spark, sf_dir):
    path = scratch_path(spark, "eval_reports")
    RP.write_eval_report(EV.report(_comparison(spark, sf_dir)), path)
    return _report_out(RP.read_eval_report(spark, path))


def _report_store(spark, sf_dir) -> str:
    path = store_path(spark, "eval_reports", sf_dir)
    if not table_ready(spark, path):
        RP.write_eval_report(EV.report(_comparison(spark, sf_dir)), path)
    return path


@query("src_json_report", _EVAL_SQL + f"\nSELECT {_REPORT_COLS} FROM cmp\n")
def src_json_report(spark, sf_dir):
    return _report_out(RP.read_eval_report(spark, _report_store(spark, sf_dir)))


def _registry(spark, sf_dir):
    """Two registered packages per sensor: v1 (baseline, registered without
    metrics) and v2 (candidate, metrics = its evaluation report folder)."""
    root = _report_store(spark, sf_dir)
    sensors = feed.readings(spark, sf_dir).select("sensor_id").distinct()
    arn = lambda v: F.concat(F.lit("arn:slotcast:model-package/parking/"), F.col("sensor_id"), F.lit(f"/{v}"))
    packages = sensors.select(arn(1).alias("model_package_arn"), F.lit(None).cast("string").alias("metrics_uri")).unionByName(
        sensors.select(arn(2).alias("model_package_arn"), PM.normalize_uri(RP.report_uri(root, F.col("sensor_id"))).alias("metrics_uri"))
    )
    events = packages.select(
        F.to_json(F.struct(F.struct(F.col("model_package_arn").alias("ModelPackageArn")).alias("detail"))).alias("body")
    )
    reports = RP.read_eval_report(spark, root).select(PM.normalize_uri("report_uri").alias("report_uri"), "r")
    j = PM.join_reports(events, packages, reports)
    return j.withColumn("sensor_id", F.regexp_extract("model_package_arn", r"/parking/([^/]+)/", 1))


_REG_SQL = """,
reg AS (
  SELECT 'arn:slotcast:model-package/parking/' || sensor_id || '/1' AS model_package_arn, sensor_id,
         false AS has_report, 'UNKNOWN' AS result, NULL AS new_mae, NULL AS old_mae FROM cmp
  UNION ALL
  SELECT 'arn:slotcast:model-package/parking/' || sensor_id || '/2', sensor_id, true, result, new_mae, old_mae FROM cmp
)"""


@query("join_report_to_model", _EVAL_SQL + _REG_SQL + "\nSELECT model_package_arn, sensor_id, has_report, result FROM reg\n")
def join_report_to_model(spark, sf_dir):
    j = _registry(spark, sf_dir)
    return j.select(
        "model_package_arn", "sensor_id", F.col("r").isNotNull().alias("has_report"),
        F.coalesce(F.col("r.comparison.result"), F.lit("UNKNOWN")).alias("result"),
    )


@query(
    "promote_decision",
    _EVAL_SQL
    + _REG_SQL
    + """
SELECT model_package_arn, sensor_id, CASE WHEN result = 'BETTER' THEN 'Approved' ELSE 'Rejected' END AS status,
       CASE WHEN NOT has_report THEN 'Error: Report not found.'
            WHEN result = 'BETTER' THEN 'Auto-approved: Better Performance (' || CAST(new_mae AS VARCHAR) || ' < ' || CAST(old_mae AS VARCHAR) || ')'
            ELSE 'Auto-rejected: Worse Performance (' || CAST(new_mae AS VARCHAR) || ' >= ' || CAST(old_mae AS VARCHAR) || ')' END AS description
FROM reg
""",
)
def promote_decision(spark, sf_dir):
    return PM.decide(_registry(spark, sf_dir)).select("model_package_arn", "sensor_id", "status", "description")


def _gate_sql():
    from slotcast.catalog.q_drift import AS_OF, PAIRS, _status_sql

    base = PAIRS + _status_sql(AS_OF) + ","
    tail = (INDEXED + "," + TAIL + _train_sql("tail")).lstrip()
    return base + tail + f"""
SELECT {_DIGEST_COLS} FROM digest WHERE sensor_id IN (SELECT sensor_id FROM summ WHERE drift_count >= 3)
"""


@query("gate_retrain", _gate_sql())
def gate_retrain(spark, sf_dir):
    _, summary = _check(spark, sf_dir)
    drifted = summary.where(F.col("drift_detected")).select("sensor_id")
    # the gate comes first: no window is built for a sensor that isn't retrained
    return _digest_out(TR.training_set(feed.readings(spark, sf_dir).join(drifted, "sensor_id", "left_semi")))


@query("ml_fit_forecaster")
def ml_fit_forecaster(spark, sf_dir):
    """Fit from the second moments of the newest 70 % of the rows' windows; no window is built."""
    results, _ = fit_forecaster(spark, TR.indexed_rows(feed.readings(spark, sf_dir)))
    return results


_LAG_SQL = f"""
w AS (
  SELECT sensor_id, idx - floor(CAST(n_total AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.7 AS DOUBLE))) AS i,
         n_total - floor(CAST(n_total AS DOUBLE) * (CAST(1.0 AS DOUBLE) - CAST(0.7 AS DOUBLE))) - {C.N_STEPS} AS n_windows,
         CAST(car_count AS DOUBLE) / {D100} AS car, CAST(hour(ts) AS DOUBLE) / CAST(24.0 AS DOUBLE) AS hour
  FROM tail),
s AS (
  SELECT *, CASE WHEN i >= floor(n_windows * CAST(0.8 AS DOUBLE)) AND i < floor(n_windows * CAST(0.9 AS DOUBLE)) THEN 'valid' ELSE 'train' END AS part
  FROM w WHERE i < n_windows)
SELECT part, CAST(lag AS INTEGER) AS lag, count(*) AS n_windows,
       {q4('sum(s.car * w.car)')} AS car_car, {q4('sum(s.car * w.hour)')} AS car_hour,
       {q4('sum(s.hour * w.car)')} AS hour_car, {q4('sum(s.hour * w.hour)')} AS hour_hour,
       {q4('sum(w.car)')} AS car, {q4('sum(w.hour)')} AS hour
FROM s CROSS JOIN range({C.N_STEPS} + 1) AS r(lag) JOIN w ON w.sensor_id = s.sensor_id AND w.i = s.i + lag
GROUP BY 1, 2
"""


@query("ml_fit_statistics", with_(READINGS, INDEXED, TAIL) + "," + _LAG_SQL)
def ml_fit_statistics(spark, sf_dir):
    """What the fit starts from: products at every lag, summed over the window starts of each part of the split."""
    sums = fit_sums(TR.indexed_rows(feed.readings(spark, sf_dir))).where(F.col("kind") == "lag")
    p = lambda left, right: q4c(F.get("products", F.lit(left * 3 + right)))  # noqa: E731  of count, hour and 1
    return sums.select(
        "part", F.col("place").alias("lag"), F.get("products", F.lit(8)).cast("long").alias("n_windows"),
        p(0, 0).alias("car_car"), p(0, 1).alias("car_hour"), p(1, 0).alias("hour_car"), p(1, 1).alias("hour_hour"), p(2, 0).alias("car"), p(2, 1).alias("hour"),
    )


FIT_CUT = "2024-01-22"  # the model is fitted on readings before this day and evaluated on those from it on


@query("ml_evaluate_fitted")
def ml_evaluate_fitted(spark, sf_dir):
    """The fitted model against persistence and the training mean, on windows of days that the fit hasn't seen."""
    cut = F.lit(FIT_CUT).cast("date")
    readings = store.read_readings(spark, sf_dir)
    past = readings.where(F.col("date") < cut)
    _, model = fit_forecaster(spark, TR.indexed_rows(past))
    mean = past.agg(F.avg(F.col("car_count").cast("double"))).first()[0]
    models = [
        replace(model, name="fitted"),
        LinearModel.persistence(),
        LinearModel("constant", np.zeros(C.N_STEPS * 2), mean / C.CAR_MAX),
    ]
    later = regular_series(readings.where(F.col("date") >= cut))
    m = EV.evaluate_series(later, models)
    return m.select("sensor_id", "model", q4c("mae").alias("mae"), q4c("mse").alias("mse"), "n_windows")


# the newest buckets that a request carries, and those of one that carries too few
REQUEST_STEPS, SHORT_STEPS = 2 * C.SLOTS_PER_DAY, 100

_REQUEST_SQL = (
    with_(READINGS, RESAMPLED)
    + f""",
newest AS (SELECT *, max(bucket) OVER (PARTITION BY sensor_id) AS last_b FROM resampled),
long_r AS (SELECT sensor_id, bucket, CAST(CAST(car_count AS DECIMAL(28,10)) AS DOUBLE) AS car_count, n FROM newest
           WHERE bucket > last_b - INTERVAL {REQUEST_STEPS * C.STEP_MINUTES} MINUTE),"""
    + interp("long_r", "long_s")
    + f""",
short_n AS (SELECT sensor_id, count(*) AS n_records, CAST((epoch(max(bucket)) - epoch(min(bucket))) / 300 + 1 AS BIGINT) AS n_steps FROM newest
            WHERE bucket > last_b - INTERVAL {SHORT_STEPS * C.STEP_MINUTES} MINUTE GROUP BY 1),
lw AS (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY bucket DESC) AS r FROM long_s),
pick AS (SELECT sensor_id, CAST(round_even(greatest(0.0, car_count / {D100} * {D100}), 0) AS INTEGER) AS prediction
         FROM lw WHERE r = {C.N_STEPS} - ({C.N_STEPS - 1} + {C.SERVE_HORIZON} - {C.SLOTS_PER_DAY})),
size AS (SELECT sensor_id, least(count(*), {C.N_STEPS}) AS n_steps, max(bucket) AS last_b FROM long_s GROUP BY 1),
recs AS (SELECT sensor_id, count(*) AS n_records FROM long_r GROUP BY 1),
ok AS (
  SELECT sensor_id, CASE WHEN n_steps = {C.N_STEPS} THEN 'OK' ELSE 'NOT_ENOUGH_DATA' END AS status, n_records, n_steps,
         CASE WHEN n_steps = {C.N_STEPS} THEN '{{"predicted_car_count":' || prediction || ',"for_timestamp":"' ||
              {sec_text(f"last_b + INTERVAL {C.SERVE_HORIZON * C.STEP_MINUTES} MINUTE")} || '"}}' END AS response
  FROM size JOIN recs USING (sensor_id) LEFT JOIN pick USING (sensor_id))
SELECT kind || '-' || sensor_id AS payload_id, status, n_records, n_steps, response FROM ok, (VALUES ('json'), ('csv')) k(kind)
UNION ALL SELECT 'short-' || sensor_id, 'NOT_ENOUGH_DATA', n_records, n_steps, NULL FROM short_n
UNION ALL SELECT 'garbled-' || sensor_id, 'EMPTY', 0, 0, NULL FROM recs
UNION ALL SELECT 'other-' || sensor_id, 'NO_RECORDS', 0, 0, NULL FROM recs
UNION ALL SELECT 'xml-' || sensor_id, 'UNSUPPORTED_TYPE', 0, 0, NULL FROM recs
"""
)


def _requests(spark, sf_dir):
    """Requests of every kind for each sensor, made of its newest buckets."""
    r = resample_mean(feed.readings(spark, sf_dir))
    last = r.groupBy("sensor_id").agg(F.max("bucket").alias("last_b"))
    r = r.join(last, "sensor_id").withColumn("age", ((F.unix_timestamp("last_b") - F.unix_timestamp("bucket")) / C.STEP_SECONDS).cast("int"))
    rows = F.sort_array(F.collect_list(F.struct("bucket", "car_count", "age")))  # of two days at most
    s = r.where(F.col("age") < REQUEST_STEPS).groupBy("sensor_id").agg(rows.alias("rows"))
    record = lambda x, count: F.struct(count.alias("car_count"), fmt_day_first(x["bucket"]).alias("timestamp"))
    as_json = lambda of, count=lambda x: x["car_count"].cast("string"): F.to_json(F.transform(of, lambda x: record(x, count(x))))
    lines = F.array_join(F.transform("rows", lambda x: F.concat(F.date_format(x["bucket"], "yyyy-MM-dd'T'HH:mm:ss"), F.lit(","), x["car_count"].cast("string"))), "\n")
    kinds = {
        "json": ("application/json", as_json("rows")),
        "csv": ("text/csv", F.concat(F.lit("timestamp,car_count\n"), lines)),
        "short": ("application/json", as_json(F.filter("rows", lambda x: x["age"] < SHORT_STEPS))),
        "garbled": ("application/json", as_json("rows", lambda x: F.lit("many"))),
        "other": ("text/csv", F.concat(F.lit("time,cars\n"), lines)),
        "xml": ("application/xml", F.lit("<rows/>")),
    }
    entries = F.array(*(F.struct(F.concat(F.lit(f"{k}-"), "sensor_id").alias("payload_id"), F.lit(t).alias("content_type"), b.alias("body")) for k, (t, b) in kinds.items()))
    return s.select(F.explode(entries).alias("p")).select("p.*")


@query("job_score_requests", _REQUEST_SQL)
def job_score_requests(spark, sf_dir):
    """Payloads to forecasts: every request has a response or the reason why not."""
    return RQ.score_requests(_requests(spark, sf_dir))


#: A forecast whose result depends on the scaler: half of the last count and half of the same slot a day before the target, plus a tenth of the range.
def _blend() -> LinearModel:
    naive, last = LinearModel.seasonal_naive(C.EVAL_LEAD), LinearModel.persistence()
    return LinearModel("blend", (naive.weights + last.weights) / 2, 0.1)


def _parts(spark, sf_dir):
    """The series before the cut, which scalers and models are fitted on, and from it on."""
    r, cut = store.read_readings(spark, sf_dir), F.lit(FIT_CUT).cast("date")
    return r.where(F.col("date") < cut), regular_series(r.where(F.col("date") >= cut))


@query(
    "ml_evaluate_bundle",
    with_(READINGS)
    + f""",
past AS (SELECT * FROM readings WHERE ts < TIMESTAMP '{FIT_CUT} 00:00:00'),
past_r AS (SELECT sensor_id, time_bucket(INTERVAL '5 minutes', ts) AS bucket, CAST(SUM(car_count) AS DOUBLE) / COUNT(car_count) AS car_count FROM past GROUP BY 1, 2),
fit AS (SELECT sensor_id, min(car_count) AS lo, max(car_count) AS hi FROM past_r GROUP BY 1),
late_r AS (SELECT sensor_id, time_bucket(INTERVAL '5 minutes', ts) AS bucket, CAST(SUM(car_count) AS DOUBLE) / COUNT(car_count) AS car_count
           FROM readings WHERE ts >= TIMESTAMP '{FIT_CUT} 00:00:00' GROUP BY 1, 2),"""
    + interp("late_r", "late_s")
    + f""",
ev AS (
  SELECT sensor_id, car_count AS last_v, count(*) OVER w AS n, lag(car_count, {_NEW_LAG}) OVER o AS day_v, lead(car_count, {C.EVAL_LEAD}) OVER o AS label
  FROM late_s
  WINDOW w AS (PARTITION BY sensor_id ORDER BY bucket ROWS BETWEEN {C.N_STEPS - 1} PRECEDING AND CURRENT ROW), o AS (PARTITION BY sensor_id ORDER BY bucket)),
e AS (SELECT *, label - ((last_v + day_v) / 2 + 0.1 * (hi - lo)) AS off FROM ev JOIN fit USING (sensor_id) WHERE n = {C.N_STEPS} AND label IS NOT NULL)
SELECT sensor_id, CAST(2 AS BIGINT) AS version, 'blend' AS model, {q4('avg(abs(off))')} AS mae, {q4('avg(off * off)')} AS mse, count(*) AS n_windows FROM e GROUP BY 1
""",
)
def ml_evaluate_bundle(spark, sf_dir):
    """A stored bundle, the second version of two: its model scores days after the cut through scalers that were fitted before it."""
    past, later = _parts(spark, sf_dir)
    root = scratch_path(spark, "bundles")
    scaler = BU.fit_scaler(regular_series(past))
    for model in (LinearModel.persistence(), _blend()):
        BU.write_bundle(spark, root, model, scaler)
    bundle = BU.read_bundle(spark, root)
    m = BU.evaluate_bundle(later, bundle)
    return m.select("sensor_id", F.lit(bundle.version).cast("long").alias("version"), "model", q4c("mae").alias("mae"), q4c("mse").alias("mse"), "n_windows")


@query("promote_fitted")
def promote_fitted(spark, sf_dir):
    """The fitted model against persistence on days it hasn't seen, and what the promotion makes of it."""
    past, later = _parts(spark, sf_dir)
    _, model = fit_forecaster(spark, TR.indexed_rows(past))
    m = EV.evaluate_series(later, [replace(model, name="fitted"), LinearModel.persistence()])
    new, old = (m.where(F.col("model") == name) for name in ("fitted", "persistence"))
    compared = EV.compare(new, old, later.select("sensor_id"))
    joined = EV.report(compared).select(F.concat(F.lit("arn:slotcast:model-package/fitted/"), "sensor_id").alias("model_package_arn"), "sensor_id", F.col("report").alias("r"))
    out = PM.decide(joined).join(compared.select("sensor_id", "new_mae", "old_mae"), "sensor_id")
    return out.select("sensor_id", "model_package_arn", "new_mae", "old_mae", "result", "status", "description")
