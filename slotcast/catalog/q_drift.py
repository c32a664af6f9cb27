"""Queries: day profiles, slot joins, errors, drift status and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import (
    PREDICTIONS,
    READINGS,
    RESAMPLED,
    SERIES,
    date_text,
    day_profile_sql,
    q4,
    resample_sql,
    interp,
    with_,
)
from slotcast.functions.numeric import q4 as q4c
from slotcast.functions.timecols import fmt_date, slot_of_day
from slotcast.operators import profile as PR
from slotcast.operators.series import interpolate_time, resample_mean
from slotcast.plans import drift as D
from slotcast.session import scratch_path
from slotcast.sinks import exports as X
from slotcast.sinks import reports
from slotcast.sources import store

AS_OF = "2024-01-31"
PAIRS_AS_OF = "2024-02-01"  # window 25..31 January: the 31st has forecasts but no actuals
THRESHOLD = 40.0  # splits days of the test data into both outcomes (library default: 10.0)
CHECK_TS = "2024-01-31T00:00:00"


def _actuals(spark, sf_dir):
    """Readings table, partitioned by the date of ``ts``: a date window prunes."""
    return store.read_readings(spark, sf_dir)


def _forecasts(spark, sf_dir):
    """Forecast table, partitioned by the date of ``prediction_for``."""
    return store.read_predictions(spark, sf_dir)


BASE = with_(READINGS, RESAMPLED, SERIES, PREDICTIONS)
PROFILES = (
    BASE
    + ","
    + day_profile_sql("readings", "pa", "ts", "car_count")
    + ","
    + day_profile_sql("predictions", "pp", "prediction_for", "prediction")
)
PAIRS = (
    PROFILES
    + """,
pairs AS (
  SELECT a.sensor_id, a.date, a.slot, a.car_count AS actual, p.prediction AS predicted
  FROM pa a JOIN pp p ON a.sensor_id = p.sensor_id AND a.date = p.date AND a.slot = p.slot
),
errs AS (
  SELECT sensor_id, date, avg(abs(actual - predicted)) AS mae, avg((actual - predicted) * (actual - predicted)) AS mse
  FROM pairs GROUP BY 1, 2
)"""
)


def _status_sql(as_of: str) -> str:
    return f""",
grid AS (
  SELECT s.sensor_id, CAST(d AS DATE) AS date
  FROM (SELECT DISTINCT sensor_id FROM readings UNION SELECT DISTINCT sensor_id FROM predictions) s,
       generate_series(DATE '{as_of}' - INTERVAL 7 DAY, DATE '{as_of}' - INTERVAL 1 DAY, INTERVAL 1 DAY) g(d)
),
ac AS (SELECT sensor_id, CAST(ts AS DATE) AS date, count(*) AS n FROM readings GROUP BY 1, 2),
pc AS (SELECT sensor_id, CAST(prediction_for AS DATE) AS date, count(*) AS n FROM predictions GROUP BY 1, 2),
dp AS (
  SELECT g.sensor_id, g.date, coalesce(ac.n, 0) AS n_actual, coalesce(pc.n, 0) AS n_pred,
         CASE WHEN coalesce(ac.n, 0) = 0 OR coalesce(pc.n, 0) = 0 THEN 'MISSING_DATA' ELSE 'PAIRED' END AS pair_state
  FROM grid g LEFT JOIN ac ON ac.sensor_id = g.sensor_id AND ac.date = g.date
              LEFT JOIN pc ON pc.sensor_id = g.sensor_id AND pc.date = g.date
),
st AS (
  SELECT dp.sensor_id, dp.date, CASE WHEN pair_state = 'PAIRED' THEN e.mae END AS mae,
         CASE WHEN pair_state <> 'PAIRED' THEN pair_state WHEN e.mae > {THRESHOLD} THEN 'DRIFT' ELSE 'OK' END AS status
  FROM dp LEFT JOIN errs e ON e.sensor_id = dp.sensor_id AND e.date = dp.date
),
summ AS (
  SELECT sensor_id, CAST(count_if(status = 'DRIFT') AS INTEGER) AS drift_count,
         CAST(count_if(status = 'OK') AS INTEGER) AS ok_count,
         CAST(count_if(status = 'MISSING_DATA') AS INTEGER) AS missing_count,
         CAST(count_if(status = 'ERROR') AS INTEGER) AS error_count
  FROM st GROUP BY 1
)"""


@query(
    "join_slot_calendar",
    with_(READINGS, resample_sql("readings", "ra", "ts", "car_count"), interp("ra", "ia", "sensor_id, date"))
    + f""",
k AS (SELECT DISTINCT sensor_id, date FROM ia),
cal AS (SELECT sensor_id, date, UNNEST(range(0, 288)) AS slot FROM k)
SELECT c.sensor_id, {date_text('c.date')} AS date, CAST(c.slot AS INTEGER) AS slot, i.car_count
FROM cal c LEFT JOIN ia i ON i.sensor_id = c.sensor_id AND i.date = c.date
 AND hour(i.bucket) * 12 + minute(i.bucket) // 5 = c.slot
""",
)
def join_slot_calendar(spark, sf_dir):
    r = resample_mean(_actuals(spark, sf_dir))
    day = interpolate_time(r, across_days=False)
    per_slot = day.select("sensor_id", "date", slot_of_day("bucket").alias("slot"), "car_count")
    cal = PR.slot_calendar(per_slot)
    return cal.select("sensor_id", fmt_date("date").alias("date"), F.col("slot").cast("int"), "car_count")


@query(
    "win_ffill_bfill",
    with_(READINGS, day_profile_sql("readings", "pa", "ts", "car_count"))
    + f"""
SELECT sensor_id, {date_text('date')} AS date, CAST(slot AS INTEGER) AS slot, car_count FROM pa
""",
)
def win_ffill_bfill(spark, sf_dir):
    prof = PR.day_profile(_actuals(spark, sf_dir))
    return prof.select("sensor_id", fmt_date("date").alias("date"), F.col("slot").cast("int"), "car_count")


@query(
    "job_day_profile",
    BASE
    + ","
    + day_profile_sql("predictions", "pp", "prediction_for", "prediction")
    + f"""
SELECT sensor_id, {date_text('date')} AS date, CAST(slot AS INTEGER) AS slot, prediction FROM pp
""",
)
def job_day_profile(spark, sf_dir):
    prof = PR.day_profile(_forecasts(spark, sf_dir), "prediction", "prediction_for")
    return prof.select("sensor_id", fmt_date("date").alias("date"), F.col("slot").cast("int"), "prediction")


def _pairs(spark, sf_dir):
    pa = PR.day_profile(_actuals(spark, sf_dir))
    pp = PR.day_profile(_forecasts(spark, sf_dir), "prediction", "prediction_for")
    return D.slot_pairs(pa, pp)


@query(
    "join_slot_actual_pred",
    PAIRS
    + f"""
SELECT sensor_id, {date_text('date')} AS date, CAST(slot AS INTEGER) AS slot, actual, predicted,
       {q4('abs(actual - predicted)')} AS abs_error
FROM pairs
""",
)
def join_slot_actual_pred(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select(
        "sensor_id",
        fmt_date("date").alias("date"),
        F.col("slot").cast("int"),
        "actual",
        "predicted",
        q4c(F.abs(F.col("actual") - F.col("predicted"))).alias("abs_error"),
    )


@query(
    "agg_mae",
    PAIRS + f"\nSELECT sensor_id, {date_text('date')} AS date, {q4('mae')} AS mae FROM errs\n",
)
def agg_mae(spark, sf_dir):
    e = D.day_errors(_pairs(spark, sf_dir))
    return e.select("sensor_id", fmt_date("date").alias("date"), q4c("mae").alias("mae"))


@query(
    "agg_mse",
    PAIRS + f"\nSELECT sensor_id, {date_text('date')} AS date, {q4('mse')} AS mse FROM errs\n",
)
def agg_mse(spark, sf_dir):
    e = D.day_errors(_pairs(spark, sf_dir))
    return e.select("sensor_id", fmt_date("date").alias("date"), q4c("mse").alias("mse"))


def _check(spark, sf_dir, as_of=AS_OF):
    sensors = store.readings_dates(spark, sf_dir)  # every sensor, also those without rows in the look-back
    actuals, forecasts = store.actuals_export(spark, sf_dir), store.predictions_export(spark, sf_dir)
    return D.check_exports(spark, actuals, forecasts, sensors, as_of, THRESHOLD, check_timestamp=CHECK_TS)


@query(
    "join_day_pairs",
    PAIRS
    + _status_sql(PAIRS_AS_OF)
    + f"""
SELECT sensor_id, {date_text('date')} AS date, n_actual, n_pred, pair_state FROM dp
""",
)
def join_day_pairs(spark, sf_dir):
    a, p = _actuals(spark, sf_dir), _forecasts(spark, sf_dir)
    grid = D.day_grid(a.select("sensor_id").unionByName(p.select("sensor_id")), PAIRS_AS_OF)
    pairs = D.pair_days(grid, D.day_counts(a, "ts", "car_count"), D.day_counts(p, "prediction_for", "prediction"))
    return pairs.select("sensor_id", fmt_date("date").alias("date"), "n_actual", "n_pred", "pair_state")


@query(
    "drift_day_status",
    PAIRS
    + _status_sql(AS_OF)
    + f"""
SELECT sensor_id, {date_text('date')} AS date, {q4('mae')} AS mae, status FROM st
""",
)
def drift_day_status(spark, sf_dir):
    st, _ = _check(spark, sf_dir)
    return st.select("sensor_id", fmt_date("date").alias("date"), q4c("mae").alias("mae"), "status")


# damaged exports: one sensor's day without a readable count, one without any line, one with some lines cut short
UNREADABLE, ABSENT, CUT = ("click", "2024-01-27"), ("error", "2024-01-26"), ("view", "2024-01-28")


def _day(at: tuple[str, str], date: str) -> str:
    return f"(sensor_id = '{at[0]}' AND CAST({date} AS DATE) = DATE '{at[1]}')"


_DAMAGED_SQL = (
    BASE
    + f""",
lines AS (SELECT * FROM readings WHERE NOT {_day(ABSENT, 'ts')}),
usable AS (SELECT * FROM lines WHERE NOT {_day(UNREADABLE, 'ts')} AND NOT ({_day(CUT, 'ts')} AND ingest_seq % 3 = 0)),"""
    + day_profile_sql("usable", "pa", "ts", "car_count")
    + ","
    + day_profile_sql("predictions", "pp", "prediction_for", "prediction")
    + f""",
errs AS (SELECT a.sensor_id, a.date, avg(abs(a.car_count - p.prediction)) AS mae
         FROM pa a JOIN pp p ON a.sensor_id = p.sensor_id AND a.date = p.date AND a.slot = p.slot GROUP BY 1, 2),
grid AS (SELECT s.sensor_id, CAST(d AS DATE) AS date FROM (SELECT DISTINCT sensor_id FROM readings) s,
         generate_series(DATE '{PAIRS_AS_OF}' - INTERVAL 7 DAY, DATE '{PAIRS_AS_OF}' - INTERVAL 1 DAY, INTERVAL 1 DAY) g(d)),
n AS (SELECT sensor_id, CAST(ts AS DATE) AS date, count(*) AS n FROM lines GROUP BY 1, 2),
u AS (SELECT sensor_id, CAST(ts AS DATE) AS date, count(*) AS n FROM usable GROUP BY 1, 2),
f AS (SELECT sensor_id, CAST(prediction_for AS DATE) AS date, count(*) AS n FROM predictions GROUP BY 1, 2)
SELECT sensor_id, {date_text('date')} AS date, coalesce(n.n, 0) AS n_lines,
       CASE WHEN n.n IS NULL OR f.n IS NULL OR u.n IS NULL THEN NULL ELSE {q4('mae')} END AS mae,
       CASE WHEN n.n IS NULL OR f.n IS NULL THEN 'MISSING_DATA' WHEN u.n IS NULL THEN 'ERROR' WHEN mae > {THRESHOLD} THEN 'DRIFT' ELSE 'OK' END AS status
FROM grid LEFT JOIN n USING (sensor_id, date) LEFT JOIN u USING (sensor_id, date) LEFT JOIN f USING (sensor_id, date) LEFT JOIN errs USING (sensor_id, date)
"""
)


@query("drift_damaged_exports", _DAMAGED_SQL)
def drift_damaged_exports(spark, sf_dir):
    """Days whose exports are absent, unreadable or damaged in part, beside whole ones: every outcome, and no failed job."""
    lines = X.daily_lines(store.read_readings(spark, sf_dir).where(f"NOT {_day(ABSENT, 'ts')}"))
    third = F.expr(f"{_day(CUT, 'date')}") & F.col("cut")
    seq = store.read_readings(spark, sf_dir).select("sensor_id", F.col("ts").alias("_order"), (F.col("ingest_seq") % 3 == 0).alias("cut"))
    lines = lines.join(seq, ["sensor_id", "_order"])
    lines = lines.withColumns({
        "car_count": F.when(F.expr(_day(UNREADABLE, "date")), F.lit("n/a")).otherwise(F.col("car_count")),
        "timestamp": F.when(third, F.lit("31/02/2024 25:61")).otherwise(F.col("timestamp")),
    }).select("car_count", "timestamp", "sensor_id", "date", "_order")
    root = scratch_path(spark, "damaged_actuals")
    X.write_lines(lines, root)
    st, _ = D.check_exports(spark, root, store.predictions_export(spark, sf_dir), store.readings_dates(spark, sf_dir), PAIRS_AS_OF, THRESHOLD)
    return st.select("sensor_id", fmt_date("date").alias("date"), F.col("n_actual").alias("n_lines"), q4c("mae").alias("mae"), "status")


@query(
    "agg_drift_count",
    PAIRS + _status_sql(AS_OF) + "\nSELECT sensor_id, drift_count, drift_count >= 3 AS drift_detected FROM summ\n",
)
def agg_drift_count(spark, sf_dir):
    _, s = _check(spark, sf_dir)
    return s.select("sensor_id", "drift_count", "drift_detected")


@query(
    "job_drift_check",
    PAIRS
    + _status_sql(AS_OF)
    + f"""
SELECT sensor_id, drift_count >= 3 AS drift_detected, drift_count, ok_count, missing_count, error_count,
       '{CHECK_TS}' AS check_timestamp
FROM summ
""",
)
def job_drift_check(spark, sf_dir):
    _, s = _check(spark, sf_dir)
    return s.select("sensor_id", "drift_detected", "drift_count", "ok_count", "missing_count", "error_count", "check_timestamp")


@query(
    "sink_drift_report",
    PAIRS
    + _status_sql(AS_OF)
    + f"""
SELECT st.sensor_id, summ.drift_count >= 3 AS drift_detected, summ.drift_count, '{CHECK_TS}' AS check_timestamp,
       {date_text('st.date')} AS date, {q4('mae', 2)} AS mae, status
FROM st JOIN summ USING (sensor_id)
""",
)
def sink_drift_report(spark, sf_dir):
    _, s = _check(spark, sf_dir)
    path = scratch_path(spark, "drift_report")
    reports.write_drift_report(s, path)
    back = reports.read_drift_report(spark, path)
    return back.select(
        "sensor_id",
        "drift_detected",
        "drift_count",
        "check_timestamp",
        F.explode("details").alias("date", "d"),
    ).select("sensor_id", "drift_detected", "drift_count", "check_timestamp", "date", F.col("d.mae").alias("mae"), F.col("d.status").alias("status"))
