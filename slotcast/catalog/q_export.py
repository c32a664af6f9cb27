"""Queries: CSV sinks and sources, master merge, daily export job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from slotcast.catalog.q_relational import EXPORT_DAY, FORECAST_LOOKBACK_HOURS, MASTER_CUT
from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import PREDICTIONS, READINGS, RESAMPLED, SERIES, date_text, with_
from slotcast.functions.timecols import fmt_date
from slotcast.plans.export import daily_export
from slotcast.session import scratch_path
from slotcast.sinks import exports as X
from slotcast.sources import store

DAY_FIRST = "'%d/%m/%Y %H:%M:%S'"

MASTER_SQL = """
master AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id, date_trunc('second', ts) ORDER BY ts DESC, ingest_seq DESC) AS rn
    FROM readings) WHERE rn = 1
)"""


def _actuals_out(df):
    return df.select(
        "sensor_id", fmt_date("date").alias("date"), F.col("car_count").cast("double").alias("car_count"), "timestamp"
    )


@query(
    "sink_daily_actuals",
    with_(READINGS)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, {DAY_FIRST}) AS timestamp FROM readings
""",
)
def sink_daily_actuals(spark, sf_dir):
    path = scratch_path(spark, "daily_actuals")
    X.write_daily_actuals(store.read_readings(spark, sf_dir), path)
    return _actuals_out(X.read_csv_or_empty(spark, path, X.ACTUALS_SCHEMA))


@query(
    "sink_daily_predictions",
    with_(READINGS, RESAMPLED, SERIES, PREDICTIONS)
    + f"""
SELECT sensor_id, {date_text('prediction_for')} AS date, prediction,
       strftime(prediction_for, {DAY_FIRST}) AS prediction_for FROM predictions
""",
)
def sink_daily_predictions(spark, sf_dir):
    path = scratch_path(spark, "daily_predictions")
    X.write_daily_predictions(store.read_predictions(spark, sf_dir), path)
    back = X.read_csv_or_empty(spark, path, X.PREDICTIONS_SCHEMA)
    return back.select("sensor_id", fmt_date("date").alias("date"), F.col("prediction").cast("int"), "prediction_for")


@query(
    "sink_master_merge",
    with_(READINGS, MASTER_SQL)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, {DAY_FIRST}) AS timestamp FROM master
""",
)
def sink_master_merge(spark, sf_dir):
    r = store.read_readings(spark, sf_dir)
    root = scratch_path(spark, "master")
    X.merge_master(spark, root, r.where(F.col("ts") < F.lit(MASTER_CUT).cast("timestamp_ntz")))
    X.merge_master(spark, root, r.where(F.col("date") == F.lit(EXPORT_DAY).cast("date")))
    return _actuals_out(X.read_csv_or_empty(spark, root, X.MASTER_SCHEMA))


@query(
    "job_daily_export",
    with_(READINGS, RESAMPLED, SERIES, PREDICTIONS, MASTER_SQL)
    + f""",
a AS (SELECT sensor_id, count(*) AS n_actuals FROM readings WHERE CAST(ts AS DATE) = DATE '{EXPORT_DAY}' GROUP BY 1),
f AS (SELECT sensor_id, count(*) AS n_forecasts FROM predictions
      WHERE timestamp BETWEEN TIMESTAMP '{EXPORT_DAY} 00:00:00' - INTERVAL {FORECAST_LOOKBACK_HOURS} HOUR
                          AND TIMESTAMP '{EXPORT_DAY} 23:59:59.999999'
        AND CAST(prediction_for AS DATE) = DATE '{EXPORT_DAY}' GROUP BY 1),
m AS (SELECT sensor_id, count(*) AS n_master FROM master GROUP BY 1)
SELECT m.sensor_id, coalesce(n_actuals, 0) AS n_actuals, coalesce(n_forecasts, 0) AS n_forecasts, n_master
FROM m LEFT JOIN a USING (sensor_id) LEFT JOIN f USING (sensor_id)
""",
)
def job_daily_export(spark, sf_dir):
    r = store.read_readings(spark, sf_dir)
    p = store.read_predictions(spark, sf_dir)
    roots = {k: scratch_path(spark, k) for k in ("actuals", "predictions", "master")}
    X.merge_master(spark, roots["master"], r.where(F.col("date") < F.lit(EXPORT_DAY).cast("date")))
    as_of = (dt.date.fromisoformat(EXPORT_DAY) + dt.timedelta(days=1)).isoformat()
    daily_export(spark, r, p, as_of, roots["actuals"], roots["predictions"], roots["master"], FORECAST_LOOKBACK_HOURS)
    a = X.read_csv_or_empty(spark, roots["actuals"], X.ACTUALS_SCHEMA).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_actuals")
    )
    f = X.read_csv_or_empty(spark, roots["predictions"], X.PREDICTIONS_SCHEMA).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_forecasts")
    )
    m = X.read_csv_or_empty(spark, roots["master"], X.MASTER_SCHEMA).groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_master")
    )
    j = m.join(a, "sensor_id", "left").join(f, "sensor_id", "left")
    return j.select(
        "sensor_id",
        F.coalesce("n_actuals", F.lit(0)).alias("n_actuals"),
        F.coalesce("n_forecasts", F.lit(0)).alias("n_forecasts"),
        "n_master",
    )


CSV_DATES = [(dt.date(2024, 1, 25) + dt.timedelta(days=i)).isoformat() for i in range(7)]  # 25..31 January


@query(
    "src_csv_or_empty",
    with_(READINGS)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, {DAY_FIRST}) AS timestamp FROM readings
WHERE CAST(ts AS DATE) BETWEEN DATE '{CSV_DATES[0]}' AND DATE '{CSV_DATES[-1]}'
""",
)
def src_csv_or_empty(spark, sf_dir):
    root = store.actuals_export(spark, sf_dir)
    return _actuals_out(X.read_csv_or_empty(spark, root, X.ACTUALS_SCHEMA, CSV_DATES))


@query(
    "src_csv_dir",
    with_(READINGS, MASTER_SQL)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, {DAY_FIRST}) AS timestamp FROM master
""",
)
def src_csv_dir(spark, sf_dir):
    root = store.master_export(spark, sf_dir)
    return _actuals_out(X.read_csv_or_empty(spark, root, X.MASTER_SCHEMA))
