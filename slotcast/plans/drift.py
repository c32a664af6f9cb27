"""Drift check: per-day MAE between the actual and the forecast day profiles.

One job covers every sensor and every day of the look-back at once: the
(sensor, date) grid is generated with ``sequence`` over the look-back, both
sides are left-joined on (sensor_id, date), and all profile work is keyed by
(sensor_id, date) (at most 288 rows per key)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.functions.numeric import exact_mean
from slotcast.functions.timecols import bucket_floor
from slotcast.operators.profile import profile_of_buckets
from slotcast.sources.day_files import read_actual_days, read_forecast_days


def _d(x) -> dt.date:
    return x if isinstance(x, dt.date) else dt.date.fromisoformat(str(x))


def day_grid(sensors: DataFrame, as_of, days: int = C.DRIFT_DAYS) -> DataFrame:
    """(sensor_id, date) for the ``days`` dates before ``as_of``."""
    d = _d(as_of)
    first = (d - dt.timedelta(days=days)).isoformat()
    last = (d - dt.timedelta(days=1)).isoformat()
    return sensors.select("sensor_id").distinct().select(
        "sensor_id", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )


def day_counts(df: DataFrame, ts: str, value: str, date_col: str = "date") -> DataFrame:
    """Rows per (sensor, date) before cleaning, and rows with a parseable time
    and value (``date`` comes from the file partition when reading exports)."""
    return df.groupBy("sensor_id", date_col).agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count(F.when(F.col(ts).isNotNull() & F.col(value).isNotNull(), 1)).alias("n_clean"),
    )


def pair_days(grid: DataFrame, actual_counts: DataFrame, pred_counts: DataFrame) -> DataFrame:
    """Left-join both sides' day counts onto the grid; either side missing ->
    MISSING_DATA, rows but none parseable -> ERROR, else PAIRED."""
    a = actual_counts.select("sensor_id", "date", F.col("n_raw").alias("n_actual"), F.col("n_clean").alias("n_actual_clean"))
    p = pred_counts.select("sensor_id", "date", F.col("n_raw").alias("n_pred"), F.col("n_clean").alias("n_pred_clean"))
    j = grid.join(a, ["sensor_id", "date"], "left").join(p, ["sensor_id", "date"], "left")
    na, np_ = F.coalesce(F.col("n_actual"), F.lit(0)), F.coalesce(F.col("n_pred"), F.lit(0))
    state = (
        F.when((na == 0) | (np_ == 0), F.lit("MISSING_DATA"))
        .when((F.col("n_actual_clean") == 0) | (F.col("n_pred_clean") == 0), F.lit("ERROR"))
        .otherwise(F.lit("PAIRED"))
    )
    return j.select("sensor_id", "date", na.alias("n_actual"), np_.alias("n_pred"), state.alias("pair_state"))


def slot_pairs(actual: DataFrame, pred: DataFrame) -> DataFrame:
    """Pair the two profiles slot by slot (1:1 on sensor, date, slot)."""
    a = actual.select("sensor_id", "date", "slot", F.col("car_count").alias("actual"))
    p = pred.select("sensor_id", "date", "slot", F.col("prediction").alias("predicted"))
    return a.join(p, ["sensor_id", "date", "slot"], "inner")


def day_errors(pairs: DataFrame) -> DataFrame:
    """MAE and MSE per (sensor, date) over the 288 slots."""
    e = F.col("actual") - F.col("predicted")
    return pairs.groupBy("sensor_id", "date").agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.count(F.lit(1)).alias("n_slots")
    )


def day_status(pairs_by_day: DataFrame, errors: DataFrame, threshold: float) -> DataFrame:
    """DRIFT when MAE > threshold (strict), OK otherwise; MISSING_DATA / ERROR
    from the day pairing (their MAE is NULL)."""
    j = pairs_by_day.join(errors.select("sensor_id", "date", "mae"), ["sensor_id", "date"], "left")
    paired = F.col("pair_state") == "PAIRED"
    status = (
        F.when(~paired, F.col("pair_state"))
        .when(F.col("mae") > F.lit(float(threshold)), F.lit("DRIFT"))
        .otherwise(F.lit("OK"))
    )
    return j.select(
        "sensor_id", "date", F.when(paired, F.col("mae")).alias("mae"), status.alias("status"), "n_actual", "n_pred"
    )


def drift_summary(statuses: DataFrame, trigger_days: int = C.DRIFT_TRIGGER_DAYS, check_timestamp=None) -> DataFrame:
    """Per sensor: DRIFT day count, decision (count >= trigger), the details
    map date -> {mae rounded to 2 places, status}, and the check time."""
    ts = F.current_timestamp().cast("timestamp_ntz") if check_timestamp is None else F.lit(check_timestamp).cast("timestamp_ntz")
    detail = F.struct(
        F.round(F.col("mae").cast("decimal(38,9)"), 2).cast("double").alias("mae"), F.col("status").alias("status")
    )
    out = statuses.groupBy("sensor_id").agg(
        F.count_if(F.col("status") == "DRIFT").cast("int").alias("drift_count"),
        F.count_if(F.col("status") == "OK").cast("int").alias("ok_count"),
        F.count_if(F.col("status") == "MISSING_DATA").cast("int").alias("missing_count"),
        F.count_if(F.col("status") == "ERROR").cast("int").alias("error_count"),
        F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyy-MM-dd"), detail))).alias("details"),
    )
    return out.withColumn("drift_detected", F.col("drift_count") >= trigger_days).withColumn(
        "check_timestamp", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    )


def check_drift(
    actuals: DataFrame,
    predictions: DataFrame,
    as_of,
    threshold: float = C.DRIFT_THRESHOLD_REFERENCE,
    days: int = C.DRIFT_DAYS,
    trigger_days: int = C.DRIFT_TRIGGER_DAYS,
    check_timestamp=None,
    sensors: DataFrame | None = None,
):
    """Full drift check from clean-or-raw actuals (sensor_id, ts, car_count,
    date) and forecasts (sensor_id, prediction_for, prediction, date).

    ``sensors`` (a sensor registry, or the table of each sensor's dates) fixes
    the sensors reported; by default they are all that ever had a row on
    either side (a scan of the sensor columns).  A silent sensor has its
    MISSING_DATA days like any other.

    Returns ``(statuses, summary)``."""
    d = _d(as_of)
    lo, hi = d - dt.timedelta(days=days), d - dt.timedelta(days=1)
    in_window_a = actuals.where(F.col("date").between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date")))
    in_window_p = predictions.where(
        F.col("date").between(F.lit(lo.isoformat()).cast("date"), F.lit(hi.isoformat()).cast("date"))
    )
    if sensors is None:
        sensors = actuals.select("sensor_id").unionByName(predictions.select("sensor_id"))
    return _checked(in_window_a, in_window_p, sensors, d, threshold, days, trigger_days, check_timestamp)


def day_buckets(rows: DataFrame, value: str, ts: str) -> DataFrame:
    """(sensor_id, date, bucket, mean, n_raw, n): one aggregate of which both the day's counts and its profile come; rows that
    can't be used lie in a bucket of their own (null) of their date."""
    ok = F.col(ts).isNotNull() & F.col(value).isNotNull()
    bucket = bucket_floor(F.when(ok, F.col(ts)))
    return rows.groupBy("sensor_id", "date", bucket.alias("bucket")).agg(
        exact_mean(F.when(ok, F.col(value))).alias(value), F.count(F.lit(1)).alias("n_raw"), F.count_if(ok).alias("n")
    )


def _checked(actuals: DataFrame, predictions: DataFrame, sensors: DataFrame, as_of, threshold: float, days: int, trigger_days: int, check_timestamp):
    """Statuses and summary of rows of the look-back; each side is read and aggregated once."""
    sides = [day_buckets(actuals, "car_count", "ts"), day_buckets(predictions, "prediction", "prediction_for")]
    counts = [x.groupBy("sensor_id", "date").agg(F.sum("n_raw").alias("n_raw"), F.sum("n").alias("n_clean")) for x in sides]
    pairs = pair_days(day_grid(sensors, as_of, days), *counts)
    profiles = [profile_of_buckets(x.where("n > 0"), v) for x, v in zip(sides, ("car_count", "prediction"), strict=True)]
    statuses = day_status(pairs, day_errors(slot_pairs(*profiles)), threshold)
    return statuses, drift_summary(statuses, trigger_days, check_timestamp)


def check_exports(
    spark: SparkSession,
    actuals_root: str,
    predictions_root: str,
    sensors: DataFrame,
    as_of,
    threshold: float = C.DRIFT_THRESHOLD_REFERENCE,
    days: int = C.DRIFT_DAYS,
    trigger_days: int = C.DRIFT_TRIGGER_DAYS,
    check_timestamp=None,
):
    """The drift check from the exported days of both sides; only the folders of the look-back are read.

    A sensor-day without lines is MISSING_DATA, one with lines none of which can be read is ERROR, and neither fails the job;
    of other days the readable lines count.  ``sensors`` is a registry or the table of each sensor's dates.
    Returns ``(statuses, summary)``."""
    d = _d(as_of)
    dates = [d - dt.timedelta(days=i) for i in range(1, days + 1)]
    actual, forecast = read_actual_days(spark, actuals_root, dates), read_forecast_days(spark, predictions_root, dates)
    readable = lambda rows, c: rows.withColumn(c, F.when(F.col("ok"), F.col(c)))
    return _checked(readable(actual, "ts"), readable(forecast, "prediction_for"), sensors, d, threshold, days, trigger_days, check_timestamp)
