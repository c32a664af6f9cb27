"""JSON report sinks (drift, evaluation) and their readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import schemas


def write_drift_report(summary: DataFrame, path: str) -> None:
    """One JSON document per sensor: drift_detected, drift_count, details
    (date -> {mae, status}), check_timestamp.  One JSON line per sensor: the
    sensor and the document."""
    doc = F.to_json(F.struct("drift_detected", "drift_count", "details", "check_timestamp"))
    summary.select("sensor_id", doc.alias("value")).write.mode("overwrite").json(path)


def read_drift_report(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("sensor_id string, value string").json(path)
    return raw.select("sensor_id", F.from_json("value", schemas.DRIFT_REPORT).alias("r")).select("sensor_id", "r.*")


def eval_report_struct(new_mae, new_mse, old_mae, result) -> F.Column:
    metric = lambda v: F.struct(v.alias("value"), F.lit(0.0).alias("standard_deviation"))
    return F.struct(
        F.struct(metric(new_mae).alias("mae"), metric(new_mse).alias("mse")).alias("regression_metrics"),
        F.struct(new_mae.alias("new_mae"), old_mae.alias("old_mae"), result.alias("result")).alias("comparison"),
    )


def write_eval_report(reports: DataFrame, path: str, key: str = "sensor_id") -> None:
    """``reports`` has ``key`` and a ``report`` struct; one JSON line per key: the key and the document."""
    reports.select(key, F.to_json("report").alias("value")).write.mode("overwrite").json(path)


def report_uri(path: str, key_value: F.Column, key: str = "sensor_id") -> F.Column:
    """The name under which a key's report is registered."""
    return F.concat(F.lit(f"{path}/{key}="), key_value)


def read_eval_report(spark: SparkSession, path: str, key: str = "sensor_id") -> DataFrame:
    raw = spark.read.schema(f"{key} string, value string").json(path)
    return raw.select(key, report_uri(path, F.col(key), key).alias("report_uri"), F.from_json("value", schemas.EVAL_REPORT).alias("r"))

