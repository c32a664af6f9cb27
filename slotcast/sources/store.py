"""Date-partitioned Parquet tables of readings and forecasts.

The keyed store of the source system (key = sensor_id + timestamp) becomes a
Parquet table partitioned by ``date``; rows are
rebalanced by (date, sensor_id), which lets Spark size the files and split a
hot sensor-day, and sorted, so that each file's min/max statistics let
``sensor_id`` / ``ts`` filters skip row groups.  Beside the readings lies the small
table of each sensor's dates (``operators.edges``).  Tables are written once per input folder under the shared folder and
reused (``_SUCCESS`` marks a finished write)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import session as SS
from slotcast.operators.edges import sensor_dates
from slotcast.operators.series import regular_series
from slotcast.plans.forecast import seasonal_naive
from slotcast.sources import feed


def write_partitioned(df: DataFrame, path: str, ts: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    out = df.withColumn("date", F.to_date(ts)) if "date" not in df.columns else df
    (
        out.hint("rebalance", "date", "sensor_id")
        .sortWithinPartitions("date", "sensor_id", ts)
        .write.mode(mode)
        .partitionBy("date")
        .format(fmt)
        .save(path)
    )


def _materialized(spark: SparkSession, name: str, sf_dir: str, build) -> str:
    path = SS.store_path(spark, name, sf_dir)
    if not SS.table_ready(spark, path):
        write_partitioned(build(), path, ts=_TS[name])
    return path


_TS = {"readings": "ts", "predictions": "prediction_for"}  # forecasts live in the partition of their target date


def readings_table(spark: SparkSession, sf_dir: str) -> str:
    return _materialized(spark, "readings", sf_dir, lambda: feed.readings(spark, sf_dir))


def predictions_table(spark: SparkSession, sf_dir: str) -> str:
    def build():
        return seasonal_naive(regular_series(feed.readings(spark, sf_dir)))

    return _materialized(spark, "predictions", sf_dir, build)


def read_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(readings_table(spark, sf_dir))


def readings_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sensor_dates`` of the readings table (written once, reused)."""
    path = SS.store_path(spark, "reading_dates", sf_dir)
    if not SS.table_ready(spark, path):
        sensor_dates(read_readings(spark, sf_dir)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(predictions_table(spark, sf_dir))


def actuals_export(spark: SparkSession, sf_dir: str) -> str:
    """Daily actuals CSV export of every day (written once, reused)."""
    from slotcast.sinks.exports import write_daily_actuals

    path = SS.store_path(spark, "daily_actuals", sf_dir)
    if not SS.table_ready(spark, path):
        write_daily_actuals(read_readings(spark, sf_dir), path)
    return path


def predictions_export(spark: SparkSession, sf_dir: str) -> str:
    from slotcast.sinks.exports import write_daily_predictions

    path = SS.store_path(spark, "daily_predictions", sf_dir)
    if not SS.table_ready(spark, path):
        write_daily_predictions(read_predictions(spark, sf_dir), path)
    return path


def master_export(spark: SparkSession, sf_dir: str) -> str:
    """Master history of every day (one merge of all readings)."""
    from slotcast.sinks.exports import merge_master

    path = SS.store_path(spark, "master", sf_dir)
    if not SS.table_ready(spark, path):
        merge_master(spark, path, read_readings(spark, sf_dir))
    return path
