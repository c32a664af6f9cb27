"""CSV exports with a folder per date, and the master history.

Writes use dynamic partition overwrite: re-exporting a day replaces only that
day's folder.  The sensor is a column, so the number of folders is that of the
days, not of sensors x days.  Rows are rebalanced by (date, sensor), which lets
Spark size the files and split a hot sensor-day, and each file is sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast import config as C
from slotcast import session as SS
from slotcast.functions.numeric import coerce_count, count_text
from slotcast.functions.timecols import fmt_day_first, parse_day_first
from slotcast.operators.dedup import keep_last

ACTUALS_SCHEMA = T.StructType(
    [
        T.StructField("car_count", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)
PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("prediction", T.StringType()),
        T.StructField("prediction_for", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)
MASTER_SCHEMA = ACTUALS_SCHEMA


def _write_csv(df: DataFrame, path: str, order_col: str) -> None:
    (
        df.hint("rebalance", "date", "sensor_id")
        .sortWithinPartitions("date", "sensor_id", order_col)
        .drop(order_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("date")
        .csv(path)
    )
    SS.mark_ready(df.sparkSession, path)


def write_daily_actuals(readings: DataFrame, path: str) -> None:
    """Per date: ``car_count, timestamp`` (dd/MM/yyyy HH:mm:ss) and the sensor,
    time-sorted, no dedup; the folders of the dates in ``readings`` are overwritten,
    so it must hold all sensors of a date."""
    _write_csv(daily_lines(readings), path, "_order")


def daily_lines(readings: DataFrame) -> DataFrame:
    """The exported text columns, the date of their folder, and what orders the lines."""
    return readings.select(
        count_text("car_count").alias("car_count"),
        fmt_day_first("ts").alias("timestamp"),
        "sensor_id",
        F.to_date("ts").alias("date"),
        F.col("ts").alias("_order"),
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ``daily_lines`` as they are."""
    _write_csv(lines, path, "_order")


def write_daily_predictions(forecasts: DataFrame, path: str) -> None:
    """Per date of prediction_for: ``prediction, prediction_for``
    (dd/MM/yyyy HH:mm:ss) and the sensor; an empty input writes nothing."""
    out = forecasts.select(
        F.col("prediction").cast("string").alias("prediction"),
        fmt_day_first("prediction_for").alias("prediction_for"),
        "sensor_id",
        F.to_date("prediction_for").alias("date"),
        F.col("prediction_for").alias("_order"),
    )
    _write_csv(out, path, "_order")


def read_csv_or_empty(spark: SparkSession, root: str, schema: T.StructType, dates=None) -> DataFrame:
    """All CSV files under ``root`` (partition folders included); ``dates``
    limits the ``date`` partitions read.  An absent root gives an empty table
    with the schema, an absent date simply has no rows."""
    if not SS.path_exists(spark, root):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(root)
    if dates is not None:
        df = df.where(F.col("date").isin([F.lit(str(d)).cast("date") for d in dates]))
    return df


def master_rows(df: DataFrame) -> DataFrame:
    """Master CSV rows -> (sensor_id, date, car_count, ts, src_rank, ingest_seq)."""
    return df.select(
        "sensor_id",
        "date",
        coerce_count("car_count").alias("car_count"),
        parse_day_first("timestamp").alias("ts"),
        F.lit(0).alias("src_rank"),
        F.lit(None).cast("long").alias("ingest_seq"),
    )


def merge_master(spark: SparkSession, master_root: str, new_rows: DataFrame) -> None:
    """Append ``new_rows`` (sensor_id, ts, car_count, ingest_seq) to the master:
    keep the last row per (sensor, second) -- the new day wins over the
    master, then later time, then later ingest -- and rewrite only the
    touched dates.  The merged rows go to a staging folder first so the master is
    never overwritten by a plan that reads it."""
    new = new_rows.select(
        "sensor_id",
        F.to_date("ts").alias("date"),
        F.col("car_count").cast(C.COUNT_TYPE).alias("car_count"),
        "ts",
        F.lit(1).alias("src_rank"),
        F.col("ingest_seq").cast("long").alias("ingest_seq"),
    )
    touched = [r["date"] for r in new.select("date").distinct().collect()]  # a calendar, so bounded
    old = master_rows(read_csv_or_empty(spark, master_root, MASTER_SCHEMA, touched))
    both = old.unionByName(new).withColumn("second", F.date_trunc("second", "ts"))
    kept = keep_last(both, ["sensor_id", "second"], ["src_rank", "ts", "ingest_seq"]).drop("second")
    staging = SS.scratch_path(spark, "master_staging")
    kept.write.mode("overwrite").parquet(staging)
    try:
        write_daily_actuals(spark.read.parquet(staging), master_root)
    finally:
        SS.delete(spark, staging)
