"""Exported days read back as text, whatever state the files are in.

The exports have a folder per date; a date filter reads only those folders.  Lines with
too few or too many fields, or a time or value that can't be parsed, don't fail the read: they come
as rows with ``ok`` false and their text in ``line``.  Of a line with too few fields those that are
there are used, so it can be counted for its sensor if it has one.

An absent root gives an empty table, an absent date no rows; a null or empty field is an unparseable one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast import session as SS
from slotcast.functions.numeric import coerce_count
from slotcast.functions.timecols import parse_lenient

TEXT = T.StringType()


def read_days(spark: SparkSession, root: str, value: str, time: str, dates: list | None = None, kind: Column | None = None) -> DataFrame:
    """(sensor_id, date, ts, value, ok, line) of exported lines ``value,time,sensor_id``; ``kind`` turns the value's text (column
    ``value``) into a number, by default a count."""
    schema = T.StructType([T.StructField(c, TEXT) for c in ("value", "time", "sensor_id", "line")] + [T.StructField("date", T.DateType())])
    if not SS.path_exists(spark, root):
        rows = spark.createDataFrame([], schema)
    else:
        read = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        rows = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "line").csv(root)
    if dates is not None:
        rows = rows.where(F.col("date").isin([F.lit(str(d)).cast("date") for d in dates]))
    number = coerce_count("value") if kind is None else kind
    out = rows.select("sensor_id", "date", parse_lenient("time").alias("ts"), number.alias("number"), "line", "value", "time")
    ok = F.col("line").isNull() & F.col("ts").isNotNull() & F.col("number").isNotNull() & F.col("sensor_id").isNotNull()
    text = F.coalesce("line", F.concat_ws(",", "value", "time", "sensor_id"))
    return out.select("sensor_id", "date", F.col("ts").alias(time), F.col("number").alias(value), ok.alias("ok"), F.when(~ok, text).alias("line"))


def read_actual_days(spark: SparkSession, root: str, dates: list | None = None) -> DataFrame:
    """(sensor_id, date, ts, car_count, ok, line)"""
    return read_days(spark, root, "car_count", "ts", dates)


def read_forecast_days(spark: SparkSession, root: str, dates: list | None = None) -> DataFrame:
    """(sensor_id, date, prediction_for, prediction, ok, line)"""
    return read_days(spark, root, "prediction", "prediction_for", dates, F.col("value").try_cast("int"))


def bad_lines(days: DataFrame) -> DataFrame:
    """(date, n_bad, example) of the dates that hold lines which couldn't be read."""
    return days.where(~F.col("ok")).groupBy("date").agg(F.count(F.lit(1)).alias("n_bad"), F.min("line").alias("example"))
