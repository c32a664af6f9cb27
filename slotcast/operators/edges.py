"""Which dates of a sensor a read needs, from a small table of its dates.

``sensor_dates`` has one row per (sensor, date) with readings; the upsert and the
store keep it beside the readings.  Serving and top-n reads choose each
sensor's dates from it, so a sensor that fell silent long ago is read from its
own last dates, and nobody's whole history is scanned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from slotcast.functions.timecols import add_steps, bucket_floor


def sensor_dates(readings: DataFrame) -> DataFrame:
    """(sensor_id, date, n, first_bucket, last_bucket) of clean readings."""
    r = readings.where(F.col("ts").isNotNull() & F.col("car_count").isNotNull() & F.col("sensor_id").isNotNull())
    days = r.groupBy("sensor_id", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("_first"), F.max("ts").alias("_last")
    )
    return days.select(
        "sensor_id", "date", "n", bucket_floor("_first").alias("first_bucket"), bucket_floor("_last").alias("last_bucket")
    )


def dates_of_last_buckets(dates: DataFrame, n: int) -> DataFrame:
    """The dates that determine each sensor's last ``n`` buckets: from the newest date whose first
    bucket is not after the window's start (the whole history if there is none)."""
    per = W.partitionBy("sensor_id")
    lo = add_steps(F.max("last_bucket").over(per), -(n - 1))
    d = dates.withColumn("hi", F.max("last_bucket").over(per)).withColumn("lo", lo)
    start = F.max(F.when(F.col("first_bucket") <= F.col("lo"), F.col("date"))).over(per)
    return d.withColumn("_start", start).where(F.col("_start").isNull() | (F.col("date") >= F.col("_start"))).drop("_start")


def dates_of_latest_rows(dates: DataFrame, n: int) -> DataFrame:
    """The newest dates of each sensor that hold its newest ``n`` rows."""
    newer = W.partitionBy("sensor_id").orderBy(F.col("date").desc()).rowsBetween(W.unboundedPreceding, -1)
    return dates.withColumn("_newer", F.coalesce(F.sum("n").over(newer), F.lit(0))).where(F.col("_newer") < n).drop("_newer")


def read_dates(table: DataFrame, needed: DataFrame) -> DataFrame:
    """The table's rows of the needed (sensor, date) pairs.  The distinct dates (a calendar, so bounded)
    become a partition filter."""
    days = [r["date"] for r in needed.select("date").distinct().collect()]
    if not days:
        return table.limit(0)
    rows = table.where(F.col("date").isin([F.lit(d) for d in days]))
    return rows.join(needed.select("sensor_id", "date"), ["sensor_id", "date"], "left_semi")
