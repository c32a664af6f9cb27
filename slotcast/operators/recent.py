"""The last ``n`` buckets of each sensor's regular series, reading only the dates that determine them.

Interpolating a bucket needs only the nearest known buckets around it, so a
series built from the dates that ``operators.edges`` chooses is exact from its
first known bucket on.  Every sensor is served, however long it has been silent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.functions.timecols import add_steps
from slotcast.operators.edges import dates_of_last_buckets, read_dates, sensor_dates
from slotcast.operators.series import regular_series


def last_buckets(table: DataFrame, n: int = C.N_STEPS, dates: DataFrame | None = None) -> DataFrame:
    """Regular-series rows of the last ``n`` buckets per sensor (exact).

    ``dates`` is the table's ``sensor_dates``; without it they are counted from
    the table."""
    needed = dates_of_last_buckets(sensor_dates(table) if dates is None else dates, n)
    series = regular_series(read_dates(table, needed))
    ends = needed.groupBy("sensor_id").agg(F.max("hi").alias("_hi"))
    return series.join(ends, "sensor_id").where(F.col("bucket") >= add_steps("_hi", -(n - 1))).drop("_hi")
