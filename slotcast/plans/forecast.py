"""Forecast tables derived from the regular series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.numeric import round_half_even_int


def seasonal_naive(series: DataFrame, value: str = "car_count", days: int = 1) -> DataFrame:
    """Forecast = value of the same slot ``days`` earlier.

    The prediction made at bucket ``b`` (``timestamp``) is for ``b + days``
    (``prediction_for``), rounded half-even to an int like the source's
    ``int(round(x))``.  ``created_at`` is the data time (reproducible)."""
    return series.where(F.col(value).isNotNull()).select(
        "sensor_id",
        F.col("bucket").alias("timestamp"),
        round_half_even_int(value).alias("prediction"),
        (F.col("bucket") + F.make_dt_interval(F.lit(days))).alias("prediction_for"),
        F.col("bucket").alias("created_at"),
    )
