"""Feature scaling: fixed scale (count / 100, hour / 24) and fitted min-max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C


def scale_fixed(df: DataFrame, value: str = "car_count", ts: str = "bucket") -> DataFrame:
    return df.withColumn("car_scaled", F.col(value).cast("double") / F.lit(C.CAR_MAX)).withColumn(
        "hour_scaled", F.hour(ts).cast("double") / F.lit(C.HOUR_MAX)
    )


def unscale_fixed(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return c * F.lit(C.CAR_MAX)


def fit_min_max(df: DataFrame, value: str = "car_count", ts: str = "bucket", keys=("sensor_id",)) -> DataFrame:
    """Per-key min-max parameters (one small row per key)."""
    return df.groupBy(*keys).agg(
        F.min(F.col(value).cast("double")).alias("car_min"),
        F.max(F.col(value).cast("double")).alias("car_max"),
        F.min(F.hour(ts)).cast("double").alias("hour_min"),
        F.max(F.hour(ts)).cast("double").alias("hour_max"),
    )


def _mm(x, lo, hi):
    span = hi - lo
    return F.when(span == 0, F.lit(0.0)).otherwise((x - lo) / span)


def apply_min_max(df: DataFrame, params: DataFrame, value: str = "car_count", ts: str = "bucket", keys=("sensor_id",)) -> DataFrame:
    """Transform with fitted parameters.  The parameter table has one row per
    key; the join is left to the planner (AQE broadcasts it when its measured
    size is under the broadcast threshold and shuffles otherwise)."""
    j = df.join(params, list(keys), "left")
    return j.withColumn("car_scaled", _mm(F.col(value).cast("double"), F.col("car_min"), F.col("car_max"))).withColumn(
        "hour_scaled", _mm(F.hour(ts).cast("double"), F.col("hour_min"), F.col("hour_max"))
    )


def inverse_min_max(col, lo="car_min", hi="car_max") -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return c * (F.col(hi) - F.col(lo)) + F.col(lo)
