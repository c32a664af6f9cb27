"""Day profiles: a value per time-of-day slot.

All windows here are partitioned by (sensor_id, date) and hold at most 288
rows; the 288-slot calendar is generated per key with ``sequence`` (a
generator, not a join against a calendar table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from slotcast import config as C
from slotcast.functions.timecols import slot_of_day
from slotcast.operators.series import interpolate_time, resample_mean


def slot_profile(series: DataFrame, value: str = "car_count", keys: tuple[str, ...] = ("sensor_id",)) -> DataFrame:
    """Mean per time-of-day slot over all days of each key (NULLs skipped)."""
    return (
        series.withColumn("slot", slot_of_day("bucket"))
        .groupBy(*keys, "slot")
        .agg(F.avg(value).alias(value), F.count(value).alias("n_days"))
    )


def slot_calendar(
    profile: DataFrame,
    value: str = "car_count",
    keys: tuple[str, ...] = ("sensor_id", "date"),
    slots: int = C.SLOTS_PER_DAY,
) -> DataFrame:
    """Reindex a profile onto all ``slots`` slots of each key (NULL where the
    profile has no value)."""
    grid = profile.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    return grid.join(profile.select(*keys, "slot", value), [*keys, "slot"], "left")


def fill_forward_backward(
    calendar: DataFrame, value: str = "car_count", keys: tuple[str, ...] = ("sensor_id", "date"), default: float = 0.0
) -> DataFrame:
    """Fill slots forward, then backward, then with ``default``."""
    w = W.partitionBy(*keys).orderBy("slot")
    prev = F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    nxt = F.first(value, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return calendar.withColumn(value, F.coalesce(prev, nxt, F.lit(float(default))))


def day_profile(
    df: DataFrame,
    value: str = "car_count",
    ts: str = "ts",
    keys: tuple[str, ...] = ("sensor_id",),
) -> DataFrame:
    """Per (keys, date of ``ts``): resample -> interpolate inside the day ->
    slot mean -> reindex 288 slots -> fill forward, backward, 0.

    ``df`` must hold clean rows (parsed time, numeric value).  Returns
    ``keys + (date, slot, <value>)`` with 288 rows per (keys, date)."""
    return profile_of_buckets(resample_mean(df, value, ts, keys), value, keys)


def profile_of_buckets(r: DataFrame, value: str = "car_count", keys: tuple[str, ...] = ("sensor_id",)) -> DataFrame:
    """The day profiles of a resampled table (keys, date, bucket, value)."""
    within_day = interpolate_time(r, value, keys, across_days=False)
    per_slot = within_day.select(*keys, "date", slot_of_day("bucket").alias("slot"), F.col(value))
    cal = slot_calendar(per_slot, value, (*keys, "date"))
    return fill_forward_backward(cal, value, (*keys, "date"))
