"""Daily export: actuals and forecasts of a day, and the master history merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.sources.scan import key_range_scan


def _day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def forecasts_for_day(predictions: DataFrame, day, lookback_hours: int = C.EXPORT_LOOKBACK_HOURS) -> DataFrame:
    """Forecasts whose ``prediction_for`` falls on ``day``, after a key scan on
    ``timestamp`` widened by ``lookback_hours`` before the day (the look-back
    must cover the forecast horizon)."""
    d = _day(day)
    start = dt.datetime.combine(d, dt.time()) - dt.timedelta(hours=lookback_hours)
    end = dt.datetime.combine(d, dt.time.max)
    scanned = key_range_scan(predictions, start.isoformat(sep=" "), end.isoformat(sep=" "), ts="timestamp", date_from_ts=False)
    day = F.lit(d.isoformat()).cast("date")
    if "date" in predictions.columns:  # the table is partitioned by the date a forecast is FOR
        scanned = scanned.where(F.col("date") == day)
    return scanned.where(F.to_date("prediction_for") == day)


def actuals_for_day(readings: DataFrame, day) -> DataFrame:
    """Readings of ``day`` as the half-open range [day, day + 1)."""
    d = _day(day)
    lo = F.lit(d.isoformat()).cast("timestamp_ntz")
    hi = F.lit((d + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return readings.where((F.col("date") == F.lit(d.isoformat()).cast("date")) & (F.col("ts") >= lo) & (F.col("ts") < hi))


def daily_export(
    spark,
    readings: DataFrame,
    predictions: DataFrame,
    as_of,
    actuals_root: str,
    predictions_root: str,
    master_root: str,
    lookback_hours: int = C.EXPORT_LOOKBACK_HOURS,
) -> dict:
    """Export the day before ``as_of``: its actuals, its forecasts and the
    master merge.  Returns the paths written."""
    from slotcast.sinks.exports import merge_master, write_daily_actuals, write_daily_predictions

    day = _day(as_of) - dt.timedelta(days=1)
    acts = actuals_for_day(readings, day)
    write_daily_actuals(acts, actuals_root)
    write_daily_predictions(forecasts_for_day(predictions, day, lookback_hours), predictions_root)
    merge_master(spark, master_root, acts)
    return {"day": day.isoformat(), "actuals": actuals_root, "predictions": predictions_root, "master": master_root}
