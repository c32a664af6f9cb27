"""Queries: clean, resample, spine, interpolate."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import READINGS, RESAMPLED, SERIES, sec_text, ts_text, with_
from slotcast.functions.timecols import fmt_seconds, fmt_text
from slotcast.operators import series as S
from slotcast.operators.clean import clean_readings
from slotcast.sources import feed


@query(
    "flt_clean_readings",
    f"""
SELECT event_type AS sensor_id, {ts_text('ts')} AS ts,
       CAST(value AS DOUBLE) AS car_count, event_id AS ingest_seq
FROM events WHERE ts IS NOT NULL AND value IS NOT NULL
""",
)
def flt_clean_readings(spark, sf_dir):
    raw = feed.raw_text_readings(spark, sf_dir)
    out = clean_readings(raw)
    return out.select("sensor_id", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"), "ingest_seq")


@query(
    "agg_resample_mean",
    with_(READINGS, RESAMPLED)
    + f"""
SELECT sensor_id, {sec_text('bucket')} AS bucket, car_count, n FROM resampled
""",
)
def agg_resample_mean(spark, sf_dir):
    r = S.resample_mean(feed.readings(spark, sf_dir))
    return r.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_count", "n")


@query(
    "join_time_spine",
    with_(READINGS, RESAMPLED)
    + f""",
b AS (SELECT sensor_id, MIN(bucket) lo, MAX(bucket) hi FROM resampled GROUP BY 1),
s AS (SELECT sensor_id, UNNEST(generate_series(lo, hi, INTERVAL '5 minutes')) AS bucket FROM b)
SELECT s.sensor_id, {sec_text('s.bucket')} AS bucket, r.car_count
FROM s LEFT JOIN resampled r ON r.sensor_id = s.sensor_id AND r.bucket = s.bucket
""",
)
def join_time_spine(spark, sf_dir):
    r = S.resample_mean(feed.readings(spark, sf_dir))
    return S.time_spine(r).select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_count")


@query(
    "win_interpolate_time",
    with_(READINGS, RESAMPLED, SERIES)
    + f"""
SELECT sensor_id, {sec_text('bucket')} AS bucket, car_count, observed FROM series
""",
)
def win_interpolate_time(spark, sf_dir):
    s = S.regular_series(feed.readings(spark, sf_dir))
    return s.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_count", "observed")


@query(
    "agg_slot_profile",
    with_(READINGS, RESAMPLED, SERIES)
    + """
SELECT sensor_id, CAST(hour(bucket) * 12 + minute(bucket) // 5 AS INTEGER) AS slot,
       CAST(ROUND(CAST(avg(car_count) AS DECIMAL(38,9)), 4) AS DOUBLE) AS car_count, count(car_count) AS n_days
FROM series GROUP BY 1, 2
""",
)
def agg_slot_profile(spark, sf_dir):
    from slotcast.functions.numeric import q4
    from slotcast.operators.profile import slot_profile

    p = slot_profile(S.regular_series(feed.readings(spark, sf_dir)))
    return p.select("sensor_id", F.col("slot").cast("int"), q4("car_count").alias("car_count"), "n_days")
