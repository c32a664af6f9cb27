"""Queries: projections, filters, ordering, top-k, set operations, dedup, scans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from slotcast import config as C
from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import (
    INDEXED,
    PREDICTIONS,
    READINGS,
    RESAMPLED,
    SERIES,
    TAIL,
    date_text,
    sec_text,
    ts_text,
    with_,
)
from slotcast.functions.timecols import epoch_seconds, fmt_date, fmt_day_first, fmt_seconds, fmt_text
from slotcast.operators import clean as CL
from slotcast.operators import dedup as DD
from slotcast.operators import edges as ED
from slotcast.operators import ordering as O
from slotcast.operators.edges import sensor_dates
from slotcast.sources import feed, store
from slotcast.sources.scan import key_range_scan

EXPORT_DAY = "2024-01-30"
MASTER_CUT = "2024-01-30 12:00:00"
FORECAST_LOOKBACK_HOURS = 24 + C.EXPORT_LOOKBACK_HOURS  # one-day horizon + the source's 2 h buffer


@query(
    "topk_latest_n",
    with_(READINGS)
    + f"""
SELECT sensor_id, {ts_text('ts')} AS ts, CAST(car_count AS DOUBLE) AS car_count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, ingest_seq DESC) AS rank FROM readings
) WHERE rank <= {C.N_STEPS}
""",
)
def topk_latest_n(spark, sf_dir):
    needed = ED.dates_of_latest_rows(store.readings_dates(spark, sf_dir), C.N_STEPS)
    top = O.latest_n(ED.read_dates(store.read_readings(spark, sf_dir), needed), C.N_STEPS)
    return top.select("sensor_id", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"), "rank")


@query(
    "sort_by_time",
    with_(READINGS, INDEXED)
    + f"""
SELECT sensor_id, idx, {ts_text('ts')} AS ts, CAST(car_count AS DOUBLE) AS car_count FROM indexed
""",
)
def sort_by_time(spark, sf_dir):
    s = O.sort_by_time(feed.readings(spark, sf_dir))
    return s.select("sensor_id", "idx", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"))


@query(
    "limit_tail_fraction",
    with_(READINGS, INDEXED, TAIL)
    + f"""
SELECT sensor_id, idx, {ts_text('ts')} AS ts, CAST(car_count AS DOUBLE) AS car_count FROM tail
""",
)
def limit_tail_fraction(spark, sf_dir):
    t = O.tail_fraction(O.sequence_index(feed.readings(spark, sf_dir)), C.TRAIN_TAIL_FRACTION)
    return t.select("sensor_id", "idx", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"))


@query(
    "agg_history_bounds",
    with_(READINGS, INDEXED, TAIL)
    + f""",
a AS (SELECT sensor_id, count(*) AS n_all, min(ts) AS f_all, max(ts) AS l_all FROM readings GROUP BY 1),
t AS (SELECT sensor_id, count(*) AS n_tail, min(ts) AS f_tail, max(ts) AS l_tail FROM tail GROUP BY 1)
SELECT a.sensor_id, n_all, {ts_text('f_all')} AS first_all, {ts_text('l_all')} AS last_all,
       n_tail, {ts_text('f_tail')} AS first_tail, {ts_text('l_tail')} AS last_tail
FROM a JOIN t USING (sensor_id)
""",
)
def agg_history_bounds(spark, sf_dir):
    idx = O.sequence_index(feed.readings(spark, sf_dir))
    tail = O.tail_fraction(idx, C.TRAIN_TAIL_FRACTION)
    whole = idx.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_all"), F.min("ts").alias("f_all"), F.max("ts").alias("l_all")
    )
    part = tail.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_tail"), F.min("ts").alias("f_tail"), F.max("ts").alias("l_tail")
    )
    j = whole.join(part, "sensor_id")
    return j.select(
        "sensor_id",
        "n_all",
        fmt_text("f_all").alias("first_all"),
        fmt_text("l_all").alias("last_all"),
        "n_tail",
        fmt_text("f_tail").alias("first_tail"),
        fmt_text("l_tail").alias("last_tail"),
    )


def _history_parts(spark, sf_dir):
    r = store.read_readings(spark, sf_dir)
    master = r.where(F.col("ts") < F.lit(MASTER_CUT).cast("timestamp_ntz")).withColumn("source", F.lit("master"))
    new = r.where(F.col("date") == F.lit(EXPORT_DAY).cast("date")).withColumn("source", F.lit("new"))
    return master, new


_HISTORY_SQL = f"""
hist AS (
  SELECT 'master' AS source, * FROM readings WHERE ts < TIMESTAMP '{MASTER_CUT}'
  UNION ALL
  SELECT 'new' AS source, * FROM readings WHERE CAST(ts AS DATE) = DATE '{EXPORT_DAY}'
)"""


@query(
    "set_union_history",
    with_(READINGS, _HISTORY_SQL)
    + f"""
SELECT source, sensor_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS timestamp, {ts_text('ts')} AS ts,
       CAST(car_count AS DOUBLE) AS car_count FROM hist
""",
)
def set_union_history(spark, sf_dir):
    master, new = _history_parts(spark, sf_dir)
    u = DD.union_history(master, new)
    return u.select(
        "source",
        "sensor_id",
        fmt_day_first("ts").alias("timestamp"),
        fmt_text("ts").alias("ts"),
        F.col("car_count").cast("double"),
    )


@query(
    "win_dedup_keep_last",
    with_(READINGS, _HISTORY_SQL)
    + f""",
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY sensor_id, date_trunc('second', ts)
      ORDER BY CASE source WHEN 'new' THEN 1 ELSE 0 END DESC, ts DESC, ingest_seq DESC) AS rn
  FROM hist
)
SELECT sensor_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS timestamp, {ts_text('ts')} AS ts,
       CAST(car_count AS DOUBLE) AS car_count, source
FROM ranked WHERE rn = 1
""",
)
def win_dedup_keep_last(spark, sf_dir):
    master, new = _history_parts(spark, sf_dir)
    u = DD.union_history(master, new).withColumn("second", F.date_trunc("second", "ts"))
    u = u.withColumn("src_rank", F.when(F.col("source") == "new", 1).otherwise(0))
    kept = DD.keep_last(u, ["sensor_id", "second"], ["src_rank", "ts", "ingest_seq"])
    return kept.select(
        "sensor_id",
        fmt_day_first("ts").alias("timestamp"),
        fmt_text("ts").alias("ts"),
        F.col("car_count").cast("double"),
        "source",
    )


@query(
    "src_key_range_scan",
    with_(READINGS)
    + f"""
SELECT sensor_id, {ts_text('ts')} AS ts, CAST(car_count AS DOUBLE) AS car_count FROM readings
WHERE ts BETWEEN TIMESTAMP '2024-01-24 00:00:00' AND TIMESTAMP '2024-01-30 23:59:59'
""",
)
def src_key_range_scan(spark, sf_dir):
    t = store.read_readings(spark, sf_dir)
    s = key_range_scan(t, "2024-01-24 00:00:00", "2024-01-30 23:59:59")
    return s.select("sensor_id", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"))


@query(
    "proj_reading_columns",
    f"""
SELECT event_type AS sensor_id, CAST(value AS DOUBLE) AS car_count,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp FROM events
""",
)
def proj_reading_columns(spark, sf_dir):
    items = feed.readings(spark, sf_dir).withColumn("timestamp", F.date_format("ts", C.ISO_MICROS_FORMAT)).drop("ts")
    out = CL.reading_columns(items)
    return out.withColumn("car_count", F.col("car_count").cast("double"))


@query(
    "proj_existing_columns",
    with_(READINGS, RESAMPLED, SERIES, PREDICTIONS)
    + f"""
SELECT sensor_id, prediction, {sec_text('prediction_for')} AS prediction_for FROM predictions
""",
)
def proj_existing_columns(spark, sf_dir):
    p = store.read_predictions(spark, sf_dir)
    out = CL.existing_columns(p, ["sensor_id", "prediction", "prediction_for", "confidence"])
    return out.withColumn("prediction_for", fmt_seconds("prediction_for"))


@query(
    "flt_target_date",
    with_(READINGS, RESAMPLED, SERIES, PREDICTIONS)
    + f"""
SELECT sensor_id, {sec_text('timestamp')} AS timestamp, prediction, {sec_text('prediction_for')} AS prediction_for
FROM predictions
WHERE timestamp BETWEEN TIMESTAMP '{EXPORT_DAY} 00:00:00' - INTERVAL {FORECAST_LOOKBACK_HOURS} HOUR
                    AND TIMESTAMP '{EXPORT_DAY} 23:59:59.999999'
  AND CAST(prediction_for AS DATE) = DATE '{EXPORT_DAY}'
""",
)
def flt_target_date(spark, sf_dir):
    from slotcast.plans.export import forecasts_for_day

    p = store.read_predictions(spark, sf_dir)
    f = forecasts_for_day(p, EXPORT_DAY, lookback_hours=FORECAST_LOOKBACK_HOURS)
    return f.select(
        "sensor_id",
        fmt_seconds("timestamp").alias("timestamp"),
        "prediction",
        fmt_seconds("prediction_for").alias("prediction_for"),
    )


@query(
    "flt_min_history",
    with_(READINGS)
    + f""",
d AS (SELECT sensor_id, CAST(ts AS DATE) AS date, count(*) AS n_day FROM readings GROUP BY 1, 2),
c AS (SELECT sensor_id, date, CAST(least(sum(n_day) OVER (PARTITION BY sensor_id ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {C.N_STEPS}) AS BIGINT) AS n FROM d)
SELECT sensor_id, {date_text('date')} AS date, n,
       CASE WHEN n >= {C.N_STEPS} THEN 'READY' ELSE 'COLD_START' END AS status,
       CASE WHEN n >= {C.N_STEPS} THEN NULL ELSE printf('COLD START: collecting data (%d/%d)', n, {C.N_STEPS}) END AS message
FROM c
""",
)
def flt_min_history(spark, sf_dir):
    r = feed.readings(spark, sf_dir).withColumn("date", F.to_date("ts"))
    per_day = r.groupBy("sensor_id", "date").agg(F.count(F.lit(1)).alias("n_day"))
    cum = F.sum("n_day").over(W.partitionBy("sensor_id").orderBy("date").rowsBetween(W.unboundedPreceding, 0))
    counts = per_day.select("sensor_id", "date", F.least(cum, F.lit(C.N_STEPS)).alias("n"))
    st = CL.min_history_status(counts, "n", C.N_STEPS)
    return st.select("sensor_id", fmt_date("date").alias("date"), "n", "status", "message")


@query(
    "flt_history_rules",
    with_(READINGS)
    + f""",
d AS (SELECT sensor_id, CAST(ts AS DATE) AS date, count(*) AS n, min(time_bucket(INTERVAL '5 minutes', ts)) AS lo,
             max(time_bucket(INTERVAL '5 minutes', ts)) AS hi FROM readings GROUP BY 1, 2),
c AS (SELECT sensor_id, date, CAST(sum(n) OVER w AS BIGINT) AS n_raw,
             CAST((epoch(max(hi) OVER w) - epoch(min(lo) OVER w)) / 300 + 1 AS BIGINT) AS n_steps
      FROM d WINDOW w AS (PARTITION BY sensor_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT sensor_id, {date_text('date')} AS date, n_raw, n_steps,
       CASE WHEN n_raw < {C.N_STEPS} THEN 'COLD_START' WHEN n_steps < {C.N_STEPS} THEN 'NOT_ENOUGH_DATA' ELSE 'READY' END AS serving,
       CASE WHEN n_raw <= {C.N_STEPS} THEN 'NOT_ENOUGH_DATA' ELSE 'READY' END AS training,
       CASE WHEN n_steps <= {C.N_STEPS + C.SERVE_HORIZON} THEN 'NOT_ENOUGH_DATA' ELSE 'READY' END AS evaluation
FROM c
""",
)
def flt_history_rules(spark, sf_dir):
    """What each sensor's history up to each date is long enough for: steps are those of the regular series."""
    days = sensor_dates(feed.readings(spark, sf_dir))
    upto = W.partitionBy("sensor_id").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    span = epoch_seconds(F.max("last_bucket").over(upto)) - epoch_seconds(F.min("first_bucket").over(upto))
    counts = days.select("sensor_id", "date", F.sum("n").over(upto).alias("n_raw"), (span / C.STEP_SECONDS + 1).cast("long").alias("n_steps"))
    out = CL.history_rules(counts, need=C.N_STEPS, lead=C.SERVE_HORIZON)
    return out.select("sensor_id", fmt_date("date").alias("date"), "n_raw", "n_steps", "serving", "training", "evaluation")
