"""Queries: envelope / payload parsing, upsert sinks, streaming ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import PREDICTIONS, READINGS, RESAMPLED, SERIES, date_text, sec_text, ts_text, with_
from slotcast.functions.timecols import fmt_date, fmt_day_first, fmt_seconds, fmt_text
from slotcast.session import scratch_path
from slotcast.sinks import exports as X
from slotcast.sinks.tables import PREDICTIONS_TABLE, READINGS_TABLE, predictions_deltas, read_table, readings_deltas
from slotcast.sources import feed, store
from slotcast.sources.payloads import parse_payloads, parse_reading
from slotcast.streaming import ingest as IG
from slotcast.streaming import late as LT
from slotcast.streaming import resample as RS

SPLIT_LO, SPLIT_HI = "2024-01-15 00:00:00", "2024-01-16 00:00:00"  # the two upsert batches overlap by one day

SECOND_DEDUP = """
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sensor_id, date_trunc('second', ts) ORDER BY ingest_seq DESC) AS rn
    FROM readings) WHERE rn = 1
)"""


@query(
    "src_json_reading",
    with_(READINGS)
    + """
SELECT sensor_id, ingest_seq, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS timestamp,
       CAST(car_count AS DOUBLE) AS car_count, coalesce(CAST(k AS VARCHAR), '') AS free_spots, true AS valid
FROM readings
""",
)
def src_json_reading(spark, sf_dir):
    env = IG.envelopes(feed.readings(spark, sf_dir)).drop("date")
    p = parse_reading(env)
    return p.select(
        "sensor_id",
        "ingest_seq",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("car_count").cast("double"),
        F.array_join("free_spots", ",").alias("free_spots"),
        "valid",
    )


@query(
    "src_payload_json_csv",
    with_(READINGS)
    + f"""
SELECT 'json-' || ingest_seq AS payload_id, 'application/json' AS content_type, sensor_id,
       {ts_text("date_trunc('second', ts)")} AS ts, CAST(car_count AS DOUBLE) AS car_count, NULL AS error FROM readings
UNION ALL
SELECT 'csv-' || ingest_seq, 'text/csv', sensor_id, {ts_text('ts')}, CAST(car_count AS DOUBLE), NULL FROM readings
""",
)
def src_payload_json_csv(spark, sf_dir):
    r = feed.readings(spark, sf_dir)
    js = r.select(
        F.concat(F.lit("json-"), F.col("ingest_seq").cast("string")).alias("payload_id"),
        F.lit("application/json").alias("content_type"),
        "sensor_id",
        F.to_json(F.array(F.struct(F.col("car_count").cast("string").alias("car_count"), fmt_day_first("ts").alias("timestamp")))).alias(
            "body"
        ),
    )
    cs = r.select(
        F.concat(F.lit("csv-"), F.col("ingest_seq").cast("string")).alias("payload_id"),
        F.lit("text/csv").alias("content_type"),
        "sensor_id",
        F.concat(
            F.lit("car_count,timestamp\n"), F.col("car_count").cast("string"), F.lit(","), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        ).alias("body"),
    )
    p = parse_payloads(js.unionByName(cs))
    return p.select("payload_id", "content_type", "sensor_id", fmt_text("ts").alias("ts"), "car_count", "error")


def _two_writes(table, df):
    """Two batches that overlap by a day."""
    lo, hi = F.lit(SPLIT_LO).cast("timestamp_ntz"), F.lit(SPLIT_HI).cast("timestamp_ntz")
    for seq, part in enumerate((F.col(table.ts) < hi, F.col(table.ts) >= lo)):
        table.write(df.where(part), seq)
    return table.read()


@query(
    "sink_upsert_readings",
    with_(READINGS)
    + f"""
SELECT sensor_id, {ts_text('ts')} AS ts, CAST(car_count AS DOUBLE) AS car_count, ingest_seq,
       coalesce(CAST(k AS VARCHAR), '') AS free_spots FROM readings
""",
)
def sink_upsert_readings(spark, sf_dir):
    t = _two_writes(readings_deltas(spark, scratch_path(spark, "readings")), feed.readings(spark, sf_dir))
    return t.select(
        "sensor_id", fmt_text("ts").alias("ts"), F.col("car_count").cast("double"), "ingest_seq",
        F.array_join("free_spots", ",").alias("free_spots"),
    )


@query(
    "sink_upsert_predictions",
    with_(READINGS, RESAMPLED, SERIES, PREDICTIONS)
    + f"""
SELECT sensor_id, {sec_text('timestamp')} AS timestamp, prediction, {sec_text('prediction_for')} AS prediction_for,
       {sec_text('created_at')} AS created_at FROM predictions
""",
)
def sink_upsert_predictions(spark, sf_dir):
    p = store.read_predictions(spark, sf_dir).drop("date")
    t = _two_writes(predictions_deltas(spark, scratch_path(spark, "predictions")), p)
    return t.select(
        "sensor_id", fmt_seconds("timestamp").alias("timestamp"), "prediction",
        fmt_seconds("prediction_for").alias("prediction_for"), fmt_seconds("created_at").alias("created_at"),
    )


ARRIVALS = ("2024-01-11", "2024-01-21")  # readings arrive in three time-ordered drops


def _arrivals(spark, sf_dir, run, cond=None):
    """Land the readings in time-ordered drops and run the stream
    (availableNow) after each drop, like a feed arriving over time."""
    path = scratch_path(spark, "landing")
    r = feed.readings(spark, sf_dir)
    if cond is not None:
        r = r.where(cond)
    edges = [None, *[F.lit(e).cast("timestamp_ntz") for e in ARRIVALS], None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = r
        if lo is not None:
            part = part.where(F.col("ts") >= lo)
        if hi is not None:
            part = part.where(F.col("ts") < hi)
        IG.write_landing(IG.envelopes(part), path)
        run(path)
    return path


@query(
    "stream_ingest_readings",
    with_(READINGS, SECOND_DEDUP)
    + """
SELECT sensor_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts, CAST(car_count AS DOUBLE) AS car_count, ingest_seq
FROM dedup
""",
)
def stream_ingest_readings(spark, sf_dir):
    table, ckpt = scratch_path(spark, "readings"), scratch_path(spark, "ckpt")
    _arrivals(spark, sf_dir, lambda landing: IG.run_ingest(spark, landing, ckpt, IG.ReadingIngest(table)))
    t = read_table(spark, table, READINGS_TABLE)
    return t.select("sensor_id", fmt_seconds("ts").alias("ts"), F.col("car_count").cast("double"), "ingest_seq")


def _score_latest_sql():
    from slotcast import config as C
    from slotcast.catalog.sqlparts import interp

    cuts = ", ".join(f"({i + 1}, TIMESTAMP '{c} 00:00:00')" for i, c in enumerate(ARRIVALS))
    return (
        with_(READINGS, SECOND_DEDUP)
        + f""",
cuts AS (SELECT * FROM (VALUES {cuts}, ({len(ARRIVALS) + 1}, TIMESTAMP '9999-12-31 00:00:00')) t(k, hi)),
recent AS (
  SELECT * FROM (
    SELECT c.k, d.sensor_id, date_trunc('second', d.ts) AS ts, d.car_count,
           row_number() OVER (PARTITION BY c.k, d.sensor_id ORDER BY date_trunc('second', d.ts) DESC, d.ingest_seq DESC) AS rn,
           count(*) OVER (PARTITION BY c.k, d.sensor_id) AS n_hist
    FROM cuts c JOIN dedup d ON date_trunc('second', d.ts) < c.hi) WHERE rn <= {C.N_STEPS} AND n_hist >= {C.N_STEPS}
),
rr AS (
  SELECT k, sensor_id, time_bucket(INTERVAL '5 minutes', ts) AS bucket,
         CAST(SUM(car_count) AS DOUBLE) / COUNT(car_count) AS car_count
  FROM recent GROUP BY 1, 2, 3
),"""
        + interp("rr", "ri", keys="k, sensor_id")
        + f""",
lw AS (SELECT *, row_number() OVER (PARTITION BY k, sensor_id ORDER BY bucket DESC) AS r,
              count(*) OVER (PARTITION BY k, sensor_id) AS n_b,
              max(bucket) OVER (PARTITION BY k, sensor_id) AS last_bucket FROM ri)
SELECT sensor_id, {sec_text('last_bucket')} AS timestamp,
       CAST(round_even(greatest(0.0, car_count / CAST(100.0 AS DOUBLE) * CAST(100.0 AS DOUBLE)), 0) AS INTEGER) AS prediction,
       {sec_text(f"last_bucket + INTERVAL {C.SERVE_HORIZON * C.STEP_MINUTES} MINUTE")} AS prediction_for
FROM lw WHERE n_b >= {C.N_STEPS} AND r = {C.N_STEPS} - ({C.N_STEPS - 1} + {C.SERVE_HORIZON} - {C.SLOTS_PER_DAY})
"""
    )


@query("stream_score_latest", _score_latest_sql())
def stream_score_latest(spark, sf_dir):
    table, preds, ckpt = (scratch_path(spark, k) for k in ("readings", "predictions", "ckpt"))
    _arrivals(spark, sf_dir, lambda landing: IG.run_ingest(spark, landing, ckpt, IG.ReadingIngest(table, preds)))
    p = read_table(spark, preds, PREDICTIONS_TABLE)
    return p.select(
        "sensor_id", fmt_seconds("timestamp").alias("timestamp"), "prediction", fmt_seconds("prediction_for").alias("prediction_for")
    )


@query(
    "stream_resample",
    with_(READINGS, SECOND_DEDUP)
    + f"""
SELECT sensor_id, {sec_text("time_bucket(INTERVAL '5 minutes', ts)")} AS bucket, CAST(SUM(car_count) AS DOUBLE) / COUNT(car_count) AS car_count,
       COUNT(car_count) AS n FROM dedup GROUP BY 1, 2
""",
)
def stream_resample(spark, sf_dir):
    changes, ckpt = scratch_path(spark, "resample_changes"), scratch_path(spark, "ckpt")
    _arrivals(spark, sf_dir, lambda landing: RS.run_resample(spark, landing, changes, ckpt))
    v = RS.resampled_view(spark, changes)
    return v.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_count", "n")


CORRECTED = "hour(ts) = 9"  # readings of these hours are sent again later, with one more on the count


@query(
    "stream_resample_corrected",
    with_(READINGS, SECOND_DEDUP)
    + f"""
SELECT sensor_id, {sec_text("time_bucket(INTERVAL '5 minutes', ts)")} AS bucket,
       CAST(SUM(car_count + CASE WHEN {CORRECTED} THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(car_count) AS car_count, COUNT(car_count) AS n
FROM dedup GROUP BY 1, 2
""",
)
def stream_resample_corrected(spark, sf_dir):
    """Readings that are sent again with another count replace the first ones in their buckets."""
    changes, ckpt, landing = (scratch_path(spark, k) for k in ("resample_changes", "ckpt", "landing"))
    r = feed.readings(spark, sf_dir)
    again = r.where(CORRECTED).withColumn("car_count", (F.col("car_count") + 1).cast(r.schema["car_count"].dataType))
    for part in (r, again):
        IG.write_landing(IG.envelopes(part), landing)
        RS.run_resample(spark, landing, changes, ckpt)
    v = RS.resampled_view(spark, changes)
    return v.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_count", "n")


@query(
    "stream_late_rows",
    with_(READINGS, SECOND_DEDUP)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, '%d/%m/%Y %H:%M:%S') AS timestamp FROM dedup
""",
)
def stream_late_rows(spark, sf_dir):
    """Mornings arrive first and every day is exported; afternoons arrive
    late, re-open every exported day, and the days are exported again."""
    exports, _ = _late(spark, sf_dir)
    back = X.read_csv_or_empty(spark, exports, X.ACTUALS_SCHEMA)
    return back.select("sensor_id", fmt_date("date").alias("date"), F.col("car_count").cast("double"), "timestamp")


def _late(spark, sf_dir):
    """One handler with all sinks over two arrivals: places of the exports and the master."""
    morning = F.hour("ts") < 12
    table, exports, log, master, preds, ckpt, landing = (scratch_path(spark, k) for k in ("readings", "exports", "exported", "master", "predictions", "ckpt", "landing"))
    handler = LT.LateAwareIngest(table, exports, log, master, preds)
    r = feed.readings(spark, sf_dir)
    IG.write_landing(IG.envelopes(r.where(morning)), landing)
    IG.run_ingest(spark, landing, ckpt, handler)
    handler.export_all(spark)
    IG.write_landing(IG.envelopes(r.where(~morning)), landing)
    IG.run_ingest(spark, landing, ckpt, handler)
    return exports, master


@query(
    "stream_master_history",
    with_(READINGS, SECOND_DEDUP)
    + f"""
SELECT sensor_id, {date_text('ts')} AS date, CAST(car_count AS DOUBLE) AS car_count,
       strftime(ts, '%d/%m/%Y %H:%M:%S') AS timestamp FROM dedup
""",
)
def stream_master_history(spark, sf_dir):
    """The master history that the same stream keeps: late rows are in it."""
    _, master = _late(spark, sf_dir)
    back = X.read_csv_or_empty(spark, master, X.MASTER_SCHEMA)
    return back.select("sensor_id", fmt_date("date").alias("date"), F.col("car_count").cast("double"), "timestamp")
