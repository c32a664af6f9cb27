"""Queries: feature scaling, sliding windows, splits, training set."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.catalog.registry import query
from slotcast.catalog.sqlparts import INDEXED, READINGS, RESAMPLED, SERIES, TAIL, q4, sec_text, ts_text, with_
from slotcast.functions import features as FE
from slotcast.functions.numeric import q4 as q4c
from slotcast.functions.timecols import add_steps, fmt_seconds, fmt_text
from slotcast.operators import sequences as Q
from slotcast.operators.series import regular_series
from slotcast.plans import training as TR
from slotcast.session import scratch_path, store_path, table_ready
from slotcast.sinks.tables import WINDOWS_TABLE, read_table
from slotcast.sources import feed

SERIES_BASE = with_(READINGS, RESAMPLED, SERIES)


def _series(spark, sf_dir):
    return regular_series(feed.readings(spark, sf_dir))


@query(
    "feat_scale",
    SERIES_BASE
    + f"""
SELECT sensor_id, {sec_text('bucket')} AS bucket, car_count / CAST(100.0 AS DOUBLE) AS car_scaled,
       CAST(hour(bucket) AS DOUBLE) / CAST(24.0 AS DOUBLE) AS hour_scaled FROM series
""",
)
def feat_scale(spark, sf_dir):
    s = FE.scale_fixed(_series(spark, sf_dir))
    return s.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_scaled", "hour_scaled")


_FIT_SQL = """,
fit AS (SELECT sensor_id, min(car_count) AS car_min, max(car_count) AS car_max,
               CAST(min(hour(bucket)) AS DOUBLE) AS hour_min, CAST(max(hour(bucket)) AS DOUBLE) AS hour_max
        FROM series GROUP BY 1),
mm AS (
  SELECT s.sensor_id, s.bucket, s.car_count, f.car_min, f.car_max,
         CASE WHEN f.car_max - f.car_min = 0 THEN 0.0 ELSE (s.car_count - f.car_min) / (f.car_max - f.car_min) END AS car_scaled,
         CASE WHEN f.hour_max - f.hour_min = 0 THEN 0.0
              ELSE (CAST(hour(s.bucket) AS DOUBLE) - f.hour_min) / (f.hour_max - f.hour_min) END AS hour_scaled
  FROM series s JOIN fit f USING (sensor_id)
)"""


def _fitted(spark, sf_dir):
    s = _series(spark, sf_dir)
    return FE.apply_min_max(s, FE.fit_min_max(s))


@query(
    "feat_scale_fitted",
    SERIES_BASE + _FIT_SQL + f"\nSELECT sensor_id, {sec_text('bucket')} AS bucket, car_scaled, hour_scaled FROM mm\n",
)
def feat_scale_fitted(spark, sf_dir):
    m = _fitted(spark, sf_dir)
    return m.select("sensor_id", fmt_seconds("bucket").alias("bucket"), "car_scaled", "hour_scaled")


@query(
    "feat_unscale",
    SERIES_BASE
    + _FIT_SQL
    + f"""
SELECT sensor_id, {sec_text('bucket')} AS bucket,
       {q4('car_count / CAST(100.0 AS DOUBLE) * CAST(100.0 AS DOUBLE)')} AS car_restored,
       {q4('car_scaled * (car_max - car_min) + car_min')} AS car_restored_fitted
FROM mm
""",
)
def feat_unscale(spark, sf_dir):
    m = _fitted(spark, sf_dir)
    fixed = FE.unscale_fixed(F.col("car_count") / F.lit(C.CAR_MAX))
    return m.select(
        "sensor_id",
        fmt_seconds("bucket").alias("bucket"),
        q4c(fixed).alias("car_restored"),
        q4c(FE.inverse_min_max("car_scaled")).alias("car_restored_fitted"),
    )


def _train_sql(src: str) -> str:
    return f""",
tr AS (SELECT sensor_id, ts, car_count, idx - floor(CAST(n_total AS DOUBLE) * {'(CAST(1.0 AS DOUBLE) - CAST(0.7 AS DOUBLE))' if src == 'tail' else '0.0'}) AS i
       FROM {src}),
win AS (
  SELECT sensor_id, i, ts, car_count,
         count(*) OVER w AS n, lag(car_count, {C.N_STEPS - 1}) OVER o AS first_car,
         sum(car_count) OVER w AS sum_car, sum(hour(ts)) OVER w AS sum_hour,
         lead(car_count, 1) OVER o AS label,
         count(*) OVER (PARTITION BY sensor_id) - {C.N_STEPS} AS n_windows
  FROM tr
  WINDOW w AS (PARTITION BY sensor_id ORDER BY i ROWS BETWEEN {C.N_STEPS - 1} PRECEDING AND CURRENT ROW),
         o AS (PARTITION BY sensor_id ORDER BY i)
),
digest AS (
  SELECT sensor_id, CAST(i - {C.N_STEPS - 1} AS BIGINT) AS window_idx, n_windows, ts AS end_ts,
         CAST(first_car AS DOUBLE) / CAST(100.0 AS DOUBLE) AS first_car,
         CAST(car_count AS DOUBLE) / CAST(100.0 AS DOUBLE) AS last_car,
         CAST(sum_car AS DOUBLE) / CAST(100.0 AS DOUBLE) AS sum_car,
         CAST(sum_hour AS DOUBLE) / CAST(24.0 AS DOUBLE) AS sum_hour,
         CAST(label AS DOUBLE) / CAST(100.0 AS DOUBLE) AS label
  FROM win WHERE n = {C.N_STEPS} AND label IS NOT NULL
)"""


_DIGEST_COLS = "sensor_id, window_idx, " + ts_text("end_ts") + " AS end_ts, first_car, last_car, sum_car, sum_hour, label"


def _digest_out(d):
    return d.select(
        "sensor_id", "window_idx", fmt_text("end_ts").alias("end_ts"), "first_car", "last_car", "sum_car", "sum_hour", "label"
    )


@query("win_train_sequences", with_(READINGS, INDEXED) + _train_sql("indexed") + f"\nSELECT {_DIGEST_COLS} FROM digest\n")
def win_train_sequences(spark, sf_dir):
    rows = TR.indexed_rows(feed.readings(spark, sf_dir), tail=None)
    return _digest_out(TR.window_digests(rows))


@query("job_training_set", with_(READINGS, INDEXED, TAIL) + _train_sql("tail") + f"\nSELECT {_DIGEST_COLS} FROM digest\n")
def job_training_set(spark, sf_dir):
    return _digest_out(TR.training_set(feed.readings(spark, sf_dir)))


_SPLIT_SQL = """,
sp AS (
  SELECT sensor_id, window_idx, n_windows,
         CAST(floor(CAST(n_windows AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS valid_start,
         CAST(floor(CAST(n_windows AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS BIGINT) AS valid_end
  FROM digest
)"""


def _split(spark, sf_dir):
    return TR.split(TR.training_set(feed.readings(spark, sf_dir)))


@query(
    "win_split_ranges",
    with_(READINGS, INDEXED, TAIL)
    + _train_sql("tail")
    + _SPLIT_SQL
    + """
SELECT sensor_id, window_idx, CASE WHEN window_idx >= valid_start AND window_idx < valid_end THEN 'valid' ELSE 'train' END AS split
FROM sp
""",
)
def win_split_ranges(spark, sf_dir):
    return _split(spark, sf_dir).select("sensor_id", "window_idx", "split")


@query(
    "ml_split",
    with_(READINGS, INDEXED, TAIL)
    + _train_sql("tail")
    + _SPLIT_SQL
    + """
SELECT sensor_id, any_value(n_windows) AS n_windows, any_value(valid_start) AS valid_start, any_value(valid_end) AS valid_end,
       CAST(count_if(window_idx < valid_start OR window_idx >= valid_end) AS BIGINT) AS n_train,
       CAST(count_if(window_idx >= valid_start AND window_idx < valid_end) AS BIGINT) AS n_valid
FROM sp GROUP BY 1
""",
)
def ml_split(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.groupBy("sensor_id").agg(
        F.first("n_windows").alias("n_windows"),
        F.first("valid_start").alias("valid_start"),
        F.first("valid_end").alias("valid_end"),
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "valid").alias("n_valid"),
    )


@query(
    "set_union_train_parts",
    with_(READINGS, INDEXED, TAIL)
    + _train_sql("tail")
    + _SPLIT_SQL
    + """
SELECT sensor_id, window_idx, CASE WHEN window_idx < valid_start THEN 'head' ELSE 'tail' END AS part
FROM sp WHERE window_idx < valid_start OR window_idx >= valid_end
""",
)
def set_union_train_parts(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.where(F.col("split") == "train").select("sensor_id", "window_idx", "part")


_EVAL_SQL = f""",
ev AS (
  SELECT sensor_id, bucket, car_count,
         count(*) OVER w AS n, lag(car_count, {C.N_STEPS - 1}) OVER o AS first_car,
         sum(car_count) OVER w AS sum_car, lead(car_count, {C.EVAL_LEAD}) OVER o AS label
  FROM series
  WINDOW w AS (PARTITION BY sensor_id ORDER BY bucket ROWS BETWEEN {C.N_STEPS - 1} PRECEDING AND CURRENT ROW),
         o AS (PARTITION BY sensor_id ORDER BY bucket)
)"""


@query(
    "win_eval_sequences",
    SERIES_BASE
    + _EVAL_SQL
    + f"""
SELECT sensor_id, {sec_text('bucket')} AS end_bucket, first_car, car_count AS last_car, {q4('sum_car')} AS sum_car, label
FROM ev WHERE n = {C.N_STEPS} AND label IS NOT NULL
""",
)
def win_eval_sequences(spark, sf_dir):
    s = _series(spark, sf_dir).withColumn("idx", Q.bucket_index())
    d = Q.window_digest(
        s,
        C.N_STEPS,
        C.EVAL_LEAD,
        sums={"sum_car": F.col("car_count")},
        firsts={"first_car": F.col("car_count")},
        label=F.col("car_count"),
        carry=("bucket", "car_count"),
    )
    return d.select(
        "sensor_id",
        fmt_seconds("bucket").alias("end_bucket"),
        "first_car",
        F.col("car_count").alias("last_car"),
        q4c("sum_car").alias("sum_car"),
        "label",
    )


@query(
    "win_last_sequence",
    SERIES_BASE
    + f""",
lw AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY bucket DESC) AS r FROM series)
       WHERE r <= {C.N_STEPS})
SELECT sensor_id, {sec_text('max(bucket)')} AS last_bucket, count(*) AS n_rows,
       arg_min(car_count, bucket) / CAST(100.0 AS DOUBLE) AS first_car,
       arg_max(car_count, bucket) / CAST(100.0 AS DOUBLE) AS last_car,
       {q4('sum(car_count / CAST(100.0 AS DOUBLE))')} AS sum_car,
       {sec_text("max(bucket) + INTERVAL 60 MINUTE")} AS prediction_for
FROM lw GROUP BY 1
""",
)
def win_last_sequence(spark, sf_dir):
    from slotcast.operators.recent import last_buckets
    from slotcast.sources import store

    s = FE.scale_fixed(last_buckets(store.read_readings(spark, sf_dir), C.N_STEPS, store.readings_dates(spark, sf_dir)))
    lw = Q.last_window(s, C.N_STEPS, ["car_scaled", "hour_scaled"])
    cars = F.filter("x", lambda v, i: i % 2 == 0)
    return lw.select(
        "sensor_id",
        fmt_seconds("last_ts").alias("last_bucket"),
        F.col("n_rows").cast("long").alias("n_rows"),
        F.element_at(cars, 1).alias("first_car"),
        F.element_at(cars, -1).alias("last_car"),
        q4c(F.aggregate(cars, F.lit(0.0), lambda a, v: a + v)).alias("sum_car"),
        fmt_seconds(add_steps("last_ts", C.SERVE_HORIZON)).alias("prediction_for"),
    )


_DIGEST = "sensor_id string, window_idx long, n_steps long, first_car double, last_car double, sum_car double, sum_hour double, label double"
_DIGEST_ROWS = 1024  # windows summed at once


def _tensor_digest(w):
    def digest(batches):
        for batch in batches:
            for i in range(0, len(batch), _DIGEST_ROWS):
                b = batch.slice(i, _DIGEST_ROWS)
                flat = b.column("x").flatten()
                x = flat.fill_null(0.0).to_numpy().reshape(len(b), -1, 2)
                null = flat.is_null().to_numpy(zero_copy_only=False).reshape(x.shape)
                total, unknown = np.cumsum(x, axis=1)[:, -1], null.any(axis=1)  # added in the order of the steps
                cols = [(x[:, 0, 0], null[:, 0, 0]), (x[:, -1, 0], null[:, -1, 0]), (total[:, 0], unknown[:, 0]), (total[:, 1], unknown[:, 1])]
                cols = [pa.array(np.full(len(b), x.shape[1])), *(pa.array(v, mask=m) for v, m in cols)]
                yield pa.RecordBatch.from_arrays([b.column("sensor_id"), b.column("window_idx"), *cols, b.column("label")], [f.split()[0] for f in _DIGEST.split(", ")])

    d = w.select("sensor_id", "window_idx", "x", "label").mapInArrow(digest, _DIGEST)
    return d.withColumns({c: q4c(c) for c in ("sum_car", "sum_hour")})


_TENSOR_SQL = (
    with_(READINGS, INDEXED, TAIL)
    + _train_sql("tail")
    + f"""
SELECT sensor_id, window_idx, CAST({C.N_STEPS} AS BIGINT) AS n_steps, first_car, last_car,
       {q4('sum_car')} AS sum_car, {q4('sum_hour')} AS sum_hour, label FROM digest
"""
)


@query("sink_train_windows", _TENSOR_SQL)
def sink_train_windows(spark, sf_dir):
    path = scratch_path(spark, "train_windows")
    TR.write_windows(TR.training_set(feed.readings(spark, sf_dir), tensors=True), path)
    return _tensor_digest(read_table(spark, path, WINDOWS_TABLE))


def windows_store(spark, sf_dir):
    """The training windows written once under the shared folder."""
    path = store_path(spark, "train_windows", sf_dir)
    if not table_ready(spark, path):
        TR.write_windows(TR.training_set(feed.readings(spark, sf_dir), tensors=True), path)
    return read_table(spark, path, WINDOWS_TABLE)


@query("src_windows", _TENSOR_SQL)
def src_windows(spark, sf_dir):
    return _tensor_digest(windows_store(spark, sf_dir))
