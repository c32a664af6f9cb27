"""Exports, master merge, upserts: keep-last rules and rerun safety."""

import datetime as dt

from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.session import scratch_path
from slotcast.sinks import exports as X
from slotcast.sinks.tables import upsert_readings


def _r(spark, rows):
    data = [("s1", dt.datetime.fromisoformat(t), v, seq, [1]) for t, v, seq in rows]
    df = spark.createDataFrame(data, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long, free_spots array<int>")
    return df.withColumn("car_count", F.col("car_count").cast(C.COUNT_TYPE))


def test_missing_root_gives_empty_table(spark):
    df = X.read_csv_or_empty(spark, scratch_path(spark, "nothing"), X.ACTUALS_SCHEMA)
    assert df.count() == 0 and df.columns == ["car_count", "timestamp", "sensor_id", "date"]


def test_master_merge_keeps_last_per_second_and_is_rerun_safe(spark):
    root = scratch_path(spark, "master")
    X.merge_master(spark, root, _r(spark, [("2024-01-01 10:00:00.2", 1.0, 1), ("2024-01-02 10:00:00", 2.0, 2)]))
    day2 = _r(spark, [("2024-01-02 10:00:00.5", 5.0, 3), ("2024-01-02 10:00:00.7", 7.0, 4), ("2024-01-02 11:00:00", 8.0, 5)])
    X.merge_master(spark, root, day2)
    X.merge_master(spark, root, day2)
    rows = sorted((r["timestamp"], r["car_count"]) for r in X.read_csv_or_empty(spark, root, X.MASTER_SCHEMA).collect())
    assert rows == [("01/01/2024 10:00:00", "1.0"), ("02/01/2024 10:00:00", "7.0"), ("02/01/2024 11:00:00", "8.0")]


def test_daily_export_overwrites_only_its_day(spark):
    root = scratch_path(spark, "actuals")
    X.write_daily_actuals(_r(spark, [("2024-01-01 10:00:00", 1.0, 1), ("2024-01-02 10:00:00", 2.0, 2)]), root)
    X.write_daily_actuals(_r(spark, [("2024-01-02 12:00:00", 9.0, 3)]), root)
    rows = sorted((str(r["date"]), r["car_count"]) for r in X.read_csv_or_empty(spark, root, X.ACTUALS_SCHEMA).collect())
    assert rows == [("2024-01-01", "1.0"), ("2024-01-02", "9.0")]


def test_upsert_last_write_wins_and_idempotent(spark):
    table = scratch_path(spark, "readings")
    b1 = _r(spark, [("2024-01-01 10:00:00", 1.0, 1), ("2024-01-01 10:00:00", 2.0, 2), ("2024-01-03 00:00:00", 3.0, 3)])
    b2 = _r(spark, [("2024-01-01 10:00:00", 4.0, 4), ("2024-01-02 00:00:00", 5.0, 5)])
    upsert_readings(spark, table, b1)
    upsert_readings(spark, table, b2)
    upsert_readings(spark, table, b2)
    rows = sorted((str(r["ts"]), float(r["car_count"])) for r in spark.read.parquet(table).collect())
    assert rows == [("2024-01-01 10:00:00", 4.0), ("2024-01-02 00:00:00", 5.0), ("2024-01-03 00:00:00", 3.0)]
