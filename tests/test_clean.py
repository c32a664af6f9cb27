"""Coercion of text timestamps and counts (FIXTURES section 3)."""

import datetime as dt

from slotcast.operators.clean import clean_readings, existing_columns, min_history_status, reading_columns


def test_lenient_parse_and_drop(spark):
    rows = [
        ("a", "08/12/2025 10:05:00", "12"),
        ("b", "2025-12-08T10:05:00", "3.5"),
        ("c", "2025-12-08T10:05:00.123456", "4"),
        ("d", "2025-12-08 10:05:00", "5"),
        ("e", "not a time", "1"),
        ("f", None, "1"),
        ("g", "08/12/2025 10:05:00", "abc"),
        ("h", "08/12/2025 10:05:00", None),
        ("i", "31/02/2025 10:05:00", "1"),
    ]
    df = spark.createDataFrame(rows, "id string, timestamp string, car_count string")
    out = {r["id"]: r for r in clean_readings(df).collect()}
    assert sorted(out) == ["a", "b", "c", "d"]
    assert out["a"]["ts"] == dt.datetime(2025, 12, 8, 10, 5)
    assert out["c"]["ts"] == dt.datetime(2025, 12, 8, 10, 5, 0, 123456)
    assert float(out["b"]["car_count"]) == 3.5


def test_projections(spark):
    df = spark.createDataFrame([("s", 1, "t", [1, 2])], "sensor_id string, car_count int, timestamp string, free_spots array<int>")
    assert reading_columns(df).columns == ["sensor_id", "car_count", "timestamp"]
    assert reading_columns(df.drop("free_spots")).columns == ["sensor_id", "car_count", "timestamp"]
    assert existing_columns(df, ["timestamp", "nope", "car_count"]).columns == ["timestamp", "car_count"]


def test_min_history(spark):
    df = spark.createDataFrame([("a", 287), ("b", 288), ("c", 289)], "sensor_id string, n long")
    out = {r["sensor_id"]: r for r in min_history_status(df).collect()}
    assert out["a"]["status"] == "COLD_START" and out["a"]["message"].endswith("(287/288)")
    assert out["b"]["status"] == "READY" and out["c"]["status"] == "READY"
