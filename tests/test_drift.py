"""Day profiles (interpolated slots) and drift status rules."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.operators.profile import day_profile
from slotcast.plans import drift as D
from tests.helpers import readings_df


def _expected_profile(rows):
    """288 slots by straight-line interpolation between slot means; before the first and after the
    last slot with readings their values hold."""
    sums = {}
    for text, value in rows:
        t = dt.datetime.fromisoformat(text)
        sums.setdefault((t.hour * 60 + t.minute) // 5, []).append(value)
    slots = sorted(sums)
    return np.interp(np.arange(288), slots, [sum(sums[s]) / len(sums[s]) for s in slots])


@pytest.mark.parametrize(
    "rows",
    [
        [("2024-01-02 06:02:00", 10.0), ("2024-01-02 06:40:00", 20.0), ("2024-01-02 18:00:00", 5.0)],
        [("2024-01-02 12:00:00", 7.0)],
        [("2024-01-02 00:00:00", 1.0), ("2024-01-02 23:59:59", 3.0)],
        [("2024-01-02 08:00:01", 1.0), ("2024-01-02 08:04:59", 4.0), ("2024-01-02 09:00:00", 8.5)],
    ],
)
def test_day_profile_slots(spark, rows):
    prof = day_profile(readings_df(spark, rows)).orderBy("slot").collect()
    assert len(prof) == 288
    np.testing.assert_allclose([r["car_count"] for r in prof], _expected_profile(rows), atol=1e-9)


def test_silent_sensor_has_its_missing_days(spark):
    a, p = _inputs(spark, {"2024-01-02": 5.0}, {"2024-01-02": 5})
    st, summ = D.check_drift(a, p, "2024-01-31")
    assert [r["status"] for r in st.collect()] == ["MISSING_DATA"] * 7
    assert summ.collect()[0]["missing_count"] == 7


def _inputs(spark, actual_days, pred_days):
    """actual_days / pred_days: {date: constant value} -> one reading per day."""
    a = [("s1", dt.datetime.fromisoformat(d + " 12:00:00"), float(v), i) for i, (d, v) in enumerate(actual_days.items())]
    p = [("s1", dt.datetime.fromisoformat(d + " 12:00:00"), int(v)) for d, v in pred_days.items()]
    ad = spark.createDataFrame(a, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long").withColumn("date", F.to_date("ts"))
    pdf = spark.createDataFrame(p, "sensor_id string, prediction_for timestamp_ntz, prediction int").withColumn(
        "date", F.to_date("prediction_for")
    )
    return ad, pdf


def test_threshold_is_strict_and_missing_days(spark):
    days = [f"2024-01-{d:02d}" for d in range(24, 31)]
    actual = {d: 10.0 for d in days[:-1]}  # the 30th has no actuals
    preds = {d: 0 for d in days}
    a, p = _inputs(spark, actual, preds)
    st, summ = D.check_drift(a, p, "2024-01-31", threshold=10.0)
    by = {r["date"].isoformat(): (r["mae"], r["status"]) for r in st.collect()}
    assert by["2024-01-24"] == (10.0, "OK")
    assert by["2024-01-30"] == (None, "MISSING_DATA")
    st2, _ = D.check_drift(a, p, "2024-01-31", threshold=9.99)
    assert {r["status"] for r in st2.collect()} == {"DRIFT", "MISSING_DATA"}


@pytest.mark.parametrize("n_drift,detected", [(2, False), (3, True)])
def test_trigger_at_three_days(spark, n_drift, detected):
    days = [f"2024-01-{d:02d}" for d in range(24, 31)]
    actual = {d: (50.0 if i < n_drift else 0.0) for i, d in enumerate(days)}
    preds = {d: 0 for d in days}
    a, p = _inputs(spark, actual, preds)
    _, summ = D.check_drift(a, p, "2024-01-31", threshold=10.0, check_timestamp="2024-01-31T00:00:00")
    r = summ.collect()[0]
    assert r["drift_count"] == n_drift and r["drift_detected"] is detected
    assert len(r["details"]) == 7 and r["check_timestamp"] == "2024-01-31T00:00:00"


def test_error_when_rows_but_none_parseable(spark):
    a = spark.createDataFrame(
        [("s1", None, 5.0, dt.date(2024, 1, 30))], "sensor_id string, ts timestamp_ntz, car_count double, date date"
    )
    p = spark.createDataFrame(
        [("s1", dt.datetime(2024, 1, 30, 12), 3, dt.date(2024, 1, 30))],
        "sensor_id string, prediction_for timestamp_ntz, prediction int, date date",
    )
    st, _ = D.check_drift(a, p, "2024-01-31", days=1)
    assert [r["status"] for r in st.collect()] == ["ERROR"]
