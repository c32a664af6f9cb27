"""Exported days that are absent, cut short or garbled."""

from pyspark.sql import functions as F

from slotcast.plans import drift as D
from slotcast.session import scratch_path
from slotcast.sources import day_files as DF


def write(spark, root, days):
    """days: {date: text of one file}"""
    for date, text in days.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{root}/date={date}")


def test_lines_of_any_shape(spark):
    root = scratch_path(spark, "days")
    write(spark, root, {
        "2024-01-01": "car_count,timestamp,sensor_id\n5.0,01/01/2024 10:00:00,a\nx,01/01/2024 10:00:00,a\n7.0,99/99/2024 10:00:00,a\n8\n1,2,a,b,c\n6.5,2024-01-01T11:00:00,b\n,,\n",
        "2024-01-02": "car_count,timestamp,sensor_id\n",
        "2024-01-03": "\x00\x01 garbage\n",
    })
    days = DF.read_actual_days(spark, root, ["2024-01-01", "2024-01-02", "2024-01-03", "2030-01-01"])
    good = sorted((r.sensor_id, float(r.car_count), str(r.ts)) for r in days.where("ok").collect())
    assert good == [("a", 5.0, "2024-01-01 10:00:00"), ("b", 6.5, "2024-01-01 11:00:00")]
    bad = {str(r.date): r.n_bad for r in DF.bad_lines(days).collect()}
    assert bad["2024-01-01"] == 5 and "2024-01-02" not in bad
    assert DF.read_actual_days(spark, scratch_path(spark, "absent")).count() == 0


def test_every_outcome_of_a_day(spark):
    actual, forecast = scratch_path(spark, "actual"), scratch_path(spark, "forecast")
    head = "car_count,timestamp,sensor_id\n"
    write(spark, actual, {
        "2024-01-01": head + "10.0,01/01/2024 12:00:00,s\n",
        "2024-01-02": head + "90.0,02/01/2024 12:00:00,s\n30.0,broken,s\n",
        "2024-01-03": head + "n/a,03/01/2024 12:00:00,s\nn/a,03/01/2024 13:00:00,s\n",
        "2024-01-04": head,
    })
    write(spark, forecast, {f"2024-01-0{d}": f"prediction,prediction_for,sensor_id\n12,0{d}/01/2024 12:00:00,s\n" for d in range(1, 6)})
    sensors = spark.createDataFrame([("s",), ("silent",)], "sensor_id string")
    st, summary = D.check_exports(spark, actual, forecast, sensors, "2024-01-06", threshold=10.0, days=5)
    got = {(r.sensor_id, str(r.date)[-1]): (r.status, r.mae) for r in st.collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "s"} == {"1": ("OK", 2.0), "2": ("DRIFT", 78.0), "3": ("ERROR", None), "4": ("MISSING_DATA", None), "5": ("MISSING_DATA", None)}
    assert {v for k, v in got.items() if k[0] == "silent"} == {("MISSING_DATA", None)}
    counts = {r.sensor_id: (r.drift_count, r.ok_count, r.missing_count, r.error_count) for r in summary.collect()}
    assert counts == {"s": (1, 1, 2, 1), "silent": (0, 0, 5, 0)}


def test_each_side_is_read_once(spark):
    import __spark_entry__ as E

    plan = E.queries()["drift_damaged_exports"](spark, "/root/testdata/sf0.001").select(F.lit(1))
    assert plan.count() == 35
