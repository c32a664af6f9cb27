"""Batch equals stream; late rows; envelope and payload parsing."""

from pyspark.sql import functions as F

from slotcast.operators.series import resample_mean
from slotcast.sources import feed
from slotcast.sources.payloads import parse_payloads, parse_reading
from tests.conftest import SF_SMALL


def test_stream_resample_equals_batch(spark):
    import __spark_entry__ as E

    s = E.queries()["stream_resample"](spark, SF_SMALL)
    b = resample_mean(feed.readings(spark, SF_SMALL)).select("sensor_id", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("bucket"), "car_count", "n")
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_late_rows_reexport_full_days(spark):
    import __spark_entry__ as E

    out = E.queries()["stream_late_rows"](spark, SF_SMALL)
    assert out.count() == feed.readings(spark, SF_SMALL).select("sensor_id", F.date_trunc("second", "ts")).distinct().count()


def test_parse_reading_defaults_and_bad_rows(spark):
    env = spark.createDataFrame(
        [
            ("s", 1, '{"timestamp":"08/12/2025 10:05:00","car_count":12,"free_spots":[3,7]}'),
            ("s", 2, '{"timestamp":"08/12/2025 10:10:00","car_count":"4"}'),
            ("s", 3, '{"timestamp":"2025-12-08T10:05:00","car_count":1}'),
            ("s", 4, "not json"),
        ],
        "sensor_id string, ingest_seq long, body string",
    )
    out = {r["ingest_seq"]: r for r in parse_reading(env).collect()}
    assert out[1]["valid"] and list(out[1]["free_spots"]) == [3, 7]
    assert out[2]["valid"] and list(out[2]["free_spots"]) == []
    assert not out[3]["valid"]  # the envelope time format is strict day-first
    assert not out[4]["valid"]


def test_parse_payloads(spark):
    p = spark.createDataFrame(
        [
            ("j", "application/json", '[{"car_count": 3, "timestamp": "08/12/2025 10:05:00"}, {"car_count": "x", "timestamp": "08/12/2025 10:10:00"}]'),
            ("c", "text/csv", "timestamp,car_count\n2025-12-08T10:05:00,7\n"),
            ("x", "application/xml", "<a/>"),
        ],
        "payload_id string, content_type string, body string",
    )
    rows = sorted(((r["payload_id"], r["car_count"], r["error"]) for r in parse_payloads(p).collect()), key=str)
    assert rows == sorted([("c", 7.0, None), ("j", None, "bad record"), ("j", 3.0, None), ("x", None, "unsupported content type")], key=str)


def test_parse_payload_shapes(spark):
    """Quoted CSV with spaces and a comma inside, JSON as columns, one record, a short line."""
    p = spark.createDataFrame(
        [
            ("q", "text/csv", 'note, "car_count" ,"timestamp"\r\n"a, b","5","2025-12-08T10:05:00"\nx\n'),
            ("k", "Application/JSON", '{"car_count": [3, "4"], "timestamp": ["08/12/2025 10:05:00", "2025-12-08T10:10:00.5"]}'),
            ("r", "application/json", '{"car_count": 9, "timestamp": "08/12/2025 10:05:00"}'),
            ("e", "application/json", "[]"),
            ("h", "text/csv", "other,timestamp\n1,2\n"),
        ],
        "payload_id string, content_type string, body string",
    )
    got = sorted(((r["payload_id"], r["car_count"], r["error"]) for r in parse_payloads(p).collect()), key=str)
    want = [("q", 5.0, None), ("q", None, "bad record"), ("k", 3.0, None), ("k", 4.0, None), ("r", 9.0, None), ("e", None, "no records"), ("h", None, "no records")]
    assert got == sorted(want, key=str)


def _land(spark, path, rows):
    from slotcast.streaming import ingest as IG
    from tests.helpers import readings_df

    IG.write_landing(IG.envelopes(readings_df(spark, rows).withColumn("free_spots", F.array().cast("array<int>"))), path)


def test_stream_resample_keeps_very_late_readings(spark, tmp_path):
    from slotcast.streaming import resample as RS

    landing, changes, ckpt = (str(tmp_path / x) for x in ("landing", "changes", "ckpt"))
    _land(spark, landing, [("2024-01-10 08:00:00", 4.0), ("2024-01-12 08:00:00", 6.0)])
    RS.run_resample(spark, landing, changes, ckpt)
    _land(spark, landing, [("2024-01-10 08:04:00", 8.0), ("2024-01-01 00:00:00", 1.0)])
    RS.run_resample(spark, landing, changes, ckpt)
    got = {(str(r["bucket"]), r["car_count"], r["n"]) for r in RS.resampled_view(spark, changes).collect()}
    assert got == {("2024-01-10 08:00:00", 6.0, 2), ("2024-01-12 08:00:00", 6.0, 1), ("2024-01-01 00:00:00", 1.0, 1)}
    RS.compact(spark, changes, 1, str(tmp_path / "folded"))
    assert {(str(r["bucket"]), r["car_count"], r["n"]) for r in RS.resampled_view(spark, str(tmp_path / "folded")).collect()} == got


def test_late_reading_and_rescoring(spark, tmp_path):
    """A late reading refreshes the forecast at the sensor's end and adds none at its old date;
    counts that are written again, lower, replace the forecast."""
    import datetime as dt

    from slotcast.sinks.tables import PREDICTIONS_TABLE, read_table
    from slotcast.streaming import ingest as IG

    landing, table, preds, ckpt = (str(tmp_path / x) for x in ("landing", "readings", "preds", "ckpt"))
    start = dt.datetime(2024, 1, 1)
    series = lambda v: [((start + dt.timedelta(minutes=5 * i)).isoformat(" "), v) for i in range(3 * 288)]
    run = lambda: IG.run_ingest(spark, landing, ckpt, IG.ReadingIngest(table, preds))
    read = lambda: [(str(r["timestamp"]), r["prediction"]) for r in read_table(spark, preds, PREDICTIONS_TABLE).collect()]
    _land(spark, landing, series(90.0))
    run()
    assert read() == [("2024-01-03 23:55:00", 90)]
    _land(spark, landing, [("2024-01-01 10:00:00", 500.0)])
    run()
    assert read() == [("2024-01-03 23:55:00", 90)]
    _land(spark, landing, series(10.0))
    run()
    assert read() == [("2024-01-03 23:55:00", 10)]


def test_prediction_key_is_unique_when_its_target_moves(spark, tmp_path):
    import datetime as dt

    from slotcast.sinks.tables import upsert_predictions

    t = dt.datetime(2024, 1, 1, 23, 30)
    for seq, target in enumerate((dt.datetime(2024, 1, 1, 23, 45), dt.datetime(2024, 1, 2, 0, 30))):
        row = spark.createDataFrame([("s", t, 90 - seq * 80, target, t)], "sensor_id string, timestamp timestamp_ntz, prediction int, prediction_for timestamp_ntz, created_at timestamp_ntz")
        upsert_predictions(spark, str(tmp_path / "p"), row, seq)
    assert [(r["prediction"], r["prediction_for"]) for r in spark.read.parquet(str(tmp_path / "p")).collect()] == [(10, target)]


def test_counts_are_neither_capped_nor_rounded(spark):
    from slotcast.operators.clean import clean_readings

    df = spark.createDataFrame([("123456789012.5", "2024-01-01T00:00:00"), ("3.14159", "01/02/2024 03:04:05"), ("x", "2024-01-01T00:00:00")], "car_count string, timestamp string")
    assert sorted(float(r["car_count"]) for r in clean_readings(df).collect()) == [3.14159, 123456789012.5]


def test_day_first_text_knows_no_zone(spark):
    from slotcast.functions.timecols import parse_day_first, parse_lenient

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("10/03/2024 02:30:00",), ("2024-03-10T02:30:00",), ("1/3/2024 02:30:00",), ("31/02/2024 00:00:00",), (None,)], "t string")
        got = [(str(r["a"]), str(r["b"])) for r in df.select(parse_day_first("t").alias("a"), parse_lenient("t").alias("b")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [("2024-03-10 02:30:00",) * 2, ("None", "2024-03-10 02:30:00"), ("None", "None"), ("None", "None"), ("None", "None")]
