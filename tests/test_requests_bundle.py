"""Scoring requests with every outcome; stored bundles against windows scaled one by one."""

import datetime as dt
import json

import numpy as np
import pytest

from slotcast.operators.clean import history_rules
from slotcast.operators.series import regular_series
from slotcast.plans import bundle as BU
from slotcast.plans.requests import score_requests
from slotcast.plans.scoring import LinearModel
from tests.helpers import readings_df

START = dt.datetime(2024, 1, 1)


def body(n, step=5, value=lambda i: float(i % 50)):
    return json.dumps([{"car_count": value(i), "timestamp": (START + dt.timedelta(minutes=step * i)).strftime("%d/%m/%Y %H:%M:%S")} for i in range(n)])


def test_every_request_has_an_answer(spark):
    rows = [
        ("whole", "application/json", body(288)),
        ("gaps", "application/json", body(100, 15)),
        ("short", "application/json", body(287)),
        ("again", "application/json", body(288)),
        ("empty", "application/json", "[]"),
        ("garbled", "application/json", body(300, value=lambda i: "many")),
        ("negative", "application/json", body(288, value=lambda i: -5.0)),
        ("cut", "application/json", body(288)[:-9]),
        ("header", "text/csv", "a,b\n1,2\n"),
        ("xml", "application/xml", "<a/>"),
        ("none", None, None),
        (None, "application/json", body(288)),
    ]
    payloads = spark.createDataFrame(rows, "payload_id string, content_type string, body string")
    got = {r.payload_id: r for r in score_requests(payloads).collect()}
    assert got.keys() == {r[0] for r in rows} - {None}
    status = {k: r.status for k, r in got.items()}
    assert status == {"whole": "OK", "gaps": "OK", "again": "OK", "negative": "OK", "short": "NOT_ENOUGH_DATA", "empty": "NO_RECORDS", "garbled": "EMPTY", "cut": status["cut"], "header": "NO_RECORDS", "xml": "UNSUPPORTED_TYPE", "none": status["none"]}
    assert status["cut"] != "OK" and status["none"] != "OK"
    assert json.loads(got["whole"].response) == {"predicted_car_count": 11, "for_timestamp": "2024-01-02 00:55:00"}  # a day before the target
    assert got["whole"].response == got["again"].response and json.loads(got["negative"].response)["predicted_car_count"] == 0
    assert (got["short"].n_records, got["short"].n_steps, got["short"].response) == (287, 287, None)
    assert got["gaps"].n_records == 100 and got["gaps"].n_steps == 288
    assert score_requests(payloads.limit(0)).count() == 0


def test_history_rules_at_their_edges(spark):
    rows = [(287, 400), (288, 287), (288, 288), (289, 300), (289, 301), (0, 0)]
    got = [(r.serving, r.training, r.evaluation) for r in history_rules(spark.createDataFrame(rows, "n_raw long, n_steps long").coalesce(1)).collect()]
    no, yes = "NOT_ENOUGH_DATA", "READY"
    assert got == [("COLD_START", no, yes), (no, no, no), (yes, no, no), (yes, yes, no), (yes, yes, yes), ("COLD_START", no, no)]


def test_bundle_round_trip_and_versions(spark, tmp_path):
    root = str(tmp_path / "bundles")
    with pytest.raises(ValueError):
        BU.read_bundle(spark, root)
    scaler = spark.createDataFrame([("a", 10.0, 30.0, 0.0, 23.0)], BU.SCALER)
    first = LinearModel("m", np.arange(4.0), 0.5, 2, 2)
    assert BU.write_bundle(spark, root, first, scaler) == 1
    assert BU.write_bundle(spark, root, LinearModel("n", np.ones(4), 0.0, 2, 2), scaler.limit(0)) == 2
    back = BU.read_bundle(spark, root, 1)
    assert (back.model.name, back.model.weights.tolist(), back.model.bias, back.scaler.collect()) == ("m", [0.0, 1.0, 2.0, 3.0], 0.5, scaler.collect())
    assert BU.read_bundle(spark, root).version == 2
    from slotcast.session import delete

    delete(spark, f"{root}/version=2/model/_SUCCESS")  # a version that was never finished
    assert BU.read_bundle(spark, root).version == 1
    with pytest.raises(ValueError):
        BU.read_bundle(spark, root, 2)


def test_bundle_scales_by_sensor_and_undoes_it(spark):
    n, lead = 4, 2
    rows = {s: [((START + dt.timedelta(minutes=5 * i)).isoformat(" "), float((i * k) % 17 + 10 * k)) for i in range(30)] for s, k in (("a", 3), ("b", 7), ("new", 5))}
    series = regular_series(readings_df(spark, rows["a"], "a").unionByName(readings_df(spark, rows["b"], "b")).unionByName(readings_df(spark, rows["new"], "new")))
    scaler = BU.fit_scaler(series.where("sensor_id <> 'new'"))
    model = LinearModel("m", np.linspace(-0.2, 0.4, 2 * n), 0.05, n, 2)
    got = {r.sensor_id: r for r in BU.evaluate_bundle(series, BU.Bundle(1, model, scaler), lead).collect()}
    served = {r.sensor_id: r.prediction for r in BU.serve_bundle(series, BU.Bundle(1, model, scaler)).collect()}
    for sensor, own in rows.items():
        v = np.array([x for _, x in own])
        hour = np.array([dt.datetime.fromisoformat(t).hour for t, _ in own], float)
        lo, hi, hl, hh = (v.min(), v.max(), hour.min(), hour.max()) if sensor != "new" else (0.0, 100.0, 0.0, 24.0)
        x = np.column_stack([(v - lo) / (hi - lo), (hour - hl) / (hh - hl)])
        p = np.array([x[i : i + n].ravel() @ model.weights + model.bias for i in range(len(v) - n + 1)]) * (hi - lo) + lo
        off = v[n - 1 + lead :] - p[: len(v) - n + 1 - lead]
        assert got[sensor].n_windows == len(off)
        assert abs(got[sensor].mae - np.abs(off).mean()) < 1e-9 and abs(got[sensor].mse - (off**2).mean()) < 1e-9
        assert served[sensor] == int(round(max(0.0, p[-1])))


def test_promotion_of_a_fitted_model(spark):
    import __spark_entry__ as E

    rows = E.queries()["promote_fitted"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 5
    for r in rows:
        assert (r.status == "Approved") == (r.new_mae < r.old_mae) and r.result == ("BETTER" if r.new_mae < r.old_mae else "WORSE")
        assert str(r.new_mae) in r.description and str(r.old_mae) in r.description
