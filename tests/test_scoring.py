"""Scoring: half-even rounding, clamp at 0, horizon, response JSON, models."""

import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotcast.plans.scoring import LinearModel, response_json, serve


def _windows(spark, last_values):
    """One window per sensor whose scaled car feature is ``v / 100`` at every row."""
    rows = []
    for i, v in enumerate(last_values):
        x = []
        for _ in range(288):
            x += [v / 100.0, 0.5]
        rows.append((f"s{i}", dt.datetime(2024, 1, 1, 10, 7), x))
    return spark.createDataFrame(rows, "sensor_id string, last_ts timestamp_ntz, x array<double>")


def test_half_even_and_clamp(spark):
    vals = [12.5, 13.5, -3.0, 0.4, 99.5]
    out = {r["sensor_id"]: r for r in serve(_windows(spark, vals), LinearModel.persistence()).collect()}
    assert [out[f"s{i}"]["prediction"] for i in range(len(vals))] == [12, 14, 0, 0, 100]
    assert out["s0"]["prediction_for"] == dt.datetime(2024, 1, 1, 11, 7)


def test_response_json(spark):
    scored = serve(_windows(spark, [14.0]), LinearModel.persistence())
    doc = json.loads(response_json(scored).collect()[0]["response"])
    assert doc == {"predicted_car_count": 14, "for_timestamp": "2024-01-01 11:07:00"}


def test_seasonal_naive_picks_day_earlier_slot():
    m = LinearModel.seasonal_naive(12)
    assert np.flatnonzero(m.weights).tolist() == [22]  # row 11, count feature
    assert np.flatnonzero(LinearModel.seasonal_naive(13).weights).tolist() == [24]
    with pytest.raises(ValueError):
        LinearModel.seasonal_naive(400)


def test_predict_udf_matches_numpy(spark):
    rng = np.random.default_rng(3)
    w = rng.normal(size=576)
    m = LinearModel("rand", w, 0.25)
    xs = rng.normal(size=(6, 576))
    df = spark.createDataFrame([(i, xs[i].tolist()) for i in range(6)], "id int, x array<double>")
    got = {r["id"]: r["p"] for r in df.select("id", m.predict_udf()(F.col("x")).alias("p")).collect()}
    for i in range(6):
        assert got[i] == pytest.approx(float(xs[i] @ w + 0.25), rel=1e-12)


def test_fitted_model_on_held_out_rows(spark):
    """The given counts are noise without a daily pattern, so no model can do much better than their mean."""
    import __spark_entry__ as E

    rows = E.queries()["ml_evaluate_fitted"](spark, "/root/testdata/sf0.01").collect()
    assert {r["model"] for r in rows} == {"fitted", "persistence", "constant"}
    sizes = {(r["sensor_id"], r["n_windows"]) for r in rows}
    assert len(sizes) == len({s for s, _ in sizes}) and all(np.isfinite([r["mae"], r["mse"]]).all() for r in rows)
    mse = {m: sum(r["mse"] for r in rows if r["model"] == m) for m in ("fitted", "persistence", "constant")}
    assert mse["fitted"] < 1.02 * mse["constant"] and mse["fitted"] < mse["persistence"]
