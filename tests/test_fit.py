"""The fit from lagged products against windows built one by one, and against MLlib's fit on them."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from slotcast.operators import lagged as L
from slotcast.plans import fit, training

N = 6


def readings(spark, sizes, seed=0):
    rng, rows = random.Random(seed), []
    for s, size in enumerate(sizes):
        for i in range(size):
            rows.append((f"s{s}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=17 * i + s), rng.choice([1.5, 20.0, 37.25, 80.0]) + 10 * (i % 5), i))
    return spark.createDataFrame(rows, "sensor_id string, ts timestamp_ntz, car_count double, ingest_seq long")


def windows_by_hand(rows, n=N):
    """Flat windows with their label, by part of the split."""
    out = {"train": [], "valid": []}
    for sensor in sorted({r.sensor_id for r in rows}):
        own = sorted((r for r in rows if r.sensor_id == sensor), key=lambda r: r.idx)
        v = [(float(r.car_count) / 100, r.ts.hour / 24) for r in own]
        total = len(v) - n
        for s in range(total):
            part = "valid" if int(total * 0.8) <= s < int(total * 0.9) else "train"
            out[part].append([x for row in v[s : s + n] for x in row] + [v[s + n][0]])
    return {p: np.array(x) for p, x in out.items() if x}


@pytest.mark.parametrize("chunk", [8, 4096])
def test_moments_against_every_window(spark, monkeypatch, chunk):
    monkeypatch.setattr(L.window_sums, "__defaults__", ("sensor_id", "idx", chunk))
    rows = training.indexed_rows(readings(spark, [40, 75, 7, 6, 3]), tail=None)
    parts = fit.part_moments(fit.fit_sums(rows, N).collect(), N)
    hand = windows_by_hand(rows.collect())
    assert parts.keys() == hand.keys()
    for p, w in hand.items():
        assert parts[p].n == len(w)
        assert np.allclose(parts[p].mean, w.mean(0), atol=1e-12)
        assert np.allclose(parts[p].centred, (w - w.mean(0)).T @ (w - w.mean(0)), atol=1e-9)


def test_fit_equals_mllib(spark):
    rows = training.indexed_rows(readings(spark, [150, 220], 3))
    res, best = fit.fit_forecaster(spark, rows, n=N)
    windows = training.split(training.window_tensors(rows, N)).select(array_to_vector("x").alias("features"), "label", "split").cache()
    train, valid = (windows.where(F.col("split") == p) for p in ("train", "valid"))
    parts = fit.part_moments(fit.fit_sums(rows, N).collect(), N)
    for r in res.collect():
        m = LinearRegression(regParam=r.reg_param).fit(train)
        weights, bias = fit.ridge(parts["train"], r.reg_param)
        assert np.allclose(weights, m.coefficients.toArray(), atol=1e-6) and abs(bias - m.intercept) < 1e-6
        assert abs(r.train_mse - m.summary.meanSquaredError) < 1e-9 and abs(r.valid_mse - m.evaluate(valid).meanSquaredError) < 1e-9
    chosen = min(res.collect(), key=lambda r: r.valid_mse)
    assert [r.model for r in res.collect() if r.selected] == [chosen.model] == [best.name]


def test_fit_without_windows_and_with_constant_columns(spark):
    rows = training.indexed_rows(readings(spark, [5, 3]), tail=None)
    res, best = fit.fit_forecaster(spark, rows, n=N)
    assert best is None and res.count() == 0
    flat = readings(spark, [60]).withColumns({"car_count": F.lit(40.0), "ts": F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")})
    _, best = fit.fit_forecaster(spark, training.indexed_rows(flat, tail=None), n=N)
    assert np.allclose(best.weights, 0) and abs(best.bias - 0.4) < 1e-12


def test_singular_columns_get_the_smallest_solution(spark):
    twice = readings(spark, [90]).withColumn("car_count", F.hour("ts") * 100.0 / 24)  # both columns are one
    res, best = fit.fit_forecaster(spark, training.indexed_rows(twice, tail=None), n=N)
    assert np.isfinite(best.weights).all() and all(np.isfinite([r.train_mse, r.valid_mse]).all() for r in res.collect())
