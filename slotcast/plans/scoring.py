"""Batch scoring through ``predict_batch_udf``.

A model is a linear map over the flat window tensor ([n_steps, 2] row-major:
scaled count, scaled hour) plus a bias -- the seasonal-naive and persistence
baselines and the fitted MLlib regression all have this form.  The four hooks
of the source's scorer map to: ``make_predict_fn`` (load once per Python
worker), the window builder (input), the vectorised predict, and
``to_json`` for the response.  Windows reach Python as Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotcast import config as C
from slotcast.functions.numeric import round_half_even_int
from slotcast.functions.timecols import add_steps


@dataclass
class LinearModel:
    name: str
    weights: np.ndarray
    bias: float = 0.0
    n_steps: int = C.N_STEPS
    n_features: int = 2
    meta: dict = field(default_factory=dict)

    @staticmethod
    def pick(name: str, row: int, n_steps: int = C.N_STEPS, n_features: int = 2, feature: int = 0) -> "LinearModel":
        w = np.zeros(n_steps * n_features)
        w[row * n_features + feature] = 1.0
        return LinearModel(name, w, 0.0, n_steps, n_features)

    @staticmethod
    def seasonal_naive(horizon: int, n_steps: int = C.N_STEPS, steps_per_day: int = C.SLOTS_PER_DAY) -> "LinearModel":
        """Same slot one day before the target: row n_steps - 1 + horizon - steps_per_day."""
        row = n_steps - 1 + horizon - steps_per_day
        if not 0 <= row < n_steps:
            raise ValueError("the day-earlier slot is outside the window")
        return LinearModel.pick(f"seasonal_naive_h{horizon}", row, n_steps)

    @staticmethod
    def persistence(n_steps: int = C.N_STEPS) -> "LinearModel":
        return LinearModel.pick("persistence", n_steps - 1, n_steps)

    def predict_udf(self, batch_size: int = 1024):
        weights, bias = np.asarray(self.weights, dtype=np.float64), float(self.bias)
        shape = [self.n_steps, self.n_features]

        def make_predict_fn():
            w = weights  # loaded once per worker process

            def predict(x: np.ndarray) -> np.ndarray:
                flat = x.reshape(x.shape[0], -1)
                return flat @ w + bias

            return predict

        return predict_batch_udf(
            make_predict_fn, return_type=T.DoubleType(), batch_size=batch_size, input_tensor_shapes=[shape]
        )


def score_scaled(windows: DataFrame, model: LinearModel, x: str = "x") -> Column:
    """Scaled forecast for every window row (a Column)."""
    return model.predict_udf()(F.col(x))


def serve(windows: DataFrame, model: LinearModel, horizon: int = C.SERVE_HORIZON, key: str = "sensor_id", low: Column | None = None, span: Column | None = None) -> DataFrame:
    """Serving post-processing: unscale (by ``low`` and ``span``, or the fixed scale), clamp at 0, round half-even to int;
    the target time is the last bucket + horizon steps."""
    scaled = windows.withColumn("_scaled", score_scaled(windows, model))
    count = F.col("_scaled") * F.lit(C.CAR_MAX) if span is None else F.col("_scaled") * span + low
    value = F.greatest(F.lit(0.0), count)
    return scaled.select(
        key,
        F.col("last_ts").alias("timestamp"),
        round_half_even_int(value).alias("prediction"),
        add_steps("last_ts", horizon).alias("prediction_for"),
    )


def response_json(scored: DataFrame, key: str = "sensor_id") -> DataFrame:
    """The scorer's response document per sensor."""
    doc = F.struct(
        F.col("prediction").alias("predicted_car_count"),
        F.date_format("prediction_for", C.RESPONSE_FORMAT).alias("for_timestamp"),
    )
    return scored.select(key, F.to_json(doc).alias("response"))
