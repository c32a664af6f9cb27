"""Stored model bundles: a linear model and each sensor's fitted scaler, versioned.

A bundle is a folder ``version=<n>`` with two small tables: ``model`` (one row: name, weights, bias) and ``scaler``
(one row per sensor: smallest and largest count and hour).  Scoring and evaluation join the
scaler by sensor, scale the series with it, and undo it on the forecast, as the model was fitted on scaled
values.  A sensor without a scaler is scaled by the fixed values.  A version is written once and
counts when both tables are committed; ``read_bundle`` takes the newest by default."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast import session as SS
from slotcast.functions.features import fit_min_max
from slotcast.operators import sequences as Q
from slotcast.plans.evaluate import evaluate_many
from slotcast.plans.scoring import LinearModel, serve

MODEL = "name string, weights array<double>, bias double, n_steps int, n_features int"
SCALER = "sensor_id string, car_min double, car_max double, hour_min double, hour_max double"


@dataclass
class Bundle:
    version: int
    model: LinearModel
    scaler: DataFrame


def versions(spark: SparkSession, root: str) -> list[int]:
    if not SS.path_exists(spark, root):
        return []
    found = [int(x.removeprefix("version=")) for x in SS.listed(spark, root) if x.startswith("version=")]
    return sorted(v for v in found if all(SS.table_ready(spark, f"{root}/version={v}/{part}") for part in ("scaler", "model")))


def write_bundle(spark: SparkSession, root: str, model: LinearModel, scaler: DataFrame) -> int:
    """Store a new version; its number."""
    version = max(versions(spark, root), default=0) + 1
    scaler.select("sensor_id", "car_min", "car_max", "hour_min", "hour_max").write.mode("overwrite").parquet(f"{root}/version={version}/scaler")
    row = (model.name, [float(w) for w in model.weights], float(model.bias), model.n_steps, model.n_features)
    spark.createDataFrame([row], MODEL).coalesce(1).write.mode("overwrite").parquet(f"{root}/version={version}/model")
    return version


def read_bundle(spark: SparkSession, root: str, version: int | None = None) -> Bundle:
    have = versions(spark, root)
    if not have or version is not None and version not in have:
        raise ValueError(f"no bundle {'' if version is None else version} at {root}; there are {have}")
    version = have[-1] if version is None else version
    m = spark.read.schema(MODEL).parquet(f"{root}/version={version}/model").first()
    model = LinearModel(m.name, np.array(m.weights), m.bias, m.n_steps, m.n_features)
    return Bundle(version, model, spark.read.schema(SCALER).parquet(f"{root}/version={version}/scaler"))


def fit_scaler(series: DataFrame) -> DataFrame:
    """Min-max parameters of each sensor's regular series."""
    return fit_min_max(series)


def scaled(series: DataFrame, bundle: Bundle, ts: str = "bucket", key: str = "sensor_id") -> DataFrame:
    """The series with ``car_scaled`` and ``hour_scaled`` by the bundle's scaler, and ``low`` and ``span`` that undo the count's."""
    # a row per sensor; the planner broadcasts it while it is small
    s = series.join(bundle.scaler.withColumnRenamed("sensor_id", key), key, "left")
    fixed = {"car_min": 0.0, "car_max": C.CAR_MAX, "hour_min": 0.0, "hour_max": C.HOUR_MAX}
    s = s.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fixed.items()})

    def apply(x: Column, low: str, high: str) -> Column:
        span = F.col(high) - F.col(low)
        return F.when(span == 0, F.lit(0.0)).otherwise((x - F.col(low)) / span)

    s = s.withColumns({"car_scaled": apply(F.col("car_count").cast("double"), "car_min", "car_max"), "hour_scaled": apply(F.hour(ts).cast("double"), "hour_min", "hour_max")})
    return s.withColumns({"low": F.col("car_min"), "span": F.col("car_max") - F.col("car_min")}).drop(*fixed)


def evaluate_bundle(series: DataFrame, bundle: Bundle, lead: int = C.EVAL_LEAD, others: list[LinearModel] = ()) -> DataFrame:
    """MAE / MSE per (sensor, model) of the bundle's model, and of others on the same scaled windows."""
    s = scaled(series, bundle).withColumn("idx", Q.bucket_index())
    windows = Q.window_arrays(s, bundle.model.n_steps, lead, ["car_scaled", "hour_scaled"], F.col("car_count"), carry=("bucket", "low", "span"))
    return evaluate_many(windows, [bundle.model, *others], F.col("low"), F.col("span"))


def serve_bundle(series: DataFrame, bundle: Bundle, horizon: int = C.SERVE_HORIZON, key: str = "sensor_id") -> DataFrame:
    """Forecasts from the newest window of each key that has a whole one, through the bundle's scaler."""
    s = scaled(series, bundle, key=key)
    undo = s.select(key, "low", "span").groupBy(key).agg(F.first("low").alias("low"), F.first("span").alias("span"))
    n = bundle.model.n_steps
    windows = Q.last_window(s, n, ["car_scaled", "hour_scaled"], (key,)).where(F.col("n_rows") == n).join(undo, key)
    return serve(windows, bundle.model, horizon, key, F.col("low"), F.col("span"))
