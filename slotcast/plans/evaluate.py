"""Model evaluation on windows of the regular series, comparison, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.functions.features import scale_fixed
from slotcast.functions.numeric import q4
from slotcast.operators import sequences as Q
from slotcast.plans.scoring import LinearModel, score_scaled
from slotcast.sinks.reports import eval_report_struct


def eval_windows(series: DataFrame, n: int = C.N_STEPS, lead: int = C.EVAL_LEAD) -> DataFrame:
    """Windows of the resampled, interpolated series; label = the unscaled
    value ``lead`` steps after the window's last row."""
    s = scale_fixed(series).withColumn("idx", Q.bucket_index())
    return Q.window_arrays(s, n, lead, ["car_scaled", "hour_scaled"], F.col("car_count"), carry=("bucket",))


def evaluate_series(series: DataFrame, models: list[LinearModel], n: int = C.N_STEPS, lead: int = C.EVAL_LEAD) -> DataFrame:
    """MAE / MSE per (sensor, model) over every evaluation window of the series, in one pass for all
    models, baselines and fitted ones alike."""
    return evaluate_many(eval_windows(series, n, lead), models)


def evaluate(windows: DataFrame, model: LinearModel) -> DataFrame:
    """MAE / MSE per sensor of ``model`` (forecasts unscaled x 100)."""
    return evaluate_many(windows, [model])


def evaluate_many(windows: DataFrame, models: list[LinearModel], low: Column | None = None, span: Column | None = None) -> DataFrame:
    """MAE / MSE per (sensor, model) for several models in ONE pass over the
    windows: every model scores the same Arrow batches, and one aggregation
    computes all metrics (partial aggregation before the shuffle).  Forecasts are unscaled
    by the windows' ``low`` and ``span``, or by the fixed scale."""

    def unscaled(p: Column) -> Column:
        return p * F.lit(C.CAR_MAX) if span is None else p * span + low

    scored = windows.select(
        "sensor_id",
        "label",
        *[unscaled(score_scaled(windows, m)).alias(f"_p{i}") for i, m in enumerate(models)],
    )
    aggs = []
    for i, _ in enumerate(models):
        err = F.col("label") - F.col(f"_p{i}")
        aggs += [F.avg(F.abs(err)).alias(f"mae{i}"), F.avg(err * err).alias(f"mse{i}")]
    wide = scored.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n_windows"), *aggs)
    entries = F.array(
        *[
            F.struct(F.lit(m.name).alias("model"), F.col(f"mae{i}").alias("mae"), F.col(f"mse{i}").alias("mse"))
            for i, m in enumerate(models)
        ]
    )
    return wide.select("sensor_id", "n_windows", F.explode(entries).alias("m")).select(
        "sensor_id", "m.model", "m.mae", "m.mse", "n_windows"
    )


def compare(new: DataFrame, old: DataFrame, sensors: DataFrame) -> DataFrame:
    """BETTER when the new MAE is strictly below the old one, else WORSE; a
    missing metric counts as 9999.0."""
    n = new.select("sensor_id", F.col("mae").alias("_nm"), F.col("mse").alias("_ns"))
    o = old.select("sensor_id", F.col("mae").alias("_om"))
    j = sensors.select("sensor_id").distinct().join(n, "sensor_id", "left").join(o, "sensor_id", "left")
    miss = F.lit(C.MISSING_METRIC)
    new_mae, old_mae = F.coalesce(q4("_nm"), miss), F.coalesce(q4("_om"), miss)
    new_mse = F.coalesce(q4("_ns"), miss)
    better = F.coalesce(F.col("_nm"), miss) < F.coalesce(F.col("_om"), miss)  # decided on unrounded values
    return j.select(
        "sensor_id",
        new_mae.alias("new_mae"),
        new_mse.alias("new_mse"),
        old_mae.alias("old_mae"),
        F.when(better, F.lit("BETTER")).otherwise(F.lit("WORSE")).alias("result"),
    )


def report(comparison: DataFrame) -> DataFrame:
    """The evaluation report document per sensor."""
    return comparison.select(
        "sensor_id",
        eval_report_struct(F.col("new_mae"), F.col("new_mse"), F.col("old_mae"), F.col("result")).alias("report"),
    )
