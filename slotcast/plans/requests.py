"""Scoring requests: a payload of readings in, a response document or a rejection out.

All requests of a batch are one job: their records are parsed together, and every step is keyed by the
request.  A request's records become a regular series of their own (5-minute means, interpolated), whose newest
288 steps are scaled, scored and unscaled.  One row per request comes back; a rejected one has a reason and no response:

* ``UNSUPPORTED_TYPE``: neither JSON nor CSV;
* ``NO_RECORDS``: the body holds no record, or lacks a column;
* ``EMPTY``: no record has a readable count and time;
* ``NOT_ENOUGH_DATA``: fewer steps than the window after resampling.

Repeated request ids would be one request; a null id is dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.functions.features import scale_fixed
from slotcast.operators.sequences import last_window
from slotcast.operators.series import regular_series
from slotcast.plans.scoring import LinearModel, response_json, serve
from slotcast.sources.payloads import parse_payloads


def score_requests(payloads: DataFrame, model: LinearModel | None = None, key: str = "payload_id", horizon: int = C.SERVE_HORIZON) -> DataFrame:
    """(key, status, n_records, n_steps, response) of every request in ``payloads`` (key, content_type, body)."""
    model = model or LinearModel.seasonal_naive(horizon)
    requests = payloads.where(F.col(key).isNotNull())
    records = parse_payloads(requests.select(key, "content_type", "body"))
    kinds = records.groupBy(key).agg(
        F.bool_or(F.col("error") == "unsupported content type").alias("unsupported"),
        F.count_if(F.col("error") == "no records").alias("n_none"),
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("error").isNull()).alias("n_records"),
    )
    good = records.where(F.col("error").isNull()).select(key, "ts", "car_count")
    windows = last_window(scale_fixed(regular_series(good, keys=(key,))), model.n_steps, ["car_scaled", "hour_scaled"], (key,))
    steps = windows.select(key, F.col("n_rows").cast("long").alias("n_steps"))
    scored = response_json(serve(windows.where(F.col("n_rows") == model.n_steps), model, horizon, key), key)
    out = kinds.join(steps, key, "left").join(scored, key, "left")
    status = (
        F.when(F.coalesce("unsupported", F.lit(False)), F.lit("UNSUPPORTED_TYPE"))
        .when(F.col("n_none") == F.col("n_all"), F.lit("NO_RECORDS"))
        .when(F.col("n_records") == 0, F.lit("EMPTY"))
        .when(F.col("response").isNull(), F.lit("NOT_ENOUGH_DATA"))
        .otherwise(F.lit("OK"))
    )
    return out.select(key, status.alias("status"), "n_records", F.coalesce("n_steps", F.lit(0).cast("long")).alias("n_steps"), "response")
