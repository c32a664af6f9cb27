"""Registry events -> evaluation report -> approve / reject."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C

URI_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*):/+([^/]*)/(.*)$"


def parse_event(events: DataFrame, body: str = "body") -> DataFrame:
    """``detail.ModelPackageArn`` of each registry event JSON."""
    return events.withColumn("model_package_arn", F.get_json_object(body, "$.detail.ModelPackageArn"))


def split_uri(col: str) -> list:
    """scheme://bucket/key -> scheme, bucket, key."""
    return [
        F.regexp_extract(col, URI_PATTERN, 1).alias("uri_scheme"),
        F.regexp_extract(col, URI_PATTERN, 2).alias("uri_bucket"),
        F.regexp_extract(col, URI_PATTERN, 3).alias("uri_key"),
    ]


def join_reports(events: DataFrame, packages: DataFrame, reports: DataFrame) -> DataFrame:
    """Events left-join their package's metrics URI, then the report stored
    at that URI (absent URI or report -> NULL report)."""
    e = parse_event(events).join(packages, "model_package_arn", "left")
    e = e.select("*", *split_uri("metrics_uri"))
    return e.join(reports, e["metrics_uri"] == reports["report_uri"], "left").drop("report_uri")


def decide(joined: DataFrame) -> DataFrame:
    """Approved when the report says BETTER; Rejected otherwise, with the
    reason; no report -> Rejected."""
    result = F.coalesce(F.col("r.comparison.result"), F.lit("UNKNOWN"))
    new_mae = F.coalesce(F.col("r.comparison.new_mae").cast("string"), F.lit("N/A"))
    old_mae = F.coalesce(F.col("r.comparison.old_mae").cast("string"), F.lit("N/A"))
    has = F.col("r").isNotNull()
    status = F.when(has & (result == "BETTER"), F.lit(C.APPROVED)).otherwise(F.lit(C.REJECTED))
    reason = (
        F.when(~has, F.lit(C.NO_REPORT_TEXT))
        .when(result == "BETTER", F.format_string(C.APPROVED_TEXT, new_mae, old_mae))
        .otherwise(F.format_string(C.REJECTED_TEXT, new_mae, old_mae))
    )
    return joined.select(
        "model_package_arn", "sensor_id", has.alias("has_report"), result.alias("result"), status.alias("status"), reason.alias("description")
    )


def normalize_uri(col) -> F.Column:
    """file:/x, file:///x -> /x (same folder, one spelling)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, "^file:/+", "/")
