"""Comparison (strict <, 9999.0 for missing) and promotion decisions."""

from pyspark.sql import functions as F

from slotcast.plans import evaluate as EV
from slotcast.plans import promote as PM


def test_compare_rules(spark):
    new = spark.createDataFrame([("a", 4.1, 20.0), ("b", 5.0, 30.0)], "sensor_id string, mae double, mse double")
    old = spark.createDataFrame([("a", 5.0, 1.0), ("b", 5.0, 1.0)], "sensor_id string, mae double, mse double")
    sensors = spark.createDataFrame([("a",), ("b",), ("c",)], "sensor_id string")
    out = {r["sensor_id"]: r for r in EV.compare(new, old, sensors).collect()}
    assert out["a"]["result"] == "BETTER"
    assert out["b"]["result"] == "WORSE"  # equal is not better
    assert out["c"]["new_mae"] == 9999.0 and out["c"]["old_mae"] == 9999.0 and out["c"]["result"] == "WORSE"


def test_promote_decisions(spark):
    cmp = spark.createDataFrame([("a", 4.1, 20.0, 5.0, "BETTER"), ("b", 6.0, 30.0, 5.0, "WORSE")],
                                "sensor_id string, new_mae double, new_mse double, old_mae double, result string")
    rep = EV.report(cmp).select(F.concat(F.lit("s3://bkt/reports/"), F.col("sensor_id")).alias("report_uri"), F.col("report").alias("r"))
    packages = spark.createDataFrame(
        [("arn:a", "s3://bkt/reports/a"), ("arn:b", "s3://bkt/reports/b"), ("arn:c", None), ("arn:d", "s3://bkt/reports/zzz")],
        "model_package_arn string, metrics_uri string",
    )
    events = packages.select(F.to_json(F.struct(F.struct(F.col("model_package_arn").alias("ModelPackageArn")).alias("detail"))).alias("body"))
    j = PM.join_reports(events, packages, rep).withColumn("sensor_id", F.lit("x"))
    out = {r["model_package_arn"]: r for r in PM.decide(j).collect()}
    assert out["arn:a"]["status"] == "Approved" and out["arn:a"]["description"] == "Auto-approved: Better Performance (4.1 < 5.0)"
    assert out["arn:b"]["status"] == "Rejected" and out["arn:b"]["description"] == "Auto-rejected: Worse Performance (6.0 >= 5.0)"
    assert out["arn:c"]["description"] == "Error: Report not found." and out["arn:d"]["status"] == "Rejected"
    uri = j.where("model_package_arn = 'arn:a'").select("uri_scheme", "uri_bucket", "uri_key").collect()[0]
    assert tuple(uri) == ("s3", "bkt", "reports/a")
