"""Streaming 5-minute resample that loses no late reading and counts a corrected one once.

A mean per bucket is a sum and a count, and both add up.  The readings are kept by (sensor, time), and every
micro-batch gives what it changed there: the new row of a key, and the old one, if there was one, taken back
(``sinks.deltas.changes``).  The signed sums per bucket go into a change log partitioned
by batch id (a replayed batch overwrites its folder), and the table is the sum
over the log.  So a reading enters its bucket by its event time however late it arrives, a reading that is sent again
replaces the one before, and no watermark drops any.  ``compact`` folds finished batches into one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast import session as SS
from slotcast.functions.timecols import bucket_start
from slotcast.streaming.ingest import Ingest, run_ingest

CHANGES = f"sensor_id string, bucket timestamp_ntz, sum_count {C.COUNT_TYPE.replace('28', '38')}, n bigint, batch_id bigint"


def signed_sums(changed: DataFrame) -> DataFrame:
    """Sum and count per (sensor, bucket) of added less retracted readings; buckets in which nothing changed are left out."""
    sums = changed.groupBy("sensor_id", bucket_start("ts").alias("bucket")).agg(
        F.sum(F.when(F.col("sign") > 0, F.col("car_count")).otherwise(-F.col("car_count"))).alias("sum_count"), F.sum("sign").alias("n")
    )
    return sums.where("n <> 0 OR sum_count <> 0")


class Changes:
    """Sink of the ingest that keeps the change log."""

    takes_changes = True

    def __init__(self, root: str):
        self.root = root

    def __call__(self, spark: SparkSession, changed: DataFrame, batch_id: int) -> None:
        signed_sums(changed).write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")


def run_resample(spark: SparkSession, landing: str, changes: str, checkpoint: str, max_files: int | None = None) -> None:
    """The stream with the log as its sink; the readings lie beside it."""
    run_ingest(spark, landing, checkpoint, Ingest(changes.rstrip("/") + "_readings", {"resample": Changes(changes)}), max_files)


def compact(spark: SparkSession, changes: str, upto: int, target: str) -> None:
    """Fold the batches up to ``upto`` into batch ``upto`` of the new log ``target``; later ones are copied."""
    log = read_changes(spark, changes).withColumn("batch_id", F.greatest("batch_id", F.lit(upto).cast("long")))
    folded = log.groupBy("batch_id", "sensor_id", "bucket").agg(F.sum("sum_count").alias("sum_count"), F.sum("n").alias("n"))
    folded.write.mode("overwrite").partitionBy("batch_id").parquet(target)


def read_changes(spark: SparkSession, changes: str) -> DataFrame:
    if not SS.path_exists(spark, changes):
        return spark.createDataFrame([], CHANGES)
    return spark.read.schema(CHANGES).parquet(changes)


def resampled_view(spark: SparkSession, changes: str) -> DataFrame:
    """The mean of every (sensor, bucket) over all batches so far."""
    log = read_changes(spark, changes).groupBy("sensor_id", "bucket").agg(F.sum("sum_count").alias("sum_count"), F.sum("n").alias("n"))
    return log.where("n > 0").select("sensor_id", "bucket", (F.col("sum_count").cast("double") / F.col("n")).alias("car_count"), "n")
