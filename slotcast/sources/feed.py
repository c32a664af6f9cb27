"""The readings feed, read from the driver's ``events`` table.

Mapping: sensor_id <- event_type, ts <- ts, car_count <- value (stored as
decimal like the source's store, config.COUNT_TYPE), free_spots <- [props.k],
ingest order <- event_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings keyed by sensor (a reading without a sensor key is dropped
    here, once, so every branch of a plan carries the same constraint and
    Spark can reuse shared shuffles)."""
    ev = events(spark, sf_dir).where(F.col("event_type").isNotNull())
    return ev.select(
        F.col("event_type").alias("sensor_id"),
        F.col("ts"),
        F.col("value").cast(C.COUNT_TYPE).alias("car_count"),
        F.array(F.get_json_object("props", "$.k").try_cast("int")).alias("free_spots"),
        F.col("event_id").alias("ingest_seq"),
    )


def raw_text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the edge device stores them: ISO text with microseconds and
    the count as text (the shape ``flt_clean_readings`` coerces)."""
    ev = events(spark, sf_dir).where(F.col("event_type").isNotNull())
    return ev.select(
        F.col("event_type").alias("sensor_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("value").cast("string").alias("car_count"),
        F.col("event_id").alias("ingest_seq"),
    )
