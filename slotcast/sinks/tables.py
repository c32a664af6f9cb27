"""Upsert into date-partitioned Parquet tables (no table format needed).

Streams and repeated writes use the run tables of ``sinks.deltas`` (``readings_deltas``, ``predictions_deltas``),
whose writes cost what the batch costs.  ``upsert`` below is for a plain Parquet folder that other tools read as it
is: it rewrites the touched dates.

``upsert`` reads only the date partitions the batch touches, keeps the last
row per key, writes the merged partitions to a staging folder and then
replaces exactly those partitions (dynamic partition overwrite), so a plan
never overwrites the files it reads.  Re-running a batch gives the same table.
The staging folder is removed afterwards.

The last write wins: every row carries the number of the write (the batch id of
a stream) that brought it, and that is the leading order column.  A key lies in
one date partition only, so it is unique over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast import session as SS
from slotcast.operators.dedup import keep_last
from slotcast.operators.edges import sensor_dates
from slotcast.sinks.deltas import DeltaTable


def upsert(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    key: list[str],
    order: list[str],
    ts: str,
    after=None,
) -> DataFrame:
    """Merge ``batch`` into ``table``, partitioned by the date of ``ts``, which must be a key column;
    returns the touched (date) rows.  ``after`` gets the merged rows of those dates."""
    b = batch.withColumn("date", F.to_date(ts))
    dates = [r["date"] for r in b.select("date").distinct().collect()]  # a calendar, so bounded
    touched = spark.createDataFrame([(d,) for d in dates], "date date")
    if not dates:
        return touched
    both = b
    if SS.table_ready(spark, table):
        old = spark.read.schema(b.schema).parquet(table).where(F.col("date").isin([F.lit(d) for d in dates]))
        both = old.unionByName(b.select(*old.columns))
    staging = SS.scratch_path(spark, "upsert_staging")
    keep_last(both, key, order).write.mode("overwrite").parquet(staging)
    try:
        merged = spark.read.schema(b.schema).parquet(staging)
        write_dates(merged.hint("rebalance", "date", key[0]).sortWithinPartitions("date", *key), table)
        if after is not None:
            after(merged)
    finally:
        SS.delete(spark, staging)
    return touched


def write_dates(rows: DataFrame, table: str) -> None:
    """Replace the date partitions that ``rows`` holds."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(table)
    SS.mark_ready(rows.sparkSession, table)


def dates_path(table: str) -> str:
    return table.rstrip("/") + "_dates"


def upsert_readings(spark: SparkSession, table: str, batch: DataFrame, write_seq: int = 0) -> DataFrame:
    """Key (sensor_id, ts); the latest write wins, within a write the latest ingest.  The table of each
    sensor's dates beside it follows."""
    cols = ["sensor_id", "ts", "car_count", "free_spots", "ingest_seq", "write_seq"]
    rows = batch.withColumn("write_seq", F.lit(write_seq).cast("long")).select(*cols)
    return upsert(
        spark, table, rows, ["sensor_id", "ts"], ["write_seq", "ingest_seq"], "ts",
        after=lambda merged: write_dates(sensor_dates(merged), dates_path(table)),
    )


def upsert_predictions(spark: SparkSession, table: str, batch: DataFrame, write_seq: int = 0) -> DataFrame:
    """Key (sensor_id, timestamp); the latest write wins, within a write the latest ``created_at``.  The
    table is partitioned by the key's date: a forecast whose target moves to another day replaces
    the old one."""
    cols = ["sensor_id", "timestamp", "prediction", "prediction_for", "created_at", "write_seq"]
    rows = batch.withColumn("write_seq", F.lit(write_seq).cast("long")).select(*cols)
    return upsert(spark, table, rows, ["sensor_id", "timestamp"], ["write_seq", "created_at"], "timestamp")


READINGS_TABLE = f"sensor_id string, ts timestamp_ntz, car_count {C.COUNT_TYPE}, free_spots array<int>, ingest_seq bigint, write_seq bigint, date date"
DATES_TABLE = "sensor_id string, n bigint, first_bucket timestamp_ntz, last_bucket timestamp_ntz, write_seq bigint, date date"
PREDICTIONS_TABLE = "sensor_id string, timestamp timestamp_ntz, prediction int, prediction_for timestamp_ntz, created_at timestamp_ntz, write_seq bigint, date date"
WINDOWS_TABLE = "window_idx bigint, n_windows bigint, x array<double>, label double, sensor_id string"


def readings_deltas(spark: SparkSession, path: str) -> DeltaTable:
    """Readings by (sensor_id, ts); the latest write wins, within a write the latest ingest."""
    return DeltaTable(spark, path, READINGS_TABLE, ["sensor_id", "ts"], ["ingest_seq"], "ts")


def predictions_deltas(spark: SparkSession, path: str) -> DeltaTable:
    """Forecasts by (sensor_id, timestamp); the latest write wins, within a write the latest ``created_at``."""
    return DeltaTable(spark, path, PREDICTIONS_TABLE, ["sensor_id", "timestamp"], ["created_at"], "timestamp")


def dates_deltas(spark: SparkSession, table: str) -> DeltaTable:
    """The table of each sensor's dates beside a readings table."""
    return DeltaTable(spark, dates_path(table), DATES_TABLE, ["sensor_id", "date"], [], "date")


def write_readings(spark: SparkSession, path: str, batch: DataFrame, write_seq: int | None = None) -> int | None:
    """Add a batch to the readings at ``path`` and to the table of dates beside it, whose counts of the touched (sensor, date)
    pairs are taken from the merged readings."""
    table = readings_deltas(spark, path)
    seq = table.write(batch, write_seq)
    if seq is not None:
        touched = touched_pairs(table, seq)
        days = [r["date"] for r in touched.select("date").distinct().collect()]  # a calendar, so bounded
        rows = table.read().where(F.col("date").isin([F.lit(d) for d in days])).join(touched, ["sensor_id", "date"], "left_semi")
        dates_deltas(spark, path).write(sensor_dates(rows), seq)
    return seq


def touched_pairs(table: DeltaTable, write_seq: int) -> DataFrame:
    """(sensor_id, date) that a write holds; its run must not be folded yet."""
    own = [r for r in table.runs() if (r.first, r.last) == (write_seq, write_seq)]
    return table.merged(own).select("sensor_id", "date").distinct()


def fold_readings(spark: SparkSession, path: str) -> None:
    readings_deltas(spark, path).fold()
    dates_deltas(spark, path).fold()


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read one of our tables, plain or of runs, with its schema (an empty table has no files
    to infer a schema from)."""
    if not SS.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if any(name.startswith("run-") for name in SS.listed(spark, path)):
        return {READINGS_TABLE: readings_deltas, PREDICTIONS_TABLE: predictions_deltas}[schema](spark, path).read()
    return spark.read.schema(schema).parquet(path)
