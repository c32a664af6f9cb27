"""Streaming ingest of reading envelopes: one handler, any number of sinks.

Each micro-batch (``foreachBatch``): parse the envelopes, add the valid readings to the table as a run of
their own (``sinks.deltas``), and record the (sensor, date) pairs they touched in the ledger.  Then every sink works
through the batches it hasn't dealt with: ``Scoring`` forecasts the touched sensors, ``late.Exports`` exports
days again that were exported before, ``late.Master`` merges touched days into the master history,
``resample.Changes`` adds up what the batch changed in every 5-minute bucket.  Runs are folded at the end of a batch,
when all sinks are done with it.

A replayed batch changes nothing: its run is the same or already folded, and sinks that had finished it pass
over it.  Everything inside a batch is an ordinary distributed DataFrame job; the stream's checkpoint lives under
the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.functions.features import scale_fixed
from slotcast.functions.timecols import fmt_day_first
from slotcast.operators.edges import dates_of_latest_rows, read_dates
from slotcast.operators.ordering import latest_n
from slotcast.operators.sequences import last_window
from slotcast.operators.series import regular_series
from slotcast.plans.scoring import LinearModel, serve
from slotcast.session import delete, scratch_path
from slotcast.sinks.deltas import changes
from slotcast.sinks.tables import dates_deltas, fold_readings, predictions_deltas, readings_deltas, touched_pairs, write_readings
from slotcast.sources.payloads import ENVELOPE, parse_reading
from slotcast.streaming.ledger import Ledger


def envelopes(readings: DataFrame) -> DataFrame:
    """Reading envelopes as the devices send them: day-first time text, the
    count, free spots (one JSON body per reading)."""
    body = F.to_json(
        F.struct(
            fmt_day_first("ts").alias("timestamp"),
            F.col("car_count").cast("double").alias("car_count"),
            "free_spots",
        )
    )
    return readings.select("sensor_id", F.col("ingest_seq").cast("long").alias("ingest_seq"), body.alias("body"), F.to_date("ts").alias("date"))


def write_landing(env: DataFrame, path: str) -> None:
    """Land envelopes as JSON-lines files, one folder per date."""
    env.hint("rebalance", "date", "sensor_id").write.mode("append").partitionBy("date").json(path)


def read_landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(ENVELOPE).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


class Ingest:
    """The per-batch work: readings, ledger, sinks.

    A sink is called with (spark, touched (sensor, date) pairs, batch id); one with ``takes_changes`` is called for
    each batch with its changes instead (``sinks.deltas.changes``)."""

    def __init__(self, readings_table: str, sinks: dict | None = None):
        self.readings_table = readings_table
        self.sinks = sinks or {}

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.readings_table.rstrip("/") + "_ledger")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table, ledger = readings_deltas(spark, self.readings_table), self.ledger(spark)
        parsed = parse_reading(batch).where("valid").drop("valid")
        if write_readings(spark, self.readings_table, parsed, batch_id) is not None:
            ledger.record(batch_id, touched_pairs(table, batch_id))
        for name, sink in self.sinks.items():
            left = ledger.open_batches(name)
            if getattr(sink, "takes_changes", False):
                for b in left:
                    sink(spark, changes(table, b), b)
                    ledger.mark(name, b)
            elif left:
                sink(spark, ledger.touched(left), left[-1])
                ledger.mark(name, left[-1])
        fold_readings(spark, self.readings_table)
        ledger.forget(list(self.sinks))


class Scoring:
    """Newest 288 readings of the touched sensors -> series -> last window -> forecast.

    The newest readings are always those of the sensor, whatever dates the
    batch brought: a late reading refreshes the forecast at the sensor's end.
    A re-scored forecast carries the batch id and replaces the older one."""

    def __init__(self, readings_table: str, predictions_table: str, model: LinearModel | None = None):
        self.readings_table, self.predictions_table = readings_table, predictions_table
        self.model = model or LinearModel.seasonal_naive(C.SERVE_HORIZON)

    def __call__(self, spark: SparkSession, touched: DataFrame, batch_id: int) -> None:
        dates = dates_deltas(spark, self.readings_table).read().join(touched.select("sensor_id").distinct(), "sensor_id", "left_semi")
        ready = dates.groupBy("sensor_id").agg(F.sum("n").alias("n")).where(F.col("n") >= C.N_STEPS).select("sensor_id")
        needed = dates_of_latest_rows(dates.join(ready, "sensor_id", "left_semi"), C.N_STEPS)
        table = readings_deltas(spark, self.readings_table).read()
        recent = scratch_path(spark, "score_recent")  # touched sensors x 288 rows, written once
        latest_n(read_dates(table, needed), C.N_STEPS).drop("rank").write.parquet(recent)
        try:
            series = regular_series(spark.read.schema(table.schema).parquet(recent))
            lw = last_window(scale_fixed(series), C.N_STEPS, ["car_scaled", "hour_scaled"]).where(F.col("n_rows") == C.N_STEPS)
            scored = serve(lw, self.model).withColumn("created_at", F.col("timestamp"))
            forecasts = predictions_deltas(spark, self.predictions_table)
            forecasts.write(scored, batch_id)
            forecasts.fold()
        finally:
            delete(spark, recent)


class ReadingIngest(Ingest):
    """Ingest, and scoring if a table of forecasts is given."""

    def __init__(self, readings_table: str, predictions_table: str | None = None, model: LinearModel | None = None):
        super().__init__(readings_table, {"scoring": Scoring(readings_table, predictions_table, model)} if predictions_table else {})


def run_ingest(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    handler,
    max_files: int | None = None,
) -> None:
    """Process everything in ``landing`` (availableNow) through ``handler``."""
    q = (
        read_landing_stream(spark, landing, max_files)
        .writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
