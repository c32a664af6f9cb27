"""Late readings reach the exported days and the master history.

The ingest adds readings by event time, so a late reading lands in its (old) date.  ``Exports`` and ``Master`` are
sinks of the ingest: the days that a batch touched are exported again if they were exported before (dynamic
partition overwrite replaces only those day folders), and merged into the master, which keeps one row per
sensor and second.  Both write whole days from the readings table, so doing a batch twice changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast import session as SS
from slotcast.plans.scoring import LinearModel
from slotcast.sinks.exports import merge_master, write_daily_actuals
from slotcast.sinks.tables import readings_deltas
from slotcast.streaming.ingest import Ingest, Scoring


def readings_of(spark: SparkSession, table: str, dates: DataFrame) -> DataFrame:
    """All readings of some dates (a calendar, so bounded)."""
    days = [r["date"] for r in dates.select("date").distinct().collect()]
    return readings_deltas(spark, table).read().where(F.col("date").isin([F.lit(d) for d in days]))


class Exports:
    def __init__(self, readings_table: str, exports_root: str, exported_log: str):
        self.readings_table, self.exports_root, self.exported_log = readings_table, exports_root, exported_log

    def exported_dates(self, spark: SparkSession) -> DataFrame:
        if not SS.path_exists(spark, self.exported_log):
            return spark.createDataFrame([], "date date")
        return spark.read.parquet(self.exported_log).select("date").distinct()

    def export(self, spark: SparkSession, dates: DataFrame, batch_id: int) -> None:
        write_daily_actuals(readings_of(spark, self.readings_table, dates), self.exports_root)
        dates.select("date").write.mode("overwrite").parquet(f"{self.exported_log}/batch_id={batch_id}")

    def __call__(self, spark: SparkSession, touched: DataFrame, batch_id: int) -> None:
        reopened = touched.select("date").distinct().join(self.exported_dates(spark), "date", "left_semi")
        if reopened.head(1):
            self.export(spark, reopened, batch_id)

    def export_all(self, spark: SparkSession, batch_id: int = -1) -> None:
        """The scheduled export of every day present so far."""
        self.export(spark, readings_deltas(spark, self.readings_table).read().select("date").distinct(), batch_id)


class Master:
    def __init__(self, readings_table: str, master_root: str):
        self.readings_table, self.master_root = readings_table, master_root

    def __call__(self, spark: SparkSession, touched: DataFrame, batch_id: int) -> None:
        rows = readings_of(spark, self.readings_table, touched).join(touched, ["sensor_id", "date"], "left_semi")
        merge_master(spark, self.master_root, rows)


class LateAwareIngest(Ingest):
    """Ingest that exports reopened days again, and, where their places are given, keeps the master and the forecasts."""

    def __init__(self, readings_table: str, exports_root: str, exported_log: str, master_root: str | None = None, predictions_table: str | None = None, model: LinearModel | None = None):
        self.exports = Exports(readings_table, exports_root, exported_log)
        sinks = {"exports": self.exports}
        if master_root:
            sinks["master"] = Master(readings_table, master_root)
        if predictions_table:
            sinks["scoring"] = Scoring(readings_table, predictions_table, model)
        super().__init__(readings_table, sinks)

    def export_all(self, spark: SparkSession, batch_id: int = -1) -> None:
        self.exports.export_all(spark, batch_id)
