"""What each micro-batch touched, and which sink has dealt with it.

The ingest handler records the (sensor, date) pairs of a batch once its readings are written.  Every
sink works through the batches that it hasn't marked yet, in order, and marks them when it is done.
A batch that is replayed after a crash is recorded again with the same pairs; sinks that had finished it
pass over it, the others do it again, and each of them writes what it would have written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast import session as SS

PAIRS = "sensor_id string, date date"


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _numbers(self, folder: str) -> list[int]:
        if not SS.path_exists(self.spark, folder):
            return []
        return sorted(int(x.removeprefix("batch-")) for x in SS.listed(self.spark, folder) if x.startswith("batch-"))

    def record(self, batch_id: int, touched: DataFrame) -> None:
        touched.select("sensor_id", "date").write.mode("overwrite").parquet(f"{self.root}/touched/batch-{batch_id:012d}")

    def recorded(self) -> list[int]:
        """Batches whose pairs are committed."""
        return [b for b in self._numbers(f"{self.root}/touched") if SS.table_ready(self.spark, f"{self.root}/touched/batch-{b:012d}")]

    def done(self, sink: str) -> int:
        """The last batch that the sink has dealt with, -1 before the first."""
        return max(self._numbers(f"{self.root}/done/{sink}"), default=-1)

    def open_batches(self, sink: str) -> list[int]:
        last = self.done(sink)
        return [b for b in self.recorded() if b > last]

    def touched(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], PAIRS)
        return self.spark.read.schema(PAIRS).parquet(*(f"{self.root}/touched/batch-{b:012d}" for b in batches)).distinct()

    def mark(self, sink: str, batch_id: int) -> None:
        """The sink has dealt with all batches up to this one."""
        before = self._numbers(f"{self.root}/done/{sink}")
        SS.touch(self.spark, f"{self.root}/done/{sink}/batch-{batch_id:012d}")
        for b in before:
            if b < batch_id:
                SS.delete(self.spark, f"{self.root}/done/{sink}/batch-{b:012d}")

    def forget(self, sinks: list[str]) -> None:
        """Delete the pairs of batches that all sinks are done with."""
        last = min((self.done(s) for s in sinks), default=-1)
        for b in self._numbers(f"{self.root}/touched"):
            if b < last:
                SS.delete(self.spark, f"{self.root}/touched/batch-{b:012d}")
