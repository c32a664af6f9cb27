"""Intermediate tables of the operators: written once under the shared folder
(``spark.checkpoint.dir``) and read back, which cuts the lineage and survives lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotcast.session import delete, scratch_path

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024  # whole texts per Arrow batch while tables are written, which bounds the workers' memory
MANY_FILES = 1 << 20  # of which the numbers are broadcast


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared root and read it back."""
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """(_row, _place): the rows of ``df`` as a struct, and a number that tells them apart however often they are read.

    Of a table in files it is the file's number and the row's place in the file, so nothing is written.  Any
    other table, and one of more than ``MANY_FILES`` files, is written once with its numbers."""
    row = F.struct(*df.columns).alias("_row")
    try:
        placed = df.select(row, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
        files = sorted(r[0] for r in placed.select("_file").distinct().limit(MANY_FILES + 1).collect())
    except AnalysisException:
        files = []
    if not files or len(files) > MANY_FILES:
        return written(df.select(row, F.monotonically_increasing_id().alias("_place")), "numbered")
    ids = df.sparkSession.createDataFrame(list(enumerate(files)), "_number long, _file string")
    placed = placed.join(F.broadcast(ids), "_file")  # a counted number of rows
    return placed.select("_row", (F.col("_number") * (1 << 40) + F.col("_index")).alias("_place"))


class Scratch:
    """Intermediate tables by name.  A table that is put again replaces the one before, which is deleted once the new one is
    written; ``free`` deletes tables that nothing reads any more."""

    def __init__(self) -> None:
        self.at: dict[str, tuple] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, name)
        with small_batches(spark):
            df.write.parquet(path)
        self.free(name)
        self.at[name] = (spark, path)
        return spark.read.schema(df.schema).parquet(path)

    def free(self, *names: str) -> None:
        for name in names:
            if name in self.at:
                delete(*self.at.pop(name))


def text_crc32(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; a null text counts as empty."""
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
