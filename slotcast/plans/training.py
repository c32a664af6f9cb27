"""Training windows: sort, newest 70 %, scale, 288-row windows, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast import config as C
from slotcast.operators import ordering as O
from slotcast.operators import sequences as Q


def indexed_rows(readings: DataFrame, tail: float | None = C.TRAIN_TAIL_FRACTION) -> DataFrame:
    """Raw rows in time order with ``idx`` / ``n_rows`` restarted at the tail
    cut (the whole history when ``tail`` is None)."""
    idx = O.sequence_index(readings)
    if tail is None:
        return idx.withColumnRenamed("n_total", "n_rows")
    cut = F.floor(F.col("n_total").cast("double") * (F.lit(1.0) - F.lit(float(tail)))).cast("long")
    t = O.tail_fraction(idx, tail)
    return t.withColumn("idx", F.col("idx") - cut).withColumn("n_rows", F.col("n_total") - cut).drop("n_total")


def window_digests(rows: DataFrame, n: int = C.N_STEPS, lead: int = C.TRAIN_LEAD) -> DataFrame:
    """Digest of every training window (first/last/sum of the scaled count,
    sum of the scaled hour, scaled label): windows start at ``window_idx``;
    there are ``n_rows - n`` per key."""
    d = Q.window_digest(
        rows,
        n,
        lead,
        sums={"sum_car": F.col("car_count"), "sum_hour": F.hour("ts")},
        firsts={"first_car": F.col("car_count")},
        label=F.col("car_count"),
        carry=("ts", "car_count", "n_rows"),
    )
    return d.select(
        "sensor_id",
        (F.col("idx") - (n - 1)).alias("window_idx"),
        (F.col("n_rows") - n).alias("n_windows"),
        F.col("ts").alias("end_ts"),
        (F.col("first_car").cast("double") / F.lit(C.CAR_MAX)).alias("first_car"),
        (F.col("car_count").cast("double") / F.lit(C.CAR_MAX)).alias("last_car"),
        (F.col("sum_car").cast("double") / F.lit(C.CAR_MAX)).alias("sum_car"),
        (F.col("sum_hour").cast("double") / F.lit(C.HOUR_MAX)).alias("sum_hour"),
        (F.col("label").cast("double") / F.lit(C.CAR_MAX)).alias("label"),
    )


def window_tensors(rows: DataFrame, n: int = C.N_STEPS, lead: int = C.TRAIN_LEAD) -> DataFrame:
    """Training windows as flat ``x`` ([n, 2] row-major: scaled count, scaled
    hour) and scaled ``label``."""
    scaled = rows.withColumn("car_scaled", F.col("car_count").cast("double") / F.lit(C.CAR_MAX)).withColumn(
        "hour_scaled", F.hour("ts").cast("double") / F.lit(C.HOUR_MAX)
    )
    t = Q.window_arrays(scaled, n, lead, ["car_scaled", "hour_scaled"], F.col("car_scaled"), carry=("n_rows",))
    return t.select(
        "sensor_id",
        (F.col("idx") - (n - 1)).alias("window_idx"),
        (F.col("n_rows") - n).alias("n_windows"),
        "x",
        "label",
    )


def split(windows: DataFrame, start: float = C.VALID_START_FRACTION, end: float = C.VALID_END_FRACTION) -> DataFrame:
    """``split`` = valid for the 80-90 % slice of each key's windows, train
    elsewhere; ``part`` = head / tail for the training rows."""
    return O.split_label(windows, start, end, idx="window_idx", total="n_windows")


def training_set(readings: DataFrame, n: int = C.N_STEPS, tail: float = C.TRAIN_TAIL_FRACTION, tensors: bool = False) -> DataFrame:
    """read -> sort -> newest 70 % -> scale -> windows (digests or tensors)."""
    rows = indexed_rows(readings, tail)
    return window_tensors(rows, n) if tensors else window_digests(rows, n)


def write_windows(windows: DataFrame, path: str) -> None:
    """Save ``x`` / ``label`` with ``sensor_id`` as a column.  No folder per
    sensor: with many sensors that would be one file per (task, sensor).  The
    window plan emits rows clustered by (sensor, chunk) in position order, so
    the Parquet row-group statistics on ``sensor_id`` still skip data for
    per-sensor reads.  Files hold at most one chunk of windows
    (``WINDOW_FILE_ROWS``): a window row is ~4.6 KB of doubles but compresses
    well, and splits are planned on compressed bytes, so bounded files keep
    the fit's passes spread over all cores."""
    windows.write.mode("overwrite").option("maxRecordsPerFile", WINDOW_FILE_ROWS).parquet(path)


WINDOW_FILE_ROWS = 4096
