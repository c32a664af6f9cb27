"""Regular 5-minute series: resample mean, time spine, time interpolation.

Scale design
------------
* ``resample_mean`` is a plain ``groupBy`` with map-side partial aggregation;
  the exact decimal sum makes the mean independent of partitioning.
* After resampling a (sensor, date) holds at most 288 rows, so every window in
  this module is partitioned by ``(sensor_id, date)``: a hot sensor spreads
  over as many tasks as it has days.  What crosses a midnight -- the last known
  bucket before a day and the first one after it -- comes from a carry table
  with one row per (sensor, date), a window over which is tiny.
* The spine is generated per (sensor, date) with ``sequence`` (no join against
  a calendar), and is unioned with the known buckets, so the single shuffle is
  the one the window needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from slotcast import config as C
from slotcast.functions.numeric import exact_mean
from slotcast.functions.timecols import bucket_start, epoch_seconds


def resample_mean(
    df: DataFrame,
    value: str = "car_count",
    ts: str = "ts",
    keys: tuple[str, ...] = ("sensor_id",),
    step_minutes: int = C.STEP_MINUTES,
) -> DataFrame:
    """Mean per step bucket (left-closed, left-labelled), NULL values skipped.

    Returns ``keys + (bucket, date, <value>, n)``; only occupied buckets.
    """
    b = bucket_start(ts, step_minutes).alias("bucket")
    out = (
        df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .groupBy(*keys, b)
        .agg(exact_mean(value).alias(value), F.count(value).alias("n"))
    )
    return out.withColumn("date", F.to_date("bucket"))


def _known(value: str, bucket: str = "bucket") -> Column:
    return F.when(F.col(value).isNotNull(), F.struct(F.col(bucket).alias("b"), F.col(value).alias("v")))


def day_edges(resampled: DataFrame, value: str, keys: tuple[str, ...] = ("sensor_id",)) -> DataFrame:
    """First and last known bucket of every (keys, date): the carry table."""
    k = resampled.where(F.col(value).isNotNull())
    return k.groupBy(*keys, "date").agg(
        F.min_by(F.struct(F.col("bucket").alias("b"), F.col(value).alias("v")), "bucket").alias("first_known"),
        F.max_by(F.struct(F.col("bucket").alias("b"), F.col(value).alias("v")), "bucket").alias("last_known"),
    )


def day_carries(edges: DataFrame, keys: tuple[str, ...] = ("sensor_id",), across_days: bool = True) -> DataFrame:
    """Dense date list per key with the bounds of the spine and the carries.

    ``lo``/``hi`` bound the spine inside a date (NULL = the whole day): the
    first known bucket on the key's first day, the last one on its last day
    (or the day's own when ``across_days`` is False).  ``carry_prev`` is the
    last known bucket before the date and ``carry_next`` the first known one
    after it.  Each day with data also covers the empty days up to the next
    day with data, so ``lag``/``lead`` over the (small) edge table is all it
    takes -- no calendar join."""
    if not across_days:
        return edges.select(
            *keys,
            "date",
            F.col("first_known.b").alias("lo"),
            F.col("last_known.b").alias("hi"),
            F.lit(None).cast(edges.schema["first_known"].dataType).alias("carry_prev"),
            F.lit(None).cast(edges.schema["first_known"].dataType).alias("carry_next"),
        )
    by_date = W.partitionBy(*keys).orderBy("date")
    e = edges.select(
        *keys,
        F.col("date").alias("data_date"),
        "first_known",
        "last_known",
        F.lag("last_known").over(by_date).alias("prev_last"),
        F.lead("first_known").over(by_date).alias("next_first"),
        F.lead("date").over(by_date).alias("next_date"),
    )
    covered = F.sequence(F.col("data_date"), F.coalesce(F.date_sub("next_date", 1), F.col("data_date")))
    e = e.select("*", F.explode(covered).alias("date"))
    own = F.col("date") == F.col("data_date")
    return e.select(
        *keys,
        "date",
        F.when(own & F.col("prev_last").isNull(), F.col("first_known.b")).alias("lo"),
        F.when(F.col("next_first").isNull(), F.col("last_known.b")).alias("hi"),
        F.when(own, F.col("prev_last")).otherwise(F.col("last_known")).alias("carry_prev"),
        F.col("next_first").alias("carry_next"),
    )


def spine(carries: DataFrame, keys: tuple[str, ...] = ("sensor_id",), step_minutes: int = C.STEP_MINUTES) -> DataFrame:
    """Every step bucket of every (keys, date) inside [lo, hi]."""
    day0 = F.col("date").cast("timestamp_ntz")
    last_of_day = day0 + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(24 * 60 - step_minutes))
    start = F.greatest(day0, F.col("lo"))  # greatest / least skip NULL bounds
    stop = F.least(last_of_day, F.col("hi"))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(step_minutes))
    return carries.where(start <= stop).select(
        *keys, "date", "carry_prev", "carry_next", F.explode(F.sequence(start, stop, step)).alias("bucket")
    )


def interpolate_time(
    resampled: DataFrame,
    value: str = "car_count",
    keys: tuple[str, ...] = ("sensor_id",),
    across_days: bool = True,
    step_minutes: int = C.STEP_MINUTES,
) -> DataFrame:
    """Fill every step bucket between the first and last known bucket.

    Linear in time between the neighbouring known buckets; a trailing gap takes
    the last known value; a leading gap stays NULL.  Returns
    ``keys + (date, bucket, <value>, observed)``.
    """
    carries = day_carries(day_edges(resampled, value, keys), keys, across_days)
    grid = spine(carries, keys, step_minutes)
    known = resampled.where(F.col(value).isNotNull()).select(
        *keys,
        "date",
        "bucket",
        F.lit(0).alias("kind"),
        F.col(value).alias("v"),
        F.lit(None).cast(carries.schema["carry_prev"].dataType).alias("carry_prev"),
        F.lit(None).cast(carries.schema["carry_next"].dataType).alias("carry_next"),
    )
    rows = grid.select(
        *keys, "date", "bucket", F.lit(1).alias("kind"), F.lit(None).cast("double").alias("v"), "carry_prev", "carry_next"
    ).unionByName(known)
    w = W.partitionBy(*keys, "date").orderBy("bucket", "kind")
    known_struct = _known("v")
    prev = F.coalesce(F.last(known_struct, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.col("carry_prev"))
    nxt = F.coalesce(F.first(known_struct, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing)), F.col("carry_next"))
    out = rows.select(*keys, "date", "bucket", "kind", prev.alias("p"), nxt.alias("nx")).where(F.col("kind") == 1)
    t = epoch_seconds("bucket").cast("double")
    tp = epoch_seconds("p.b").cast("double")
    tn = epoch_seconds("nx.b").cast("double")
    lerp = F.col("p.v") + (F.col("nx.v") - F.col("p.v")) * (t - tp) / (tn - tp)
    filled = (
        F.when(F.col("p.b") == F.col("bucket"), F.col("p.v"))
        .when(F.col("p").isNull(), F.lit(None).cast("double"))
        .when(F.col("nx").isNull(), F.col("p.v"))
        .otherwise(lerp)
    )
    return out.select(
        *keys,
        "date",
        "bucket",
        filled.alias(value),
        (F.col("p.b") == F.col("bucket")).alias("observed"),
    )


def time_spine(resampled: DataFrame, value: str = "car_count", keys: tuple[str, ...] = ("sensor_id",)) -> DataFrame:
    """Every step bucket between a key's first and last bucket, with the
    resampled mean where the bucket is occupied and NULL elsewhere."""
    carries = day_carries(day_edges(resampled, value, keys), keys, True)
    grid = spine(carries, keys).select(*keys, "date", "bucket")
    return grid.join(resampled.select(*keys, "date", "bucket", value), [*keys, "date", "bucket"], "left")


def regular_series(
    readings: DataFrame, value: str = "car_count", ts: str = "ts", keys: tuple[str, ...] = ("sensor_id",)
) -> DataFrame:
    """clean readings -> resample -> interpolate (the serving / evaluation series)."""
    return interpolate_time(resample_mean(readings, value, ts, keys), value, keys)
