"""Key + time range scan over a date-partitioned table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ts(x):
    return F.lit(x).cast("timestamp_ntz") if isinstance(x, (str, dt.datetime)) else x


def key_range_scan(
    table: DataFrame,
    start,
    end,
    sensors: list[str] | None = None,
    ts: str = "ts",
    date_from_ts: bool = True,
) -> DataFrame:
    """Rows with ``ts BETWEEN start AND end`` (inclusive) for the given sensors
    (all when None).  When the table's ``date`` partition is the date of
    ``ts`` (``date_from_ts``), a ``date`` predicate beside the time predicate
    prunes the partitions; sensor and time filters are pushed to Parquet."""
    s, e = _ts(start), _ts(end)
    cond = F.col(ts).between(s, e)
    if date_from_ts:
        cond = cond & F.col("date").between(F.to_date(s), F.to_date(e))
    if sensors is not None:
        cond = cond & F.col("sensor_id").isin(list(sensors))
    return table.where(cond)
