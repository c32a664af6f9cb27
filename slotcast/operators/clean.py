"""Projection and filter operators over raw readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.functions.numeric import coerce_count
from slotcast.functions.timecols import parse_lenient
from slotcast.schemas import require_columns


def clean_readings(df: DataFrame, value: str = "car_count", ts: str = "timestamp", out_ts: str = "ts") -> DataFrame:
    """Coerce the count to a number and the time to a timestamp (day-first or
    ISO text, bad -> NULL), then drop rows where either is NULL."""
    require_columns(df.columns, [value, ts], "readings")
    out = df.withColumn(value, coerce_count(value)).withColumn(out_ts, parse_lenient(ts))
    if out_ts != ts:
        out = out.drop(ts)
    return out.where(F.col(value).isNotNull() & F.col(out_ts).isNotNull())


def reading_columns(df: DataFrame, keys: tuple[str, ...] = ("sensor_id",)) -> DataFrame:
    """Keep and order ``car_count, timestamp`` (plus keys); drops ``free_spots``
    and anything else, absent or not."""
    require_columns(df.columns, ["car_count", "timestamp"], "readings")
    return df.select(*[k for k in keys if k in df.columns], "car_count", "timestamp")


def existing_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Keep only the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def min_history_status(counts: DataFrame, n_col: str = "n", need: int = 288) -> DataFrame:
    """READY when at least ``need`` points, else COLD_START with an n/need message."""
    n = F.col(n_col)
    return counts.withColumn("status", F.when(n >= need, F.lit("READY")).otherwise(F.lit("COLD_START"))).withColumn(
        "message",
        F.when(n >= need, F.lit(None).cast("string")).otherwise(
            F.format_string("COLD START: collecting data (%d/%d)", n, F.lit(need))
        ),
    )


def history_rules(counts: DataFrame, n_raw: str = "n_raw", n_steps: str = "n_steps", need: int = 288, lead: int = 12) -> DataFrame:
    """Whether a history is long enough, by the rule of each job: a forecast needs ``need`` readings, and as many steps once they
    are resampled; a training set needs more than ``need`` rows, an evaluation more than ``need + lead`` steps."""
    raw, steps = F.col(n_raw), F.col(n_steps)
    rules = {
        "serving": F.when(raw < need, F.lit("COLD_START")).when(steps < need, F.lit("NOT_ENOUGH_DATA")),
        "training": F.when(raw <= need, F.lit("NOT_ENOUGH_DATA")),
        "evaluation": F.when(steps <= need + lead, F.lit("NOT_ENOUGH_DATA")),
    }
    return counts.withColumns({name: F.coalesce(bad, F.lit("READY")) for name, bad in rules.items()})
