"""Time expressions over TIMESTAMP_NTZ columns (zone-free)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotcast import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_start(ts, step_minutes: int = C.STEP_MINUTES) -> Column:
    """Left-closed, left-labelled bucket; 5 min divides the day, so epoch
    alignment equals start-of-day alignment."""
    return F.window(_col(ts), f"{step_minutes} minutes").start


def bucket_floor(ts, step_minutes: int = C.STEP_MINUTES) -> Column:
    """The same bucket by arithmetic, for plans that need more than one per row."""
    step = step_minutes * 60
    secs = (F.floor(epoch_seconds(ts) / step) * step).cast("long")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 for a TIMESTAMP_NTZ (no zone applied)."""
    return F.unix_timestamp(_col(ts))


def slot_of_day(ts, step_minutes: int = C.STEP_MINUTES) -> Column:
    """Time of day as a slot number: hour * (60/step) + minute div step."""
    t = _col(ts)
    return F.hour(t) * (60 // step_minutes) + F.floor(F.minute(t) / step_minutes).cast("int")


_DAY_FIRST = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2}:\d{2})$"


def parse_day_first(text) -> Column:
    """Strict day-first text -> TIMESTAMP_NTZ; bad text -> NULL.  The text is turned into ISO text
    and cast, so no session zone is involved."""
    t = _col(text)
    return F.when(t.rlike(_DAY_FIRST), F.regexp_replace(t, _DAY_FIRST, "$3-$2-$1 $4")).try_cast("timestamp_ntz")


def parse_lenient(text) -> Column:
    """Day-first text, else ISO text (with or without fraction), else NULL."""
    t = F.trim(_col(text).cast("string"))
    return F.coalesce(parse_day_first(t), t.try_cast("timestamp_ntz"))


def fmt_day_first(ts) -> Column:
    """dd/MM/yyyy HH:mm:ss (drops the fraction)."""
    return F.date_format(_col(ts), C.DAY_FIRST_FORMAT)


def fmt_iso(ts, micros: bool = False) -> Column:
    return F.date_format(_col(ts), C.ISO_MICROS_FORMAT if micros else C.ISO_SECONDS_FORMAT)


def fmt_text(ts) -> Column:
    """Report text for a timestamp: yyyy-MM-dd HH:mm:ss.SSSSSS."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def fmt_seconds(ts) -> Column:
    return F.date_format(_col(ts), C.RESPONSE_FORMAT)


def fmt_date(d) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")


def add_steps(ts, steps, step_minutes: int = C.STEP_MINUTES) -> Column:
    steps_col = steps if isinstance(steps, Column) else F.lit(int(steps))
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), steps_col * step_minutes)
