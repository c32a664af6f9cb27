"""Column-level helpers: all built-in Spark expressions (JVM side, codegen)."""

from slotcast.functions.numeric import coerce_count, exact_mean, q4, round_half_even_int
from slotcast.functions.timecols import (
    bucket_start,
    epoch_seconds,
    fmt_day_first,
    fmt_iso,
    parse_day_first,
    parse_lenient,
    slot_of_day,
)

__all__ = [
    "bucket_start",
    "coerce_count",
    "epoch_seconds",
    "exact_mean",
    "fmt_day_first",
    "fmt_iso",
    "parse_day_first",
    "parse_lenient",
    "q4",
    "round_half_even_int",
    "slot_of_day",
]
