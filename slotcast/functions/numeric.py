"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotcast import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q4(c, places: int = 4) -> Column:
    """Report rounding: through DECIMAL(38,9) then half-up to ``places``.

    Going through a decimal first makes the rounding independent of the last
    bits of a floating sum (which depend on partitioning).
    """
    return F.round(_col(c).cast("decimal(38,9)"), places).cast("double")


def exact_mean(c) -> Column:
    """Mean as exact decimal sum / count: the same double on every partitioning."""
    x = _col(c)
    return (F.sum(x).cast("double") / F.count(x)).cast("double")


def coerce_count(c) -> Column:
    """Numeric coercion of a count given as text or number; bad -> NULL."""
    return _col(c).cast("string").try_cast(C.COUNT_TYPE)


def count_text(c) -> Column:
    """A count as text, without the zeros of its stored scale."""
    return _col(c).cast("double").cast("string")


def round_half_even_int(c) -> Column:
    """Python-style int(round(x)): half-even to 0 places."""
    return F.bround(_col(c), 0).cast("int")
