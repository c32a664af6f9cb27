"""Union and keep-last dedup of history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_history(*parts: DataFrame) -> DataFrame:
    """Concatenate history parts by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def keep_last(
    df: DataFrame,
    key: list[str],
    order: list[str],
) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` tuple.

    Written as ``max_by`` over a struct rather than ``row_number``: it sorts too (a
    struct buffer needs Spark's sort aggregate), but aggregates partially, so only
    one candidate per key and map task crosses the shuffle."""
    others = [c for c in df.columns if c not in key]
    packed = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*key).agg(F.max_by(packed, ordering).alias("_row")).select(*key, "_row.*")
