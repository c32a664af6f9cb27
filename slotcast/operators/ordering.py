"""Ordering operators: positions, sort, newest-N, tail fraction.

``sequence_index`` numbers the rows of each key in time order without a
window over the whole key (which would put a hot sensor in one task): rows
are numbered inside (key, block) -- block = hour of the timestamp -- and
offset by the row counts of the earlier blocks, which come from a small
per-(key, block) table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def _order_cols(order):
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sequence_index(
    df: DataFrame,
    keys: tuple[str, ...] = ("sensor_id",),
    ts: str = "ts",
    tiebreak: tuple[str, ...] = ("ingest_seq",),
    block_unit: str = "HOUR",
    with_total: bool = True,
) -> DataFrame:
    """Adds ``idx`` (0-based position in time order within ``keys``) and,
    with ``with_total``, ``n_total`` (rows of the key)."""
    blk = df.withColumn("_blk", F.date_trunc(block_unit, F.col(ts)))
    counts = blk.groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    w_blocks = W.partitionBy(*keys).orderBy("_blk")
    offs = counts.select(
        *keys,
        "_blk",
        F.coalesce(F.sum("_n").over(w_blocks.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        *([F.sum("_n").over(W.partitionBy(*keys)).alias("n_total")] if with_total else []),
    )
    rn = F.row_number().over(W.partitionBy(*keys, "_blk").orderBy(*_order_cols((ts, *tiebreak))))
    numbered = blk.withColumn("_rn", rn)
    return (
        numbered.join(offs, [*keys, "_blk"], "inner")
        .withColumn("idx", (F.col("_off") + F.col("_rn") - 1).cast("long"))
        .drop("_blk", "_rn", "_off")
    )


def sort_by_time(df: DataFrame, keys: tuple[str, ...] = ("sensor_id",), ts: str = "ts", tiebreak=("ingest_seq",)) -> DataFrame:
    """Ascending sort on the parsed time (range-partitioned global sort) with
    the position of each row inside its key."""
    return sequence_index(df, keys, ts, tiebreak, with_total=False).orderBy(*keys, ts, *tiebreak)


def latest_n(df: DataFrame, n: int, keys: tuple[str, ...] = ("sensor_id",), ts: str = "ts", tiebreak=("ingest_seq",)) -> DataFrame:
    """Newest ``n`` rows per key (``rank`` 1 = newest).  ``row_number() <= n``
    is planned as a window group limit: each map task keeps only its own top
    ``n`` per key before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (ts, *tiebreak)])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def tail_fraction(indexed: DataFrame, fraction: float) -> DataFrame:
    """Newest ``fraction`` of each key: drop the first floor(n * (1 - fraction))
    rows, computed in double arithmetic like the source."""
    cut = F.floor(F.col("n_total").cast("double") * (F.lit(1.0).cast("double") - F.lit(float(fraction))))
    return indexed.where(F.col("idx") >= cut)


def split_label(indexed: DataFrame, start: float, end: float, idx: str = "idx", total: str = "n_total") -> DataFrame:
    """Contiguous ranges: ``valid`` for floor(n*start) <= idx < floor(n*end),
    ``train`` elsewhere (head + tail, one scan)."""
    n = F.col(total).cast("double")
    v0 = F.floor(n * F.lit(float(start)))
    v1 = F.floor(n * F.lit(float(end)))
    i = F.col(idx)
    return (
        indexed.withColumn("valid_start", v0.cast("long"))
        .withColumn("valid_end", v1.cast("long"))
        .withColumn(
            "split",
            F.when((i >= v0) & (i < v1), F.lit("valid")).otherwise(F.lit("train")),
        )
        .withColumn("part", F.when(i < v0, F.lit("head")).when(i >= v1, F.lit("tail")).otherwise(F.lit(None)))
    )
