"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a score for a key, ``-weight / ln(u)`` with ``u`` from a 64-bit
hash of (key, shard), and the highest score wins.  A shard gets keys in
proportion to its weight, and one more shard takes keys only into itself.  All
of it is built-in expressions.

Nulls: a null key is a key like any other (all such rows share a shard); a null
text has no bytes and the crc32 of the empty text.  Repeated rows stay repeated
and get slots of their own.  An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm.store import text_crc32

BLOCKS = 1024  # of each shard, numbered apart, so that no shard is numbered in one task
COPIES = 1 << 16  # rows that one row of the counted table grows to at once


def scores(key: Column, weights: Sequence[float]) -> Column:
    """Array of (score, hash, -shard), one per shard; the greatest is the key's shard."""

    def score(weight: Column, shard: Column) -> Column:
        h = F.xxhash64(key, shard)
        u = (F.shiftrightunsigned(h, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-weight / F.log(u)).alias("score"), h.alias("hash"), (-shard).alias("neg"))

    return F.transform(F.array(*(F.lit(float(w)) for w in weights)), score)


def winner(of: Column) -> Column:
    return -F.array_max(of).getField("neg")


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard 0 .. len(weights) - 1 of a key."""
    return winner(scores(key, weights))


def number_slots(df: DataFrame, shard: str, order: Sequence[str]) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard, without sorting a shard in one task.

    Equal rows are counted first (with map-side combining, so a hot key is one
    row), rows are numbered inside hash blocks, and the blocks' totals give the
    offsets.  ``order`` names the columns that make a row; only they, ``shard``
    and ``slot`` come out."""
    rows = df.groupBy(shard, *order).agg(F.count(F.lit(1)).alias("_n")).withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(BLOCKS)))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(shard, "_block").agg(F.sum("_n").alias("_sum")).select(shard, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_block").orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    first = rows.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(offsets, [shard, "_block"])
    first = first.withColumn("_first", F.col("_first") + F.col("_offset"))
    pieces = first.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))).hint("rebalance")
    last = F.least(F.col("_n") - 1, (F.col("_piece") + 1) * COPIES - 1)
    each = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_piece") * COPIES, last)))
    return each.select(*order, shard, (F.col("_first") + F.col("_copy")).alias("slot"))


def shard_documents(docs: DataFrame, weights: Sequence[float], grown_weight: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's shard, its slot there, and the shard it would have with one more shard of ``grown_weight``.

    ``size`` is the text's UTF-8 bytes plus 8.  Columns beside the key and the
    text are not read, whatever their names."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        text_crc32(F.col(text)).alias("text_crc32"),
    )
    drawn = scores(F.col("doc_id"), [*weights, grown_weight])
    rows = rows.withColumn("shard", winner(F.slice(drawn, 1, len(weights)))).withColumn("grown_shard", winner(drawn))
    return number_slots(rows, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
