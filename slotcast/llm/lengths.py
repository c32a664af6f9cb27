"""Token counts for every context limit from one exact length histogram.

Documents are encoded once and aggregated by (group, encoded length); suffix
sums over the distinct lengths then answer totals, quantiles and truncated
totals for any context limit.  The histogram has at most as many rows as the
longest document has tokens, per group.

Nulls: a null text is empty (length 0 plus the end id); a null group is a group.
Repeated rows count as often as they occur.  An empty table gives no rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.tokens import word_encoder

BLOCK = 4096  # lengths that one window holds


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text", group: str = "lang", end_ids: int = 1) -> DataFrame:
    """(grp, length) of each document, with ``end_ids`` ids that close it."""
    rows = docs.select(F.col(group).cast("string").alias("grp"), F.col(text).alias("text"))

    def encode(batches):
        encoder = word_encoder(tokenizer)
        for b in batches:
            for c in T.chunks(b.column("text")):
                n = encoder.encode(c.data, c.offsets)[1] + end_ids
                yield pa.RecordBatch.from_arrays([b.column("grp").slice(c.lo, c.hi - c.lo), pa.array(n, pa.int64())], ["grp", "length"])

    return rows.mapInArrow(encode, "grp string, length long")


def histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("grp", "length").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_table(hist: DataFrame) -> DataFrame:
    """Running sums of the histogram, in blocks of lengths so that no group is one sort.

    Per (grp, length): the documents and tokens up to that length, the documents
    longer than it, the group's totals, and ``truncated_tokens``, the tokens left
    if every document is cut at that length."""
    h = hist.withColumn("_block", F.floor(F.col("length") / BLOCK)).withColumn("_tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy("grp", "_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    w = Window.partitionBy("grp").orderBy("_block")
    earlier, whole = w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("grp")
    blocks = blocks.select(
        F.col("grp").alias("_grp"), F.col("_block").alias("_b"),
        F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_d0"), F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_t0"),
        F.sum("_d").over(whole).alias("all_docs"), F.sum("_t").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("grp", "_block").orderBy("length").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("_d1", F.sum("n_docs").over(inside)).withColumn("_t1", F.sum("_tokens").over(inside))
    h = h.join(blocks, h.grp.eqNullSafe(blocks._grp) & (h._block == blocks._b))
    docs, tokens = F.col("_d0") + F.col("_d1"), F.col("_t0") + F.col("_t1")
    longer = F.col("all_docs") - docs
    return h.select(
        "grp", "length", "n_docs", docs.alias("docs_upto"), tokens.alias("tokens_upto"), longer.alias("docs_longer"),
        (tokens + F.col("length") * longer).alias("truncated_tokens"), "all_docs", "all_tokens",
    )


def at_limits(table: DataFrame, limits: list[int]) -> DataFrame:
    """Documents that fit, documents cut, and tokens kept for each context limit, any number >= 0."""
    rows = table.select("*", F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits))).alias("limit"))
    fits = F.col("length") <= F.col("limit")
    out = rows.groupBy("grp", "limit").agg(
        F.coalesce(F.max(F.when(fits, F.col("docs_upto"))), F.lit(0)).alias("docs_whole"),
        F.coalesce(F.max(F.when(fits, F.col("tokens_upto"))), F.lit(0)).alias("_whole"),
        F.max("all_docs").alias("all_docs"), F.max("all_tokens").alias("all_tokens"),
    )
    cut = F.col("all_docs") - F.col("docs_whole")
    return out.select("grp", "limit", "docs_whole", cut.alias("docs_cut"), (F.col("_whole") + cut * F.col("limit")).alias("tokens_kept"), "all_docs", "all_tokens")


def quantile(table: DataFrame, share: float) -> DataFrame:
    """Least length that at least ``share`` of a group's documents don't exceed."""
    return table.where(F.col("docs_upto") >= F.lit(share) * F.col("all_docs")).groupBy("grp").agg(F.min("length").alias("length"))


def is_quantile(share: float) -> Column:
    """Marks the row of ``suffix_table`` that holds the group's quantile."""
    before = F.col("docs_upto") - F.col("n_docs")
    return (F.col("docs_upto") >= F.lit(share) * F.col("all_docs")) & (before < F.lit(share) * F.col("all_docs"))
