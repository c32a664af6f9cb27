"""Mixing sources to target weights with hash-threshold histograms.

Each document has a 60-bit hash of its key.  A source whose target is ``t`` times
its size takes every document ``floor(t)`` times, and once more those whose hash
lies below a threshold.  The threshold comes from nested histograms: sum the
sizes by source and hash bucket, find the bucket in which the budget ends, and
refine only that bucket, until one hash is left.  No sort, and a rerun takes the
same documents.  What the document at the threshold leaves of the budget goes, the
same way, to later documents that fit into it.

Nulls: a null source is a source of its own, last in order; a null or empty text
has size 0; a null key hashes as the text "null".  Rows with one key share a hash
and are taken together.  An empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3  # times that a source or a document may be repeated
BITS, LEVELS = 15, 4  # of the hash, per level
FEW_SOURCES = 100_000  # up to so many, per-source tables (under 100 bytes a row) are broadcast; beyond, joins shuffle
KEY = "_source_key"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(key: Column) -> Column:
    """The first 60 bits of the key's md5, which any SQL engine can compute too."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, 15), 16, 10).cast("long")


def source_key(source: Column) -> Column:
    """The source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size")).withColumns(
        {KEY: source_key(F.col("source")), "_hash": hash60(F.col("doc_id"))}
    )


def source_targets(sizes: DataFrame, cycle: int = 3, most: int = MOST) -> DataFrame:
    """Target of each source: weights 1..cycle by code point order share the total; none exceeds ``most`` times its size.

    Sorted by size per weight, the sources that hit their cap are a prefix, so
    the level at which the others share the rest follows from running sums.
    The windows run over one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("_rank").asc())
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sizes.groupBy(KEY, "source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("_rank", F.row_number().over(by_name) - 1).withColumn("weight", F.pmod(F.col("_rank"), F.lit(cycle)) + 1)
    left = F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    shares = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("_level", left / shares).withColumn("_at", F.row_number().over(by_cap))
    free = F.when(F.col("_level") * F.col("weight") <= most * F.col("source_size"), F.struct("_at", "_level"))
    s = s.withColumn("_level", F.min(free).over(whole).getField("_level"))
    target = F.least((most * F.col("source_size")).cast("double"), F.col("_level") * F.col("weight"))
    return s.select(KEY, "source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def per_source(table: DataFrame) -> DataFrame:
    """A written per-source table, ready for joins with documents: broadcast if its counted rows are few, as
    otherwise a hot source's documents meet in one task."""
    return F.broadcast(table) if table.count() <= FEW_SOURCES else table


def budget_thresholds(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the hash at which its budget ends: the rows below ``_prefix`` fit, with ``_left`` to spare, and the ``_sum`` of the rows at that hash doesn't."""
    state = budgets.select(KEY, F.lit(0).cast("long").alias("_prefix"), F.col("_left").cast("double").alias("_left"), F.lit(0).cast("long").alias("_sum"))
    state = written(state, "mix_thresholds")
    for level in range(1, LEVELS + 1):
        up, here = BITS * (LEVELS - level + 1), BITS * (LEVELS - level)
        rows = sizes.where(F.col("size") > 0).join(per_source(state.select(KEY, "_prefix")), KEY).where(F.shiftright("_hash", up) == F.col("_prefix"))
        buckets = rows.groupBy(KEY, F.shiftright("_hash", here).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        w = Window.partitionBy(KEY).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        over = buckets.withColumn("_upto", F.sum("_sum").over(w)).join(state.select(KEY, "_left"), KEY).where(F.col("_upto") > F.col("_left"))
        edge = over.groupBy(KEY).agg(F.min(F.struct("_bucket", "_sum", "_upto")).alias("_edge"))
        state = written(
            state.drop("_sum").join(edge, KEY, "left").select(
                KEY,
                F.coalesce("_edge._bucket", F.shiftleft(F.col("_prefix") + 1, BITS)).alias("_prefix"),  # all rows fit: the threshold is the bucket's end
                F.coalesce(F.col("_left") - (F.col("_edge._upto") - F.col("_edge._sum")), F.lit(0.0)).alias("_left"),
                F.coalesce("_edge._sum", F.lit(0)).cast("long").alias("_sum"),
            ),
            "mix_thresholds",
        )
    return state


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Whole copies of each source, and who is taken once more: hashes below ``_first``, then, for what
    that leaves of the budget, hashes below ``_next`` (itself too if ``_with``) of documents no larger than that rest."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_copies", whole.cast("int"))
    one = budget_thresholds(sizes, targets.withColumn("_left", F.col("target") - F.col("_copies") * F.col("source_size")))
    one = one.select(KEY, F.col("_prefix").alias("_first"), F.col("_left").alias("_rest"))
    one = written(one, "mix_first")
    rest = sizes.join(per_source(one), KEY).where((F.col("_hash") >= F.col("_first")) & (F.col("size") <= F.col("_rest")))
    two = budget_thresholds(rest.select(KEY, "_hash", "size"), one.withColumn("_left", F.col("_rest")))
    two = two.select(KEY, F.col("_prefix").alias("_next"), (F.col("_sum") < 2 * F.col("_left")).alias("_with"))
    return written(targets.join(one, KEY).join(two, KEY), "mix_plan")


PLAN = ["_copies", "_first", "_rest", "_next", "_with"]


def copies() -> Column:
    """How often a row that carries ``_hash``, ``size`` and its source's plan is taken."""
    small = (F.col("size") > 0) & (F.col("size") <= F.col("_rest"))
    later = small & ((F.col("_hash") < F.col("_next")) | (F.col("_with") & (F.col("_hash") == F.col("_next"))))
    return F.col("_copies") + ((F.col("_hash") < F.col("_first")) | later).cast("int")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cycle: int = 3) -> DataFrame:
    """Per row: its size, its source's size and target, and how many words of it the mix takes.  Other columns are not read."""
    sizes = written(sized(docs, key, text, source), "mix_sizes")
    state = thresholds(sizes, source_targets(sizes, cycle))
    out = sizes.join(per_source(state.select(KEY, "source_size", "target", *PLAN)), KEY)
    return out.select("doc_id", "source", "size", "source_size", "target", copies().alias("copies"), (F.col("size") * copies()).alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", cycle: int = 3) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, all columns kept."""
    sizes = written(sized(docs, key, text, source), "mix_sizes")
    plan = per_source(thresholds(sizes, source_targets(sizes, cycle)).select(F.col(KEY).alias("_mix_key"), F.struct(*PLAN).alias("_mix")))
    rows = docs.select(F.struct(*docs.columns).alias("_row")).withColumn("_mix_key", source_key(F.col(f"_row.{source}"))).join(plan, "_mix_key")
    rows = rows.select("_row", "_mix.*", hash60(F.col(f"_row.{key}")).alias("_hash"), word_count(F.col(f"_row.{text}")).alias("size"))
    rows = rows.select("_row", copies().alias("_n")).where("_n > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_n"))).select("_row.*")
