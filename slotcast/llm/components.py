"""Connected components of an edge table, by alternating large stars and small stars.

Each round is two joins on a node and its smallest neighbour; a node with very
many edges is a skewed join key, which Spark splits.  Rounds are written to the
shared folder, so lineage stays short; a round's table is deleted when the next one is there.

Edges with a null end and edges from a node to itself join nothing; repeated edges count
once; no edges give no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.store import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    up = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v) that isn't its component's smallest node."""
    tables = Scratch()
    now = tables.put(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(now)
    while True:
        now = tables.put(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after
