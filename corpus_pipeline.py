"""A training corpus in five stages, each written as Parquet and read again by the next.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``docs``.  ``run`` applies them to
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotcast.llm import decontam, jaccard, mixing, planes, quality
from slotcast.llm.queries import PIECE_BPE, WORD_BPE, table, vocabulary
from slotcast.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tokeniser-fertility rules keep."""
    return quality.passing(docs, vocabulary(PIECE_BPE), vocabulary(WORD_BPE))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (four-word shingles, Jaccard 0.85, as op6)."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion to their weights; a document stands as often as it is taken."""
    return mixing.mixed_documents(docs)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Plane files of token ids, and the index read back from them."""
    out = planes.encode_documents(docs, scratch_path(spark, "corpus_ids"), vocabulary(WORD_BPE))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "piece")


STAGES = [
    ("quality_rules", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_ids", write_ids),
]

#: No SQL engine has the tokenizers of the first and last stage; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
