"""Bloom filters of 64-bit hashes: a prefilter of bounded size before an exact join.

Null hashes are in no filter and are kept by ``without``; a filter of no hashes holds none."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm.textops import mix64

MIN_BITS, MAX_BITS = 16, 29  # log2 of the filter's bits: 64 MB at most, which is what is broadcast
BITS_PER_HASH = 32
PROBES = 4
CHUNK = 16  # log2 of the bits in one row


def _probe(h: np.ndarray, number: int, log: int) -> np.ndarray:
    """Place of the hash's bit for one probe (int64)."""
    return (mix64(h + np.uint64(0x9E3779B97F4A7C15 * (number + 1) % 2**64)) >> np.uint64(64 - log)).astype(np.int64)


def bitmap(rows: DataFrame, column: str, n: int, bits_per_hash: int = BITS_PER_HASH) -> np.ndarray:
    """Filter of all hashes in a long column of about ``n`` rows, of a size that follows n up to MAX_BITS."""
    log = int(np.clip(np.ceil(np.log2(max(1, n * bits_per_hash))), MIN_BITS, MAX_BITS))

    def places(batches):
        for b in batches:
            h = b.column("h").to_numpy().view(np.uint64)
            at = np.unique(np.concatenate([_probe(h, i, log) for i in range(PROBES)]))
            yield pa.RecordBatch.from_arrays([pa.array(at >> CHUNK), pa.array(at)], ["chunk", "bit"])

    def piece(table: pa.Table) -> pa.Table:  # at most 2 ** CHUNK distinct bits
        bits = np.zeros(1 << CHUNK, bool)
        bits[table.column("bit").to_numpy() & ((1 << CHUNK) - 1)] = True
        return pa.table({"chunk": table.column("chunk")[:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    distinct = rows.select(F.col(column).alias("h")).where("h IS NOT NULL").mapInArrow(places, "chunk long, bit long").distinct()
    out = np.zeros(1 << (log - 3), np.uint8)
    for chunk, bits in distinct.groupBy("chunk").applyInArrow(piece, "chunk long, bits binary").collect():
        out[chunk << (CHUNK - 3) : (chunk + 1) << (CHUNK - 3)] = np.frombuffer(bits, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be among those of the filter."""
    log = len(bits).bit_length() - 1 + 3
    live = np.arange(len(h))
    for i in range(PROBES):
        at = _probe(h[live], i, log)
        live = live[(bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0]
    out = np.zeros(len(h), bool)
    out[live] = True
    return out


def without(rows: DataFrame, column: str, gone: DataFrame) -> DataFrame:
    """The rows whose (long) column stands in no row of ``gone``, which has that column only.

    Rows that the filter of ``gone`` doesn't mark stay as they are; the marked ones are joined, so only these are shuffled.
    Both tables are read twice and should be written ones."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(gone, column, gone.count()))

    @F.pandas_udf("boolean")
    def marked(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(sent.value, h.to_numpy(np.int64).view(np.uint64)))

    suspect = marked(F.coalesce(F.col(column), F.lit(0).cast("long"))) & F.col(column).isNotNull()
    return rows.where(~suspect).unionByName(rows.where(suspect).join(gone.distinct(), column, "left_anti").select(*rows.columns))
