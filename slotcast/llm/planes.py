"""Token-id files with shuffled planes.

A file holds whole documents in ascending key order::

    b"IDPL1\\n" | planes of block 0 | planes of block 1 | ... | footer | footer length, 8 bytes | b"IDPL1\\n"

A block is up to ``BLOCK_IDS`` ids (unsigned 32-bit).  Its ids are transposed into
4 byte planes or 32 bit planes, and each plane is compressed with zstandard,
so that the high planes, nearly constant, cost almost nothing.  The footer is
the chunk index (JSON, zstandard): where each plane of each block lies, and how
many ids it holds, then the documents' keys and lengths.  Any block can be
read alone.

Writing: Spark sorts the documents by key into ranges, each task encodes its
range and writes files of about ``FILE_IDS`` ids, under a temporary name that is
renamed when complete, so a repeated task replaces its files by equal ones.
Files are opened with ``pyarrow.fs``, which knows local and cloud paths; they are
read back with Spark's ``binaryFile``.

Nulls: a null key comes first; a null text is empty (only the end id).  Equal
keys stand in order of their text's hash; equal rows are interchangeable.  An
empty table gives no file and no rows.  Other columns are not read."""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.store import small_batches
from slotcast.llm.tokens import word_encoder

MAGIC = b"IDPL1\n"
BLOCK_IDS = 1 << 17
FILE_IDS = 1 << 23
LEVEL = 1
MANIFEST = "file string, n_docs long, n_ids long, n_bytes long"
INDEX = "part long, piece long, row long, doc_id long, offset long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """The block's byte planes, or its bit planes (least significant first)."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        return [x.tobytes() for x in np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")]
    return [x.tobytes() for x in raw.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if len(planes) == 32:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


class FileBuilder:
    """Collects documents' ids into blocks; ``finish`` gives the file's bytes."""

    def __init__(self, bits: bool = False, level: int = LEVEL):
        self.bits, self.zstd = bits, zstandard.ZstdCompressor(level=level)
        self.out, self.blocks = [MAGIC], []
        self.at, self.n_ids = len(MAGIC), 0
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self.waiting, self.n_waiting = [], 0

    def add(self, keys: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.keys += keys
        self.lengths += lengths.tolist()
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            self._flush(self.n_waiting // BLOCK_IDS * BLOCK_IDS)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting)
        for i in range(0, n, BLOCK_IDS):
            block = ids[i : min(n, i + BLOCK_IDS)]
            places = []
            for plane in to_planes(block, self.bits):
                packed = self.zstd.compress(plane)
                places.append([self.at, len(packed)])
                self.out.append(packed)
                self.at += len(packed)
            self.blocks.append({"n": len(block), "planes": places})
        self.waiting, self.n_waiting = [ids[n:]], len(ids) - n

    def finish(self) -> bytes:
        if self.n_waiting:
            self._flush(self.n_waiting)
        footer = self.zstd.compress(json.dumps({"blocks": self.blocks, "keys": self.keys, "lengths": self.lengths}).encode())
        return b"".join([*self.out, footer, struct.pack("<Q", len(footer)), MAGIC])


def read_index(data) -> dict:
    """The chunk index and the documents of a file."""
    view = memoryview(data)
    if bytes(view[: len(MAGIC)]) != MAGIC or bytes(view[-len(MAGIC) :]) != MAGIC:
        raise ValueError("not a plane file, or not a whole one")
    end = len(view) - len(MAGIC) - 8
    size = struct.unpack("<Q", view[end : end + 8])[0]
    return json.loads(zstandard.ZstdDecompressor().decompress(view[end - size : end]))


def read_block(data, block: dict) -> np.ndarray:
    """The ids of one block."""
    view, n, zstd = memoryview(data), block["n"], zstandard.ZstdDecompressor()
    size = n if len(block["planes"]) == 4 else (n + 7) // 8
    return from_planes([zstd.decompress(view[at : at + length], max_output_size=size) for at, length in block["planes"]], n)


def documents_of(data) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(key, offset in the file, ids) of each document, block by block."""
    index = read_index(data)
    blocks, held, at = iter(index["blocks"]), np.zeros(0, np.uint32), 0
    for key, n in zip(index["keys"], index["lengths"], strict=True):
        if len(held) < n:
            more = [held]
            have = len(held)
            while have < n:
                more.append(read_block(data, next(blocks)))
                have += len(more[-1])
            held = np.concatenate(more)
        yield key, at, held[:n]
        held, at = held[n:], at + n


def open_folder(path: str):
    """A folder of any store that pyarrow knows, and its path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def store_file(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename."""
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)
    c = TaskContext.get()
    temp = f"{root}/_{name}.{c.taskAttemptId() if c else 0}"
    with store.open_output_stream(temp) as out:
        out.write(data)
    store.move(temp, f"{root}/{name}")


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text", bits: bool = False, parts: int | None = None) -> DataFrame:
    """Sort, encode and write; the result lists the files, and the files are there once it has run.

    The last sort key tells equal rows apart, so a key that many rows share is
    dealt over several ranges."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"_text": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("_text").asc(), F.col("_row").asc()]
    parts = parts or rows.rdd.getNumPartitions()
    rows = rows.repartitionByRange(max(1, parts), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches):
        encoder, part, piece, out = word_encoder(tokenizer), TaskContext.get().partitionId(), 0, FileBuilder(bits)
        done = []

        def close():
            name, data = f"ids-{part:06d}-{piece:06d}.idpl", out.finish()
            store_file(folder, name, data)
            done.append((name, len(out.keys), out.n_ids, len(data)))

        for b in batches:
            keys = b.column("doc_id")
            for c in T.chunks(b.column("text")):
                ids, n = encoder.encode(c.data, c.offsets)
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, np.uint32(end_id))
                out.add(keys.slice(c.lo, c.hi - c.lo).to_pylist(), n + 1, ids)
                if out.n_ids >= FILE_IDS:
                    close()
                    piece, out = piece + 1, FileBuilder(bits)
        if out.keys:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True) if done else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["file", "n_docs", "n_ids", "n_bytes"])

    return rows.mapInArrow(T.tidy(write), MANIFEST)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the folder's files, decoded: where it lies and the crc32 of its ids."""

    def read(batches):
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                part, piece = path.rsplit("/", 1)[1].removesuffix(".idpl").split("-")[1:]
                rows = [(int(part), int(piece), i, k, at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4"))) for i, (k, at, ids) in enumerate(documents_of(data.as_buffer()))]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], [f.split()[0] for f in INDEX.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.idpl").load(folder).select("path", "content")
    return files.mapInArrow(T.tidy(read), INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before a document: its place in the file plus the earlier files' totals (one row per file)."""
    w = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)
    files = index.groupBy("part", "piece").agg(F.sum("n_tokens").alias("_n"))
    files = files.select("part", "piece", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    return index.join(files, ["part", "piece"]).select("doc_id", (F.col("_before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "part", "piece")


def encode_documents(docs: DataFrame, folder: str, tokenizer: str, **options) -> DataFrame:
    """Write the files, then give the index that is read back from them."""
    spark = docs.sparkSession
    written = write_files(docs, folder, tokenizer, **options)
    with small_batches(spark):
        written.write.mode("overwrite").parquet(f"{folder}/_manifest")
    if spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").isEmpty():
        return with_starts(spark.createDataFrame([], INDEX))
    return with_starts(read_files(spark, folder))
