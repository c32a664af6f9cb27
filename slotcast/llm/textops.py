"""Vectorised text helpers that run inside Arrow tasks (numpy, no per-word Python).

A word is a run of bytes other than ASCII white space (``[^\\x20\\x09-\\x0D]+``).
Every helper works on whole texts; a batch is cut into chunks of whole
documents only to bound the memory of the temporary arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240131)).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = np.random.Generator(np.random.PCG64(20240202)).integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 4096), _BASE)
        steps[0] = 1
        _POWERS = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


@dataclass
class Chunk:
    """Whole documents of a batch: rows ``lo..hi``, their bytes, and where each begins."""

    lo: int
    hi: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, hi - lo + 1


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and row offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into runs of whole documents of about ``limit`` bytes."""
    data, offsets = text_bytes(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield Chunk(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def give_back() -> None:
    """Free memory that the allocators of Arrow and C keep goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which the worker gives back what it needs no more: Spark keeps workers for later
    stages, beside which a stage's largest batches and temporary arrays would still stand."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


@dataclass
class Words:
    hash: np.ndarray  # uint64, of each word
    start: np.ndarray  # int64, byte where each word starts
    doc: np.ndarray  # int64, row of each word within the chunk
    first: np.ndarray  # int64, docs + 1: the words of row d are first[d]..first[d+1]


def word_starts(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start byte of every word, and the mask of separator bytes."""
    gap = space[data]
    begin = ~gap
    begin[1:] &= gap[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # a document's first byte starts a word, whatever stands before it
    begin[edges] = ~gap[edges]
    return np.flatnonzero(begin), gap


#: Code points of scripts written without spaces between words (Thai, Lao, Tibetan, Myanmar, Khmer, Tai,
#: Javanese, kana, Bopomofo, Han), and of their punctuation and the full-width one.
UNSPACED = [(0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0x3005, 0x3008), (0x3021, 0x3030), (0x3031, 0x3036), (0x3038, 0x303D), (0x3040, 0x30FB), (0x30FC, 0x3130),
            (0x31A0, 0x31C0), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xA9E0, 0xAA00), (0xA980, 0xA9E0), (0xAA60, 0xAA80), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1B000, 0x1B170), (0x20000, 0x3FFFE)]
UNSPACED_GAPS = [(0x0E5A, 0x0E5C), (0x0F04, 0x0F15), (0x104A, 0x1050), (0x17D4, 0x17D7), (0x3000, 0x3005), (0x3008, 0x3021), (0x3030, 0x3031), (0x3036, 0x3038), (0x303D, 0x3040), (0x30FB, 0x30FC), (0xFF01, 0xFF10), (0xFF1A, 0xFF21), (0xFF3B, 0xFF41), (0xFF5B, 0xFF66)]


def unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lead bytes of the characters of unspaced scripts, the bytes after them, and all bytes of such scripts' punctuation."""
    at = np.flatnonzero((data >= 0xE0) & (data < 0xF8))
    long = data[at] >= 0xF0
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
    code = np.where(long, padded[at] & 7, padded[at] & 15) << 12 | (padded[at + 1] & 63) << 6 | padded[at + 2] & 63
    code = np.where(long, code << 6 | padded[at + 3] & 63, code)
    size = np.where(long, 4, 3)

    def among(ranges: list[tuple[int, int]]) -> np.ndarray:
        out = np.zeros(len(code), bool)
        for lo, hi in ranges:
            out |= (code >= lo) & (code < hi)
        return out

    gaps = among(UNSPACED_GAPS)
    own = among(UNSPACED) & ~gaps
    return at[own], at[own] + size[own], ragged(at[gaps], size[gaps])


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, space: np.ndarray = IS_SPACE, characters: bool = False) -> Words:
    """64-bit hashes of all words, with A-Z lower-cased if asked; with ``characters`` each one of an unspaced script is a word."""
    if lower:
        data = LOWER[data]
    start, gap = word_starts(data, offsets, space)
    if characters and (data >= 0xE0).any():
        lead, after, gaps = unspaced(data)
        gap[gaps] = True
        begin = np.zeros(len(data) + 1, bool)
        begin[start] = begin[lead] = begin[after] = True
        if len(gaps):
            begin[gaps + 1] = True
        begin = begin[:-1] & ~gap
        start = np.flatnonzero(begin)
    first = np.searchsorted(start, offsets, "left")
    return Words(hash_runs(data, start, gap), start, np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first)


def hash_runs(data: np.ndarray, start: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """64-bit hash of the run of bytes at each start, up to the next start or gap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    span = np.diff(np.append(start, len(data)))
    at = np.arange(start[0], len(data)) - np.repeat(start, span)
    part = _BYTE[data[start[0] :]] * _powers(int(span.max()) + 1)[at]
    part[gap[start[0] :]] = 0
    return mix64(np.add.reduceat(part, start - start[0]))


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``k`` words that lies within one document."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = words.hash[:n] * _STEP[0]
    for j in range(1, k):
        h = h + words.hash[j : n + j] * _STEP[j % 64] + _U(j)
    inside = words.doc[:n] == words.doc[k - 1 :]
    return mix64(h[inside]), words.doc[:n][inside]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i]+lengths[i]-1 of all i, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Arrow lists of the given lengths over flat values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)
