"""Benchmark decontamination with spaced seeds.

Words are runs of letters, digits and non-ASCII characters, lower-cased; each character
of a script without spaces (Han, kana, Thai, ...) is a word of its own.  A fixed
mask hashes some places of a window of words and ignores the others, so a hit
survives substitutions at the ignored places.  The hashes of all benchmark
windows are joined with those of all documents; every hit proposes an alignment
of an item with a document, and the alignment is verified word by word: the best
stretch of which at least four fifths match must hold ``MIN_MATCH`` matching words,
or four fifths of the item if that is less.

Most document windows match nothing, so a Bloom filter of the benchmark's hashes, whose
size is bounded (``bitmaps.MAX_BITS``) whatever the benchmark, drops them before the join;
what it lets through by chance the join still drops.  Equal texts
are verified once.

An item of fewer than ``MIN_ITEM`` words can't hold a seed at every place, so it must stand whole and unchanged: the hashes of
all windows of its length are joined with the item's.  One of ``WHOLE`` words or fewer, which many texts hold by chance, must
be all of a text.  A hit brings the words around it that its item may need, by classes of item lengths, so one very
long item doesn't make all hits bring whole texts.

Nulls: a null text has no words; a null key is a key; keys are whole numbers.  Items without words match nothing; items with
equal words are reported under the smallest id.  An empty table on either side gives no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.bitmaps import bitmap, in_bitmap, without
from slotcast.llm.store import written

#: Places of a window that a mask reads.
MASKS = [(0, 1, 3, 4, 6), (0, 1, 2, 5, 6), (0, 1, 2, 3, 5), (0, 2, 4, 5, 6)]
MIN_ITEM = 8  # words of an item that is found by seeds
WHOLE = 2  # words of an item that only a whole text matches
REACH = 64  # words around a hit for the shortest class of items; each class has four times the one before
MIN_MATCH = 13
MISS = 4  # matches that a stretch needs for each mismatch: four fifths of it

NOT_WORD = np.ones(256, bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False
SEEDS = "item_id long, pos int, hash long, reach int"
#: A segment of words around hits; of reach 0 the hits are windows as long as ``pos`` says.
SEGMENTS = "doc_id long, text_hash long, reach int, lo int, words binary, hits array<struct<pos:int,hash:long>>"
VERIFIED = "text_hash long, item_id long, n_words int, n_match int"


def seed_hashes(words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of every mask at every place where it lies within one document."""
    places, out = [], []
    for number, mask in enumerate(MASKS):
        n = len(words.hash) - mask[-1]
        if n <= 0:
            continue
        h = np.full(n, np.uint64(number + 1))
        for j, at in enumerate(mask):
            h = T.mix64(h + words.hash[at : at + n]) if j == 0 else h * np.uint64(0x9E3779B97F4A7C15) + words.hash[at : at + n]
        inside = np.flatnonzero(words.doc[:n] == words.doc[mask[-1] :])
        places.append(inside)
        out.append(T.mix64(h[inside]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(out)


def _words(c: T.Chunk) -> T.Words:
    return T.hash_words(c.data, c.offsets, lower=True, space=NOT_WORD, characters=True)


def benchmark_items(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct word sequence: smallest id, words (as 64-bit hashes)."""
    rows = benchmark.select(F.col(key).cast("long").alias("item_id"), F.col(text).alias("text"))

    def run(batches):
        for b in batches:
            ids = b.column("item_id")
            for c in T.chunks(b.column("text")):
                w = _words(c)
                keep = np.flatnonzero(np.diff(w.first) > 0)
                raw = [w.hash[w.first[i] : w.first[i + 1]].tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([ids.slice(c.lo, c.hi - c.lo).take(pa.array(keep)), pa.array(raw, pa.binary())], ["item_id", "words"])

    return rows.mapInArrow(run, "item_id long, words binary").groupBy("words").agg(F.min("item_id").alias("item_id"))


def _one(raw: bytes) -> T.Words:
    h = np.frombuffer(raw, np.uint64)
    return T.Words(h, h, np.zeros(len(h), np.int64), np.array([0, len(h)]))


def reach_of(n: int) -> int:
    """Words that a hit of an item of n words brings along on either side."""
    reach = REACH
    while reach < n:
        reach *= 4
    return reach


def item_seeds(items: DataFrame) -> DataFrame:
    """Seeds of the items of MIN_ITEM words or more; of a shorter one the hash of all of it, with its length as ``pos`` and reach 0."""

    def run(batches):
        for b in batches:
            for i, raw in zip(b.column("item_id").to_pylist(), b.column("words").to_pylist(), strict=True):
                words = _one(raw)
                n = len(words.hash)
                if n < MIN_ITEM:
                    at, seeds, reach = np.array([n]), T.windows(words, n)[0], 0
                else:
                    (at, seeds), reach = seed_hashes(words), reach_of(n)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(seeds.view(np.int64)), pa.array([reach] * len(at), pa.int32())], ["item_id", "pos", "hash", "reach"])

    return items.select("item_id", "words").mapInArrow(run, SEEDS)


def hit_segments(docs: DataFrame, bits: dict[int, np.ndarray], short: dict[int, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of words around the places whose hash may be a benchmark's: ``bits`` has a filter of the seeds of each reach,
    ``short`` one of the items of each length below MIN_ITEM."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, short))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def segments(w: T.Words, at: np.ndarray, h: np.ndarray, reach: int):
        """(row, reach, lo, words, hits)"""
        order = np.argsort(at, kind="stable")
        at, h = at[order], h[order]
        doc = w.doc[at]
        cut = np.flatnonzero((np.diff(at) > 2 * reach) | (np.diff(doc) > 0)) + 1
        for s, e in zip(np.concatenate([[0], cut]).tolist() if len(at) else [], np.append(cut, len(at)).tolist(), strict=False):
            d = int(doc[s])
            lo = max(int(at[s]) - reach, int(w.first[d]))
            hi = min(int(at[e - 1]) + reach, int(w.first[d + 1]))
            yield d, reach, lo - int(w.first[d]), w.hash[lo:hi].tobytes(), list(zip((at[s:e] - lo).tolist(), h[s:e].view(np.int64).tolist(), strict=True))

    def whole(w: T.Words, n: int, filter_: np.ndarray):
        h, doc = T.windows(w, n)
        if n <= WHOLE:
            alone = np.diff(w.first)[doc] == n
            h, doc = h[alone], doc[alone]
        found = np.flatnonzero(in_bitmap(filter_, h))
        for d, x in dict.fromkeys(zip(doc[found].tolist(), h[found].view(np.int64).tolist(), strict=True)):
            yield d, 0, -1, b"", [(n, x)]

    def run(batches):
        bits, short = shared.value
        for b in batches:
            own = [b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist()]
            for c in T.chunks(b.column("text")):
                w = _words(c)
                at, h = seed_hashes(w) if bits else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                out = []
                for reach, filter_ in bits.items():
                    found = in_bitmap(filter_, h)
                    out += segments(w, at[found], h[found], reach)
                for n, filter_ in short.items():
                    out += whole(w, n, filter_)
                out = [(own[0][c.lo + d], own[1][c.lo + d], reach, lo, words, [{"pos": p, "hash": x} for p, x in hits]) for d, reach, lo, words, hits in out]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.struct([("pos", pa.int32()), ("hash", pa.int64())]))]
                columns = zip(*out, strict=True) if out else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], ["doc_id", "text_hash", "reach", "lo", "words", "hits"])

    return rows.mapInArrow(T.tidy(run), SEGMENTS)


def best_overlap(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int]:
    """Words and matches of the best stretch when item word j lies at document word shift + j: the one with the most
    matches of all in which these are four fifths, and the longest of several."""
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if lo >= hi:
        return 0, 0
    same = doc[lo + shift : hi + shift] == item[lo:hi]
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -MISS))])
    start = np.searchsorted(-np.minimum.accumulate(total), -total)  # for each end, the first place that is no higher
    matches = np.concatenate([[0], np.cumsum(same)])
    matches = matches - matches[start]
    size = np.arange(len(total)) - start
    end = np.lexsort((size, matches))[-1]
    return int(size[end]), int(matches[end])


def overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Verified (text_hash, item_id, n_words, n_match), and the (doc_id, text_hash) of the documents that had hits."""
    spark = docs.sparkSession
    items = written(benchmark_items(benchmark, item_key, item_text), "benchmark_items")
    seeds = written(item_seeds(items), "benchmark_seeds")
    of_reach, of_length = seeds.where("reach > 0"), seeds.where("reach = 0")
    bits = {r: bitmap(of_reach.where(F.col("reach") == r), "hash", n, 64) for r, n in of_reach.groupBy("reach").count().collect()}
    short = {k: bitmap(of_length.where(F.col("pos") == k), "hash", n, 64) for k, n in of_length.groupBy("pos").count().collect()}
    segments = written(hit_segments(docs, bits, short, key, text), "benchmark_hits")
    own = segments.where("reach > 0").dropDuplicates(["text_hash", "reach", "lo"])
    hits = own.select("text_hash", "reach", "lo", F.explode("hits").alias("hit")).select("text_hash", "reach", "lo", "hit.pos", "hit.hash")
    aligned = hits.join(seeds.withColumnRenamed("pos", "at"), ["hash", "reach"]).select("text_hash", "reach", "lo", "item_id", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    pairs = aligned.join(own.select("text_hash", "reach", "lo", F.col("words").alias("doc_words")), ["text_hash", "reach", "lo"]).join(items.select("item_id", F.col("words").alias("item_words")), "item_id")

    def verify(batches):
        for b in batches:
            found = []
            for h, i, s, d, w in zip(*(b.column(x).to_pylist() for x in ("text_hash", "item_id", "shift", "doc_words", "item_words")), strict=True):
                item = np.frombuffer(w, np.uint64)
                n, match = best_overlap(np.frombuffer(d, np.uint64), item, s)
                if match >= min(MIN_MATCH, -(-len(item) * 4 // 5)):
                    found.append((h, i, n, match))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True) if found else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["text_hash", "item_id", "n_words", "n_match"])

    verified = pairs.select("text_hash", "item_id", "shift", "doc_words", "item_words").mapInArrow(verify, VERIFIED)
    same = segments.where("reach = 0").select("text_hash", F.explode("hits").alias("hit")).select("text_hash", "hit.pos", "hit.hash").distinct()
    same = same.join(of_length.select("item_id", "pos", "hash"), ["pos", "hash"]).select("text_hash", "item_id", F.col("pos").alias("n_words"), F.col("pos").alias("n_match"))
    best = verified.unionByName(same).groupBy("text_hash", "item_id").agg(F.max("n_words").alias("n_words"), F.max("n_match").alias("n_match"))
    return written(best, "benchmark_overlaps"), segments.select("doc_id", "text_hash")


def contaminated(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """One row per contaminated document: how many items it holds, the best of them, and its overlap."""
    found, own = overlaps(docs, benchmark, **columns)
    texts = found.groupBy("text_hash").agg(
        F.count("item_id").alias("n_items"),
        F.max(F.struct("n_match", "n_words", (-F.col("item_id")).alias("neg"))).alias("best"),
    )
    pairs = own.distinct().join(texts, "text_hash")
    rows = pairs.groupBy("doc_id").agg(F.max("n_items").alias("n_items"), F.max("best").alias("best"))
    return rows.select("doc_id", "n_items", (-F.col("best.neg")).alias("best_item"), F.col("best.n_match").alias("n_match"), F.col("best.n_words").alias("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """The rows of ``docs`` whose text overlaps no benchmark item, all columns kept.

    Only rows that a filter of the contaminated texts' hashes marks are joined; ``docs`` is read again for it and should be
    a table in files."""
    found, _ = overlaps(docs, benchmark, **columns)
    text = columns.get("text", "text")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(text).alias("text_hash"))
    return without(rows, "text_hash", found.select("text_hash").distinct()).select("_row.*")
