"""Quality rules from tokeniser fertility.

Two public vocabularies measure each document: characters per token, the share
of byte-fallback tokens (one of the two has them), and the entropy of its tokens.
The entropy is the collision entropy with pairs of different places, whose
estimate doesn't depend on the length.  Text of a kind that a vocabulary knows
lies in a narrow range for each language; symbol runs, shouting, tables of
fragments and broken encodings lie below it.

The bands of each language come from histograms of all documents that pass the
base rule (median, and median deviation as the spread), so they need no sort and
no collected group.  A document is rejected if its deviations below the medians,
in spreads, add up to more than ``CUT``, or its byte-fallback share lies above its
band.  Spreads grow for short documents as the measures' noise does, and for
languages with few documents, whose medians are less certain.  A language with fewer
than ``MIN_BAND`` documents that pass the base rule has no bands of its own: the bands
of all documents in the text's script hold (most of its letters decide), or those of all
documents if these are too few or the text has no letters, as wide as the smallest
language's.

Nulls: a null text is empty and fails the base rule; a null language is a
language of its own.  Repeated rows are judged alike.  An empty table gives no
rows.  Columns beside the ones named are not read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.bitmaps import without
from slotcast.llm.store import numbered, written
from slotcast.llm.tokens import IdCache, WordEncoder, word_encoder

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
CUT = 9.0  # spreads below the medians, summed over the four measures
NOISE = 400  # tokens at which a document's own noise adds as much as the spread of its language
MIN_BAND = 8
FEW = 30  # documents of a language at which its medians' own noise adds as much as the spread
SCALE = 1000  # histogram bins per unit of a measure
FALLBACK = 0.1  # byte-fallback share that may exceed the median at least
MEASURES = {"chars_per_piece": 0.02, "chars_per_token": 0.02, "piece_entropy": 0.05, "token_entropy": 0.05, "fallback_share": 0.0}  # with the least spread
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
LINE_END = np.zeros(256, bool)
LINE_END[0x0A] = True
#: Code points of scripts; other letters, symbols and signs belong to none.
SCRIPTS = {
    "latin": [(0x41, 0x5B), (0x61, 0x7B), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x2B0), (0x1E00, 0x1F00)], "greek": [(0x370, 0x400), (0x1F00, 0x2000)], "cyrillic": [(0x400, 0x530)],
    "armenian": [(0x530, 0x590)], "hebrew": [(0x590, 0x600)], "arabic": [(0x600, 0x700), (0x750, 0x780), (0x8A0, 0x900)], "devanagari": [(0x900, 0x980)], "bengali": [(0x980, 0xA00)],
    "gurmukhi": [(0xA00, 0xA80)], "gujarati": [(0xA80, 0xB00)], "oriya": [(0xB00, 0xB80)], "tamil": [(0xB80, 0xC00)], "telugu": [(0xC00, 0xC80)], "kannada": [(0xC80, 0xD00)],
    "malayalam": [(0xD00, 0xD80)], "sinhala": [(0xD80, 0xE00)], "thai": [(0xE00, 0xE80)], "lao": [(0xE80, 0xF00)], "tibetan": [(0xF00, 0x1000)], "myanmar": [(0x1000, 0x10A0)],
    "georgian": [(0x10A0, 0x1100)], "hangul": [(0x1100, 0x1200), (0xAC00, 0xD7B0)], "ethiopic": [(0x1200, 0x13A0)], "khmer": [(0x1780, 0x1800)], "mongolian": [(0x1800, 0x18B0)],
    "kana": [(0x3041, 0x3100)], "han": [(0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0x20000, 0x323B0)],
}
SCRIPT_NAMES = np.array([None, *SCRIPTS], object)
SCRIPT_OF = np.zeros(0x110000, np.uint8)
for _number, _ranges in enumerate(SCRIPTS.values(), 1):
    for _lo, _hi in _ranges:
        SCRIPT_OF[_lo:_hi] = _number
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CACHE_WORDS = 600_000
_PIECES: dict[str, Pieces] = {}


class Pieces:
    """Pieces of single words by a sentencepiece file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        self.size = self.processor.get_piece_size()
        self.is_byte = np.array([self.processor.is_byte(i) for i in range(self.size)])
        self.cache = IdCache(CACHE_WORDS)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.processor.encode([w.decode("utf-8", "replace") for w in words], num_threads=1)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum())), sizes


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, hash): first index, inverse, counts."""
    _, first, inverse, counts = np.unique(h ^ T.mix64(doc.astype(np.uint64) + np.uint64(1)), return_index=True, return_inverse=True, return_counts=True)
    return first, inverse, counts


def base_counts(c: T.Chunk, words: T.Words) -> dict[str, np.ndarray]:
    """The counts of the base rule for each document of a chunk; ``words`` are not lower-cased."""
    n_docs = len(c.offsets) - 1
    n_words = np.diff(words.first)
    chars = _per_doc(~T.IS_SPACE[c.data] & ((c.data & 0xC0) != 0x80), c.offsets)
    symbols = _per_doc(SYMBOL[c.data], c.offsets)
    lines = T.hash_words(c.data, c.offsets, lower=False, space=LINE_END)
    dup_lines = np.zeros(n_docs, np.int64)
    if len(lines.start):
        solid = np.add.reduceat((~T.IS_SPACE[c.data]).astype(np.int64), lines.start) > 0
        doc, h = lines.doc[solid], lines.hash[solid]
        first, _, _ = _distinct(doc, h)
        dup_lines = np.bincount(doc, minlength=n_docs) - np.bincount(doc[first], minlength=n_docs)
    marked = np.zeros(len(words.hash) + 1, np.int64)
    n = len(words.hash) - WINDOW + 1
    if n > 0:
        at = np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1 :])
        h, doc = T.windows(words, WINDOW)
        _, inverse, counts = _distinct(doc, h)
        again = at[counts[inverse] > 1]
        marked[again] += 1
        marked[again + WINDOW] -= 1
    repeat = _per_doc(np.cumsum(marked)[:-1] > 0, words.first)
    return dict(zip(BASE, (n_words, chars, symbols, dup_lines, repeat), strict=True))


def _collision_entropy(ids: np.ndarray, ends: np.ndarray, vocabulary: int) -> np.ndarray:
    """-log2 of the chance that two different places of a document hold the same id."""
    n = np.diff(ends)
    doc = np.repeat(np.arange(len(n)), n)
    keys, counts = np.unique(doc * vocabulary + ids, return_counts=True)
    same = np.bincount(keys // vocabulary, weights=counts * (counts - 1.0), minlength=len(n))
    return -np.log2(np.maximum(same, 1.0) / np.maximum(n * (n - 1.0), 1.0))


def scripts(c: T.Chunk) -> np.ndarray:
    """The script of most letters of each document, None without letters."""
    n_docs, width = len(c.offsets) - 1, len(SCRIPT_NAMES)
    lead = np.flatnonzero((c.data & 0xC0) != 0x80)
    code = c.data[lead].astype(np.int64)
    wide = np.flatnonzero(code >= 0xC0)
    byte = np.append(c.data, np.zeros(3, np.uint8)).astype(np.int64) & 0x3F
    at, first = lead[wide], code[wide]
    two, three = (first & 0x1F) << 6 | byte[at + 1], (first & 0x0F) << 12 | byte[at + 1] << 6 | byte[at + 2]
    four = (first & 0x07) << 18 | byte[at + 1] << 12 | byte[at + 2] << 6 | byte[at + 3]
    code[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, np.minimum(four, 0x10FFFF)))
    doc = np.repeat(np.arange(n_docs), _per_doc((c.data & 0xC0) != 0x80, c.offsets))
    counts = np.bincount(doc * width + SCRIPT_OF[code], minlength=n_docs * width).reshape(n_docs, width)
    counts[:, 0] = 0
    return SCRIPT_NAMES[np.where(counts.any(axis=1), counts.argmax(axis=1), 0)]


def fertility(c: T.Chunk, words: T.Words, of: Pieces, encoder: WordEncoder) -> dict[str, np.ndarray]:
    """Tokens, byte-fallback tokens and token entropies in bits of each document."""
    until = np.append(words.start, len(c.data))

    def spell(i: np.ndarray) -> list[bytes]:
        return [c.data[a:b].tobytes().rstrip() for a, b in zip(words.start[i].tolist(), until[i + 1].tolist(), strict=True)]

    ids, sizes = of.cache.lookup(words.hash, spell, of.encode)
    ends = np.concatenate([[0], np.cumsum(sizes)])[words.first]
    out = {"n_pieces": np.diff(ends), "n_fallback": _per_doc(of.is_byte[ids], ends), "piece_entropy": _collision_entropy(ids, ends, of.size)}
    ids, sizes = encoder.encode(c.data, c.offsets)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return out | {"n_tokens": sizes, "token_entropy": _collision_entropy(ids, ends, len(encoder.ends_piece))}


MEASURED = "doc_id long, band string, script string, " + ", ".join(f"{x} long" for x in BASE) + ", n_pieces long, n_fallback long, piece_entropy double, n_tokens long, token_entropy double"


def measure(docs: DataFrame, piece_model: str, word_model: str, key: str = "doc_id", text: str = "text", band: str = "lang") -> DataFrame:
    """One row per document with the counts of the base rule and the measures.  ``band`` names the language or script column."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(band).cast("string").alias("band"), F.col(text).alias("text"))

    def run(batches):
        of, encoder = pieces(piece_model), word_encoder(word_model)
        for b in batches:
            for c in T.chunks(b.column("text")):
                words = T.hash_words(c.data, c.offsets, lower=False)
                out = base_counts(c, words) | fertility(c, words, of, encoder)
                own = [*(b.column(x).slice(c.lo, c.hi - c.lo) for x in ("doc_id", "band")), pa.array(scripts(c), pa.string())]
                yield pa.RecordBatch.from_arrays(own + [pa.array(x) for x in out.values()], ["doc_id", "band", "script", *out])

    measured = rows.mapInArrow(T.tidy(run), MEASURED)
    return measured.withColumns({
        "chars_per_piece": F.col("word_chars") / F.greatest("n_pieces", F.lit(1)),
        "chars_per_token": F.col("word_chars") / F.greatest("n_tokens", F.lit(1)),
        "fallback_share": F.col("n_fallback") / F.greatest("n_pieces", F.lit(1)),
    })


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _key(band: Column) -> Column:
    return F.coalesce(F.concat(F.lit("b"), band), F.lit("n"))


ALL = "a"  # the band of all documents


def _script() -> Column:
    return F.concat(F.lit("s"), F.col("script"))


def _median(hist: DataFrame, by: list[str], value: str) -> DataFrame:
    """Lower median of ``value`` in a histogram with counts ``n``; the bins are bounded by the measures' range."""
    w = Window.partitionBy(*by)
    h = hist.withColumn("_upto", F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("_all", F.sum("n").over(w))
    return h.where(2 * F.col("_upto") >= F.col("_all")).groupBy(*by).agg(F.min(value).alias("median"), F.first("_all").alias("n_docs"))


def bands(measured: DataFrame) -> DataFrame:
    """(band, measure) -> median, spread, n_docs; the bands are those of each language, of each script and of all documents."""
    values = F.array(*(F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * SCALE).cast("long").alias("bin")) for m in MEASURES))
    good = measured.where(~base_failed()).select(_key(F.col("band")).alias("band"), _script().alias("script"), F.explode(values).alias("v"))
    hist = good.groupBy("band", "script", "v.measure", "v.bin").agg(F.count(F.lit(1)).alias("n"))
    hist = hist.select(F.explode(F.array_compact(F.array("band", "script", F.lit(ALL)))).alias("band"), "measure", "bin", "n")
    hist = written(hist.groupBy("band", "measure", "bin").agg(F.sum("n").alias("n")), "quality_histogram")
    middle = _median(hist, ["band", "measure"], "bin")
    away = hist.join(middle.select("band", "measure", "median"), ["band", "measure"]).withColumn("away", F.abs(F.col("bin") - F.col("median")))
    spread = _median(away.groupBy("band", "measure", "away").agg(F.sum("n").alias("n")), ["band", "measure"], "away")
    return middle.join(spread.select("band", "measure", F.col("median").alias("spread")), ["band", "measure"])


def judge(measured: DataFrame) -> DataFrame:
    """Add ``base_failed``, the deviation ``score`` and the verdict ``kept``."""
    table = bands(measured)
    wide = table.groupBy("band").pivot("measure", list(MEASURES)).agg(F.first("median").alias("median"), F.first("spread").alias("spread"))
    wide = wide.join(table.groupBy("band").agg(F.max("n_docs").alias("n_docs")), "band")
    wide = wide.where((F.col("n_docs") >= MIN_BAND) | (F.col("band") == ALL))
    wide = written(wide.select(F.col("band").alias("_band"), F.struct(*(c for c in wide.columns if c != "band")).alias("_limit")), "quality_bands")
    rows = measured.withColumns({"_band": _key(F.col("band")), "_script": _script()}).join(wide, "_band", "left")
    of_script = wide.where(F.col("_band").startswith("s")).select(F.col("_band").alias("_script"), F.col("_limit").alias("_script_limit"))
    of_all = wide.where(F.col("_band") == ALL).select(F.col("_limit").alias("_all_limit"))  # one row, or none
    rows = rows.join(F.broadcast(of_script), "_script", "left").join(F.broadcast(of_all), F.lit(True), "left")  # a row for each script
    own = F.col("_limit").isNotNull()
    rows = rows.withColumns({"_limit": F.coalesce("_limit", "_script_limit", "_all_limit"), "_few": F.when(own, F.col("_limit.n_docs")).otherwise(F.least(F.lit(MIN_BAND), F.coalesce("_script_limit", "_all_limit")["n_docs"]))})
    limit = F.col("_limit")
    widen = F.sqrt((1 + NOISE / F.greatest("n_pieces", F.lit(1))) * (1 + FEW / F.col("_few")))

    def off(m: str) -> Column:
        spread = F.greatest(limit[f"{m}_spread"] / SCALE * 1.4826, F.lit(MEASURES[m]))
        return (F.col(m) - limit[f"{m}_median"] / SCALE) / (spread * widen)

    score = sum((F.least(off(m), F.lit(0.0)) for m in list(MEASURES)[1:4]), F.least(off("chars_per_piece"), F.lit(0.0)))
    allowed = limit["fallback_share_median"] / SCALE + F.greatest(limit["fallback_share_spread"] / SCALE * 5 * 1.4826, F.lit(FALLBACK)) * widen
    return rows.withColumn("base_failed", base_failed()).withColumn("score", score).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce((F.col("score") >= -CUT) & (F.col("fallback_share") <= allowed), F.lit(True))
    )


def quality_rules(docs: DataFrame, piece_model: str, word_model: str, key: str = "doc_id", text: str = "text", band: str = "lang") -> DataFrame:
    """Base counts, measures, score and verdict of every document."""
    measured = written(measure(docs, piece_model, word_model, key, text, band), "quality_measures")
    out = judge(measured)
    return out.select("doc_id", *BASE, "base_failed", "kept", F.col("band").alias(band), *MEASURES, "score")


def passing(docs: DataFrame, piece_model: str, word_model: str, text: str = "text", band: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns kept.

    Rows are told apart by numbers (``store.numbered``); of the rows only those that a filter of the rejected numbers
    marks are joined, so kept texts aren't shuffled."""
    rows = numbered(docs)
    fields = rows.select("_place", F.col(f"_row.{text}").alias("text"), F.col(f"_row.{band}").alias("band"))
    judged = quality_rules(fields, piece_model, word_model, "_place", "text", "band")
    rejected = written(judged.where(~F.col("kept")).select(F.col("doc_id").alias("_place")), "quality_rejected")
    return without(rows, "_place", rejected).select("_row.*")
