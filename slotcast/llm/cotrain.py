"""Quality classifier by co-training on two views of a document.

* Text content: hashed counts of its words and symbol runs, as a vector of length 1.
* Page metadata: language, source, length, line layout and typography (shares of
  capitals, symbols, digits and white space, all of ASCII).

Each view has a logistic regression of its own.  Over ``ROUNDS`` rounds each
classifier labels all unlabelled documents, and where it is confident the other view
learns from its label.  Both are then calibrated on labelled documents that no round has
seen (Platt scaling), and their log-odds are added, less the prior's, to score all
documents.

A fit (Spark ML) reads a bounded sample, drawn by a hash of the key: at most about ``LABELLED``
labelled documents and ``POOL`` of the confidently labelled ones, an equal share of these
from each language and source, so that rare ones take part.  Scoring covers every document: one Arrow pass reads a text,
counts its tokens and applies both models, so a round reads each text once.

Nulls: a null text is empty, a null language or source a value of its own; null
labels don't count.  A document with several labels has their mean, at least a
half being good; repeated rows score alike.  With fewer than ``FEWEST`` labels of
either class all documents get the labels' mean (0.5 without labels).  If the labels are so few that the
part kept for calibration, or the rest, lacks a class, the fit and the calibration use all of them, and the
calibration is that of training rows.  An empty table gives no rows.  Other columns are not read."""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from slotcast.llm import textops as T
from slotcast.llm.store import written

LABELLED = 12_000
POOL = 12_000
ROUNDS = 2
CONFIDENT = 0.97
CALIBRATE = 4  # one labelled document in so many is kept for calibration
FEWEST = 5
TEXT_BITS = 16  # log2 of the text view's columns
WHO = 1024  # columns of the metadata view for language and source
SYMBOLS = b"#*$%&|<>!{}[]=~^_+@"
GAP, LETTER, OTHER = 0, 1, 2
KIND = np.full(256, OTHER, np.uint8)  # of bytes; those beyond ASCII count as letters
KIND[[x for x in range(256) if chr(x).isalpha() or x >= 128]] = LETTER
KIND[T.IS_SPACE] = GAP
SHARES = np.zeros((4, 256), bool)  # capitals, digits, symbols, spaces
SHARES[0, 65:91] = SHARES[1, 48:58] = SHARES[2, list(SYMBOLS)] = True
SHARES[3] = T.IS_SPACE
NUMBERS = 3 + len(SHARES)


def _per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes of each text."""
    upto = np.concatenate([[0], np.cumsum(flags)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def text_view(c: T.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed tokens of a chunk: document, column, and value; a document's values have length 1."""
    kind = KIND[c.data]
    begin = kind != GAP
    begin[1:] &= kind[1:] != kind[:-1]
    edges = c.offsets[:-1][c.offsets[:-1] < c.offsets[1:]]
    begin[edges] = kind[edges] != GAP
    start = np.flatnonzero(begin)
    column = (T.hash_runs(c.data, start, kind == GAP) >> np.uint64(64 - TEXT_BITS)).astype(np.int64)
    doc = np.searchsorted(c.offsets, start, "right") - 1
    both, count = np.unique(doc << TEXT_BITS | column, return_counts=True)
    doc = both >> TEXT_BITS
    norm = np.sqrt(np.bincount(doc, count.astype(np.float64) ** 2, c.hi - c.lo))
    return doc, both & ((1 << TEXT_BITS) - 1), count / norm[doc]


def meta_view(c: T.Chunk) -> np.ndarray:
    """The numbers of each document: logarithms of its characters, lines and characters a line, and shares of kinds of characters."""
    chars = _per_doc((c.data & 0xC0) != 0x80, c.offsets)
    lines = _per_doc(c.data == 10, c.offsets) + 1
    shares = [_per_doc(of[c.data], c.offsets) / np.maximum(chars, 1) for of in SHARES]
    return np.column_stack([np.log1p(chars), np.log(lines), np.log1p(chars / lines), *shares])


def views(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, text, and language and source as text and as columns of the metadata view."""
    names = {"lang": lang, "source": source}
    who = {n: F.coalesce(F.concat(F.lit(f"{n} "), F.col(c).cast("string")), F.lit("none")) for n, c in names.items()}
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), *(c.alias(n) for n, c in who.items()))
    return rows.withColumns({f"{n}_at": F.pmod(F.xxhash64(F.lit(n), n), F.lit(WHO)) + NUMBERS for n in names})


def _chunks(batches):
    """(batch slice, chunk) of whole texts."""
    for b in batches:
        for c in T.chunks(b.column("text")):
            yield b.slice(c.lo, c.hi - c.lo), T.Chunk(0, c.hi - c.lo, c.data, c.offsets)


def features(rows: DataFrame) -> DataFrame:
    """The rows of ``views`` with text_features and meta_features, for the bounded samples that models are fitted on."""
    keep = [n for n in rows.columns if n not in ("text", "lang_at", "source_at")]

    def run(batches):
        for b, c in _chunks(batches):
            n = c.hi
            doc, column, value = text_view(c)
            who = np.column_stack([b.column(f"{x}_at").to_numpy() for x in ("lang", "source")])
            numbers = meta_view(c)
            meta = [{i: float(x) for i, x in enumerate(numbers[d])} for d in range(n)]
            for d in range(n):
                for at in who[d].tolist():
                    meta[d][at] = meta[d].get(at, 0.0) + 1.0
            lists = [T.list_array(pa.array(column, pa.int32()), np.bincount(doc, minlength=n)), T.list_array(pa.array(value), np.bincount(doc, minlength=n))]
            lists += [pa.array([sorted(m) for m in meta], pa.list_(pa.int32())), pa.array([[m[k] for k in sorted(m)] for m in meta], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), *lists], [*keep, "ti", "tv", "mi", "mv"])

    schema = S.StructType([*(rows.schema[x] for x in keep), *S.StructType.fromDDL("ti array<int>, tv array<double>, mi array<int>, mv array<double>").fields])
    sizes = {"text": ("ti", "tv", 1 << TEXT_BITS), "meta": ("mi", "mv", NUMBERS + WHO)}
    vector = {v: F.udf(lambda i, x, size=size: Vectors.sparse(size, i, x), VectorUDT())(F.col(i), F.col(x)) for v, (i, x, size) in sizes.items()}
    return rows.mapInArrow(run, schema).select(*keep, *(c.alias(f"{v}_features") for v, c in vector.items()))


def margins(rows: DataFrame, models: dict[str, LogisticRegressionModel]) -> DataFrame:
    """(doc_id, lang, source, text, meta): each view's log-odds of every document, from one pass over the texts."""
    weights = {v: (m.coefficients.toArray(), float(m.intercept)) for v, m in models.items()}
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        (tw, tb), (mw, mb) = sent.value["text"], sent.value["meta"]
        for b, c in _chunks(batches):
            doc, column, value = text_view(c)
            text = np.bincount(doc, value * tw[column], c.hi) + tb
            meta = meta_view(c) @ mw[:NUMBERS] + mw[b.column("lang_at").to_numpy()] + mw[b.column("source_at").to_numpy()] + mb
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in keep), pa.array(text), pa.array(meta)], [*keep, "text", "meta"])

    keep = ["doc_id", "lang", "source"]
    schema = S.StructType([*(rows.schema[x] for x in keep), *S.StructType.fromDDL("text double, meta double").fields])
    return rows.mapInArrow(run, schema)


def _draw(key: Column, salt: int, bound: int, of: int) -> Column:
    """True for about ``bound`` of ``of`` keys, the same ones in every run."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) < int(min(1.0, bound / max(of, 1)) * (1 << 30))


def _fit(rows: DataFrame, view: str, label: str) -> LogisticRegressionModel:
    """A logistic regression in which both classes weigh the same."""
    shares = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    weight = F.when(F.col(label) == 1, sum(shares.values()) / (2 * shares[1])).otherwise(sum(shares.values()) / (2 * shares[0]))
    model = LogisticRegression(featuresCol=f"{view}_features", labelCol=label, weightCol="weight", maxIter=15, regParam=1e-3, rawPredictionCol=f"{view}_raw", probabilityCol=f"{view}_p", predictionCol=f"{view}_label")
    return model.fit(rows.withColumn("weight", weight))


class CoTrained:
    """Both views' models with their calibrations; ``transform`` scores the rows of ``views``."""

    def __init__(self, models: dict, platt: dict[str, tuple[float, float]], prior: float):
        self.models, self.platt, self.prior = models, platt, prior

    def transform(self, rows: DataFrame) -> DataFrame:
        odds = {view: F.lit(a) * F.col(view) + F.lit(b) for view, (a, b) in self.platt.items()}
        both = sum(odds.values(), F.lit(-self.prior))

        def p(x: Column) -> Column:
            return 1 / (1 + F.exp(-x))

        return margins(rows, self.models).select("doc_id", *(p(x).alias(f"{view}_score") for view, x in odds.items()), p(both).alias("score"))


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> tuple[DataFrame, DataFrame]:
    """A bounded sample of the labelled ``docs`` (with ``label``), and all others."""
    marks = labels.select(F.col(key).alias("doc_id"), F.col(label).alias("_mark")).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("_mark").alias("_mark"))
    marks = marks.where("_mark IS NOT NULL").select("doc_id", (F.col("_mark") >= 0.5).cast("double").alias("label"))
    n_marks = marks.count()
    drawn = written(marks.where(_draw(F.col("doc_id"), 1, LABELLED, n_marks)), "labels_drawn")
    # the text columns of the drawn rows only; the bounded side decides the join
    some = docs.where(F.col(key).isNotNull()).drop("label")
    with_label = some.join(F.broadcast(drawn.withColumnRenamed("doc_id", key)), key)  # at most about LABELLED rows
    pool = some.join(F.broadcast(drawn.withColumnRenamed("doc_id", key).drop("label")), key, "left_anti")
    return with_label, pool


def taught(sure: DataFrame) -> DataFrame:
    """doc_id and label of at most about POOL of the rows (doc_id, label, lang, source), an equal share of each language and source."""
    by = ["lang", "source"]
    groups = written(sure.groupBy(by).agg(F.count(F.lit(1)).alias("_n")), "cotrain_groups")
    share = POOL / max(1, groups.count())
    keep = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(1 << 30)) < F.least(F.lit(1.0), share / F.col("_n")) * (1 << 30)
    return sure.join(groups, by).where(keep).select("doc_id", "label").distinct()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", **columns) -> CoTrained | float:
    """The co-trained classifier, or the labels' mean if either class has too few."""
    marked, pool = labelled(docs, labels, key, label)
    known = views(marked.withColumn(key, F.struct(F.col(key).alias("id"), "label")), key, **columns)
    known = known.withColumns({"label": F.col("doc_id.label"), "doc_id": F.col("doc_id.id")})
    known = written(features(known).select("doc_id", "label", "text_features", "meta_features"), "cotrain_labelled")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < FEWEST:
        return counts.get(1.0, 0) / sum(counts.values()) if counts else 0.5
    unknown = views(pool, key, **columns)
    apart = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(CALIBRATE)) == 0
    teach, check = known.where(~apart), known.where(apart)
    if teach.where("label = 0").isEmpty() or teach.where("label = 1").isEmpty() or check.where("label = 0").isEmpty() or check.where("label = 1").isEmpty():
        teach = check = known
    sets = {"text": teach, "meta": teach}
    sure = log(CONFIDENT / (1 - CONFIDENT))
    for turn in range(ROUNDS + 1):
        models = {view: _fit(rows, view, "label") for view, rows in sets.items()}
        if turn == ROUNDS:
            break
        found = {view: F.when(F.abs(view) >= sure, (F.col(view) > 0).cast("double")).alias(view) for view in models}
        scored = margins(unknown, models).select("doc_id", "lang", "source", *found.values())
        scored = written(scored.where("text IS NOT NULL OR meta IS NOT NULL"), "cotrain_sure")
        for view, other in (("text", "meta"), ("meta", "text")):
            drawn = written(taught(scored.where(F.col(view).isNotNull()).select("doc_id", F.col(view).alias("label"), "lang", "source")), "cotrain_drawn")
            some = pool.join(F.broadcast(drawn.select(F.col("doc_id").alias(key)).distinct()), key, "left_semi")  # at most about POOL rows
            learnt = features(views(some, key, **columns)).join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text_features", "meta_features")
            sets[other] = written(teach.unionByName(learnt), "cotrain_taught")
    platt = {}
    for view, model in models.items():
        own = model.transform(check).select("label", vector_to_array(F.col(f"{view}_raw"))[1].alias("margin"))
        line = LogisticRegression(featuresCol="x", labelCol="label", maxIter=20, regParam=1e-2).fit(VectorAssembler(inputCols=["margin"], outputCol="x").transform(own))
        platt[view] = (max(0.0, float(line.coefficients[0])), float(line.intercept))
    positive = counts[1.0] / (counts[0.0] + counts[1.0])
    return CoTrained(models, platt, log(positive / (1 - positive)))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", **columns) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every document."""
    model = fit(docs, labels, key, label, **columns)
    if isinstance(model, float):
        scored = docs.select(F.col(key).alias("doc_id"), *(F.lit(model).alias(x) for x in ("text_score", "meta_score", "score")))
    else:
        scored = model.transform(views(docs, key, **columns))
    return scored.withColumn("kept", F.col("score") >= 0.5)
