"""Hard negatives by spanning-tree bounds over the anchors.

An anchor's positives are its best rows of the same label; a hard negative of a positive is a
row of another label whose score lies in a window below the positive's.  Scores are
inner products of whole numbers, so they are exact, and so are the results.

1. **Anchor trees.**  Anchors are laid into blocks of neighbours: each goes to the nearest of
   at most ``CENTRES`` sampled anchors, and a centre with many is split by a hash.  Each block
   gets a minimum spanning tree of the distances between its anchors.
2. **Bounds.**  ``<c, x> = <p, x> + <c - p, x>``, so the score of ``x`` at a parent ``p``, plus and
   minus the length of the edge to ``c`` times the norm of ``x``, bounds its score at ``c``.  The
   walk starts from exact scores at the root; a row that isn't scored at a node
   hands its (wider) bounds on to the children.
3. **Rescoring.**  Only rows whose bounds overlap what can still matter are scored: for
   positives, from the worst of the best found so far upwards, or from the lower bound that
   enough rows of the batch have; for negatives, the windows of the anchor's positives, in the same way.

The anchors are a stated query set against all rows.  They are sent to the tasks in rounds of at most
``ROUND_BYTES``, and each task keeps the best rows of each anchor and window; Spark joins the
tasks' lists.  No row is dropped and no pair table is made.

Keys and labels are whole numbers.  Rows with a null key, label, vector or component take no part;
short vectors count as filled up with zeros, and components beyond 2^26 in size as 2^26, so that
scores fit into a long.  Repeated rows count each; of several anchors with one key the first by
label and vector is taken, and rows with an anchor's key are neither its positives nor its negatives.
Ties go to the smaller key.  An empty table gives no rows.  Columns beside the three aren't read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm.store import written
from slotcast.session import scratch_path

CENTRES = 256
BLOCK = 512  # anchors of a tree, about
ROUND_BYTES = 32 << 20  # of anchors sent to the tasks at once
LARGEST = 1 << 26  # of a component
EXACT = 1 << 53  # sums below it are exact in doubles


# ---- trees


@dataclass
class Tree:
    """Anchors in the order of the walk; a node's parent stands before it, the last child's subtree is the largest."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # int64
    parent: np.ndarray  # place of the parent, -1 for the root
    edge: np.ndarray  # length of the edge to it
    last: np.ndarray  # the parent isn't needed after this node


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, squared edge) of each row in a minimum spanning tree grown from the row nearest to the mean."""
    v = vectors.astype(np.float64)
    n = len(v)
    root = int(np.argmin(((v - v.mean(0)) ** 2).sum(1)))
    parent, best, done = np.full(n, root), ((v - v[root]) ** 2).sum(1), np.zeros(n, bool)
    parent[root], edge = -1, np.zeros(n)
    done[root] = True
    best[root] = np.inf
    for _ in range(n - 1):
        c = int(np.argmin(best))
        edge[c], done[c], best[c] = best[c], True, np.inf
        away = ((v - v[c]) ** 2).sum(1)
        closer = ~done & (away < best)
        best[closer], parent[closer] = away[closer], c
    return parent, edge


def walk_order(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order in which parents come first and large subtrees last, and which nodes are the last of their parent."""
    n = len(parent)
    children: list[list[int]] = [[] for _ in range(n)]
    for c, p in enumerate(parent.tolist()):
        if p >= 0:
            children[p].append(c)
    found = [int(np.flatnonzero(parent < 0)[0])]
    for p in found:  # breadth first; grows as it goes
        found += children[p]
    size = np.ones(n, np.int64)
    for c in reversed(found):
        if parent[c] >= 0:
            size[parent[c]] += size[c]
    order, last, todo = [], np.zeros(n, bool), [found[0]]
    while todo:
        p = todo.pop()
        order.append(p)
        own = sorted(children[p], key=lambda c: size[c])
        if own:
            last[own[-1]] = True
        todo += reversed(own)
    return np.array(order), last


def tree_of(keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
    parent, squared = spanning_tree(vectors)
    order, last = walk_order(parent)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    up = parent[order]
    return Tree(keys[order], labels[order], vectors[order], np.where(up < 0, -1, place[up]), np.sqrt(squared[order]), last[order])


# ---- the walk


class Rows:
    """A batch of rows: keys, labels, vectors and norms."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.keys, self.labels, self.vectors = keys, labels, vectors
        self.floats = vectors.astype(np.float64)
        self.norms = np.sqrt((self.floats**2).sum(1)) * (1 + 1e-12)
        self.largest = int(np.abs(vectors).max(initial=0))

    def scores(self, v: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products (int64) of v with the rows, or with those at the given places."""
        exact = self.largest * int(np.abs(v).max(initial=0)) * max(1, len(v)) < EXACT
        own, v = (self.floats, v.astype(np.float64)) if exact else (self.vectors, v)
        if at is None:
            return (own @ v).astype(np.int64)
        return (own[at] @ v if 2 * len(at) < len(own) else (own @ v)[at]).astype(np.int64)


def walk(tree: Tree, rows: Rows, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(node, places, scores) of the rows that ``wanted(node, low, high)`` says are wanted, given bounds of their scores."""
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    inner = set(tree.parent.tolist())
    for c, p in enumerate(tree.parent.tolist()):
        if p < 0:
            scores = rows.scores(tree.vectors[c])
            low = high = scores.astype(np.float64)
            at = np.flatnonzero(wanted(c, low, high))
            exact = scores[at]
        else:
            low, high = kept.pop(p) if tree.last[c] else kept[p]
            most = np.sqrt(float((tree.vectors[c].astype(np.float64) ** 2).sum())) * rows.norms  # no score is beyond it
            reach = tree.edge[c] * (1 + 1e-9) * rows.norms + most * 2.0**-48
            low, high = np.maximum(low - reach, -most * (1 + 1e-9)), np.minimum(high + reach, most * (1 + 1e-9))
            at = np.flatnonzero(wanted(c, low, high))
            exact = rows.scores(tree.vectors[c], at)
            low[at] = high[at] = exact
        if c in inner:
            kept[c] = (low, high)
        if len(at):
            yield c, at, exact


class Best:
    """The k best (score, key) of one list, higher scores first, ties by smaller key."""

    __slots__ = ("k", "scores", "keys")

    def __init__(self, k: int):
        self.k, self.scores, self.keys = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def worst(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        if len(self.scores) == self.k:
            at = np.flatnonzero(scores >= self.scores[-1])
            scores, keys = scores[at], keys[at]
        if len(scores):
            scores, keys = np.append(self.scores, scores), np.append(self.keys, keys)
            first = np.lexsort((keys, -scores))[: self.k]
            self.scores, self.keys = scores[first], keys[first]


def kth(low: np.ndarray, k: int) -> float:
    """The k-th best of these rows scores no less than this."""
    return float(np.partition(low, -k)[-k]) if len(low) >= k else -np.inf


def add_positives(tree: Tree, rows: Rows, best: list[Best]) -> int:
    """Add a batch to the anchors' best rows of their own label; how many scores it took beside the root's."""

    def wanted(c, low, high):
        own = (rows.labels == tree.labels[c]) & (rows.keys != tree.keys[c])
        return own & (high >= max(best[c].worst(), kth(low[own], best[c].k)))

    n = 0
    for c, at, scores in walk(tree, rows, wanted):
        n += len(at)
        best[c].add(scores, rows.keys[at])
    return n


def add_negatives(tree: Tree, rows: Rows, windows: list[list[tuple[int, int]]], best: list[list[Best]]) -> int:
    """Add a batch to the best rows of other labels in each anchor's windows (least, most); how many scores it took."""

    def wanted(c, low, high):
        other, hit = (rows.labels != tree.labels[c]) & (rows.keys != tree.keys[c]), np.zeros(len(low), bool)
        for (least, most), found in zip(windows[c], best[c], strict=True):
            within = other & (low >= least) & (high <= most)
            hit |= (high >= max(least, found.worst(), kth(low[within], found.k))) & (low <= most)
        return hit & other

    n = 0
    for c, at, scores in walk(tree, rows, wanted):
        n += len(at)
        for (least, most), found in zip(windows[c], best[c], strict=True):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            found.add(scores[inside], rows.keys[at[inside]])
    return n


# ---- in Spark


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        out = flat.reshape(len(sizes), width)
    else:
        out = np.zeros((len(sizes), width), np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return np.clip(out, -LARGEST, LARGEST)


def _rows(batch: pa.RecordBatch, width: int) -> Rows:
    return Rows(batch.column("key").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("vector"), width))


def _blocks(anchors: DataFrame, width: int) -> DataFrame:
    """A row per tree: (block, n, tree's arrays as bytes)."""
    spark = anchors.sparkSession
    n = anchors.count()
    centres = anchors.orderBy(F.xxhash64("key"), "key").limit(CENTRES).toArrow()
    sent = spark.sparkContext.broadcast(_matrix(centres.column("vector").combine_chunks(), width).astype(np.float64) if n > BLOCK else None)

    def nearest(batches):
        for b in batches:
            near = np.zeros(len(b), np.int32)
            if sent.value is not None and len(b):
                v, c = _matrix(b.column("vector"), width).astype(np.float64), sent.value
                near = ((c**2).sum(1)[None] - 2 * v @ c.T).argmin(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(near), *b.columns], ["centre", *b.schema.names])

    placed = written(anchors.mapInArrow(nearest, "centre int, key long, label long, vector array<long>"), "anchor_centres")
    parts = placed.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("long").alias("parts"))  # CENTRES rows at most
    placed = placed.join(F.broadcast(parts), "centre").withColumn("block", F.col("centre").cast("long") * (1 << 40) + F.pmod(F.xxhash64("key"), "parts"))

    def build(table: pa.Table) -> pa.Table:
        t = tree_of(table.column("key").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("vector").combine_chunks(), width))
        packed = {x: pa.array([getattr(t, x).tobytes()], pa.binary()) for x in ("keys", "labels", "vectors", "parent", "edge", "last")}
        return pa.table({"block": table.column("block")[:1], "n": pa.array([len(t.keys)], pa.int64())} | packed)

    schema = "block long, n long, keys binary, labels binary, vectors binary, parent binary, edge binary, last binary"
    return written(placed.select("block", "key", "label", "vector").groupBy("block").applyInArrow(build, schema), "anchor_trees")


def _tree(row, width: int) -> Tree:
    ints = [np.frombuffer(row[x], np.int64) for x in ("keys", "labels")]
    return Tree(*ints, np.frombuffer(row.vectors, np.int64).reshape(row.n, width), np.frombuffer(row.parent, np.int64), np.frombuffer(row.edge, np.float64), np.frombuffer(row.last, bool))


def _rounds(blocks: DataFrame, width: int) -> list[list[int]]:
    """Blocks of each round: one number per block comes to the driver."""
    rounds: list[list[int]] = [[]]
    room = ROUND_BYTES
    for block, n in blocks.select("block", "n").orderBy("block").collect():
        if rounds[-1] and room < n * (8 * width + 64):
            rounds.append([])
            room = ROUND_BYTES
        rounds[-1].append(block)
        room -= n * (8 * width + 64)
    return rounds if rounds[0] else []


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", label: str = "label", vector: str = "vector", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each of an anchor's ``positives`` best rows of
    its label the ``negatives`` best rows of other labels with ``low * positive <= 100 * negative <= high * positive``.

    ``is_anchor`` is a condition over the columns of ``rows``; ``vector`` is an array of whole numbers."""
    spark = rows.sparkSession
    taken = rows.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    taken = written(taken.where("key IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(F.forall("vector", lambda x: x.isNotNull())), "vectors")
    width = taken.agg(F.max(F.size("vector"))).first()[0] or 0
    anchors = taken.where("anchor").groupBy("key").agg(F.min(F.struct("label", "vector")).alias("first")).select("key", "first.*")
    blocks = _blocks(written(anchors, "anchors"), width)
    data = taken.select("key", "label", "vector")
    paths = scratch_path(spark, "positives"), scratch_path(spark, "negatives")
    schemas = "block long, anchor long, key long, score long", "block long, anchor long, positive long, of long, key long, score long"
    rounds = _rounds(blocks, width)

    def in_round(step: int, blocks_of: list[int], run) -> None:
        sent = spark.sparkContext.broadcast([(r.block, _tree(r, width)) for r in blocks.where(F.col("block").isin(blocks_of)).collect()])
        found = data.mapInArrow(lambda batches: run(batches, sent.value), schemas[step])
        by, k = (["anchor"], positives) if step == 0 else (["anchor", "positive"], negatives)
        _ranked(found, by, k).write.mode("append").parquet(paths[step])
        sent.destroy()

    def own_label(batches, trees):
        best = [[Best(positives) for _ in t.keys] for _, t in trees]
        for b in batches:
            batch = _rows(b, width)
            for (_, t), lists in zip(trees, best, strict=True):
                add_positives(t, batch, lists)
        for (block, t), lists in zip(trees, best, strict=True):
            sizes = np.array([len(x.keys) for x in lists], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(sizes.sum(), block)), pa.array(np.repeat(t.keys, sizes)), pa.array(np.concatenate([x.keys for x in lists])), pa.array(np.concatenate([x.scores for x in lists]))], ["block", "anchor", "key", "score"])

    def other_labels(batches, trees, windows):
        best = [[[Best(negatives) for _ in own] for own in of] for of in windows]
        for b in batches:
            batch = _rows(b, width)
            for (_, t), of, lists in zip(trees, windows, best, strict=True):
                add_negatives(t, batch, [[w[:2] for w in own] for own in of], lists)
        for (block, t), of, lists in zip(trees, windows, best, strict=True):
            flat = [(a, *w[2:], s, x) for a, own, tops in zip(t.keys.tolist(), of, lists, strict=True) for w, top in zip(own, tops, strict=True) for x, s in zip(top.scores.tolist(), top.keys.tolist(), strict=True)]
            columns = [pa.array([x[i] for x in flat], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), block), pa.int64()), *columns], ["block", "anchor", "positive", "of", "key", "score"])

    for of in rounds:
        in_round(0, of, own_label)
    for of in rounds:
        best = spark.read.parquet(paths[0]).where(F.col("block").isin(of)).select("anchor", "key", "score").collect()  # ``positives`` rows per anchor of the round
        windows_of: dict[int, list] = {}
        for anchor, positive, score in best:
            windows_of.setdefault(anchor, []).append((-(-low * score // 100), high * score // 100, positive, score))
        sent = spark.sparkContext.broadcast(windows_of)
        in_round(1, of, lambda batches, trees, sent=sent: other_labels(batches, trees, [[sorted(sent.value.get(a, ())) for a in t.keys.tolist()] for _, t in trees]))
        sent.destroy()
    if not rounds:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = spark.read.parquet(paths[1])
    return out.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("key").alias("negative_id"), F.col("of").alias("positive_score"), F.col("score").alias("negative_score"))
