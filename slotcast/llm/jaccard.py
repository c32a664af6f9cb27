"""Exact Jaccard join of shingle sets in the metric space of the Jaccard distance.

``d = 1 - |x & y| / |x | y|`` is a metric; two documents link at ``d <= r`` with
``r = 1 - threshold``.  Documents with equal sets are one point (a class).

1. **Regions of single shingles.**  Every shingle is a pivot, and pivots have a
   global order, rare ones first.  The region of pivot ``s`` holds the sets whose first
   shingle is ``s``; a set is replicated into the regions that are no further than
   ``r`` from it: those of its shingle number ``i`` with ``i <= r |x|``, as any set of that
   region lacks the ``i`` shingles before.  Two sets that link therefore meet in the region
   of their first common shingle.  Rare pivots keep regions small.  The order comes from
   counts of all shingles in a table of fixed size; any order gives the same links.
2. **Windows of places.**  In the region of their first common shingle, number ``i`` of ``x``, the
   sets have at most ``|x| - i`` in common, so ``x`` links with no set of more than
   ``(1 + t) / t (|x| - i) - |x|`` shingles (``t`` the threshold), its *reach*, and both sizes must be within the
   other's reach.  A class without such a partner outside of its own component leaves the region.
3. **Document pivots, by rounds.**  Each region draws the ``PIVOTS`` (each later round ``GROWTH`` times as many) classes that
   have its shingle earliest, and measures the others against them.  Then all classes that
   are connected by now get one label, regions whose classes are all connected are done, and a
   pivot leaves, as its links in the region are known.  Near copies of one text so
   become one component by their distances to one or two of them.
4. **Voronoi regions, recursively.**  From the second round on, a region of more than ``LEAF`` classes has
   all distances to its pivots measured, and every class goes to the region of its nearest pivot
   and, as a boundary document, to each other region ``q`` that the triangle inequality
   leaves open: ``d(x, q) <= radius(q) + r`` and ``d(x, q) - d(x, nearest) <= 2 r``.  Inside, two classes meet only if
   their distances to the pivot differ by ``r`` at most.  These regions join in the same way.  A region
   that would hold more than twice its classes in this way stays whole, since all its classes
   are as far from each other as from the pivots; its next round has more pivots.

Distances are bounded from below first: a set's sketch holds, for about half a bit
per shingle, the parity of the shingles of each hash bucket, and two sketches
differ in no more bits than the sets differ in shingles.  Only pairs that pass are
measured exactly, so only their sets are read from the texts.

Links are never expanded within a class or a component.  A set's id is a 64-bit
hash of its shingles, and shingles are 64-bit hashes; but for collisions of these the join is exact.
Tables of a round are deleted when the next one has its own.

Nulls: a null text has no words; a document without words has an empty set and
links with nothing.  Documents with a null key take part in links but name no
component, unless all of one are null.  Repeated rows link.  An empty table gives
no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.bitmaps import bitmap, in_bitmap, without
from slotcast.llm.components import components
from slotcast.llm.store import Scratch, numbered, written

COUNT_BITS = 22  # log2 of the shingle counters that give the pivots' order
COUNT_CHUNK = 14  # log2 of the counters in one row
PIVOTS = 1  # of a region in the first round
GROWTH = 4  # times as many in each later one
LEAF = 8  # classes of a region that aren't laid into Voronoi regions of their own
SEEN = 1 << 20  # sets that one task remembers, so that it sends copies once
EPS = 1e-9


def shingle_sets(c: T.Chunk, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each document of a chunk."""
    w = T.hash_words(c.data, c.offsets, lower=True)
    n_words = np.diff(w.first)
    h, doc = T.windows(w, k)
    ends = np.searchsorted(doc, np.arange(len(n_words) + 1))
    out = [np.unique(h[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    for d in np.flatnonzero((n_words > 0) & (n_words < k)):  # the whole sequence is the one shingle
        short = T.Words(w.hash[w.first[d] : w.first[d + 1]], w.start, np.zeros(n_words[d], np.int64), w.first)
        out[d] = T.mix64(T.windows(short, int(n_words[d]))[0] + np.uint64(n_words[d]))
    return out


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit id of each set, the same in whatever order the set was met."""
    return np.array([int(np.add.reduce(T.mix64(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)) + len(s) & (2**64 - 1) for s in sets], np.uint64).view(np.int64)


def sketch(s: np.ndarray) -> bytes:
    """Parity of the shingles in each of a power of two of hash buckets, from half a bucket per shingle to one."""
    bits = 64
    while 2 * bits < len(s):
        bits *= 2
    count = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(count & 1 > 0, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """Two sets with these sketches differ in at least so many shingles."""
    if len(x) < len(y):
        x, y = y, x
    a, b, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(x)
    while size > len(y):  # fold: buckets of the smaller sketch are unions of those of the larger
        size //= 2
        a = (a >> (8 * size)) ^ (a & ((1 << (8 * size)) - 1))
    return (a ^ b).bit_count()


def prefix_size(n: int, percent: int) -> int:
    """How many regions a set of n shingles is in: its own and those at distance <= r."""
    return n - (percent * n + 99) // 100 + 1


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))


def measured_sets(docs: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """A row per document (doc_id, set_id, n_shingles), and rows (chunk, counts) of each task's shingle counters."""

    def run(batches):
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for b in batches:
            for c in T.chunks(b.column("text")):
                sets = shingle_sets(c, k)
                if sets:
                    at = np.concatenate(sets) >> np.uint64(64 - COUNT_BITS)
                    np.add.at(counts, at.astype(np.int64), 1)
                n = len(sets)
                own = b.column("doc_id").slice(c.lo, n)
                yield pa.RecordBatch.from_arrays([own, pa.array(set_ids(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        pack = zstandard.ZstdCompressor(level=1).compress
        used = [i for i, x in enumerate(counts.reshape(-1, 1 << COUNT_CHUNK)) if x.any()]
        for i in used:
            raw = pack(counts[i << COUNT_CHUNK : (i + 1) << COUNT_CHUNK].tobytes())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([i], pa.int32()), pa.array([raw], pa.binary())], names)

    names = ["doc_id", "set_id", "n_shingles", "chunk", "counts"]
    return _rows(docs, key, text).mapInArrow(T.tidy(run), "doc_id long, set_id long, n_shingles long, chunk int, counts binary")


def rarity(measured: DataFrame) -> np.ndarray:
    """Coarse logarithm of each counter's total: the leading part of the pivots' order."""

    def add(batches):
        unpack, sums = zstandard.ZstdDecompressor().decompress, {}
        for b in batches:
            for chunk, raw in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
                sums.setdefault(chunk, np.zeros(1 << COUNT_CHUNK, np.uint64))
                sums[chunk] += np.frombuffer(unpack(raw), np.uint32)
        for chunk, total in sums.items():
            level = np.minimum(4 * np.log2(total + 1.0), 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["chunk", "levels"])

    parts = measured.where("chunk IS NOT NULL").select("chunk", "counts").repartition("chunk")
    out = np.zeros(1 << COUNT_BITS, np.uint8)
    for chunk, levels in parts.mapInArrow(add, "chunk int, levels binary").collect():
        out[chunk << COUNT_CHUNK : (chunk + 1) << COUNT_CHUNK] = np.frombuffer(levels, np.uint8)
    return out


def _prefixes(docs: DataFrame, k: int, percent: int, levels, key: str, text: str, keep=None) -> DataFrame:
    """Per class and task: (set_id, n, regions, places); with ``keep``, only regions in that bitmap, and the set's sketch if any is left.

    A place is the number of the region's shingle in the set's order."""
    spread = docs.sparkSession.sparkContext.broadcast(levels)
    kept = docs.sparkSession.sparkContext.broadcast(keep) if keep is not None else None

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for c in T.chunks(b.column("text")):
                sets = shingle_sets(c, k)
                out = []
                for i, s in zip(set_ids(sets).tolist(), sets, strict=True):
                    if not len(s) or i in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(i)
                    first = s[np.argsort(spread.value[(s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)], kind="stable")[: prefix_size(len(s), percent)]]
                    places = np.arange(len(first))
                    if kept is not None:
                        places = np.flatnonzero(in_bitmap(kept.value, first))
                        if not len(places):
                            continue
                    out.append((i, len(s), first.view(np.int64)[places], places, sketch(s) if kept is not None else None))
                sizes = np.array([len(x[2]) for x in out], np.int64)
                flat = [np.concatenate([x[j] for x in out]) if out else np.zeros(0, np.int64) for j in (2, 3)]
                lists = [T.list_array(pa.array(x, pa.int64()), sizes) for x in flat]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), *lists, pa.array([x[4] for x in out], pa.binary())], ["set_id", "n", "regions", "places", "sketch"])

    return _rows(docs, key, text).mapInArrow(T.tidy(run), "set_id long, n long, regions array<long>, places array<long>, sketch binary")


def bounded(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs with both sides' sizes and sketches (a, na, ka, b, nb, kb): the least distance, and whether they may link."""

    def run(batches):
        for b in batches:
            na, nb = (b.column(x).to_numpy() for x in ("na", "nb"))
            apart = np.fromiter(map(least_difference, b.column("ka").to_pylist(), b.column("kb").to_pylist()), np.int64, len(na))
            apart = np.maximum(apart, np.abs(na - nb))
            total = na + nb
            may = 100 * (total - apart) >= percent * (total + apart)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(2 * apart / (total + apart)), pa.array(may)], ["a", "b", "lo", "may"])

    return pairs.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(run, "a long, b long, lo double, may boolean")


def distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact distance of each distinct pair (a, b), and whether it links; a set crosses the shuffle once, and once per pair."""
    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("set_id"))
    own = ends.join(sets, "set_id").withColumn("of", F.when(F.col("set_id") == F.col("a"), F.lit("a")).otherwise(F.lit("b")))
    both = own.groupBy("a", "b").agg(*(F.max(F.when(F.col("of") == x, F.col("shingles"))).alias(f"s{x}") for x in "ab"))

    def run(batches):
        for b in batches:
            d, links = [], []
            for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                d.append(1 - both / union)
                links.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(d, pa.float64()), pa.array(links, pa.bool_())], ["a", "b", "d", "linked"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, d double, linked boolean")


def read_sets(docs: DataFrame, ids: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """(set_id, shingles) of the classes in ``ids``, read from the texts; a filter lets a few others through, too."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(ids, "set_id", ids.count()))

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for c in T.chunks(b.column("text")):
                sets = shingle_sets(c, k)
                of = set_ids(sets)
                out = []
                for i in np.flatnonzero(in_bitmap(wanted.value, of.view(np.uint64))).tolist():
                    if of[i] not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(of[i])
                        out.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(of[out]), pa.array([sets[i].tobytes() for i in out], pa.binary())], ["set_id", "shingles"])

    return _rows(docs, key, text).mapInArrow(T.tidy(run), "set_id long, shingles binary").dropDuplicates(["set_id"])


# ---- regions


def merged(labels: DataFrame | None, links: DataFrame, tables: Scratch) -> DataFrame | None:
    """Labels (node, root) of all classes that aren't their component's smallest, after more links (a, b)."""
    if labels is not None:
        for c in "ab":
            links = links.join(labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(c, F.coalesce(f"root_{c}", c)).drop(f"root_{c}")
    edges = tables.put(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return labels
    roots = components(edges)
    if labels is not None:
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = labels.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")).unionByName(roots)
    return tables.put(roots, "labels")


def reach(n: Column, place: Column, percent: int) -> Column:
    """Shingles of the largest set that may link with a set of n, whose first common shingle is number ``place``."""
    return F.floor((100 + percent) * (n - place) / F.lit(percent) + EPS) - n


def with_partners(state: DataFrame) -> DataFrame:
    """The classes of each region that may link with one of another component there.

    Sizes are taken together by their eight leading bits; of each the two components that reach furthest stand for all."""
    cut = F.greatest(F.floor(F.log2("n")).cast("int") - 7, F.lit(0))
    floor = F.expr("shiftleft(shiftright(n, cut), cut)")
    own = state.withColumn("cut", cut).groupBy("region", floor.alias("floor"), "root").agg(F.max("most").alias("most"))
    order = Window.partitionBy("region", "floor").orderBy(F.desc("most"), "root")
    two = own.withColumn("rank", F.row_number().over(order)).where("rank <= 2")
    ends = two.groupBy("region").agg(F.collect_list(F.struct("floor", "most", "root")).alias("ends")).where("size(ends) > 1")
    met = F.exists("ends", lambda e: (e["root"] != F.col("root")) & (e["floor"] <= F.col("most")) & (e["most"] >= F.col("n")))
    return state.join(ends, "region").where(met).drop("ends")


def _side(rows: DataFrame, x: str, *more: str) -> DataFrame:
    return rows.select("region", F.col("set_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "place", "most", "root", "near", *more)))


def voronoi(star: DataFrame, known: DataFrame, r: float) -> DataFrame:
    """(cell, region, set_id, near) of the classes that remain, from the pairs (region, a, b) of pivots and classes and their
    distances (a, b, d): Voronoi regions of the pivots with their boundary documents, or the whole region if these hold too much."""
    left = star.select("region", "a", "place_a", F.col("b").alias("set_id")).join(known.select("a", F.col("b").alias("set_id"), "d"), ["a", "set_id"])
    home = left.groupBy("region", "set_id").agg(F.min(F.struct("d", "a")).alias("home"), F.min(F.struct("place_a", "a", "d")).getField("d").alias("to_first"))
    radius = home.groupBy("region", F.col("home.a").alias("a")).agg(F.max("home.d").alias("radius"))
    cells = left.join(home, ["region", "set_id"]).join(radius, ["region", "a"])
    cells = cells.where((F.col("a") == F.col("home.a")) | ((F.col("d") <= F.col("radius") + r) & (F.col("d") - F.col("home.d") <= 2 * r)))
    size = cells.groupBy("region").agg((F.count(F.lit(1)) > 2 * F.count_distinct("set_id")).alias("crowded"))
    split = cells.join(size.where("NOT crowded"), "region").select(F.xxhash64("region", "a").alias("region"), "region", "set_id", F.col("d").alias("near"))
    whole = home.join(size.where("crowded"), "region").select("region", "region", "set_id", F.col("to_first").alias("near"))
    return split.toDF("cell", "region", "set_id", "near").unionByName(whole.toDF("cell", "region", "set_id", "near"))


def connected(docs: DataFrame, measured: DataFrame, k: int, percent: int, key: str, text: str, trace: list | None = None) -> DataFrame | None:
    """(node, root) of the classes that links connect to a smaller one; ``trace`` gets a dictionary of counts for each round."""
    r = 1 - percent / 100 + EPS
    tables = Scratch()
    levels = rarity(measured)
    each = _prefixes(docs, k, percent, levels, key, text).select("set_id", F.explode("regions").alias("region"))
    shared = tables.put(each.groupBy("region").agg(F.min("set_id").alias("least"), F.max("set_id").alias("last")).where("least <> last").select("region"), "regions")
    keep = bitmap(shared, "region", shared.count())
    found = tables.put(_prefixes(docs, k, percent, levels, key, text, keep).dropDuplicates(["set_id"]), "region_sets")
    sketches = found.select("set_id", "n", "sketch")
    members = found.select("set_id", "n", F.explode(F.arrays_zip("regions", "places")).alias("m")).select("m.regions", "set_id", "n", "m.places")
    state = members.toDF("region", "set_id", "n", "place").withColumns({"most": reach(F.col("n"), F.col("place"), percent), "near": F.lit(None).cast("double")})
    labels, sets, pivots, turn = None, None, PIVOTS, 0
    while True:
        if labels is None:
            state = state.withColumn("root", F.col("set_id"))
        else:
            state = state.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        state = tables.put(with_partners(state), "state")
        if state.isEmpty():
            break
        order = Window.partitionBy("region").orderBy("place", "set_id")
        drawn = tables.put(state.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= pivots).drop("rank"), "pivots")
        star = _side(drawn, "a").join(_side(state, "b"), "region").where("place_a < place_b OR (place_a = place_b AND a < b)")
        may = (F.col("n_b") <= F.col("most_a")) & (F.col("n_a") <= F.col("most_b")) & (F.col("root_a") != F.col("root_b"))
        may &= F.coalesce(F.abs(F.col("near_a") - F.col("near_b")) <= r, F.lit(True))
        large = None
        if turn:
            large = tables.put(state.groupBy("region").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > LEAF).select("region"), "large")
            if large.isEmpty():
                large = None
        pairs = star.where(may) if large is None else star.join(large, "region", "left_anti").where(may)
        pairs = tables.put(pairs.select("a", "b").distinct(), "pairs")
        one, two = (sketches.select(F.col("set_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"k{x}")) for x in "ab")
        close = tables.put(bounded(pairs.join(one, "a").join(two, "b"), percent).where("may").select("a", "b"), "close")
        if turn < 2:  # the first round's close pairs, then all that are left in any region
            ids = close.select(F.explode(F.array("a", "b")).alias("set_id")) if turn == 0 else state.select("set_id")
            ids = tables.put(ids.distinct(), "sets_wanted")
            sets = read_sets(docs, ids, k, key, text)
            if turn:  # used by all further rounds
                sets = tables.put(sets, "sets")
        known = tables.put(distances(close, sets, percent), "distances")
        links = known.where("linked").select("a", "b")
        rest = state.join(drawn.select("region", "set_id"), ["region", "set_id"], "left_anti")
        if trace is not None:
            trace.append({"regions": state.select("region").distinct().count(), "classes": state.count(), "pivots": drawn.count(), "pairs": pairs.count(), "links": links.count(), "large": large.count() if large is not None else 0})
        if large is not None:
            inner = tables.put(star.join(large, "region", "left_semi"), "star")
            measured_star = tables.put(distances(inner.select("a", "b").distinct(), sets, percent), "star_distances")
            links = links.unionByName(measured_star.where("linked").select("a", "b"))
            others = inner.join(drawn.select("region", F.col("set_id").alias("b")), ["region", "b"], "left_anti")
            cells = voronoi(others, measured_star, r)
            placed = cells.join(rest.drop("near"), ["region", "set_id"]).drop("region").withColumnRenamed("cell", "region")
            rest = rest.join(large, "region", "left_anti").unionByName(placed)
            if trace is not None:
                trace[-1] |= {"cells": placed.select("region").distinct().count(), "placed": placed.count()}
        state = tables.put(rest.drop("root"), "rest")
        labels = merged(labels, links, tables)
        pivots *= GROWTH
        turn += 1
    tables.free("regions", "region_sets", "pivots", "large", "pairs", "close", "sets_wanted", "sets", "distances", "star", "star_distances", "rest", "links", "state")
    return labels


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text", trace: list | None = None) -> DataFrame:
    """(doc_id, set_id, n_shingles, component_id) of every document; columns beside the key and the text are not read.
    ``trace`` gets a dictionary of counts for each round."""
    measured = written(measured_sets(docs, k, key, text), "shingle_sets")
    roots = connected(docs, measured, k, percent, key, text, trace)
    rows = measured.where("chunk IS NULL").select("doc_id", "set_id", "n_shingles")
    classes = rows.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    if roots is None:
        classes = classes.withColumn("root", F.col("set_id"))
    else:
        classes = classes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select("set_id", "component_id")
    whole = rows.where("n_shingles > 0").join(named, "set_id").select("doc_id", "set_id", "n_shingles", "component_id")
    return whole.unionByName(rows.where("n_shingles = 0").select("doc_id", "set_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less near-duplicates: of each component the row with the smallest key stays, of several with that
    key one of them; a null key comes last.  Documents without words belong to no component and all stay.

    Rows are told apart by numbers (``store.numbered``), as keys may be null or repeat.  Of the rows only those that a
    filter of the others' numbers marks are joined, so texts that stay aren't shuffled."""
    rows = numbered(docs)
    placed = rows.select("_place", F.col(f"_row.{key}").alias("_key"), F.col(f"_row.{text}").alias("_text"))
    member = jaccard_components(placed, k, percent, "_place", "_text").where("n_shingles > 0").select(F.col("doc_id").alias("_place"), "component_id")
    member = written(member.join(placed.select("_place", "_key"), "_place"), "near_duplicates")
    order = F.struct(F.col("_key").isNull(), "_key", "_place")
    first = member.groupBy("component_id").agg(F.min(order).getField("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    extra = member.join(first.where("_n > 1"), "component_id").where("_place <> _first").select("_place")
    return without(rows, "_place", written(extra, "near_duplicates_extra")).select("_row.*")
