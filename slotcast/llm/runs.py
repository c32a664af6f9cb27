"""Periodic runs of words by maximal-pair enumeration over the LCP-interval tree of each text.

A run is a stretch of words with smallest period ``q`` and a length of at least
``max(min_length, min_exponent * q)`` that no neighbouring word extends.  Such a run is a
maximal pair: the stretch without its last ``q`` words and the one without its first
``q`` are equal, lie ``q`` words apart, and differ in the word before and in the word after.
So a pair of suffixes with ``l`` words in common is a run exactly if its distance ``q`` has
``max(min_length, min_exponent * q) <= l + q`` and its left words differ.

1. **Suffix ranks** by doubling: ranks by 1, 2, 4, ... words, numbered in lexicographic
   order; only classes that still hold several suffixes are sorted again.  The common
   prefix of two neighbours in suffix order comes from the same ranks, longest first.
2. **LCP-interval tree, bottom-up**, with a stack.  An interval keeps its positions sorted
   and in one list per left word.  When two children of an interval meet, every position
   of the smaller one looks up the other's positions of *other* left words at an allowed
   distance; each find is a maximal pair, and nothing is extended.
3. The pairs at multiples of a run's period have the run's start and length, so the least
   distance of each (start, length) is the period.

Texts without a repeated window of as many words as the shortest pair has are left out
before step 1, and positions with no repetition near enough for their longest common
prefix before step 2; neither can be in a pair.  Words are compared by 64-bit hashes.
The work of a text is done in the task that reads it; nothing is shuffled.

Nulls: a null text has no words; a null key is kept as it is.  Empty texts have no runs
and an empty collapsed text.  Repeated rows give repeated results, an empty table none.
Columns beside the key and the text aren't read, so their names don't matter.  A text takes
about 4 bytes per word and doubling while it is worked on."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from slotcast.llm import textops as T

MIN_LENGTH = 6  # words of the shortest run
MIN_EXPONENT = 4  # periods that a run holds at least

RUN = "array<struct<start:long,length:long,period:long>>"


def shortest_pair(min_length: int, min_exponent: int) -> int:
    """Words that the two ends of any run have in common, at least."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, max(2, min_length + 1)))


# ---- suffixes


def _candidates(w: T.Words, k: int) -> np.ndarray:
    """Rows with two equal windows of k words."""
    h, doc = T.windows(w, k)
    h = T.mix64(h ^ T.mix64(doc.astype(np.uint64) + np.uint64(1)))
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    return np.unique(doc[twice[at] == h])


def prefix_ranks(keys: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words until no two are equal.

    ``keys`` tells words (and texts) apart; ``end`` is where each position's text ends.
    A rank is the place of its class's first suffix in suffix order."""
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    rank = np.zeros(n, np.int32)
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, width = [rank], 1
    size = np.bincount(rank, minlength=n)
    live = np.flatnonzero(size[rank] > 1)
    while len(live):
        far = live + width
        after = np.where(far < end[live], rank[np.minimum(far, n - 1)].astype(np.int64) + 1, 0)
        own = rank[live].astype(np.int64)
        key = own * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key, own = key[order], own[order]
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, own[1:] != own[:-1])
        first = np.flatnonzero(group)[np.cumsum(group) - 1]  # of the old class
        place = own + np.flatnonzero(new)[np.cumsum(new) - 1] - first
        rank = rank.copy()
        rank[live[order]] = place
        levels.append(rank)
        width *= 2
        alone = new & np.append(new[1:], True)
        live = np.sort(live[order][~alone])
    return levels


def common_prefix(levels: list[np.ndarray], end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at a and b (different places) have in common."""
    length = np.zeros(len(a), np.int64)
    for t in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = np.flatnonzero((x < end[a]) & (y < end[b]))
        same = inside[levels[t][x[inside]] == levels[t][y[inside]]]
        length[same] += 1 << t
    return length


# ---- intervals


class Interval:
    """Positions of an LCP interval: all of them in order, and in order for each left word."""

    __slots__ = ("places", "lefts")

    def __init__(self, place: int, left: int):
        self.places, self.lefts = [place], {left: [place]}


def _meet(a: Interval, b: Interval, common: int, least: int, most: int, left_of: dict[int, int], out: list) -> Interval:
    """Maximal pairs between two children of an interval of ``common`` words at distances least..most; their union."""
    if len(a.places) < len(b.places):
        a, b = b, a
    for left, own in b.lefts.items() if least <= most else ():
        if len(a.lefts) == 1 and left in a.lefts:
            continue
        for x in own:
            lo, hi = bisect_left(a.places, x - most), bisect_right(a.places, x + most)
            if hi - lo <= len(a.lefts):
                found = [y for y in a.places[lo:hi] if left_of[y] != left]
            else:
                found = [y for other, theirs in a.lefts.items() if other != left for y in theirs[bisect_left(theirs, x - most) : bisect_right(theirs, x + most)]]
            out.extend((min(x, y), max(x, y), common) for y in found if abs(x - y) >= least)
    for left, own in b.lefts.items():
        theirs = a.lefts.setdefault(left, [])
        for x in own:
            insort(a.places, x)
            insort(theirs, x)
    return a


def maximal_pairs(place: list[int], left: list[int], common: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """(i, j, l) of all maximal pairs i < j that are runs, from suffixes in order, their left words and the words that each
    has in common with the next."""
    floor, out, stack, left_of = shortest_pair(min_length, min_exponent), [], [], dict(zip(place, left, strict=True))

    def join(a: Interval, b: Interval, words: int) -> Interval:
        return _meet(a, b, words, max(1, min_length - words), words // (min_exponent - 1), left_of, out)

    for x, before, shared in zip(place, left, common, strict=True):
        node = Interval(x, before)
        while stack and stack[-1][0] > shared:  # these intervals end here
            words, below = stack.pop()
            node = join(below, node, words)
        if shared < floor:
            stack.clear()
        elif stack and stack[-1][0] == shared:
            stack[-1] = (shared, join(stack[-1][1], node, shared))
        else:
            stack.append((shared, node))
    return out


def runs_of(w: T.Words, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each row that has any, by start, then period."""
    floor = shortest_pair(min_length, min_exponent)
    rows = _candidates(w, floor)
    if not len(rows):
        return {}
    sizes = np.diff(w.first)[rows]
    word = T.ragged(w.first[rows], sizes)
    ends = np.cumsum(sizes)
    begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    doc = np.repeat(np.arange(len(rows), dtype=np.uint64), sizes)
    keys = T.mix64(w.hash[word] ^ T.mix64(doc + np.uint64(1)))
    levels = prefix_ranks(keys, end)
    order = np.empty(len(keys), np.int64)
    order[levels[-1]] = np.arange(len(keys))

    common = np.zeros(len(keys) + 1, np.int64)  # of each suffix with the one before it in order
    t = floor.bit_length() - 1  # 2 ** t words at least must be equal
    ranks = levels[min(t, len(levels) - 1)][order]
    near = np.flatnonzero(ranks[1:] == ranks[:-1]) if t < len(levels) else np.zeros(0, np.int64)
    common[near + 1] = common_prefix(levels, end, order[near], order[near + 1])
    most = np.maximum(common[:-1], common[1:])
    kept = np.flatnonzero(most >= floor)
    if not len(kept):
        return {}

    # of these, only what has a repetition near enough
    group = np.cumsum(common[:-1] < floor)[kept]
    at = order[kept]
    by_place = np.lexsort((at, group))
    same = group[by_place][1:] == group[by_place][:-1]
    gap = np.where(same, np.diff(at[by_place]), len(keys) + 1)
    nearest = np.minimum(np.append(gap, len(keys) + 1), np.append(len(keys) + 1, gap))
    fits = np.zeros(len(kept), bool)
    fits[by_place] = nearest * (min_exponent - 1) <= most[kept][by_place]
    kept = kept[fits]
    if not len(kept):
        return {}
    shared = np.minimum.reduceat(common, kept + 1)
    at = order[kept]
    left = np.where(at > begin[at], levels[0][np.maximum(at - 1, 0)], -1)
    pairs = maximal_pairs(at.tolist(), left.tolist(), shared.tolist(), min_length, min_exponent)

    least: dict[tuple[int, int], int] = {}  # period of each (start, length)
    for i, j, words in pairs:
        run = (i, words + j - i)
        least[run] = min(least.get(run, j - i), j - i)
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (start, length), period in least.items():
        r = int(doc[start])
        out.setdefault(int(rows[r]), []).append((int(start - begin[start]), int(length), int(period)))
    for runs in out.values():
        runs.sort(key=lambda x: (x[0], x[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that a run holds after its first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    gone = np.cumsum(depth)[:-1] > 0
    return [x for x, drop in zip(words, gone.tolist(), strict=True) if not drop]


# ---- the operator


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row: the key, ``runs`` (start, length, period in words; by start, then period), and ``collapsed``, the words of the
    text joined by one space without those that a run repeats."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has two words and two periods at least")

    def run(batches):
        for b in batches:
            for c in T.chunks(b.column("text")):
                found = runs_of(T.hash_words(c.data, c.offsets, lower=False), min_length, min_exponent)
                raw, offsets = c.data.tobytes(), c.offsets.tolist()
                texts = []
                for d in range(c.hi - c.lo):
                    words = raw[offsets[d] : offsets[d + 1]].split()
                    texts.append(b" ".join(collapse(words, found[d]) if d in found else words))
                flat = [x for d in range(c.hi - c.lo) for x in found.get(d, ())]
                columns = [pa.array([x[i] for x in flat], pa.int64()) for i in range(3)]
                runs = T.list_array(pa.StructArray.from_arrays(columns, ["start", "length", "period"]), np.array([len(found.get(d, ())) for d in range(c.hi - c.lo)], np.int64))
                yield pa.RecordBatch.from_arrays([b.column("key").slice(c.lo, c.hi - c.lo), runs, pa.array(texts, pa.binary()).cast(pa.string())], ["key", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = S.StructType([S.StructField("key", rows.schema["key"].dataType), *S.StructType.fromDDL(f"runs {RUN}, collapsed string").fields])
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period; of several the first in order.  Null if there is none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def digest(runs: Column) -> Column:
    """sha256 of ``start,length,period`` lines."""
    line = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    return F.sha2(F.array_join(F.transform(runs, lambda r: F.concat(line(r), F.lit("\n"))), "").cast("binary"), 256)
