"""Language-model scores by context-tree weighting over bytes.

Each byte is coded as binary decisions (the bits of its number among the bytes seen
in training; one more number stands for all others, which share it equally).  For every context of up to
``DEPTH`` preceding bytes and every decision, the counts of zeros and ones give a
Krichevsky-Trofimov estimate, and context-tree weighting mixes the estimates of
all depths: a node's weighted probability is half its own estimate plus half
the product of its children's.  The counts of the whole training text determine
all weights, so training is counting; texts are then scored with the trained
tree held fixed.

A context is expanded if it occurs at least ``LEAST`` times, so the tree grows with
the corpus.  The bytes of a node's dropped children form one child of their own.

The counts of a node's decisions and its weighted probabilities are kept for the
decisions that it has seen; any other leaves its parent's prediction with a half.
Subtrees below three bytes of context lie within one task each, and Spark groups the
nodes of three bytes by their parents; the driver holds the nodes of up to two bytes,
whose number the alphabet bounds.  A second pass carries the predictions down and
scores every distinct byte with its context that occurs anywhere.  The commonest of
these, at most COMMON_GRAMS, are broadcast; all rarer ones are joined.

A text is the lower-cased (A-Z) bytes and an end symbol, with end symbols as the
context of its first bytes; ``END`` (0xFF) never occurs in UTF-8.

Beside it stands a base score with add-one word frequencies over all training
tokens.  Words with at least ``1 / COMMON`` of them, at most COMMON words, are
broadcast; all rarer ones are joined.

Nulls: a null text is empty (one end token); a null key is in the training part.
Repeated rows count as often as they occur.  An empty table gives no rows; with no
training documents all bytes are equally likely.  Other columns are not read."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotcast.llm import textops as T
from slotcast.llm.store import written

DEPTH = 5
LEAST = 2
COMMON = 1 << 21
COMMON_GRAMS = 1 << 22
BLOCK = 1 << 16  # grams that a task takes at once, more only for one subtree
END = 0xFF
END_WORD = np.uint64(0xFFFFFFFFFFFFFFFF)  # the end token among the word hashes
HOLD = 1 << 21  # distinct keys that a task counts before it sends them on
WORD, GRAM, HELD = 0, 1, 2  # counts in the training part, and grams of the held-out part


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")), F.lit(7)) == 2


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end symbol: the byte with its ``depth`` predecessors as one number, and its document."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.full(len(data) + n_docs * (depth + 1), END, np.uint8)
    shift = np.arange(n_docs) * (depth + 1) + depth
    padded[np.arange(len(data)) + np.repeat(shift, size)] = T.LOWER[data]
    key = padded[: len(padded) - depth].astype(np.uint64)
    for j in range(1, depth + 1):
        key = (key << np.uint64(8)) | padded[j : len(padded) - depth + j]
    doc = np.repeat(np.arange(n_docs), size + depth + 1)[depth:]
    real = np.ones(len(padded), bool)
    real[T.ragged(offsets[:-1] + np.arange(n_docs) * (depth + 1), np.full(n_docs, depth))] = False
    return key[real[depth:]], doc[real[depth:]]


class Counter:
    """Counts of 64-bit keys, merged now and then; gives them up when too many are distinct."""

    def __init__(self, hold: int = HOLD):
        self.hold, self.parts, self.waiting = hold, [], 0

    def add(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        k, n = np.unique(keys, return_counts=True)
        self.parts.append((k, n))
        self.waiting += len(k)

    def take(self, force: bool = False):
        """Merged (keys, counts) once there are too many to hold, or at the end."""
        if not self.parts or not (force or self.waiting > 2 * self.hold):
            return None
        keys, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, n = keys[first], np.add.reduceat(n, first)
        self.parts, self.waiting = ([], 0) if force or len(keys) > self.hold else ([(keys, n)], len(keys))
        return None if self.parts else (keys, n)


def corpus_counts(rows: DataFrame, depth: int) -> DataFrame:
    """(kind, key, n): how often each word occurs in the training part, and each byte with its context in either part."""

    def run(batches):
        counters = {WORD: Counter(), GRAM: Counter(), HELD: Counter()}

        def send(force: bool):
            for kind, counter in counters.items():
                if got := counter.take(force):
                    keys, n = got
                    for i in range(0, len(keys), 1 << 16):
                        k = keys[i : i + (1 << 16)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k.view(np.int64)), pa.array(n[i : i + (1 << 16)])], ["kind", "key", "n"])

        for b in batches:
            held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for c in T.chunks(b.column("text")):
                out = held[c.lo : c.hi]
                words = T.hash_words(c.data, c.offsets, lower=True)
                counters[WORD].add(np.concatenate([words.hash[~out[words.doc]], np.full(int((~out).sum()), END_WORD)]))
                gram, doc = grams(c.data, c.offsets, depth)
                counters[GRAM].add(gram[~out[doc]])
                counters[HELD].add(gram[out[doc]])
                yield from send(False)
        yield from send(True)

    return rows.select("text", "held_out").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log(Gamma(n + 1/2)) for counts n >= 0 (Stirling's series after shifting by 8)."""
    return _log_gamma(n + 0.5)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(shift)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov estimate of a sequence with a zeros and b ones."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return log_gamma_half(a) + log_gamma_half(b) - np.log(np.pi) - _log_gamma(a + b + 1)


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of the binary decisions (in heap order from place 1) for rows of symbol counts."""
    n, width = counts.shape
    zeros, ones = np.zeros((n, width)), np.zeros((n, width))
    level, nodes = counts.astype(np.float64), width // 2
    while nodes:
        pair = level.reshape(n, nodes, 2)
        zeros[:, nodes : 2 * nodes], ones[:, nodes : 2 * nodes] = pair[:, :, 0], pair[:, :, 1]
        level, nodes = pair.sum(axis=2), nodes // 2
    return zeros, ones


def _blocks(n: int, size: int = 4096):
    return (slice(i, min(n, i + size)) for i in range(0, n, size))


def _log_kt_rows(counts: np.ndarray) -> np.ndarray:
    out = np.empty(counts.shape, np.float64)
    for rows in _blocks(len(counts)):
        out[rows] = log_kt(*decisions(counts[rows]))
    return out


@dataclass
class Tree:
    """A tree in memory, the measure of the distributed one.  The symbol of each byte; per depth the child table (node, symbol) -> node of the next depth or -1, and
    log10 of each symbol's probability where the path ends."""

    symbol: np.ndarray
    n_symbols: int
    children: list[np.ndarray]
    scores: list[np.ndarray]

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in [*self.children, *self.scores])


def build_tree(tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """Weights and mixed predictions from counts.  ``tables[d]``: (context, byte, count) of the kept contexts of
    length d, a context's oldest byte being its highest; a kept context's suffixes are kept too."""
    contexts = [np.unique(t[0]) for t in tables]
    if not len(contexts[0]):
        contexts[0] = np.zeros(1, np.uint64)
    depth = max(d for d, x in enumerate(contexts) if len(x))
    seen = np.unique(np.append(tables[0][1].astype(np.int64), END))
    other = len(seen)  # the symbol of all bytes that weren't seen
    symbol = np.full(256, other, np.int64)
    symbol[seen] = np.arange(other)
    width = 2
    while width < other + 1:
        width *= 2
    counts, parents, children = [], [None], []
    for d in range(depth + 1):
        ctx, (c, byte, n) = contexts[d], tables[d]
        table = np.zeros((len(ctx), width), np.float32 if n.max(initial=0) < 1 << 24 else np.float64)
        table[np.searchsorted(ctx, c), symbol[byte.astype(np.int64)]] = n
        counts.append(table)
        if d:
            oldest = symbol[(ctx >> np.uint64(8 * (d - 1))).astype(np.int64)]
            parent = np.searchsorted(contexts[d - 1], ctx & np.uint64((1 << (8 * (d - 1))) - 1))
            parents.append(parent)
            links = np.full(len(contexts[d - 1]) * (other + 1), -1, np.int32)
            links[parent * (other + 1) + oldest] = np.arange(len(ctx))
            children.append(links)

    def rest(d: int) -> np.ndarray:
        left = counts[d].astype(np.float64)
        if d < depth:
            np.subtract.at(left, parents[d + 1], counts[d + 1])
        return left

    weights, below = [None] * (depth + 1), None
    for d in range(depth, -1, -1):
        own = _log_kt_rows(counts[d])
        if d == depth:
            weights[d], below = np.ones((1, 1), np.float32), own
            continue
        product = _log_kt_rows(rest(d))
        np.add.at(product, parents[d + 1], below)
        below = np.logaddexp(own, product) + np.log(0.5)
        weights[d] = np.exp(own + np.log(0.5) - below).astype(np.float32)
    scores, so_far, left = [], None, None
    for d in range(depth + 1):
        n = len(counts[d])
        so_far = so_far[parents[d]] if d else np.zeros((n, width), np.float32)
        left = left[parents[d]] if d else np.ones((n, width), np.float32)
        remaining, score = rest(d), np.empty((n, other + 1), np.float32)
        for rows in _blocks(n):
            zeros, ones = decisions(counts[d][rows])
            w = weights[d] if len(weights[d]) == 1 else weights[d][rows]
            so_far[rows] += left[rows] * w * (ones + 0.5) / (zeros + ones + 1)
            left[rows] *= 1 - w
            zeros, ones = decisions(remaining[rows])
            one = np.clip(so_far[rows] + left[rows] * (ones + 0.5) / (zeros + ones + 1), 1e-9, 1 - 1e-9)
            score[rows] = _symbol_scores(one)[:, : other + 1]
        score[:, other] -= np.log10(max(1, 256 - other))
        scores.append(score.reshape(-1))
    return Tree(symbol, other + 1, children, scores)


def _symbol_scores(one: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol from those of its decisions (rows in heap order)."""
    level, nodes = np.zeros((len(one), 1)), 1
    while nodes < one.shape[1]:
        p = one[:, nodes : 2 * nodes].astype(np.float64)
        level = np.stack([level + np.log10(1 - p), level + np.log10(p)], axis=2).reshape(len(one), -1)
        nodes *= 2
    return level


def score_bytes(tree: Tree, key: np.ndarray) -> np.ndarray:
    """log10 probability of each byte with its context, as ``grams`` gives them."""
    of, n = tree.symbol, tree.n_symbols
    symbol = of[(key & np.uint64(0xFF)).astype(np.int64)]
    out = tree.scores[0][symbol]
    live, node = np.arange(len(key)), np.zeros(len(key), np.int64)
    for d, links in enumerate(tree.children):
        node = links[node * n + of[((key[live] >> np.uint64(8 * (d + 1))) & np.uint64(0xFF)).astype(np.int64)]]
        found = node >= 0
        live, node = live[found], node[found].astype(np.int64)
        out[live] = tree.scores[d + 1][node * n + symbol[live]]
    return out


@dataclass
class Alphabet:
    """The symbol of each byte, and how many there are; the last one stands for all bytes that weren't seen."""

    symbol: np.ndarray
    other: int

    @classmethod
    def of(cls, seen: np.ndarray) -> Alphabet:
        seen = np.unique(np.append(seen.astype(np.int64), END))
        symbol = np.full(256, len(seen), np.int64)
        symbol[seen] = np.arange(len(seen))
        return cls(symbol, len(seen))

    @property
    def bits(self) -> int:
        return max(1, self.other.bit_length())

    def paths(self, byte: np.ndarray):
        """(place, bit) of each decision on the way to the byte."""
        path = self.symbol[byte.astype(np.int64)] + (1 << self.bits)
        for k in range(1, self.bits + 1):
            yield (path >> k).astype(np.uint64), (path >> (k - 1)) & 1


@dataclass
class Level:
    """The decisions seen by the contexts of one depth: code (context << 8 | place, ascending), zeros and ones, those of
    them in no kept child, the weight of the own estimate, and the log of the weighted probability (NaN: not kept)."""

    code: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    rest_zeros: np.ndarray
    rest_ones: np.ndarray
    weight: np.ndarray
    below: np.ndarray

    def kept(self) -> np.ndarray:
        return ~np.isnan(self.below)


def _at(code: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted code in the ascending codes, and whether it is there."""
    if not len(code):
        return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
    spot = np.minimum(np.searchsorted(code, want), len(code) - 1)
    return spot, code[spot] == want


def _drop_rare(code: np.ndarray, n: np.ndarray, below: np.ndarray) -> np.ndarray:
    spot, _ = _at(code, code >> np.uint64(8) << np.uint64(8) | np.uint64(1))  # every byte passes the first place
    return np.where(n[spot] >= LEAST, below, np.nan)


def leaves(key: np.ndarray, n: np.ndarray, alphabet: Alphabet) -> Level:
    """The level of the longest contexts from the counts of bytes with their contexts."""
    context = key >> np.uint64(8) << np.uint64(8)
    places, bits = zip(*alphabet.paths(key & np.uint64(0xFF)), strict=True)
    code, of = np.unique(np.concatenate([context | x for x in places]), return_inverse=True)
    n, bit = np.tile(n.astype(np.float64), len(bits)), np.concatenate(bits)
    zeros, ones = (np.bincount(of, weights=np.where(bit == x, n, 0.0), minlength=len(code)) for x in (0, 1))
    return Level(code, zeros, ones, zeros, ones, np.ones(len(code)), _drop_rare(code, zeros + ones, log_kt(zeros, ones)))


def _shorter(code: np.ndarray, depth: int) -> np.ndarray:
    return code & np.uint64((1 << 8 * (depth + 1)) - 1)


def parents(code: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray, depth: int) -> Level:
    """The level of length ``depth`` from that of its children, which lack nothing of a parent."""
    kept = ~np.isnan(below)
    code, of = np.unique(_shorter(code, depth), return_inverse=True)
    total = lambda x: np.bincount(of, weights=x, minlength=len(code))
    rest_zeros, rest_ones, product = total(np.where(kept, 0, zeros)), total(np.where(kept, 0, ones)), total(np.where(kept, below, 0))
    zeros, ones = total(zeros), total(ones)
    own = log_kt(zeros, ones)
    below = np.logaddexp(own, log_kt(rest_zeros, rest_ones) + product) + np.log(0.5)
    weight = np.exp(own + np.log(0.5) - below)
    return Level(code, zeros, ones, rest_zeros, rest_ones, weight, _drop_rare(code, zeros + ones, below) if depth else below)


@dataclass
class Mixed:
    """Predictions of one level's kept decisions: code, the mixture of the shorter contexts' and the own estimate, the
    weight left for longer ones, and the probability of a one where the path ends."""

    code: np.ndarray
    so_far: np.ndarray
    left: np.ndarray
    one: np.ndarray


def mixed(level: Level, above: Mixed | None, depth: int) -> Mixed:
    keep = level.kept()
    code, z, o, rz, ro, w = (x[keep] for x in (level.code, level.zeros, level.ones, level.rest_zeros, level.rest_ones, level.weight))
    so_far, left = np.zeros(len(code)), np.ones(len(code))
    if above is not None:
        spot, _ = _at(above.code, _shorter(code, depth - 1))
        so_far, left = above.so_far[spot], above.left[spot]
    so_far, left = so_far + left * w * (o + 0.5) / (z + o + 1), left * (1 - w)
    return Mixed(code, so_far, left, so_far + left * (ro + 0.5) / (rz + ro + 1))


def gram_log10(key: np.ndarray, levels: list[Mixed], alphabet: Alphabet) -> np.ndarray:
    """log10 probability of each byte with its context; ``levels`` are those of all depths."""
    first = key >> np.uint64(8) << np.uint64(8) | np.uint64(1)
    ends = np.zeros(len(key), np.int64)
    for d, level in enumerate(levels[1:], 1):
        ends[_at(level.code, _shorter(first, d))[1]] = d
    out = np.zeros(len(key))
    for place, bit in alphabet.paths(key & np.uint64(0xFF)):
        code = key >> np.uint64(8) << np.uint64(8) | place
        one = np.full(len(key), 0.5)
        for d, level in enumerate(levels):
            spot, hit = _at(level.code, _shorter(code, d))
            spot = spot[hit]
            one[hit] = np.where(ends[hit] == d, level.one[spot], level.so_far[spot] + level.left[spot] / 2)
        one = np.clip(one, 1e-9, 1 - 1e-9)
        out += np.log10(np.where(bit == 1, one, 1 - one))
    out[alphabet.symbol[(key & np.uint64(0xFF)).astype(np.int64)] == alphabet.other] -= np.log10(max(1, 256 - alphabet.other))
    return out


def _whole(batches, names: list[str]):
    """Columns of rows that come sorted by the first one, cut only where it changes."""
    held, n, size = [], 0, BLOCK
    for b in batches:
        held.append([b.column(x).to_numpy(zero_copy_only=False) for x in names])
        n += b.num_rows
        if n >= size:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if cut:
                yield [x[:cut] for x in columns]
            held, n = [[x[cut:] for x in columns]], n - cut
            size = max(BLOCK, 2 * n)
    if n:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


TOP = 2  # length of the contexts that the driver holds


def _subtrees(grams_: DataFrame, key: str, shift: int, length: int) -> DataFrame:
    """Rows with the last ``length`` context bytes as ``tail``, equal ones in one task and together."""
    rows = grams_.withColumn("tail", F.shiftright(key, shift).bitwiseAND(F.lit((1 << 8 * length) - 1)))
    return rows.repartition("tail").sortWithinPartitions("tail")


def gram_scores(counts: DataFrame, depth: int) -> DataFrame:
    """(key, n, score): every byte with its context of the corpus counts, how often it occurs, and its log10 probability."""
    spark = counts.sparkSession
    all_grams = counts.where(F.col("kind") != WORD).groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("kind") == GRAM, F.col("n")).otherwise(0)).alias("trained"))
    below = min(TOP + 1, depth)  # length of the contexts whose subtrees tasks hold
    rows = written(all_grams, "grams")
    bytes_ = rows.where("trained > 0").select(F.col("key").bitwiseAND(F.lit(0xFF)).alias("b")).distinct().toArrow()
    alphabet = Alphabet.of(bytes_.column("b").to_numpy())

    def climb(key: np.ndarray, n: np.ndarray) -> list[Level]:
        """The levels from ``below`` down to the longest contexts."""
        levels = [leaves(key.view(np.uint64)[n > 0], n[n > 0], alphabet)]
        for d in range(depth - 1, below - 1, -1):
            c = levels[0]
            levels.insert(0, parents(c.code, c.zeros, c.ones, c.below, d))
        return levels

    names = ["code", "zeros", "ones", "below"]

    def up(batches):
        for _, key, n in _whole(batches, ["tail", "key", "trained"]):
            level = climb(key, n)[0]
            yield pa.RecordBatch.from_arrays([pa.array(level.code.view(np.int64)), *(pa.array(x) for x in (level.zeros, level.ones, level.below))], names)

    columns = ["code", "zeros", "ones", "rest_zeros", "rest_ones", "weight", "below"]

    def join(batches):
        for _, code, zeros, ones, under in _whole(batches, ["tail", *names]):
            level = parents(code.view(np.uint64), zeros, ones, under, below - 1)
            yield pa.RecordBatch.from_arrays([pa.array(level.code.view(np.int64)), *(pa.array(getattr(level, x)) for x in columns[1:])], columns)

    middle = _subtrees(rows, "key", 8, below).select("tail", "key", "trained").mapInArrow(up, "code long, zeros double, ones double, below double")
    middle = _subtrees(middle, "code", 8, below - 1).mapInArrow(join, "code long, " + ", ".join(f"{x} double" for x in columns[1:]))
    got = middle.toArrow()  # the alphabet bounds it
    got = [got.column(x).to_numpy() for x in columns]
    order = np.argsort(got[0])
    levels = [Level(got[0][order].view(np.uint64), *(x[order] for x in got[1:]))]
    for d in range(below - 2, -1, -1):
        c = levels[0]
        levels.insert(0, parents(c.code, c.zeros, c.ones, c.below, d))
    top = []
    for d, level in enumerate(levels):
        top.append(mixed(level, top[-1] if top else None, d))
    shared = spark.sparkContext.broadcast(top)

    def down(batches):
        for _, key, n, trained in _whole(batches, ["tail", "key", "n", "trained"]):
            levels = list(shared.value)
            for level in climb(key, trained):
                levels.append(mixed(level, levels[-1], len(levels)))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(gram_log10(key.view(np.uint64), levels, alphabet))], ["key", "n", "score"])

    return _subtrees(rows, "key", 8, below).select("tail", "key", "n", "trained").mapInArrow(down, "key long, n long, score double")


def score(docs: DataFrame, depth: int = DEPTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts, base score and tree score of every document, and the code length in bits per byte."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    counts = written(corpus_counts(rows, depth), "corpus_counts")
    scored = written(gram_scores(counts, depth), "gram_scores")
    least = max(1, (scored.agg(F.sum("n")).first()[0] or 0) / COMMON_GRAMS)
    hot = scored.where(F.col("n") >= least).select("key", "score").toArrow()  # at most COMMON_GRAMS
    gram_keys, gram_score = hot.column("key").to_numpy().view(np.uint64), hot.column("score").to_numpy()
    order = np.argsort(gram_keys)
    hot = spark.sparkContext.broadcast((gram_keys[order], gram_score[order].astype(np.float32)))
    words = counts.where(F.col("kind") == WORD).select(F.col("key").alias("word"), F.col("n").alias("c"))
    tokens, types = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    common = words.where(F.col("c") >= max(1, tokens / COMMON)).toArrow()  # at most COMMON words
    known, often = common.column("word").to_numpy().view(np.uint64), common.column("c").to_numpy()
    order = np.argsort(known)
    known = spark.sparkContext.broadcast((known[order], often[order].astype(np.float64)))

    def run(batches):
        keys, c_of = known.value
        for b in batches:
            for c in T.chunks(b.column("text")):
                n_docs = c.hi - c.lo
                w = T.hash_words(c.data, c.offsets, lower=True)
                pair = np.concatenate([w.hash, np.full(n_docs, END_WORD)])
                doc = np.concatenate([w.doc, np.arange(n_docs)])
                spot = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
                hit = keys[spot] == pair if len(keys) else np.zeros(len(pair), bool)
                base = np.bincount(doc[hit], weights=np.log10(c_of[spot[hit]] + 1.0), minlength=n_docs) if hit.any() else np.zeros(n_docs)
                rare = np.flatnonzero(~hit)
                rare = rare[np.argsort(doc[rare], kind="stable")]
                gram, of = grams(c.data, c.offsets, depth)
                gram, number = np.unique(gram, return_inverse=True)
                spot, known_gram = _at(hot.value[0], gram)
                each = np.zeros(len(gram))
                each[known_gram] = hot.value[1][spot[known_gram]]
                fit = np.bincount(of, weights=each[number], minlength=n_docs)
                far = ~known_gram[number]
                pairs, times = np.unique(of[far] * len(gram) + number[far], return_counts=True)
                n_far = np.bincount(pairs // max(1, len(gram)), minlength=n_docs)
                far = [T.list_array(pa.array(x), n_far) for x in (gram[pairs % max(1, len(gram))].view(np.int64), times)]
                own = [b.column(x).slice(c.lo, n_docs) for x in ("row", "doc_id", "held_out")]
                out = [pa.array(np.bincount(doc, minlength=n_docs)), pa.array(np.bincount(doc[hit], minlength=n_docs)), pa.array(base), pa.array(fit), pa.array(np.diff(c.offsets))]
                yield pa.RecordBatch.from_arrays([*own, *out, T.list_array(pa.array(pair[rare].view(np.int64)), np.bincount(doc[rare], minlength=n_docs)), *far], names)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_common", "base", "score", "n_bytes", "rare", "far", "times"]
    kind = dict(rows.dtypes)["doc_id"]
    made = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_common long, base double, score double, n_bytes long, rare array<long>, far array<long>, times array<long>"
    )
    made = written(made, "scores")
    rare = made.select("row", F.explode("rare").alias("word")).join(words, "word")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("rare_base"), F.count(F.lit(1)).alias("n_rare"))
    far = made.select("row", F.explode(F.arrays_zip("far", "times")).alias("x")).select("row", F.col("x.far").alias("key"), F.col("x.times").alias("times"))
    far = far.join(scored.where(F.col("n") < least).select("key", F.col("score").alias("one")), "key")
    far = far.groupBy("row").agg(F.sum(F.col("one") * F.col("times")).alias("far_score"))
    out = made.join(rare, "row", "left").join(far, "row", "left").withColumn("score", F.col("score") + F.coalesce("far_score", F.lit(0.0)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(tokens + types + 1))).alias("base_score"),
        "score", (-F.col("score") / float(np.log10(2)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
