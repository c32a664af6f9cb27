"""Periodic runs against brute force: every stretch of every text, by definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slotcast.llm import queries, runs
from slotcast.llm import textops as T

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def runs_by_hand(words, min_length=6, exponent=4):
    """By definition: for each period the maximal stretches of equal words, kept if no smaller period has the same stretch."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(min_length, exponent * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n_, q) for (s, n_), q in out.items())


def collapsed_by_hand(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_in(texts, *rule):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return runs.runs_of(T.hash_words(np.frombuffer(b"".join(data), np.uint8), offsets, lower=False), *rule)


def periodic(rng, alphabet, n):
    """Words with runs, runs within runs, and near runs."""
    words = []
    while len(words) < n:
        block = [rng.choice(alphabet) for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.3:
            block = block * rng.randint(2, 5) + [rng.choice(alphabet)]
        words += (block * rng.randint(1, 9))[: rng.randint(1, 60)]
    return words


@pytest.mark.parametrize("rule", [(6, 4), (2, 2), (9, 3), (40, 2)])
def test_runs_against_every_stretch(rule):
    rng = random.Random(11)
    texts = [periodic(rng, "ab" if k % 3 else "abcdef", rng.randint(0, 140)) for k in range(150)]
    texts += [["a"] * n for n in range(9)] + [["a", "b"] * 9, ["a"] * 300, [], ["x", *["y"] * 40, "x"]]
    found = found_in([" ".join(t) for t in texts], *rule)
    for d, words in enumerate(texts):
        assert found.get(d, []) == runs_by_hand(words, *rule), words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=1).map(lambda x: x or "c"), max_size=60))
def test_runs_of_any_words(words):
    assert found_in([" ".join(words)]).get(0, []) == runs_by_hand(words)


def test_ranks_are_lexicographic():
    keys = np.array([3, 1, 3, 1, 3, 2, 3, 1], np.uint64)
    end = np.array([5] * 5 + [8] * 3)
    levels = runs.prefix_ranks(keys, end)
    suffixes = [tuple(keys[i : end[i]].tolist()) for i in range(8)]
    # equal suffixes of two texts are told apart by their keys in the operator; here (3, 1) stands once in each
    assert [suffixes[i] for i in np.argsort(levels[1], kind="stable")] == sorted(suffixes, key=lambda s: s[:2])


def test_long_runs_stay_linear():
    """A word 100,000 times, and a period of 1,000: each interval searches lists of other left words only."""
    texts = [["a"] * 100_000, [f"w{i}" for i in range(1000)] * 40]
    assert found_in([" ".join(t) for t in texts]) == {0: [(0, 100_000, 1)], 1: [(0, 40_000, 1000)]}


def test_find_runs_on_edge_cases(spark):
    long = "x " * 20_000
    rows = [(1, "a b " * 6 + "c"), (1, "a b " * 6 + "c"), (None, "z " * 6), (2, None), (3, ""), (4, " \n\t"), (5, long), (6, "é x " * 8), (7, "A a " * 3)]
    docs = spark.createDataFrame([(*r, "r", 1, "k") for r in rows], "doc_id long, text string, runs string, start int, key string")
    out = runs.find_runs(docs)
    assert out.columns == ["doc_id", "runs", "collapsed"] and dict(out.dtypes)["doc_id"] == "bigint"
    got = sorted((repr(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    want = [(1, [(0, 12, 2)], "a b c")] * 2 + [(None, [(0, 6, 1)], "z"), (2, [], ""), (3, [], ""), (4, [], ""), (5, [(0, 20_000, 1)], "x"), (6, [(0, 8, 1)], "é x"), (7, [], "A a A a A a")]
    assert got == sorted((repr(k), x, c) for k, x, c in want)
    assert runs.find_runs(docs.limit(0)).count() == 0
    by_name = runs.find_runs(docs, key="key", text="runs")
    assert by_name.columns == ["key", "runs", "collapsed"] and {r.collapsed for r in by_name.collect()} == {"r"}


def planted_by_hand(doc_id, text):
    words, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_against_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op11_maximal_pair_runs(spark, SF).collect()}
    docs = queries.table(spark, SF, "documents").collect()
    assert len(rows) == len(docs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    n = 0
    for d in docs:
        words = planted_by_hand(d.doc_id, d.text)
        found = runs_by_hand(words)
        n += len(found)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        want = (d.doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(collapsed_by_hand(words, found)))
        assert tuple(rows[d.doc_id]) == want
    assert n > 5
