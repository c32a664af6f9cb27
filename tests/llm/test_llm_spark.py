"""The operators on small tables with every odd case, and on the smallest given tables, held against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slotcast.llm import bitmaps, components, cotrain, ctw, decontam, jaccard, lengths, mixing, planes, quality, queries, sharding, templates
from slotcast.llm import textops as T
from slotcast.session import scratch_path

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = {65 + i: 97 + i for i in range(26)}
WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, lang string, source string, size long, hash string, _row string, n int, label double, score string, part string, word string"
BASE = "the quick brown fox jumps over the lazy dog and then runs back home to sleep until the next morning comes with rain"


def edge_docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(BASE.split()) + rng.choice(["", ".", "s"]) for _ in range(rng.randint(1, 60))), "en", f"s{i % 3}") for i in range(10, 30)]
    rows += [(1, None, "en", "s0"), (2, "", None, None), (3, " \n\t", "en", "é"), (None, BASE, "en", "s1"), (None, None, None, None)]
    rows += [(4, BASE, "en", "s0")] * 3 + [(5, BASE + " x", "en", "s0"), (6, BASE.upper(), "en", None), (4, "other text under the same key", "en", "s0")]
    rows += [(7, "word " * 40_000, "en", "s2"), (8, "%%% ### " * 30, "en", "s2"), (9, "日本語 テキスト", "ja", "s2")]
    return spark.createDataFrame([(*r, 0, "h", "r", 1, 0.5, "sc", "p", "w") for r in rows], SCHEMA)


def empty(df):
    return df.limit(0)


def sf_docs(spark):
    return queries.table(spark, SF, "documents")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# ---- sharding


def check_shards(rows, docs):
    assert len(rows) == len(docs)
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    want = sorted(((d["doc_id"] is None, d["doc_id"] or 0, len((d["text"] or "").encode()) + 8, zlib.crc32((d["text"] or "").encode())) for d in docs))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    assert len({(r["doc_id"], r["shard"], r["grown_shard"]) for r in rows}) == len({r["doc_id"] for r in rows})


def test_sharding(spark):
    docs = edge_docs(spark)
    rows = rows_of(sharding.shard_documents(docs, [1.0] * 5))
    check_shards(rows, rows_of(docs))
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    assert sharding.shard_documents(empty(docs), [1.0, 2.0]).count() == 0
    rows = rows_of(queries.op2_rendezvous_sharding(spark, SF))
    check_shards(rows, rows_of(sf_docs(spark)))
    assert {r["law"] for r in rows} == {"key"} and all(r["grown_shard"] in (r["shard"], 24) for r in rows)


def test_shards_follow_their_weights(spark):
    keys = spark.range(20_000)
    n = {r["s"]: r["n"] for r in keys.groupBy(sharding.shard_of(F.col("id"), [1.0, 1.0, 2.0]).alias("s")).agg(F.count("id").alias("n")).collect()}
    assert abs(n[2] - 10_000) < 400 and abs(n[0] - 5_000) < 300


def test_rendezvous_scores_by_hand(spark):
    xxhash = pytest.importorskip("xxhash")

    def shard(key, n):
        best = []
        for s in range(n):
            h = xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=42).intdigest()
            h = xxhash.xxh32(b"").intdigest() * 0 + spark_int_hash(s, h)
            best.append((-1.0 / math.log(((h >> 11) + 0.5) / (1 << 53)), -s))
        return -max(best)[1]

    def spark_int_hash(value, seed):
        return xxhash.xxh64(value.to_bytes(4, "little", signed=True), seed=seed).intdigest()

    got = spark.range(50).select("id", sharding.shard_of(F.col("id"), [1.0] * 7).alias("s")).collect()
    assert all(r["s"] == shard(r["id"], 7) for r in got)


# ---- mixing


def targets_by_hand(sizes):
    """Source sizes -> targets: share by weight, cap at three times, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left, free = total - sum(fixed.values()), [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in over}


def check_mix(rows, docs, loose):
    want = collections.Counter((d["doc_id"], len(WORD.findall(d["text"] or ""))) for d in docs)
    assert collections.Counter((r["doc_id"], r["size"]) for r in rows) == want
    sizes = collections.defaultdict(int)
    for d in docs:
        sizes[d["source"]] += len(WORD.findall(d["text"] or ""))
    target = targets_by_hand(sizes)
    for source, t in target.items():
        own = [r for r in rows if r["source"] == source]
        assert all(r["target"] == pytest.approx(t) and r["source_size"] == sizes[source] for r in own)
        assert abs(sum(r["taken"] for r in own) - t) <= loose(own)
    assert all(r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in rows)


def test_mixing(spark):
    docs = edge_docs(spark)
    rows = rows_of(mixing.mix(docs))
    check_mix(rows, rows_of(docs), lambda own: max([0, *(collections.Counter({}) or [sum(x["size"] for x in own if x["doc_id"] == r["doc_id"]) for r in own])]))
    assert mixing.mix(empty(docs)).count() == 0
    assert sorted(map(str, rows_of(mixing.mix(docs)))) == sorted(map(str, rows))
    both = mixing.mixed_documents(docs)
    assert both.columns == docs.columns
    took = collections.Counter()
    for r in rows:
        took[r["doc_id"]] += r["copies"]
    assert collections.Counter(r["doc_id"] for r in both.collect()) == collections.Counter({k: v for k, v in took.items() if v})
    sf = sf_docs(spark)
    check_mix(rows_of(mixing.mix(sf)), rows_of(sf), lambda own: 0.1 * own[0]["target"] + 30)  # ten documents a source


def test_mixing_without_words(spark):
    docs = edge_docs(spark).where("doc_id IN (1, 2, 3)")
    assert {(r["size"], r["target"], r["taken"]) for r in rows_of(mixing.mix(docs))} == {(0, 0.0, 0)}


# ---- token ids


def ids_by_hand(texts):
    got = Tokenizer.from_file(WORD_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [np.array([*e.ids, 1], "<u4") for e in got]


def check_ids(rows, docs):
    own = sorted(docs, key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0))
    ids = dict(zip(map(id, own), ids_by_hand([d["text"] for d in own]), strict=True))
    key = lambda i, n, c: (i is not None, i or 0, n, c)
    assert sorted(key(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(key(d["doc_id"], len(ids[id(d)]), zlib.crc32(ids[id(d)].tobytes())) for d in own)
    at = 0
    for r in sorted(rows, key=lambda r: (r["start"])):
        assert r["start"] == at
        at += r["n_tokens"]
    in_order = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert [i is not None for i in in_order] == sorted(i is not None for i in in_order)
    assert [i for i in in_order if i is not None] == sorted(i for i in in_order if i is not None)


def test_plane_files(spark, monkeypatch):
    docs = edge_docs(spark)
    check_ids(rows_of(planes.encode_documents(docs, scratch_path(spark, "ids"), WORD_BPE, parts=3, bits=True)), rows_of(docs))
    assert planes.encode_documents(empty(docs), scratch_path(spark, "ids"), WORD_BPE).count() == 0
    check_ids(rows_of(queries.op9_bit_plane_files(spark, SF)), rows_of(sf_docs(spark)))


# ---- lengths


def test_length_histogram(spark):
    for docs in (edge_docs(spark), sf_docs(spark)):
        raw = rows_of(docs)
        n = collections.defaultdict(list)
        for d, ids in zip(raw, ids_by_hand([d["text"] for d in raw]), strict=True):
            n[d["lang"]].append(len(ids))
        table = lengths.suffix_table(lengths.histogram(lengths.encoded_lengths(docs, WORD_BPE)))
        rows = rows_of(table)
        assert sorted((str(r["grp"]), r["length"], r["n_docs"]) for r in rows) == sorted((str(g), x, c) for g, v in n.items() for x, c in collections.Counter(v).items())
        for r in rows:
            v, at = n[r["grp"]], r["length"]
            assert r["docs_upto"] == sum(x <= at for x in v) and r["docs_longer"] == sum(x > at for x in v)
            assert r["truncated_tokens"] == sum(min(x, at) for x in v) and r["all_tokens"] == sum(v)
        for r in rows_of(lengths.at_limits(table, [0, 5, 64, 10**6])):
            v, at = n[r["grp"]], r["limit"]
            assert r["tokens_kept"] == sum(min(x, at) for x in v) and r["docs_cut"] == sum(x > at for x in v)
        for share in (0.5, 0.99):
            want = {g: sorted(v)[math.ceil(share * len(v)) - 1] for g, v in n.items()}
            assert {r["grp"]: r["length"] for r in rows_of(lengths.quantile(table, share))} == want
            assert {r["grp"]: r["length"] for r in rows_of(table.where(lengths.is_quantile(share)))} == want
    assert lengths.suffix_table(lengths.histogram(lengths.encoded_lengths(empty(docs), WORD_BPE))).count() == 0


# ---- quality rules


def test_quality_rules(spark):
    docs = edge_docs(spark)
    rows = rows_of(quality.quality_rules(docs, PIECE_BPE, WORD_BPE))
    assert len(rows) == docs.count()
    failed = {r["doc_id"] for r in rows if r["base_failed"]}
    assert {1, 2, 3, 7, 8, 9} <= failed and all(not r["kept"] for r in rows if r["base_failed"])
    assert quality.quality_rules(empty(docs), PIECE_BPE, WORD_BPE).count() == 0
    passing = quality.passing(docs, PIECE_BPE, WORD_BPE)
    assert passing.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in passing.collect()) == collections.Counter(r["doc_id"] for r in rows if r["kept"])


def test_quality_rules_keep_good_and_reject_junk(spark):
    rows = {r["doc_id"]: r for r in rows_of(queries.op3_tokeniser_fertility(spark, SF))}
    marks = [(rows[m["doc_id"]], m["quality"]) for m in rows_of(queries.table(spark, SF, "labels"))]
    good = [r for r, q in marks if q == 1 and not r["base_failed"]]
    junk = [r for r, q in marks if q == 0]
    assert sum(r["kept"] for r in good) >= 0.98 * len(good) and sum(r["kept"] for r in junk) <= 0.1 * len(junk)


def test_byte_fallback_band(spark):
    clean = [(i, BASE + f" {i} some more words of the same kind here", "en") for i in range(40)]
    odd = [(99, BASE + " " + " ".join(chr(0x1FAE0 + i) * 3 for i in range(16)), "en")]
    rows = rows_of(quality.quality_rules(spark.createDataFrame(clean + odd, "doc_id long, text string, lang string"), PIECE_BPE, WORD_BPE))
    assert {r["doc_id"] for r in rows if not r["kept"]} == {99}


def test_rare_languages_have_the_bands_of_their_script_or_of_all(spark):
    rng = random.Random(6)
    text = lambda i: " ".join(rng.sample(BASE.split(), 22) + [f"number {i} in the long row of plain sentences"])
    runs = " ".join("".join(rng.choice("#*$%&|<>!~^") for _ in range(6)) for _ in range(60))
    broken = " ".join("".join(chr(rng.randint(0xC0, 0x17F)) for _ in range(6)) for _ in range(60))
    docs = [(i, text(i), "en") for i in range(60)] + [(100, text(100), "xx"), (101, runs, "xx"), (102, broken, "yy"), (103, runs + " |", None)]
    rows = {r["doc_id"]: r for r in rows_of(quality.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string"), PIECE_BPE, WORD_BPE))}
    assert not any(r["base_failed"] for r in rows.values()) and len(rows) == len(docs)
    assert {i for i, r in rows.items() if not r["kept"]} == {101, 102, 103}


# ---- jaccard join


def links_by_hand(docs, percent=85, k=4):
    sets = []
    for d in docs:
        w = WORD.findall((d["text"] or "").translate(LOW))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), d["doc_id"]), d["doc_id"])
    key = lambda *x: tuple(map(str, x))
    return sorted(key(d["doc_id"], len(s), least.get(find(i)) if s else d["doc_id"]) for i, (d, s) in enumerate(zip(docs, sets, strict=True)))


def check_join(df, docs):
    assert sorted(tuple(map(str, (r["doc_id"], r["n_shingles"], r["component_id"]))) for r in df.collect()) == links_by_hand(docs)


def test_jaccard_join(spark):
    docs = edge_docs(spark)
    check_join(jaccard.jaccard_components(docs), rows_of(docs))
    assert jaccard.jaccard_components(empty(docs)).count() == 0
    sf = sf_docs(spark)
    check_join(queries.op6_jaccard_metric_join(spark, SF), rows_of(sf))


def near_copies(n, seed, words=60):
    """Chains of near-copies, and texts that share a passage without being near."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)]
    rows, shared = [], [rng.choice(pool) for _ in range(25)]
    for group in range(n // 20):
        base = [rng.choice(pool) for _ in range(words)]
        for _ in range(12):
            base = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                base[rng.randrange(words)] = rng.choice(pool)
            rows.append(" ".join(base))
        rows += [" ".join(shared + [rng.choice(pool) for _ in range(rng.randint(3, 40))]) for _ in range(8)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("leaf", [16, 2])
def test_jaccard_join_is_exact_with_and_without_recursion(spark, monkeypatch, leaf):
    """With tiny leaves and pivot counts the Voronoi recursion does the work."""
    monkeypatch.setattr(jaccard, "LEAF", leaf)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "GROWTH", 2)
    monkeypatch.setattr(jaccard, "COUNT_BITS", 15)  # a poor order of the pivots, so regions are larger
    docs = spark.createDataFrame(near_copies(100, leaf), "doc_id long, text string")
    check_join(jaccard.jaccard_components(docs), rows_of(docs))


def crowd(groups, copies, words, changes, seed=7):
    """Texts of some groups, all with one passage of words that stand nowhere else; copies with few changes, so that most don't link."""
    rng = random.Random(seed)
    mark = "rare passage that all of them share"
    rows = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(words)]
        for _ in range(copies):
            text = list(base)
            for i in rng.sample(range(words), rng.choice(changes)):
                text[i] = f"x{rng.random()}"
            rows.append(" ".join([mark, *text]))
    return list(enumerate(rows))


def test_jaccard_join_draws_pivots_by_default(spark):
    """Copies with two changes each of a text that isn't there: crowded regions without links, which take several rounds."""
    rows = crowd(2, 30, 140, [2]) + [(1000 + i, t) for i, t in crowd(2, 10, 70, [0, 1, 1, 2], 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trace = []
    check_join(jaccard.jaccard_components(docs, trace=trace), rows_of(docs))
    assert len(trace) > 2 and all(t["pivots"] >= t["regions"] for t in trace) and any(t["large"] for t in trace)


def test_voronoi_regions_keep_every_near_pair(spark):
    """Points of a line and a cluster: regions of the nearest pivots with boundary points; a cluster that would be copied to all stays whole."""
    rng = random.Random(1)
    at = {(1, i): i / 60 for i in range(60)} | {(2, 100 + i): 0.5 + rng.random() / 100 for i in range(20)}
    pivots = {1: [5, 20, 35, 50], 2: [100, 101, 102]}
    star = [(g, p, pivots[g].index(p), i) for (g, i) in at for p in pivots[g] if i not in pivots[g]]
    known = [(p, i, abs(at[g, p] - at[g, i])) for g, p, _, i in star]
    cells = jaccard.voronoi(spark.createDataFrame(star, "region long, a long, place_a long, b long"), spark.createDataFrame(known, "a long, b long, d double"), 0.02).collect()
    of = collections.defaultdict(dict)
    for c in cells:
        of[c.cell][c.set_id] = c.near
    assert {c for c in of if 100 < min(of[c])} == {2} and len(of[2]) == 17  # the whole cluster
    line = [c for c in of if min(of[c]) < 100]
    assert len(line) == 4 and max(len(of[c]) for c in line) < 20 and sum(len(of[c]) for c in line) > 56  # some stand in two
    rest = [i for g, i in at if g == 1 and i not in pivots[1]]
    for x in rest:
        for y in rest:
            if abs(at[1, x] - at[1, y]) <= 0.02:
                assert any(x in of[c] and y in of[c] and abs(of[c][x] - of[c][y]) <= 0.02 + 1e-9 for c in line)


def test_jaccard_pairs_grow_with_a_group_of_copies(spark):
    """Copies with up to two changes are one component by a pivot or two, not by all their pairs."""
    docs, trace = spark.createDataFrame(crowd(1, 400, 140, [0, 1, 1, 2, 3]), "doc_id long, text string"), []
    jaccard.jaccard_components(docs, trace=trace)
    assert sum(t["pairs"] for t in trace) < 1200  # of 79,800


def test_one_of_each(spark):
    docs = edge_docs(spark)
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    rows = rows_of(left)
    assert sum(r["text"] in (BASE, BASE + " x", BASE.upper()) for r in rows) == 1
    assert {1, 2, 3} <= {r["doc_id"] for r in rows} and [r["doc_id"] for r in rows if r["text"] == BASE] == [4]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (5, 6), (6, 5), (7, 7), *[(100 + i, 101 + i) for i in range(30)]]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {2: 1, 3: 1, 9: 1, 6: 5} | {101 + i: 100 for i in range(30)}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bitmap(spark):
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 5000)
    bits = bitmaps.bitmap(spark.createDataFrame([(int(x),) for x in h], "hash long"), "hash", len(h))
    assert bitmaps.in_bitmap(bits, h.view(np.uint64)).all()
    assert bitmaps.in_bitmap(bits, rng.integers(0, 1 << 63, 5000).view(np.uint64)).mean() < 0.01
    assert not bitmaps.bitmap(spark.createDataFrame([], "hash long"), "hash", 0).any()


# ---- decontamination


def test_decontamination(spark):
    rng = random.Random(1)
    words = [f"t{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([40, 9, 20, 7, 120])] + [(90, None), (91, ""), (92, "dup dup")]
    items.append((95, items[0][1].upper() + "!"))
    bench = spark.createDataFrame([(*x, "h") for x in items], "item_id long, text string, hash string")
    text = dict(items)
    swapped = text[0].split()
    swapped[5::6] = ["zz"] * len(swapped[5::6])
    docs = [
        (1, "before " + text[0].replace(" ", ", ") + " after"), (2, "x " + " ".join(swapped) + " y"), (3, text[1]), (4, text[3]),
        (5, " ".join(text[4].split()[30:50])), (6, " ".join(text[4].split()[30:38])), (7, None), (8, ""), (None, text[2]),
        (9, " ".join(rng.choice(words) for _ in range(4000))), (10, "pre " + text[2] + " mid " + text[0]), (10, "clean"), (11, text[2]), (11, text[2]),
    ]
    table = spark.createDataFrame([(*d, "h", "w") for d in docs], "doc_id long, text string, hash string, words string")
    rows = {r["doc_id"]: r for r in rows_of(decontam.contaminated(table, bench))}
    assert set(rows) == {1, 2, 3, 4, 5, None, 10, 11}
    assert rows[1]["best_item"] == 0 and rows[1]["n_match"] == 40 and rows[10]["n_items"] == 2
    left = decontam.decontaminate(table, bench)
    assert left.columns == table.columns and sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [6, 7, 8, 9, 10]))
    assert decontam.contaminated(empty(table), bench).count() == 0
    assert decontam.contaminated(table, empty(bench)).count() == 0


def test_short_and_very_long_items(spark):
    """Items too short for seeds stand whole; those of two words are whole texts; one item of 20,000 words doesn't widen the others' segments."""
    rng = random.Random(6)
    words = [f"t{i}" for i in range(4000)]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    usual = " ".join(rng.choice(words) for _ in range(30))
    bench = spark.createDataFrame([(1, "What is the capital city of France?"), (2, "Yes."), (3, "three word item"), (4, long), (5, usual), (6, "no no")], "item_id long, text string")
    noise = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = ["well: what is the capital city of france, " + noise(50), "what is the capital town of france", "yes", "yes yes", noise(10) + " no no " + noise(5), "a Three-word ITEM b", "No, no!",
             noise(300) + " " + usual + " " + noise(9000), noise(40) + " " + " ".join(long.split()[500:700]) + " " + noise(40), long]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: (r["best_item"], r["n_match"], r["n_words"]) for r in rows_of(decontam.contaminated(docs, bench))}
    assert rows == {0: (1, 7, 7), 2: (2, 1, 1), 5: (3, 3, 3), 6: (6, 2, 2), 7: (5, 30, 30), 8: (4, 200, 250), 9: (4, 20_000, 20_000)}
    items = decontam.benchmark_items(bench)
    seeds = decontam.item_seeds(items)
    assert {r.reach for r in seeds.select("reach").distinct().collect()} == {0, 64, 64 * 4**5}
    bits = {r: bitmaps.bitmap(seeds.where(F.col("reach") == r), "hash", 100_000) for r in (64, 64 * 4**5)}
    sizes = {(r.doc_id, r.reach): len(r.words) // 8 for r in decontam.hit_segments(docs, bits, {}).collect()}
    assert sizes[7, 64] <= 30 + 2 * 64 and (7, 64 * 4**5) not in sizes


def test_decontamination_of_unspaced_scripts(spark):
    passages = {1: "春眠不覚暁処処聞啼鳥。夜来風雨声、花落知多少。", 2: "ภาษาไทยเป็นภาษาที่ไม่เว้นวรรคระหว่างคำ", 3: "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"}
    bench = spark.createDataFrame(list(passages.items()), "item_id long, text string")
    docs = [(1, "前の文です" + passages[1] + "後の文です"), (2, "ก่อน" + passages[2]), (3, passages[1].replace("風", "雪")), (4, "全く別の文章で、何も写していません。"), (5, "a " + passages[3].replace("thirteen", "x") + " b")]
    rows = {r["doc_id"]: r["best_item"] for r in rows_of(decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench))}
    assert rows == {1: 1, 2: 2, 3: 1, 5: 3}


def test_decontamination_finds_every_planted_passage(spark):
    plain = lambda t: " " + " ".join(re.findall(r"\w+", (t or "").lower())) + " "
    items = [plain(b["text"]) for b in rows_of(queries.table(spark, SF, "benchmark"))]
    want = {d["doc_id"] for d in rows_of(sf_docs(spark)) if any(i in plain(d["text"]) for i in items)}
    assert {r["doc_id"] for r in rows_of(queries.op1_spaced_seed_decontamination(spark, SF))} == want


# ---- classifier


def test_cotraining(spark):
    docs = sf_docs(spark)
    labels = queries.table(spark, SF, "labels")
    marks = {r["doc_id"]: r["quality"] for r in rows_of(labels)}
    train = labels.where("doc_id % 3 <> 0")  # the rest is held out
    rows = {r["doc_id"]: r for r in rows_of(cotrain.classify(docs, train))}
    held = [(rows[i]["kept"], q) for i, q in marks.items() if i % 3 == 0]
    assert sum(k == bool(q) for k, q in held) >= 0.9 * len(held)
    assert len(rows) == docs.count()


def test_cotraining_edges(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r["score"], r["kept"]) for r in rows_of(cotrain.classify(docs, none))} == {(0.5, True)}
    one = spark.createDataFrame([(i, 1) for i in range(10, 20)] + [(4, None), (None, 0)], "doc_id long, quality int")
    assert {r["score"] for r in rows_of(cotrain.classify(docs, one))} == {1.0}
    both = spark.createDataFrame([(i, 1) for i in range(10, 30)] + [(i, 0) for i in (1, 2, 3, 7, 8, 9, 9)] + [(9, 0)], "doc_id long, quality int")
    rows = rows_of(cotrain.classify(docs, both))
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert cotrain.classify(empty(docs), both).count() == 0


def test_views_and_margins_by_hand(spark):
    """Token counts and page numbers of odd texts, and scores that equal the fitted models' own on the features."""
    docs = edge_docs(spark)
    rows = cotrain.views(docs).orderBy("doc_id", "text").collect()
    token = re.compile(r"(?:[A-Za-z]|[^\x00-\x7f])+|[^A-Za-z\x80-\U0010ffff\x20\x09-\x0d]+")
    made = cotrain.features(cotrain.views(docs).withColumn("doc_id", F.struct("doc_id", "text"))).collect()
    of = {(r.doc_id.doc_id, r.doc_id.text): r for r in made}
    for r in rows:
        counts = sorted(collections.Counter(token.findall(r.text or "")).values())
        v = of[r.doc_id, r.text].text_features
        norm = math.sqrt(sum(c * c for c in counts))
        assert np.allclose(sorted(v.values), [c / norm for c in counts])
        text, meta = r.text or "", of[r.doc_id, r.text].meta_features
        lines = text.count("\n") + 1
        want = [math.log1p(len(text)), math.log(lines), math.log1p(len(text) / lines)]
        want += [sum(f(x) for x in text) / max(1, len(text)) for f in (lambda x: "A" <= x <= "Z", lambda x: "0" <= x <= "9", lambda x: x in "#*$%&|<>!{}[]=~^_+@", lambda x: x in " \t\n\v\f\r")]
        assert np.allclose(meta.toArray()[: cotrain.NUMBERS], want) and meta.toArray()[cotrain.NUMBERS :].sum() == 2
    learn = cotrain.features(cotrain.views(docs)).withColumn("label", (F.xxhash64("meta_features") % 2 == 0).cast("double"))
    models = {v: cotrain._fit(learn, v, "label") for v in ("text", "meta")}
    got = sorted((str(r.doc_id), round(r.text, 9), round(r.meta, 9)) for r in cotrain.margins(cotrain.views(docs), models).collect())
    own = learn
    for m in models.values():
        own = m.transform(own)
    assert got == sorted((str(r.doc_id), round(r.text_raw[1], 9), round(r.meta_raw[1], 9)) for r in own.collect())


def test_a_round_teaches_each_view_what_the_other_is_sure_of(spark, monkeypatch):
    """The confident labels of one round, drawn and passed on, against a plain evaluation of the first models."""
    tables = {}
    keep = cotrain.written
    monkeypatch.setattr(cotrain, "written", lambda df, name: tables.setdefault(name, []).append(keep(df, name)) or tables[name][-1])
    monkeypatch.setattr(cotrain, "ROUNDS", 1)
    docs, labels = sf_docs(spark), queries.table(spark, SF, "labels")
    cotrain.fit(docs, labels)
    known = {r.doc_id: r.label for r in tables["cotrain_labelled"][0].collect()}
    teach = tables["cotrain_labelled"][0].where(~(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(cotrain.CALIBRATE)) == 0))
    models = {v: cotrain._fit(teach, v, "label") for v in ("text", "meta")}
    score = {r.doc_id: {"text": r.text, "meta": r.meta} for r in cotrain.margins(cotrain.views(docs), models).collect() if r.doc_id not in known}
    edge = math.log(cotrain.CONFIDENT / (1 - cotrain.CONFIDENT))
    sure = {v: {i: float(m[v] > 0) for i, m in score.items() if abs(m[v]) >= edge} for v in models}
    seen = tables["cotrain_sure"][0].collect()
    for v in models:
        assert {r.doc_id: r[v] for r in seen if r[v] is not None} == sure[v]
    # fewer than POOL are sure, so all are drawn; the other view learns from them beside the labelled ones
    taught = [{r.doc_id: r.label for r in t.collect()} for t in tables["cotrain_taught"]]
    base = {r.doc_id: r.label for r in teach.collect()}
    assert taught == [base | sure["text"], base | sure["meta"]] and sure["text"]


def test_cotraining_takes_confident_rows_of_rare_sources_from_all(spark, monkeypatch):
    monkeypatch.setattr(cotrain, "POOL", 40)
    rows = [(i, 1.0, "en", "big") for i in range(4000)] + [(10_000 + i, 0.0, "fi", "rare") for i in range(10)]
    got = rows_of(cotrain.taught(spark.createDataFrame(rows, "doc_id long, label double, lang string, source string")))
    assert sum(r["doc_id"] >= 10_000 for r in got) == 10 and 5 <= len(got) - 10 <= 45


# ---- html


def test_site_templates(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"https://user@Big.example:80/p{i}", f"<body><div>Our site line</div><p>own words {i}</p><div><p>Read more here</p></div></body>"))
        rows.append((100 + i, "http://small.example/", "<body><div>Our site line</div><p>same page</p></body>"))
    rows += [(50, None, None), (51, "http://x/", ""), (52, "nonsense", "<article><p>kept</p></article>"), (0, rows[0][1], rows[0][2])]
    rows.append((53, None, "<p>" + "long " * 50_000 + "</p>"))
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], "page_id long, url string, html string, host string, text string")
    out = rows_of(templates.extract(pages))
    assert len(out) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in out)
    text = {r["page_id"]: r["text"] for r in out}
    assert all(text[i] == f"own words {i}" for i in range(12))
    assert text[100] == "Our site line\nsame page"  # copies of one page make no template
    assert text[50] == text[51] == "" and text[52] == "kept" and len(text[53]) == 5 * 50_000 - 1
    assert templates.extract(empty(pages)).count() == 0


def test_copies_of_an_article_under_other_menus_are_no_template(spark):
    body = "".join(f"<p>paragraph {j} of one long article that is reprinted</p>" for j in range(6))
    forms = {"a": "<article><h1>T{0}</h1><div>%s</div></article>", "b": "<div>menu {0}</div><div>%s</div>", "c": "<h1>title {0}</h1><div>menu {0}</div>%s<div>Site line</div>", "d": "<main>%s</main><div>x{0}</div>"}
    rows = [(i, f"http://{k}.example/{i}", f"<body>{(f % body).format(i)}</body>") for k, f in forms.items() for i in range(8)]
    for r in rows_of(templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))):
        assert all(f"paragraph {j} of" in r["text"] for j in range(6)), r


def test_templates_of_a_section_of_a_large_host_are_removed(spark):
    rows = [(i, f"http://large.example/{i}", f"<body>{'<div>Section line</div>' if i < 6 else ''}<p>these are the own words of page {i}</p></body>") for i in range(1500)]
    text = {r["page_id"]: r["text"] for r in rows_of(templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert text == {i: f"these are the own words of page {i}" for i in range(1500)}


def test_recurrence_decides_on_a_mixed_corpus(spark, monkeypatch):
    """Menus, bars and notices under no telling name, some of them in the article, which only their recurrence tells."""
    rng = random.Random(9)
    rows, want = [], {}
    for h in range(3):
        bars = [f"<div class='x{k}'><span>bar {h} {k}</span><ul><li>one {k}</li><li>two</li></ul></div>" for k in range(6)]
        for i in range(3 if h == 2 else 40):
            own = [f"paragraph {h} {i} {j} " + " ".join(rng.choices(BASE.split(), k=30)) for j in range(4)]
            shared = rng.sample(bars, 4)
            inside = "".join(f"<p>{p}</p>" + (shared[j] if j < 2 else "") for j, p in enumerate(own))
            menu = f"<div class='nav'>menu of {h}</div><nav>links of {h}</nav>"
            rows.append((1000 * h + i, f"http://host{h}.example/{i}", f"<body>{menu}{shared[2]}<article><h1>title {h} {i}</h1>{inside}</article>{shared[3]}</body>"))
            want[1000 * h + i] = [f"title {h} {i}", *own]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in rows_of(templates.extract(pages))}
    for i, lines in want.items():
        got = text[i].split("\n")
        assert got == lines if i < 2000 else [x for x in got if x in lines] == lines and len(got) > len(lines)  # the last host is small
    monkeypatch.setattr(templates, "FURNITURE_NAMES", frozenset())
    monkeypatch.setattr(templates, "FURNITURE_TAGS", frozenset())
    bare = {i: templates.Page(h).main_text(set()) for i, _, h in rows}
    assert sum(bare[i] != text[i] for i in bare if i < 2000) == 80  # the recurrence rule acts on every page of the large hosts


def test_a_page_under_many_hosts_is_joined_with_its_own_hosts_cuts(spark, monkeypatch):
    shared = "<body><div>Site line</div><p>the same words on every mirror of it</p></body>"
    rows = [(100 * h, f"http://u:p@M{h}.example:8080/", shared) for h in range(20)]
    rows += [(100 * h + i, f"//m{h}.example/{i}?q", f"<body><div>Site line</div><p>some words of page {i} on host {h}</p></body>") for h in range(10) for i in range(1, 6)]
    tables = {}
    keep = templates.written
    monkeypatch.setattr(templates, "written", lambda df, name: tables.setdefault(name, keep(df, name)))
    text = {r["page_id"]: r["text"] for r in rows_of(templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    assert all(("Site line" in x) == (i >= 1000) for i, x in text.items()) and len(text) == len(rows)
    cuts = rows_of(tables["template_cuts"])
    assert {"host", "page_hash", "cut"} == set(cuts[0]) and len({(c["host"], c["page_hash"]) for c in cuts}) == len(cuts) and all(len(c["cut"]) == 1 for c in cuts)
    hosts = ["http://a.B/x", "https://u@c:9/", "//D?x", "nonsense", None, "http:///x", "HTTP://e#f", "x http://a/"]
    got = spark.createDataFrame([(x,) for x in hosts], "url string").select(templates._host(F.col("url")).alias("h"))
    assert [r["h"] for r in got.collect()] == ["a.b", "c", "d", "", "", "", "e", ""]
    plan = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, .*host.*page_hash", plan)


def test_extraction_of_given_pages(spark):
    """The given pages have one article each: its paragraphs and heading, nothing else."""
    import html as h

    raw = {r["page_id"]: r["html"] for r in rows_of(queries.table(spark, SF, "pages"))}
    for r in rows_of(queries.op5_site_template_removal(spark, SF)):
        article = re.search(r"<article>(.*?)(?:</article>|<footer>)", raw[r["page_id"]], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(h.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b)


# ---- language-model scores


def check_scores(rows, docs):
    tokens = [[*WORD.findall((d["text"] or "").translate(LOW)), None] for d in docs]
    out = [zlib.crc32(("" if d["doc_id"] is None else str(d["doc_id"])).encode()) % 7 == 2 for d in docs]
    count = collections.Counter(t for x, o in zip(tokens, out, strict=True) if not o for t in x)
    total, types = sum(count.values()), len(count)
    want = sorted((str(d["doc_id"]), o, len(x), sum(count[t] > 0 for t in x), total, round(sum(math.log10((count[t] + 1) / (total + types + 1)) for t in x), 6)) for d, x, o in zip(docs, tokens, out, strict=True))
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert len(got) == len(want) and all(a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-4) for a, b in zip(got, want, strict=True))
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_language_model_scores(spark, monkeypatch):
    docs = edge_docs(spark)
    check_scores(rows_of(ctw.score(docs)), rows_of(docs))
    assert ctw.score(empty(docs)).count() == 0
    monkeypatch.setattr(ctw, "COMMON", 50)  # most words take the way of the rare ones
    check_scores(rows_of(queries.op7_context_tree_weighting(spark, SF)), rows_of(sf_docs(spark)))


def test_contexts_are_kept_by_a_fixed_count_whatever_the_corpus(spark, monkeypatch):
    """The tree has every context seen twice, though it holds less than 1 / 131,072 of the bytes; scores are those of one tree in memory."""
    filler = [(7 * i, "ab" * 100_000) for i in range(3)]
    rare = [(1000 + i, f"zq{chr(107 + i % 7)}xv") for i in range(14)]
    docs = spark.createDataFrame(filler + rare + [(None, None)], "doc_id long, text string")
    texts = [t or "" for _, t in filler + rare + [(None, None)]]
    out = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in filler + rare + [(None, None)]]
    cut = lambda x: next(iter(T.chunks(pa.array(x, pa.string()), 1 << 30)))
    c = cut([t for t, o in zip(texts, out, strict=True) if not o])
    keys = ctw.grams(c.data, c.offsets, ctw.DEPTH)[0]
    tables = []
    for d in range(ctw.DEPTH + 1):
        u, n = np.unique(keys & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True)
        contexts, of = np.unique(u >> np.uint64(8), return_inverse=True)
        keep = (np.bincount(of, weights=n) >= 2)[of] | (d == 0)
        tables.append(((u >> np.uint64(8))[keep], (u & np.uint64(255))[keep], n[keep]))
    tree = ctw.build_tree(tables)
    c = cut(texts)
    key, doc = ctw.grams(c.data, c.offsets, ctw.DEPTH)
    want = np.bincount(doc, weights=ctw.score_bytes(tree, key), minlength=len(texts))
    for common in (1 << 22, 8):
        monkeypatch.setattr(ctw, "COMMON_GRAMS", common)
        got = {r["doc_id"]: r["score"] for r in rows_of(ctw.score(docs))}
        assert [got[d] for d, _ in filler + rare + [(None, None)]] == pytest.approx(want.tolist(), rel=1e-4, abs=1e-3)


# ---- pipeline


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = queries.table(spark, SF, "documents")
    columns, sets = docs.columns, {}
    for name, stage in P.STAGES:
        path = scratch_path(spark, "stage")
        out = stage(spark, docs, SF)
        assert out.columns == columns or name == "token_ids"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        sets[name] = rows_of(docs)
        if name == "jaccard_join":
            groups = collections.Counter(x[2] for x in links_by_hand(rows_of(before)))
            assert len(sets[name]) == len(groups)
        if name == "decontamination":
            assert {r["doc_id"] for r in sets[name]} == {r["doc_id"] for r in rows_of(before)} - {r["doc_id"] for r in rows_of(decontam.contaminated(before, queries.table(spark, SF, "benchmark")))}
    check_ids(sets["token_ids"], sets["mixing"])
    assert len({r["doc_id"] for r in sets["quality_rules"]}) > 0.7 * queries.table(spark, SF, "documents").count()


def test_pipeline_stages_on_edge_cases(spark):
    import corpus_pipeline as P

    for name, stage in P.STAGES:
        docs = edge_docs(spark)
        path = scratch_path(spark, "edge")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        assert stage(spark, docs, SF).count() > 0, name
        assert stage(spark, empty(docs), SF).count() == 0, name


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_oracle_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.execute(queries.ORACLE[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert got[columns].sort_values(columns).to_numpy().tolist() == want[columns].sort_values(columns).to_numpy().tolist()


def test_every_query_is_registered():
    import __spark_entry__ as E

    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and set(queries.ORACLE) <= set(E.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))


def test_plane_files_are_written_from_small_batches(spark, monkeypatch):
    """Whole texts reach the writing tasks in batches of store.BATCH_ROWS, and the session's own setting stands again."""
    from slotcast.llm import store

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"file": [""], "n_docs": [len(b)], "n_ids": [0], "n_bytes": [0]})

    before = spark.conf.get(store.BATCH)
    folder = scratch_path(spark, "ids")
    monkeypatch.setattr(planes, "write_files", lambda docs, *_, **__: docs.mapInArrow(sizes, planes.MANIFEST))
    planes.encode_documents(spark.range(0, 3 * store.BATCH_ROWS, 1, 1), folder, WORD_BPE)
    rows = spark.read.parquet(f"{folder}/_manifest").collect()
    assert max(r["n_docs"] for r in rows) <= store.BATCH_ROWS and sum(r["n_docs"] for r in rows) == 3 * store.BATCH_ROWS
    assert spark.conf.get(store.BATCH) == before
