"""Parts of the operators that need no Spark, held against plain Python."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from slotcast.llm import ctw, decontam, jaccard, planes, quality, templates
from slotcast.llm import textops as T
from slotcast.llm.tokens import WordEncoder

WORD = re.compile("[^\x20\x09-\x0d]+")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "   \n\t ", "one", "İstanbul ſ ß ẞ ﬁ", "áé 日本語 テスト", "it's DON'T 've 42km <|endoftext|>x", "À×÷ÿŸ œŒ", "x y z\x1cq\x85r", "z" * 5000, "#*$%&|<>!! <a|b> <| |>", "\x00\x7f"]


def chunk(texts):
    (c,) = T.chunks(pa.array(texts, pa.string()), 1 << 30)
    return c


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(WORD_BPE)


def reference_ids(texts):
    return [e.ids for e in Tokenizer.from_file(WORD_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_gives_the_ids_of_whole_texts(encoder):
    texts = ODD + ["Éa, ÇA va? 12ab", "plain words only. MORE!! words"]
    c = chunk(texts)
    ids, n = encoder.encode(c.data, c.offsets)
    want = reference_ids(texts)
    assert n.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=5))
def test_encoder_on_any_text(texts):
    e = _ENCODER[0]
    c = chunk(texts)
    ids, _ = e.encode(c.data, c.offsets)
    assert ids.tolist() == [i for x in reference_ids(texts) for i in x]


_ENCODER = [WordEncoder(WORD_BPE, cache_words=20)]  # so small that it is emptied on the way


def test_words_and_windows():
    texts = ["A b  c\nd", None, "", "x y", "a B c d"]
    c = chunk(texts)
    w = T.hash_words(c.data, c.offsets)
    assert np.diff(w.first).tolist() == [4, 0, 0, 2, 4]
    assert w.hash[:4].tolist() == w.hash[6:].tolist()
    h, doc = T.windows(w, 4)
    assert doc.tolist() == [0, 4] and h[0] == h[1]
    assert len(T.windows(w, 5)[0]) == 0


def base_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    marked = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(text.count(x) for x in "#*$%&|<>"), dup, len(marked)]


def test_base_counts():
    rng = random.Random(5)
    texts = ODD + ["a b\na b\n \n a b\na b\r\n\n"]
    for _ in range(30):
        texts.append(rng.choice(["", " "]).join(rng.choice(["a ", "b ", "c\n", "%% ", "é "]) for _ in range(rng.randint(0, 60))))
    c = chunk(texts)
    got = quality.base_counts(c, T.hash_words(c.data, c.offsets, lower=False))
    assert np.stack([got[x] for x in quality.BASE], axis=1).tolist() == [base_by_hand(t) for t in texts]


def test_fertility_counts_byte_fallback_and_entropy(encoder):
    of = quality.Pieces(PIECE_BPE)
    c = chunk(["plain plain plain plain", "\U0001f9ff\U0001fae0", ""])
    out = quality.fertility(c, T.hash_words(c.data, c.offsets, lower=False), of, encoder)
    assert out["n_fallback"][0] == 0 and out["n_fallback"][1] > 0 and out["n_pieces"][2] == 0
    n = out["n_pieces"][0]
    per = n // 4  # the same pieces four times
    ids = of.processor.encode("plain")
    pairs = sum(c * (c - 1) for c in (4 * ids.count(i) for i in set(ids)))
    assert per == len(ids) and out["piece_entropy"][0] == pytest.approx(-np.log2(pairs / (n * (n - 1))))


def test_script_of_most_letters():
    texts = ["plain é text", "日本 abc", "漢字漢字 ab", "ひらがな 漢字", "12 %% 🧿", "", None, "Привет x", "ภาษาไทย", "한국어 z", "Ωμέγα a", "𠀋𠀋 a"]
    assert quality.scripts(chunk(texts)).tolist() == ["latin", "latin", "han", "kana", None, None, None, "cyrillic", "thai", "hangul", "greek", "han"]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        assert planes.from_planes(planes.to_planes(ids, bits), n).tolist() == ids.tolist()
    builder = planes.FileBuilder(bits)
    docs = [(None, rng.integers(0, 50_000, n).astype(np.uint32)) if i == 0 else (i, rng.integers(0, 50_000, n).astype(np.uint32)) for i, n in enumerate([3, 1, planes.BLOCK_IDS + 5, 1, 40])]
    for key, ids in docs:
        builder.add([key], np.array([len(ids)]), ids)
    data = builder.finish()
    back = list(planes.documents_of(data))
    assert [k for k, _, _ in back] == [k for k, _ in docs]
    assert all(a.tolist() == b.tolist() for (_, _, a), (_, b) in zip(back, docs, strict=True))
    block = planes.read_index(data)["blocks"][1]
    assert len(planes.read_block(data, block)) == block["n"]
    with pytest.raises(ValueError):
        planes.read_index(data[:-1])


def jaccard_by_hand(texts, k=4):
    low = {65 + i: 97 + i for i in range(26)}
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(low))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def test_shingle_sets():
    texts = ODD + ["a b c", "A B C", "a b", "a b c d", "a b c d a b c d a", "p q r s t"]
    sets = jaccard.shingle_sets(chunk(texts), 4)
    hand = jaccard_by_hand(texts)
    assert [len(s) for s in sets] == [len(s) for s in hand]
    assert all((a.tolist() == b.tolist()) == (x == y) for a, x in zip(sets, hand, strict=True) for b, y in zip(sets, hand, strict=True))
    ids = jaccard.set_ids(sets)
    assert ids[-6] == ids[-5] != ids[-4]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for n, m in [(1, 1), (40, 45), (300, 310), (100, 130), (90, 500)]:
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], rng.integers(0, 1 << 63, m).astype(np.uint64)]))
        apart = len(np.setxor1d(x, y))
        assert jaccard.least_difference(jaccard.sketch(x), jaccard.sketch(y)) <= apart
        assert jaccard.least_difference(jaccard.sketch(x), jaccard.sketch(x)) == 0


@given(st.integers(1, 400), st.integers(50, 100))
def test_prefix_is_just_long_enough(n, percent):
    need = -(-percent * n // 100)  # shingles that a partner shares at least
    assert jaccard.prefix_size(n, percent) == n - need + 1


def test_seeds_survive_a_substitution_anywhere():
    rng = np.random.default_rng(2)
    item = rng.integers(1, 1 << 62, 20).astype(np.uint64)
    of = lambda h: set(decontam.seed_hashes(T.Words(h, h, np.zeros(len(h), np.int64), np.array([0, len(h)])))[1].tolist())
    for i in range(20):
        other = item.copy()
        other[i] += np.uint64(1)
        assert of(item) & of(other)
    other = item.copy()
    other[4::5] += np.uint64(1)  # one word in five
    assert of(item) & of(other)
    assert decontam.best_overlap(other, item, 0)[1] == 16
    assert decontam.best_overlap(np.concatenate([item[:3], other]), item, 3)[1] == 16


def test_one_or_two_substitutions_anywhere_are_found():
    of = lambda h: set(decontam.seed_hashes(T.Words(h, h, np.zeros(len(h), np.int64), np.array([0, len(h)])))[1].tolist())
    for n in range(8, 21):
        item = np.random.default_rng(n).integers(1, 1 << 62, n).astype(np.uint64)
        seeds = of(item)
        for places in [*itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2)]:
            if 5 * (n - len(places)) < 4 * n:
                continue
            other = item.copy()
            other[list(places)] += np.uint64(1)
            assert decontam.best_overlap(np.concatenate([item[:2] + np.uint64(3), other]), item, 2) == (n, n - len(places))
            assert seeds & of(other)


def test_best_overlap_by_hand():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n, m = rng.integers(1, 30, 2)
        item, doc, shift = rng.integers(1, 3, n).astype(np.uint64), rng.integers(1, 3, m).astype(np.uint64), int(rng.integers(-30, 30))
        same = [doc[j + shift] == item[j] for j in range(n) if 0 <= j + shift < m]
        stretches = [(sum(same[i:j]), j - i) for i in range(len(same)) for j in range(i + 1, len(same) + 1) if 5 * sum(same[i:j]) >= 4 * (j - i)]
        match, size = max(stretches, default=(0, 0))
        assert decontam.best_overlap(doc, item, shift) == (size, match)


def test_characters_of_unspaced_scripts_are_words():
    def cut(text):
        c = chunk([text])
        w = T.hash_words(c.data, c.offsets, space=decontam.NOT_WORD, characters=True)
        return w.hash.tolist()

    one = lambda text: cut(text)[0]
    assert cut("日本語。テスト「x」") == [one(x) for x in "日本語テストx"]
    assert cut("ภาษาไทย") == [one(x) for x in "ภาษาไทย"]
    assert cut("été abc日x𠀋y，z é") == [one(x) for x in ["été", "abc", "日", "x", "𠀋", "y", "z", "é"]]
    assert cut("，。") == cut("") == []
    c = chunk(["日。", "", "本a", None, "。b"])
    assert np.diff(T.hash_words(c.data, c.offsets, space=decontam.NOT_WORD, characters=True).first).tolist() == [1, 0, 2, 0, 1]
    assert len(T.hash_words(c.data, c.offsets, space=decontam.NOT_WORD).hash) == 3


def kt(a, b):
    p, zeros, ones = 1.0, 0, 0
    for bit in [0] * a + [1] * b:
        p *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        zeros, ones = zeros + (not bit), ones + bit
    return np.log(p)


def test_kt_estimate():
    a, b = np.array([0, 0, 1, 5, 40, 7]), np.array([0, 1, 1, 3, 2, 60])
    assert np.allclose(ctw.log_kt(a, b), [kt(x, y) for x, y in zip(a, b, strict=True)], atol=1e-9)


def tables_of(texts, depth, least=1):
    c = chunk(texts)
    keys = ctw.grams(c.data, c.offsets, depth)[0]
    out = []
    for d in range(depth + 1):
        u, n = np.unique(keys & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True)
        ctx = u >> np.uint64(8)
        total = dict(zip(*[x.tolist() for x in (lambda v, i: (v, np.bincount(i, weights=n)))(*np.unique(ctx, return_inverse=True))], strict=True))
        keep = np.array([d == 0 or total[x] >= least for x in ctx.tolist()])
        out.append((ctx[keep], u[keep] & np.uint64(255), n[keep]))
    return out


def test_tree_against_recursive_weighting():
    """One binary decision at a time, by the definition, over all contexts of up to two bytes."""
    texts, depth = ["abab abba", "abca", ""], 2
    tree = ctw.build_tree(tables_of(texts, depth))
    c = chunk(texts)
    keys = ctw.grams(c.data, c.offsets, depth)[0]
    seen = sorted({k & 255 for k in keys.tolist()})
    width = 8  # four or more symbols and one for the others
    assert len(seen) + 1 <= width
    pairs = [((k >> 8) & 0xFFFF, seen.index(k & 255)) for k in keys.tolist()]

    def counts(context, d, node):
        zeros = ones = 0
        for ctx, s in pairs:
            if d and (ctx & ((1 << 8 * d) - 1)) != context:
                continue
            path = s + width
            while path > 1:
                if path >> 1 == node:
                    ones, zeros = ones + (path & 1), zeros + (not path & 1)
                path >>= 1
        return zeros, ones

    def weighted(context, d, node):
        own = kt(*counts(context, d, node))
        if d == depth:
            return own
        children = {ctx & ((1 << 8 * (d + 1)) - 1) for ctx, _ in pairs if not d or (ctx & ((1 << 8 * d) - 1)) == context}
        return np.logaddexp(own, sum(weighted(x, d + 1, node) for x in children)) + np.log(0.5)

    def one(ctx, node):
        p = None
        for d in range(depth, -1, -1):
            context = ctx & ((1 << 8 * d) - 1)
            z, o = counts(context, d, node)
            est = (o + 0.5) / (z + o + 1)
            w = 1.0 if d == depth else np.exp(kt(z, o) + np.log(0.5) - weighted(context, d, node))
            p = est if p is None else w * est + (1 - w) * p
        return p

    for key in sorted(set(keys.tolist()))[:12]:
        s, node, want = seen.index(key & 255) + width, 1, 0.0
        for bit in f"{s:b}"[1:]:
            p = one((key >> 8) & 0xFFFF, node)
            want += np.log10(p if bit == "1" else 1 - p)
            node = 2 * node + int(bit)
        assert ctw.score_bytes(tree, np.array([key], np.uint64))[0] == pytest.approx(want, abs=1e-4)


def test_tree_is_a_distribution_and_unseen_bytes_have_a_share():
    tree = ctw.build_tree(tables_of(["abracadabra " * 40, "abba"], 3, least=2))
    for context in (0x616272, 0xFFFFFF, 0x7A7A7A):
        keys = np.array([(context << 8) | b for b in range(256)], np.uint64)
        assert (10 ** ctw.score_bytes(tree, keys).astype(float)).sum() == pytest.approx(1, abs=0.02)  # code words that stand for no byte take the rest
    empty = ctw.build_tree([(np.zeros(0, np.uint64),) * 3] * 3)
    assert np.isfinite(ctw.score_bytes(empty, np.array([0x6161], np.uint64))).all()


def test_scores_grow_with_training():
    c = chunk(["the cat sat on the mat " * 50])
    trained = ctw.build_tree(tables_of(["the cat sat on the mat " * 50], 3))
    other = ctw.build_tree(tables_of(["quick brown foxes jump over lazy dogs " * 50], 3))
    keys = ctw.grams(c.data, c.offsets, 3)[0]
    assert ctw.score_bytes(trained, keys).sum() > ctw.score_bytes(other, keys).sum()


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        (None, ""),
        ("just text & more", "just text & more"),
        ("<article><h1>T &amp; U</h1><p>a  b\n c<br>d</p></article><footer>f</footer>", "T & U\na b c d"),
        ("<nav>menu<article><p>kept", "kept"),
        ("<article><p>one<p>two<footer>no</footer>", "one\ntwo"),
        ("<body><header>h</header><main><p>m</p></main><p>out</p></body>", "m"),
        ("<article><p>x <b>bo</b>ld 1 < 2 &#233;&nbsp;y</p><div class='comments'>c</div><form>q</form></article>", "x bold 1 < 2 é y"),
        ("<script>var t='</p>';</script><style>p{}</style><p>a<!-- b --></p><p hidden>h</p>", "a"),
        ("<p>unclosed <script>x", "unclosed"),
        ("<article><h2 id='related-work'>Related work</h2><p>a</p><h2 id='comments-on-method'>On comments</h2><section class='social-science'><p>b</p></section></article>", "Related work\na\nOn comments\nb"),
        ("<article><h2 id='comments'>Comments</h2><p>a</p><div class='comment-list'>c</div><div id='ad-box'>d</div><p class='ad'>e</p><div class='big nav'>f</div></article>", "Comments\na"),
        ("<body><div class='site-footer'>f</div><p>a <span class='ad'>x</span>b</p><div class='navigator'>g</div></body>", "a b\ng"),
        ("<article><ul><li>i<li>j</ul><table><tr><td>1<td>2</table></article></div></div>", "i\nj\n1\n2"),
    ],
)
def test_main_text(html, want):
    assert templates.Page(html or "").main_text(set()) == want


def test_template_subtrees():
    page = "<body><div>site line</div><p>own {0}</p><div><p>deep</p><p>text {0}</p></div></body>"
    one, two = templates.Page(page.format(1)), templates.Page(page.format(2))
    common = {e[0] for e in one.elements} & {e[0] for e in two.elements}
    assert one.main_text(common) == "own 1\ntext 1"
    article = templates.Page("<article><p>own</p></article><p>own</p>")
    assert article.main_text({e[0] for e in article.elements}) == "own"


def test_crc_law():
    assert zlib.crc32("é".encode()) == zlib.crc32(b"\xc3\xa9")


def test_tidy_tasks_give_memory_back(monkeypatch):
    """All batches come through; memory goes back once, at the end, after an error, and when the reader stops early."""
    calls = []
    monkeypatch.setattr(T, "give_back", lambda: calls.append(1))
    assert list(T.tidy(lambda batches: (2 * b for b in batches))(iter(range(4)))) == [0, 2, 4, 6] and len(calls) == 1
    with pytest.raises(ZeroDivisionError):
        list(T.tidy(lambda batches: (1 // b for b in batches))(iter([1, 0])))
    early = T.tidy(lambda batches: (b for b in batches))(iter(range(4)))
    assert next(early) == 0 and len(calls) == 2
    early.close()
    assert len(calls) == 3
    monkeypatch.undo()
    T.give_back()
