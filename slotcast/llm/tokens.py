"""Token ids of whole texts with a public tokenizer file, word by word.

The tokenizer of ``word_bpe_49k.json`` drops white space, lower-cases, splits into
letter runs, digits and punctuation runs, and no piece crosses white space.  The
ids of a text are therefore the ids of its pieces, one after another, and each
distinct piece has to go through the library's BPE once only.

* Plain documents (printable ASCII without apostrophes, and the letters U+00C0 to
  U+00FF, which Unicode normalisation leaves alone) are split with numpy.
* In the others, plain words are split by the tokenizer's own pattern, and every
  other word goes through the whole tokenizer.

The caches are bounded and emptied when full, so memory stays bounded whatever
the vocabulary."""

from __future__ import annotations

import json
import os
import re

import numpy as np

from slotcast.llm import textops as T

CACHE_WORDS = 600_000
LINE = 64  # pieces in one call's text
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ňŊ-ž]+")
#: The split pattern of the tokenizer file, for lower-cased plain words.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-zß-öø-ž0-9]+")
#: Bytes of plain documents: white space 0, letters 1, digits 2, others 3.
KIND = np.full(256, 3, np.uint8)
KIND[T.IS_SPACE] = 0
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = KIND[128:] = 1
#: Bytes that plain documents don't hold, and those that may follow 0xC3 (all but the signs U+00D7 and U+00F7).
ODD = np.zeros(256, bool)
ODD[:32] = ODD[127:] = ODD[0x27] = True
ODD[T.IS_SPACE] = ODD[0xC3] = False
ACCENT = np.zeros(256, bool)
ACCENT[0x80:0xC0] = True
ACCENT[[0x97, 0xB7]] = False
_ENCODERS: dict[tuple, WordEncoder] = {}


class _Index(dict):
    """key -> its number; new keys get the next one and wait in ``new``."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n

    def take(self) -> list:
        new, self.new = self.new, []
        return new


class IdCache:
    """Ids of strings, filed under the strings' 64-bit hashes; emptied when it holds more than ``limit``."""

    def __init__(self, limit: int):
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.keys, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def lookup(self, hashes: np.ndarray, spell, encode) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all strings one after another, and each string's count.

        ``spell(i)`` gives the strings at places i, ``encode(strings)`` their ids and counts."""
        if len(self.keys) > self.limit:
            self._clear()
        keys, where, at = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        known = spot < len(self.keys)
        new[known] = self.keys[spot[known]] != keys[known]
        if new.any():
            ids, sizes = encode(spell(where[new]))
            self.number = np.insert(self.number, spot[new], np.arange(len(sizes)) + len(self.first) - 1)
            self.keys = np.insert(self.keys, spot[new], keys[new])
            self.ids = np.concatenate([self.ids, ids])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        number = self.number[np.searchsorted(self.keys, keys)][at]
        sizes = self.first[number + 1] - self.first[number]
        return self.ids[T.ragged(self.first[number], sizes)], sizes


class WordEncoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if split["pattern"]["Regex"] != r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+":
            raise ValueError("the split pattern of this tokenizer file is not the one handled here")
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]}}
        self.bpe = Tokenizer.from_str(json.dumps(spec))
        vocab = spec["model"]["vocab"]
        self.ends_piece = np.zeros(max(vocab.values()) + 1, bool)  # the ids that end a piece carry the suffix
        self.ends_piece[[i for t, i in vocab.items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.cache_words = cache_words
        self._clear()
        self.runs = IdCache(cache_words)

    def _clear(self) -> None:
        self.words, self.pieces = _Index(), _Index()
        self.piece_ids, self.piece_first = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _split(self, word: bytes) -> list:
        text = word.decode("utf-8", "replace")
        if PLAIN.fullmatch(text) and not ("<" in text and any(s in text for s in self.special)):
            return PIECES.findall(text.lower())
        return [(text,)]

    def _learn_pieces(self) -> None:
        new = self.pieces.take()
        plain = [p for p in new if type(p) is str]
        lines = [" ".join(plain[i : i + LINE]) for i in range(0, len(plain), LINE)]
        flat = np.array([i for e in self.bpe.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], np.uint32)
        sizes = np.zeros(len(new), np.int64)
        odd = [x.ids for x in self.tokenizer.encode_batch_fast([p[0] for p in new if type(p) is not str], add_special_tokens=False)]
        ids = np.concatenate([flat, *(np.array(x, np.uint32) for x in odd)])
        is_plain = np.fromiter((type(p) is str for p in new), bool, len(new))
        sizes[is_plain] = np.diff(np.flatnonzero(self.ends_piece[flat]), prepend=-1)
        sizes[~is_plain] = [len(x) for x in odd]
        start = np.zeros(len(new), np.int64)  # plain ones stand first in ids, in order
        start[is_plain] = np.cumsum(sizes[is_plain]) - sizes[is_plain]
        start[~is_plain] = sizes[is_plain].sum() + np.cumsum(sizes[~is_plain]) - sizes[~is_plain]
        self.piece_ids = np.concatenate([self.piece_ids, ids[T.ragged(start, sizes)]])
        self.piece_first = np.concatenate([self.piece_first, self.piece_first[-1] + np.cumsum(sizes)])

    def _learn(self) -> None:
        new = self.words.take()
        if not new:
            return
        number = self.pieces.__getitem__
        parts = [list(map(number, self._split(w))) for w in new]
        if self.pieces.new:
            self._learn_pieces()
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter((i for x in parts for i in x), np.int64, int(n.sum()))
        size = self.piece_first[at + 1] - self.piece_first[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ends = ends[np.cumsum(n)]
        self.ids = np.concatenate([self.ids, self.piece_ids[T.ragged(self.piece_first[at], size)]])
        self.first = np.concatenate([self.first, self.first[-1] + ends])

    def _encode_runs(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lines = [b" ".join(runs[i : i + LINE]).decode() for i in range(0, len(runs), LINE)]
        flat = np.array([i for e in self.bpe.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], np.uint32)
        return flat, np.diff(np.flatnonzero(self.ends_piece[flat]), prepend=-1)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's documents one after another (uint32), and the count of each."""
        lead = np.zeros(len(data), bool)
        lead[1:] = data[:-1] == 0xC3
        odd = ODD[data] & ~(lead & ACCENT[data])
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)  # may begin a special token
        seen = np.concatenate([[0], np.cumsum(odd)])[offsets]
        plain = np.diff(seen) == 0
        if plain.all():
            return self._encode_plain(data, offsets, lead)
        size = np.diff(offsets)

        def part(mask, encode):
            at = T.ragged(offsets[:-1][mask], size[mask])
            return encode(data[at], np.concatenate([[0], np.cumsum(size[mask])]), lead[at])

        ids, counts = part(plain, self._encode_plain)
        odd_ids, odd_counts = part(~plain, lambda d, o, _: self._encode_words(d, o))
        n = np.zeros(len(size), np.int64)
        n[plain], n[~plain] = counts, odd_counts
        first = np.zeros(len(size), np.int64)
        first[plain] = np.cumsum(counts) - counts
        first[~plain] = len(ids) + np.cumsum(odd_counts) - odd_counts
        return np.concatenate([ids, odd_ids])[T.ragged(first, n)], n

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = T.LOWER[data]
        low[lead & (data < 0x9F)] += 32
        kind = KIND[data]
        begin = kind > 0
        begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[edges] = kind[edges] > 0
        start = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(start, offsets, "left"))
        until = np.append(start, len(low))

        def spell(i: np.ndarray) -> list[bytes]:
            return [low[a:b].tobytes().rstrip() for a, b in zip(start[i].tolist(), until[i + 1].tolist(), strict=True)]

        ids, size = self.runs.lookup(T.hash_runs(low, start, kind == 0), spell, self._encode_runs)
        ends = np.concatenate([[0], np.cumsum(size)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def _encode_words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.cache_words:
            self._clear()
        raw = data.tobytes()
        number = self.words.__getitem__
        found = [list(map(number, raw[a:b].split())) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        self._learn()
        words = np.fromiter(map(len, found), np.int64, len(found))
        at = np.fromiter((i for x in found for i in x), np.int64, int(words.sum()))
        size = self.first[at + 1] - self.first[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids[T.ragged(self.first[at], size)], np.diff(ends[np.concatenate([[0], np.cumsum(words)])])


def word_encoder(path: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder per Python worker and file."""
    key = (path, cache_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, cache_words)
    return _ENCODERS[key]
