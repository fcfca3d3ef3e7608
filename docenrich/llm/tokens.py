"""Token ids of texts, by a tokenizer file, at the speed a cache of words allows."""

from __future__ import annotations

import hashlib
import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: Words that are kept; as many of those known before are kept until these are full again.
CACHED_WORDS = 250_000
#: Parts words for some, not for others.
_ODD_SPACE = "[\\x1c-\\x1f]"
_SPACE = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
#: Characters that composition leaves alone and that have one lower-case form.
_PLAIN = re.compile("[!-~À-įı-ňŊ-ž]+")
_MARKS = frozenset(".,;:!?")
_NONE = np.iinfo(np.int64).max

_ENCODERS: dict[tuple, "Encoder"] = {}

# How the tokenizer files for which words are merged here prepare a text.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def encoder(definition: str, by_word: bool = True) -> "Encoder":
    """The encoder of this worker process for a tokenizer's definition (the file's content)."""
    key = (hashlib.sha256(definition.encode()).hexdigest(), by_word)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition, by_word)
    return _ENCODERS[key]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, without special tokens.

    ``by_word`` holds for tokenizers to which white space only parts words: the
    ids of each run between white space are then looked up, and only unknown
    runs are tokenized.
    """

    def __init__(self, definition: str, by_word: bool):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.by_word = by_word
        self.merges = Merges.of(json.loads(definition)) if by_word else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _tokenize(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, words: list[str]) -> None:
        if self.merges:
            plain = [w for w in words if _PLAIN.fullmatch(w) and "<|" not in w]
            self.known.update(zip(plain, self.merges.encode(plain)))
            words = [w for w in words if w not in self.known]
        self.known.update(zip(words, self._tokenize(words)))

    def forget(self) -> None:
        """Let go of the words that are kept, for what runs in this process next."""
        self.known, self.older = {}, {}

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        found = list(map(self.known.get, words))
        missing = [w for w, ids in zip(words, found) if ids is None]
        if missing:
            if len(self.known) > CACHED_WORDS:
                self.older, self.known = self.known, {}
            older, known = self.older, self.known
            new = [w for w in missing if w not in older]
            if len(new) < len(missing):
                known.update((w, older[w]) for w in missing if w in older)
            if new:
                self._learn(new)
            found = [known[w] if ids is None else ids for w, ids in zip(words, found)]
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text. The words of all of them are numbered, looked up once
        each, and their ids gathered in the order of the texts."""
        if not self.by_word:
            return self._tokenize(texts if isinstance(texts, list) else texts.to_pylist())
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts
        if pc.any(pc.match_substring_regex(column, _ODD_SPACE)).as_py():
            split = [_SPACE.split(t) for t in column.to_pylist()]
            words = pa.array(split, pa.list_(pa.large_string()))
        else:
            words = pc.utf8_split_whitespace(column)
        numbered = words.flatten().dictionary_encode()
        place = numbered.indices.to_numpy(zero_copy_only=False)
        ids = self._ids(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        n = sizes[place]
        ends = np.r_[0, np.cumsum(n)]
        at = np.arange(ends[-1]) + np.repeat(first[place] - ends[:-1], n)
        whole = np.frombuffer(b"".join(ids), dtype="<u4")[at].tobytes()
        bounds = words.offsets.to_numpy().astype(np.int64)
        bounds = (4 * ends[bounds - bounds[0]]).tolist()
        return [whole[a:b] for a, b in zip(bounds, bounds[1:])]


class Merges:
    """Byte-pair merges of many words at once.

    In each round every word merges its pair of the lowest rank; a pair that a
    merge makes ranks after it, so the rounds give what merging one by one does.
    """

    def __init__(self, vocab: dict[str, int], merges: list):
        shown = _byte_alphabet()
        self.find = regex.compile(_WORDS).findall
        self.inner = np.array([vocab[c] for c in shown], dtype=np.int64)
        self.last = np.array([vocab[c + "</w>"] for c in shown], dtype=np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys = np.full((1 << self.bits) + 64, -1, dtype=np.int64)
        self.ranks = np.full(len(self.keys), _NONE, dtype=np.int64)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self.keys[slot] != -1:
                slot += 1
            self.keys[slot], self.ranks[slot] = key, rank

    @classmethod
    def of(cls, definition: dict) -> "Merges | None":
        """None for tokenizers that prepare texts or merge in another way."""
        model = definition["model"]
        parts = (definition["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        as_known = (
            model["type"] == "BPE"
            and model.get("end_of_word_suffix") == "</w>"
            and not model.get("ignore_merges")
            and (definition["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and (parts[0].get("pattern") or {}).get("Regex") == _WORDS
            and [p.get("type") for p in parts] == ["Split", "ByteLevel"]
        )
        return cls(model["vocab"], model["merges"]) if as_known else None

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        ranks = np.where(found == keys, self.ranks[slots], _NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] += 1
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            ranks[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return ranks

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        lower = [t.lower() for t in texts]
        runs = {t: self._runs(t) for t in lower if not t.isalpha()}
        distinct = list({t for t in lower if t.isalpha()}.union(chain.from_iterable(runs.values())))
        ids = dict(zip(distinct, self._words([w.encode() for w in distinct])))
        for text, words in runs.items():
            ids[text] = b"".join([ids[w] for w in words])
        return [ids[t] for t in lower]

    def _runs(self, text: str) -> list[str]:
        # most are a word and the mark behind it
        word, mark = text[:-1], text[-1:]
        return [word, mark] if mark in _MARKS and word.isalpha() else self.find(text)

    def _words(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        ids, word = self.inner[data], np.repeat(np.arange(len(words)), sizes)
        ids[ends - 1] = self.last[data[ends - 1]]
        done_ids, done_words = [], []
        while len(ids):
            ranks = np.full(len(ids), _NONE, dtype=np.int64)
            pair = np.flatnonzero(word[1:] == word[:-1])
            ranks[pair] = self._ranks(ids[pair] * self.size + ids[pair + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(ids)])
            best = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            ready = best == _NONE
            done_ids.append(ids[ready])
            done_words.append(word[ready])
            at = np.flatnonzero((ranks == best) & ~ready)
            # of pairs that overlap (a a a), the first, the third ...
            fresh = np.r_[True, np.diff(at) != 1] if len(at) else np.zeros(0, dtype=bool)
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            ids[at] = self.merged[ranks[at]]
            keep = ~ready
            keep[at + 1] = False
            ids, word = ids[keep], word[keep]
        word = np.concatenate(done_words)
        flat = np.concatenate(done_ids)[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]
