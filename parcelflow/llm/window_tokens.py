"""Token ids of whole texts by the public word-level BPE vocabulary.

Encoding each text as a whole repeats the merges of every frequent word. Here
a piece of many texts is one array of code points: it is cut into the
tokenizer's pre-tokens with numpy, and only a pre-token not yet in the worker's
bounded cache goes to the tokenizer's model. Texts with a code point of
0x250 or more after lower-casing, or with the string of a special token in any
case, take the tokenizer as a whole, so normal forms, scripts beyond Latin and
special tokens follow its own rules. Both ways give equal ids."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from parcelflow.llm.textspans import hash_runs, mix64

LATIN = 0x250
CACHE = 1_000_000

_POINT = mix64(np.arange(1, LATIN + 1, dtype=np.uint64))


def _classes() -> np.ndarray:
    """0 space, 1 letter, 2 number, 3 other."""
    out = np.full(LATIN, 3, np.int8)
    for c in range(LATIN):
        kind = unicodedata.category(chr(c))[0]
        out[c] = 1 if kind == "L" else 2 if kind == "N" else 0 if c in (0x20, 0x85, 0xA0) or 9 <= c <= 13 else 3
    return out


_CLASS = _classes()


def _byte_letters() -> list[str]:
    """The printable character that byte-level BPE uses for each byte: itself
    where printable, else the next one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


_BYTE_LETTER = _byte_letters()


class CachedTokenizer:
    def __init__(self, path: str, cache: int = CACHE):
        self.whole = Tokenizer.from_file(path)
        special = sorted({t.content.lower() for t in self.whole.get_added_tokens_decoder().values()}, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)")
        self.model, self.limit = self.whole.model, cache
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _pre_tokens(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of pre-tokens: runs of letters, single numbers, runs
        of others; 's 't 'm 'd 're 've 'll where a run of others would begin."""
        kind = np.where(points < LATIN, _CLASS[np.minimum(points, LATIN - 1)], 0)
        begin = np.ones(len(kind), bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        tick = np.flatnonzero(begin & (points == 0x27))
        if len(tick):
            pad = np.concatenate([points, [0, 0, 0]])
            a, b = pad[tick + 1], pad[tick + 2]
            two = np.isin(a, [ord(c) for c in "stmd"])
            three = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
            for which, size in ((two, 2), (three, 3)):
                at = tick[which]
                for j in range(1, size):
                    begin[at + j] = False
                begin[(at + size)[at + size < len(begin)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(kind))
        word = kind[starts] != 0
        return starts[word], ends[word]

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        if len(self.keys) + len(keys) > self.limit:
            self._clear()
        ids = [[t.id for t in self.model.tokenize("".join([_BYTE_LETTER[b] for b in w.encode()]))] for w in words]
        n = np.array([len(x) for x in ids], np.int64)
        at = self.used + np.cumsum(n) - n
        self.used += int(n.sum())
        while self.used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[at[0] : self.used] = [t for x in ids for t in x]
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = np.insert(self.keys, place, keys), np.insert(self.at, place, at), np.insert(self.n, place, n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        low = [t.lower() for t in texts]
        size = np.array([len(t) for t in low], np.int64)
        points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum(size + 1)])
        wide = np.maximum.reduceat(points, first[:-1]) >= LATIN if len(texts) else np.zeros(0, bool)
        wide |= np.array([self.special.search(t) is not None for t in low], bool)
        whole = {int(i): np.array(e.ids, np.uint32) for i, e in zip(
            np.flatnonzero(wide), self.whole.encode_batch([texts[i] for i in np.flatnonzero(wide)], add_special_tokens=False), strict=True)}
        if whole:
            points = np.where(np.repeat(wide, size + 1), np.uint32(0x20), points)
        starts, ends = self._pre_tokens(points)
        keys, index, inverse = np.unique(hash_runs(_POINT[np.minimum(points, LATIN - 1)], starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            before = len(self.keys)
            new = np.flatnonzero(~known)
            words = points[starts[0]:].tobytes().decode("utf-32-le") if len(starts) else ""
            cut = starts[index[new]] - starts[0], ends[index[new]] - starts[0]
            self._learn(keys[new], [words[s:e] for s, e in zip(*cut, strict=True)])
            if len(self.keys) < before + len(new):  # the cache began anew
                old = np.flatnonzero(known)
                cut = starts[index[old]] - starts[0], ends[index[old]] - starts[0]
                if len(old):
                    self._learn_rest(keys[old], [words[s:e] for s, e in zip(*cut, strict=True)])
            at = np.searchsorted(self.keys, keys)
        n, at = self.n[at][inverse], self.at[at][inverse]
        total = np.cumsum(n)
        ids = self.flat[np.repeat(at - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        word_first = np.searchsorted(starts, first)
        ends_at = np.concatenate([[0], total])[word_first]
        counts = np.diff(ends_at)
        if whole:
            parts = [whole.get(i, ids[a:b]) for i, (a, b) in enumerate(zip(ends_at[:-1], ends_at[1:], strict=True))]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, counts

    def _learn_rest(self, keys: np.ndarray, words: list[str]) -> None:
        limit, self.limit = self.limit, 1 << 62  # one piece may pass the limit
        self._learn(keys, words)
        self.limit = limit
