"""Compressed full-text index over integer words: suffix array, Burrows-Wheeler
transform, and a wavelet matrix of packed bits with block ranks.

Searches run for many streams at once: one numpy step extends every stream by
one word to the left."""

from __future__ import annotations

import numpy as np

_U = np.uint64


class BitRank:
    """Packed bits; ones before a position by block count and popcount."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(_U)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (_U(1) << (at & 63).astype(_U)) - _U(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.shift = list(range(max(1, int(alphabet - 1).bit_length()) - 1, -1, -1))
        self.levels, self.zeros = [], []
        row = symbols
        for s in self.shift:
            bit = ((row >> s) & 1).astype(bool)
            self.levels.append(BitRank(bit))
            self.zeros.append(len(row) - int(bit.sum()))
            row = np.concatenate([row[~bit], row[bit]])
        self.start = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for s, level, zeros in zip(self.shift, self.levels, self.zeros, strict=True):
            ones = level.ones(at)
            at = np.where((symbol >> s) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, at) - self.start[symbol]


def _order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), np.int64)
    new[0] = 0
    new[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


class FMIndex:
    """Index of texts of words (0 and up), with a threshold length.

    ``group`` numbers, in suffix order, the classes of suffixes that agree in
    their first ``threshold`` words."""

    def __init__(self, words: np.ndarray, first: np.ndarray, threshold: int):
        n_texts = len(first) - 1
        self.threshold, self.shift = threshold, n_texts + 1
        text = np.repeat(np.arange(n_texts), np.diff(first))
        place = np.arange(len(words)) + text
        seq = np.zeros(len(words) + n_texts + 1, np.int64)  # ends with the sentinel 0
        seq[place] = words + self.shift
        seq[first[1:] + np.arange(n_texts)] = np.arange(1, n_texts + 1)  # a separator of its own after each text
        self.text_of = np.full(len(seq), -1, np.int64)
        self.text_of[place] = text
        n = len(seq)
        order, rank = _order(seq)
        length, short, short_length = 1, rank, 1
        while rank.max() < n - 1:
            ahead = np.zeros(n, np.int64)
            ahead[: max(n - length, 0)] = rank[length:] + 1
            order, rank = _order(rank * (n + 1) + ahead)
            length *= 2
            if length <= threshold:
                short, short_length = rank, length
        self.suffixes = order
        if short_length * 2 > threshold:  # prefixes of the threshold: two overlapping ones
            ahead = np.zeros(n, np.int64)
            back = threshold - short_length
            ahead[: n - back] = short[back:] + 1
            key = (short * (n + 1) + ahead)[order]
        else:  # all suffixes differ in fewer words
            key = rank[order]
        self.group = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
        self.wavelet = WaveletMatrix(seq[order - 1], int(seq.max()) + 1)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(seq))])[:-1]
        self.n = n

    def group_minimum(self, value_of_text: np.ndarray) -> np.ndarray:
        """Least value among the texts of each group's suffixes; separators
        count as the largest integer."""
        value = np.append(value_of_text, np.iinfo(np.int64).max)[self.text_of[self.suffixes]]
        return np.minimum.reduceat(value, np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1]])))

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: intervals of the matches with one more word in front."""
        both = self.smaller[np.tile(symbol, 2)] + self.wavelet.rank(np.tile(symbol, 2), np.concatenate([low, high]))
        return both[: len(symbol)], both[len(symbol) :]

    def matches(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each position of the streamed texts the group of its first
        ``threshold`` words, or -1 where the index lacks them (or the text
        ends before). Words the index doesn't know are negative.

        Matching statistics from the right: a match grows to the left as long
        as the index has it; where it breaks, it is taken up again with its end
        moved to the left, at once to the threshold if it was longer."""
        out = np.full(len(words), -1, np.int64)
        at, end = first[1:] - 1, first[1:].copy()
        low, high = np.zeros(len(at), np.int64), np.full(len(at), self.n, np.int64)
        begin = first[:-1]
        live = np.flatnonzero(end - begin >= self.threshold)
        while len(live):
            w = words[at[live]]
            known = w >= 0
            lo, hi = low[live].copy(), high[live].copy()
            if known.any():
                lo[known], hi[known] = self.extend(w[known] + self.shift, lo[known], hi[known])
            good = known & (lo < hi)
            ok, no = live[good], live[~good]
            low[ok], high[ok] = lo[good], hi[good]
            long = end[ok] - at[ok] >= self.threshold
            out[at[ok][long]] = self.group[low[ok][long]]
            at[ok] -= 1
            if len(no):
                # every stretch with this word and the match's last word breaks
                end[no] = np.where(words[at[no]] < 0, at[no], np.minimum(end[no] - 1, at[no] + self.threshold))
                end[no] = np.maximum(end[no], at[no])
                at[no] = end[no] - 1
                low[no], high[no] = 0, self.n
            live = live[(at[live] >= begin[live]) & (end[live] - begin[live] >= self.threshold)]
        return out
