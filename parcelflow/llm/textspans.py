"""Vectorised word spans and hashes over the UTF-8 bytes of an Arrow column.

A record batch is cut into pieces of bounded bytes (a longer single text is a
piece of its own); within a piece all texts are one byte array with offsets, so
one numpy pass finds and hashes the words of thousands of documents."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15  # odd, so powers of it are invertible mod 2**64


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table of 256 entries, true within the given closed ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: bytes of words `[^\x20\x09-\x0D]+`
NON_SPACE = ~byte_table((0x20, 0x20), (0x09, 0x0D))
#: bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`
LETTERS = ~byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: A-Z to a-z, all other bytes unchanged
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LOWER = np.frombuffer(LOWER, np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=_U))
_powers = (np.ones(1, _U), np.ones(1, _U))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the step and of its inverse mod 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 64)
        up, down = np.full(size, _STEP, _U), np.full(size, pow(_STEP, -1, 1 << 64), _U)
        up[0] = down[0] = 1
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n > PIECE_BYTES + 64:
            return made  # for one very long text; not kept
        _powers = made
    return _powers


def hash_runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of ``values[start:end]`` for each run, equal for equal runs."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as the empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    raw = column.buffers()
    off = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8)[off[0] : off[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # no glibc: nothing to give back
    _trim = None


def release() -> None:
    """Give freed memory back to the system: a worker process serves one task
    after another and would keep the most that any of them needed."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text and ``rows``
    rows each; a text beyond the limit is a slice of its own."""
    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        at = 0
        total = np.concatenate([[0], np.cumsum(size)])
        while at < batch.num_rows:
            to = int(np.searchsorted(total, total[at] + limit, "right")) - 1
            to = min(max(to, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
    release()


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Words:
    """The words of all texts of a piece.

    starts, ends: byte positions; first: index of each text's first word, with
    the total at the end; doc: index of the text of each word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = table[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        begin[edge] = inside[edge]
        end[edge - 1] = inside[edge - 1]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_runs(_BYTE[self.data], self.starts, self.ends)

    def left(self) -> np.ndarray:
        """How many words of its text begin at or after each word."""
        return self.first[self.doc + 1] - np.arange(len(self.starts))


def gram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes (text ends ignored)."""
    n = max(len(words) - k + 1, 0)
    total = np.zeros(n, _U)
    for j in range(k):
        total += words[j : j + n] * (mix64(np.full(1, j + 1, _U)) | _U(1))  # unrelated odd factors
    return mix64(total + _U(k))


def word_code(word: bytes) -> int:
    """The hash of one word as ``Words.hashes`` gives it."""
    data = np.frombuffer(word, np.uint8)
    return int(hash_runs(_BYTE[data], np.array([0]), np.array([len(data)]))[0])


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 as the int64 of the same bits, for a Spark long."""
    return x.view(np.int64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """List column with ``counts`` values a row."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)
