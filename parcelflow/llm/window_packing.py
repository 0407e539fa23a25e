"""Packing of documents into token windows by best-fit decreasing.

A document's ids end with the end id. Overlong documents are first cut into
full windows; what remains is shorter than a window and goes, longest first,
into the open window with the least room that still holds it. That choice
depends on lengths alone, so the plan is made from the counts of each length
(at most one entry per length below the window, whatever the table's size): a
segment tree indexed by remaining capacity finds the tightest open windows, and
whole runs of equal windows are filled at once. Spark then numbers the pieces
of each length (per input partition, then by a running sum over partitions, so
a frequent length is no hot task) and each piece reads its window from the plan.

Padding: a window is padded to ``window``, but one whose fill is a power of two
is left as it is.

Defined results: a null text is an empty one and an empty text is one piece that
holds the end id alone; each input row is packed, also with repeated or null
ids; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import keyed, staged
from parcelflow.llm.window_tokens import CachedTokenizer

WINDOW = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"

_tokenizers: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """One per Python worker and path."""
    if path not in _tokenizers:
        _tokenizers[path] = CachedTokenizer(path)
    return _tokenizers[path]


class CapacityTree:
    """Segment tree over remaining capacities: which of them have open windows."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.full = [False] * (2 * self.size)

    def put(self, capacity: int, some: bool) -> None:
        at = capacity + self.size
        self.full[at] = some
        while at > 1:
            at //= 2
            self.full[at] = self.full[2 * at] or self.full[2 * at + 1]

    def tightest(self, need: int) -> int:
        """Least capacity of ``need`` or more with an open window, or -1."""
        at = need + self.size
        while not self.full[at]:
            while at % 2:  # climb out of right children
                at //= 2
            if at == 0:
                return -1
            at += 1
        while at < self.size:
            at = 2 * at if self.full[2 * at] else 2 * at + 1
        return at - self.size


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Best-fit decreasing for ``counts[length]`` pieces of each length.

    Rows (length, first rank, window of that rank, pieces per window, offset of
    the first of them): pieces of a length are numbered from 0, and from the
    row's first rank on they fill consecutive windows."""
    tree = CapacityTree(window)
    runs: dict[int, list[tuple[int, int]]] = {}  # capacity -> [(first window, number)]
    rows, windows = [], 0

    def open_run(capacity: int, first: int, number: int) -> None:
        if number and capacity:
            runs.setdefault(capacity, []).append((first, number))
            tree.put(capacity, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity < 0:
                capacity, each = window, window // length
                first, number = windows, -(-left // each)
                windows += number
            else:
                first, number = runs[capacity].pop()
                tree.put(capacity, bool(runs[capacity]))
                each = capacity // length
            filled = min(number, left // each)
            rows.append((length, rank, first, each, window - capacity))
            open_run(capacity - each * length, first, filled)
            left, rank = left - filled * each, rank + filled * each
            if filled < number and left:  # fewer than one window's share is left
                open_run(capacity - left * length, first + filled, 1)
                filled, left = filled + 1, 0
            open_run(capacity, first + filled, number - filled)
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut_and_count(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """One row per piece, numbered within its length in its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for piece in T.pieces(batches):
            ids, n = tok.encode([t or "" for t in piece.column("text").to_pylist()])
            at = np.cumsum(n)
            ids = np.insert(ids.astype("<u4"), at, end_id)
            total = n + 1
            first = np.cumsum(total) - total
            pieces = -(-total // window)
            doc = np.repeat(np.arange(len(n)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(total[doc] - start, window)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + b)]) for a, b in zip((first[doc] + start).tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            sizes, begin = np.unique(length[order], return_index=True)
            rank = np.empty_like(length)
            rank[order] = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length)))) + np.repeat(seen[sizes], np.diff(np.append(begin, len(length))))
            seen += np.bincount(length, minlength=window + 1)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc]),
                 pa.array(np.full(len(doc), part, np.int32)), pa.array(rank)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"])

    return docs.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, rank long")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: its document, place and digest, and the sequence and
    offset that it fills."""
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = staged(cut_and_count(rows, path, window, end_id), "pieces")
    here = staged(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r.length: r.n for r in here.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``window`` rows
    plan = plan_windows(counts, window)
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = here.select("part", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    scale = np.int64(1 << 44)  # ranks stay below
    keys = plan[:, 0] * scale + plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, length * scale + rank, "right") - 1]
            nth = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(row[:, 2] + nth // row[:, 3]), pa.array(row[:, 4] + nth % row[:, 3] * length)],
                names=[*b.schema.names[:5], "sequence_id", "offset"])

    # a row for each length in each partition
    numbered = cut.join(keyed(before, here.count()), ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("before")).alias("rank"))
    return numbered.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
