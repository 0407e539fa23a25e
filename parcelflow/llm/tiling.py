"""Benchmark decontamination by greedy string tiling.

Seeds are runs of as many words as the least tile has (a shorter item is its own
seed), so no pair that tiles could cover is missed. A document whose seeds touch
enough of an item's words is tiled against it: the longest runs of words that both
have, not overlapping earlier ones, are marked again and again, found by running Karp-Rabin hashes at falling search lengths. Tiles may stand in any
order in the document, so reordered passages still cover the item; a pair is a
leak when its tiles cover at least ``coverage`` of the item's words.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased.

The seeds join runs as a lookup in a broadcast seed table while the benchmark's
text is at most ``BROADCAST_BYTES``, else as a shuffled join; both give the same
pairs. Tiles lie within the words that seeds touch, so pairs whose seeds touch less
than ``coverage`` of the item are dropped before they are tiled.

Defined results: a null text on either side is an empty one; items without words
match nothing; each input row is judged by its own text, so repeated rows are
reported, and dropped, alike; other columns are ignored, or kept by
``decontaminate``; an empty table on either side gives no pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import free_name, staged

LEAST_TILE = 3
SEED = LEAST_TILE
COVERAGE = 0.8
BROADCAST_BYTES = 16 << 20

SCHEMA = "doc_id long, item_id long, item_words long, covered long, coverage double, n_tiles long, tiles string"


def _runs(free: np.ndarray, k: int) -> np.ndarray:
    """Starts of the runs of ``k`` free positions."""
    if len(free) < k:
        return np.zeros(0, np.int64)
    total = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(total[k:] == total[:-k])


def _hashes(codes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    return T.hash_runs(codes, starts, starts + k)


def tile(item: np.ndarray, text: np.ndarray, least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """(item start, text start, length) of the greedy tiles, in order of
    marking. ``item`` and ``text`` are word hashes."""
    least = max(1, min(least, len(item)))
    free_item, free_text, tiles = np.ones(len(item), bool), np.ones(len(text), bool), []
    # positions of the text that no least match touches can hold no tile
    grams = _hashes(text, np.arange(max(len(text) - least + 1, 0)), least)
    touched = np.zeros(len(text), bool)
    for at in np.flatnonzero(np.isin(grams, _hashes(item, np.arange(len(item) - least + 1), least))):
        touched[at : at + least] = True
    free_text &= touched
    length = len(item)
    while length >= least:
        a, b = _runs(free_item, length), _runs(free_text, length)
        marked = False
        if len(a) and len(b):
            table: dict[int, list[int]] = {}
            for at, h in zip(b.tolist(), _hashes(text, b, length).tolist(), strict=True):
                table.setdefault(h, []).append(at)
            for i, h in zip(a.tolist(), _hashes(item, a, length).tolist(), strict=True):
                if not free_item[i : i + length].all():
                    continue
                for j in table.get(h, ()):
                    if free_text[j : j + length].all() and (item[i : i + length] == text[j : j + length]).all():
                        free_item[i : i + length] = free_text[j : j + length] = False
                        tiles.append((i, j, length))
                        marked = True
                        break
        length = length if marked else length - 1
    return tiles


class Items:
    """A benchmark as word hashes, with its seeds sorted for lookups."""

    def __init__(self, rows: list[tuple[int, str | None]], seed: int, coverage: float):
        self.ids = [r[0] for r in rows]
        words = T.Words(T.lowered((buf := T.text_buffer(pa.array([r[1] for r in rows], pa.string())))[0]), buf[1], T.LETTERS)
        h = words.hashes()
        self.codes = [h[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        self.needed, self.doc = coverage * words.counts, words.doc
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        left = words.left()
        for k in range(1, seed + 1):
            g = T.gram_hash(h, k)
            at = np.flatnonzero((left[: len(g)] >= k) & (np.minimum(words.counts[words.doc[: len(g)]], seed) == k))
            if len(at):
                at = at[np.argsort(g[at], kind="stable")]
                self.seeds[k] = g[at], at

    def candidates(self, words: T.Words, h: np.ndarray) -> dict[int, list[int]]:
        """Items of which each text of the piece has seeds that touch enough
        words."""
        out: dict[int, list[int]] = {}
        left = words.left()
        for k, (grams, place) in self.seeds.items():
            g = T.gram_hash(h, k)
            hit = np.flatnonzero(_among(g, grams) & (left[: len(g)] >= k))
            doc = words.doc[hit]
            for at in np.split(hit, np.flatnonzero(np.diff(doc)) + 1) if len(hit) else ():
                found = np.unique(g[at])
                low, high = np.searchsorted(grams, found, "left"), np.searchsorted(grams, found, "right")
                n = high - low
                start = np.sort(place[np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)])
                item = self.doc[start]
                touched = np.full(len(start), k)  # by each run, up to the next one's start
                touched[:-1] = np.where(item[1:] == item[:-1], np.minimum(np.diff(start), k), k)
                first = np.flatnonzero(np.diff(item, prepend=-1))
                enough = np.add.reduceat(touched, first) >= self.needed[item[first]]
                if enough.any():
                    out.setdefault(int(words.doc[at[0]]), []).extend(item[first][enough].tolist())
        return out


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _leaks(column: pa.Array, items: Items, coverage: float, least: int) -> Iterator[tuple[int, int, int, list]]:
    """(row, item, covered words, tiles) of the leaking pairs of a piece."""
    data, off = T.text_buffer(column)
    words = T.Words(T.lowered(data), off, T.LETTERS)
    h = words.hashes()
    for d, found in sorted(items.candidates(words, h).items()):
        text = h[words.first[d] : words.first[d + 1]]
        for i in sorted(found):
            tiles = tile(items.codes[i], text, least)
            covered = sum(t[2] for t in tiles)
            if covered >= coverage * len(items.codes[i]):
                yield d, i, covered, tiles


def _small(benchmark: DataFrame) -> list[tuple[int, str | None]] | None:
    """The benchmark's rows if its text is within the broadcast bound."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    return [(r.item_id, r.text) for r in benchmark.orderBy("item_id", "text").collect()] if size <= BROADCAST_BYTES else None


def _pairs(docs: DataFrame, benchmark: DataFrame, seed: int, coverage: float) -> DataFrame:
    """(text_key, item_id) by a shuffled join on seeds; a pair has runs enough
    to touch ``coverage`` of the item."""

    def grams(name: str, short: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in T.pieces(batches):
                data, off = T.text_buffer(piece.column("text"))
                words = T.Words(T.lowered(data), off, T.LETTERS)
                h, left = words.hashes(), words.left()
                for k in range(1, seed + 1):
                    g = T.gram_hash(h, k)[: len(h)]
                    at = np.flatnonzero(left[: len(g)] >= k)
                    if short and k < seed:  # an item's seed is shorter only if the item is
                        at = at[words.counts[words.doc[at]] == k]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(name).take(pa.array(words.doc[at])), pa.array(T.signed(T.mix64(g[at] + np.uint64(k)))),
                         pa.array(words.counts[words.doc[at]], pa.int64())], names=[name, "seed", "n"])
        return run

    items = benchmark.select("item_id", "text").mapInArrow(grams("item_id", True), "item_id long, seed long, n long").groupBy("item_id", "seed", "n").agg(
        F.count("*").alias("c"))
    items = staged(items, "item-seeds")
    texts = docs.select("text_key", "text").mapInArrow(grams("text_key", False), "text_key long, seed long, n long").select("text_key", "seed")
    texts = staged(texts.join(items.select("seed").distinct(), "seed", "left_semi").distinct(), "text-seeds")
    # a leak shares ``least`` of an item's seeds, so at least one of all but
    # ``least - 1`` of them: those that the most texts have needn't be joined on
    common = texts.groupBy("seed").agg(F.count("*").alias("texts"))
    rare_first = Window.partitionBy("item_id", "n").orderBy("texts", "seed").rowsBetween(Window.unboundedPreceding, -1)
    least = F.ceil(F.lit(coverage) * F.col("n") / F.lit(seed) - 1e-9)
    ranked = items.join(common, "seed").withColumns({"before": F.coalesce(F.sum("c").over(rare_first), F.lit(0)),
                                                     "all": F.sum("c").over(Window.partitionBy("item_id", "n"))})
    met = texts.join(ranked.where(F.col("before") <= F.col("all") - least).select("item_id", "n", "seed"), "seed").select("text_key", "item_id", "n").distinct()
    full = staged(met, "met").join(items, ["item_id", "n"]).join(texts, ["text_key", "seed"])
    return (full.groupBy("text_key", "item_id", "n").agg(F.sum("c").alias("c")).where(F.col("c") * seed >= F.lit(coverage) * F.col("n"))
            .select("text_key", "item_id").distinct())


def _normal(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
            benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, least: int = LEAST_TILE,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per leaking (document, item); ``tiles`` lists item start:text
    start:length in words."""
    docs, benchmark = _normal(docs, benchmark, id_col, text_col)
    seed = min(seed, least)
    rows = _small(benchmark)

    def batch(out: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                          names=[x.split()[0] for x in SCHEMA.split(", ")])

    def report(doc, items: Items, i: int, covered: int, tiles: list) -> tuple:
        n = len(items.codes[i])
        return doc, items.ids[i], n, covered, covered / n, len(tiles), ",".join(f"{a}:{b}:{k}" for a, b, k in sorted(tiles))

    if rows is not None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(rows, seed, coverage)
            for piece in T.pieces(batches):
                ids = piece.column("doc_id")
                out = [report(ids[d].as_py(), items, i, covered, tiles) for d, i, covered, tiles in _leaks(piece.column("text"), items, coverage, least)]
                if out:
                    yield batch(out)

        return docs.mapInArrow(run, SCHEMA)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            out = []
            for doc, text, item, wording in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "item_id", "wording")), strict=True):
                items = Items([(item, wording)], seed, coverage)
                out += [report(doc, items, i, covered, tiles) for _, i, covered, tiles in _leaks(pa.array([text], pa.string()), items, coverage, least)]
            if out:
                yield batch(out)

    keyed = docs.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    pairs = _pairs(keyed, benchmark, seed, coverage)
    return (keyed.join(pairs, "text_key").join(benchmark.withColumnRenamed("text", "wording"), "item_id")
            .select("doc_id", "text", "item_id", "wording").mapInArrow(verify, SCHEMA))


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, least: int = LEAST_TILE,
                  text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, of texts without a leak."""
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = _small(benchmark)
    if rows is not None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(rows, min(seed, least), coverage)
            for piece in T.pieces(batches, text_col):
                keep = np.ones(piece.num_rows, bool)
                for d, *_ in _leaks(piece.column(text_col), items, coverage, least):
                    keep[d] = False
                yield piece.filter(pa.array(keep))

        return docs.mapInArrow(run, docs.schema)
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    bad = find_leaks(docs.select(key.alias("k"), F.col(text_col).alias("t")).distinct(), benchmark, coverage, seed, least, "k", "t")
    leak = free_name(docs, "_leak_key")
    bad = bad.select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(bad, key == F.col(leak), "left_anti")
