"""Document fingerprints from Lempel-Ziv phrases.

A text's words (longest runs of non-space characters, cut after 16 code points)
are parsed LZ78-style: the longest phrase already in the dictionary plus one
word is the next phrase. The phrases' 64-bit hashes are a set; 128 minimum
hashes of it, 16 bits each in base 64, are the fingerprint. The likeness of two
fingerprints is the share of equal minima, an estimate of the Jaccard
similarity of the phrase sets: texts that compress each other share phrases.

Defined results: null and empty texts have the empty phrase set, whose
fingerprint is the same for all of them (likeness 1 to each other). Rows stand
in descending doc_id, null ids last, rows of equal id by text; "next" wraps
around, so the only row of a table is its own next. Other columns are ignored;
an empty table gives an empty table.

The order needs no single task: bounds taken from the ids cut them into ranges,
each range's highest document is also sent to the range above as its tail, and
a task streams its sorted ranges with one document of look-ahead.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T

MINIMA = 128
_WORD = re.compile(r"\S{1,16}")
_SPACE = re.compile(r"\s")
_seeds = T.mix64(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
_FACTOR = (_seeds[:MINIMA] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (_seeds[MINIMA:] >> np.uint64(32)).astype(np.uint32)
_BLOCK = 1024
_NONE = np.full(MINIMA, 0xFFFFFFFF, np.uint32)

LOWEST = -(1 << 63)
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def phrases(words: list[str], seen: set[int], at: int = 0) -> tuple[list[int], int]:
    """Hashes of the new phrases of ``words`` given the dictionary ``seen``
    (which grows) and the open phrase ``at``; and the phrase left open. A
    phrase's hash is its last word's, seeded with the hash of the rest."""
    new = []
    for w in words:
        h = xxhash.xxh64_intdigest(w, at)
        if h in seen:
            at = h
        else:
            seen.add(h)
            new.append(h)
            at = 0
    return new, at


def minima(hashes: list[int]) -> np.ndarray:
    low = _NONE.copy()
    h = (np.array(hashes, np.uint64) >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(h), _BLOCK):
        np.minimum(low, (h[i : i + _BLOCK, None] * _FACTOR + _SHIFT).min(axis=0), out=low)
    return low


def signature(text: str) -> np.ndarray:
    return minima(phrases(_WORD.findall(text), set())[0]).astype(np.uint16)


def encode(sig: np.ndarray) -> str:
    return base64.b64encode(sig.astype("<u2").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.count_nonzero(a == b)) / MINIMA


def edit(text: str, following: str) -> tuple[str, int]:
    """The text with its last third replaced by as much of the next one's
    start; and how many leading code points are unchanged."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k], len(text) - k


def both_signatures(text: str, following: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Signatures of the text and of its edited text. Their common start up to
    a space is parsed once; the two ends go on from its dictionary."""
    edited, kept = edit(text, following)
    cut = kept
    while cut and not text[cut - 1].isspace():
        cut -= 1
    seen: set[int] = set()
    shared, at = phrases(_WORD.findall(text, 0, cut), seen)
    low, other = minima(shared), set(seen)
    own = np.minimum(low, minima(phrases(_WORD.findall(text, cut), seen, at)[0]))
    new = np.minimum(low, minima(phrases(_WORD.findall(edited, cut), other, at)[0]))
    return own.astype(np.uint16), new.astype(np.uint16), edited


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            sigs = [encode(signature(t or "")) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sigs, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


def _ranges(rows: DataFrame, n: int) -> tuple[list[int], int]:
    """At most ``n`` ids that bound ranges of about equal counts, each an id of
    the table; and the highest id."""
    got = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n).alias("b"), F.max("key").alias("m")).first()
    return (sorted(set(got.b) - {got.m}), got.m) if got.m is not None else ([], LOWEST)


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness and
    that to the next document's."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"))
    bounds, top = _ranges(rows.select("key"), 4 * parts)
    edges = np.array(bounds, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            key = piece.column("key").to_numpy()
            at = np.searchsorted(edges, key)
            row = np.arange(len(key))
            tail = row[np.isin(key, edges)]  # its range's highest: ends the range above
            wrap = row[key == top]  # ends the lowest range
            take = np.concatenate([row, tail, wrap])
            range_no = np.concatenate([at, at[tail] + 1, np.zeros(len(wrap), np.int64)]).astype(np.int32)
            order = np.concatenate([np.zeros(len(row)), np.ones(len(tail)), np.full(len(wrap), 2)]).astype(np.int32)
            out = piece.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(range_no), pa.array(order)], names=["doc_id", "text", "key", "range", "tail"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last = None  # (range, doc_id, text), its next one not yet seen
        waiting = None  # a row that lacks only the next one's signature
        done = None  # range whose tail has come

        def close(sig: np.ndarray) -> None:
            nonlocal waiting
            if waiting is not None:
                doc, n, sha, own, new = waiting
                out.append((doc, n, sha, encode(own), encode(new), likeness(own, new), likeness(own, sig)))
                waiting = None

        for piece in T.pieces(batches):
            for doc, text, at, tail in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "range", "tail")), strict=True):
                if tail and done == at:
                    continue  # repeated rows of the bounding id: the first is the next one
                text = text or ""
                if last is not None:
                    own, new, edited = both_signatures(last[2], text)
                    close(own)
                    waiting = (last[1], len(last[2]), hashlib.sha256(edited.encode()).hexdigest(), own, new)
                if tail:
                    close(signature(text))
                    last, done = None, at
                else:
                    last = (at, doc, text)
                if len(out) >= 1000:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    dealt = rows.mapInArrow(deal, "doc_id long, text string, key long, range int, tail int")
    return dealt.repartition(parts, "range").sortWithinPartitions("range", "tail", F.desc("key"), "text").mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=[x.split()[0] for x in SCHEMA.split(", ")])
