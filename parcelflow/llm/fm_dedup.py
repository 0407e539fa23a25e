"""Substring dedup with a compressed FM-index per shard.

A window is ``window`` consecutive words of one document; a word goes when a
window over it also starts in a document with a smaller id. Only equal windows
matter, so documents are cut where equal windows cut alike: the least hash of
the 8-word grams in a window is its anchor, and a run of windows with one
anchor is a segment. Equal windows have equal anchors.

1. One pass over the texts hashes words and lists each document's segments.
2. Anchors seen in one document only are dropped; equal segments are one unit,
   which knows the smallest document that holds it.
3. Units, with their words, are dealt to shards by anchor. A shard builds an
   FM-index of its units and streams them through it by backward search over
   the wavelet tree, each unit once for all documents that hold it, whose words
   are the same. The matching statistics say at which positions a match reaches
   the window length, and the group of equal windows there has a smallest
   document.
4. A document loses the words under the windows whose group, by those
   statistics, has a smaller document: of its units' holders the first one those
   with a document before it, every later one all that the search found. Texts
   are joined only for documents with candidates.

An anchor with more than ``crowded`` different units (a passage in a large share
of the documents, each in other surroundings) would crowd a shard: its windows
are dealt one by one by their own hash instead, after those of one document only
are dropped, so that each distinct window is one row. Such anchors are counted and
joined, never collected.

Defined results: a null text has no words; fewer words than the window, nothing
goes; a document's own repeats stay; rows that repeat an id are judged each by
its own text and never against each other; a row without an id loses nothing
and causes no loss. Other columns are ignored; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.fm_index import FMIndex
from parcelflow.llm.frames import keyed, staged

WINDOW = 50
GRAM = 8
RUN = 64
SHARD_WORDS = 400_000
#: An anchor's units are dealt by window above this number.
CROWDED = 2000

_SEGMENT = "struct<anchor:long,seg:long,start:int,n:int>"
_KEY = ["anchor", "seg", "n"]


def window_anchors(h: np.ndarray, window: int) -> np.ndarray:
    """Least gram hash of the window that starts at each word (text ends
    ignored), by prefix and suffix minima of blocks."""
    k = min(GRAM, window)
    g, width = T.gram_hash(h, k), window - k + 1
    if len(g) < width:
        return np.zeros(0, np.uint64)
    pad = np.concatenate([g, np.full(-len(g) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(pad, axis=1).ravel()
    back = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(g) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def segments(words: T.Words, h: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Document, anchor, hash, first word in the document and number of windows
    of every segment of a piece."""
    at = np.flatnonzero(words.left() >= window)
    anchor = window_anchors(h, window)[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(new)
    inside = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(inside % RUN == 0)
    n = np.diff(np.append(begin, len(at)))
    first = at[begin]
    doc = words.doc[first]
    return doc, anchor[begin], T.hash_runs(h, first, first + n + window - 1), first - words.first[doc], n


def plain_texts(words: T.Words) -> tuple[memoryview, np.ndarray]:
    """Every text's words joined by one space, as bytes with offsets."""
    more = np.arange(len(words.starts)) + 1 < words.first[words.doc + 1]
    gap = words.ends[more]
    data, keep = words.data.copy(), words.inside.copy()
    data[gap] = 0x20
    keep[gap] = True
    total = np.concatenate([[0], np.cumsum(keep)])
    return memoryview(data[keep].tobytes()), total[words.offsets]


def _words(piece: pa.RecordBatch, column: str = "text") -> T.Words:
    data, off = T.text_buffer(piece.column(column))
    return T.Words(data, off, T.NON_SPACE)


def index_documents(docs: DataFrame, window: int) -> DataFrame:
    """Per row: words, digest of the whole text, and segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            words = _words(piece)
            doc, anchor, seg, start, n = segments(words, words.hashes(), window)
            known = ~np.asarray(piece.column("doc_id").is_null())[doc]
            doc, anchor, seg, start, n = (x[known] for x in (doc, anchor, seg, start, n))
            text, off = plain_texts(words)
            sha = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            rows = pa.StructArray.from_arrays([pa.array(T.signed(anchor)), pa.array(T.signed(seg)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                                              names=["anchor", "seg", "start", "n"])
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("tkey"), pa.array(words.counts, pa.int64()), pa.array(sha, pa.string()),
                 T.lists(rows, np.bincount(doc, minlength=len(words.counts)))], names=["doc_id", "tkey", "n_words", "sha", "segs"])

    return docs.mapInArrow(run, f"doc_id long, tkey long, n_words long, sha string, segs array<{_SEGMENT}>")


def crowded_windows(rows: DataFrame, window: int) -> DataFrame:
    """The windows of the listed segments, as segments of one window each with an
    anchor of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            words = _words(piece)
            h = words.hashes()
            each = piece.column("segs")
            of = np.repeat(np.arange(piece.num_rows), np.diff(each.offsets.to_numpy()))
            start, n = (each.flatten().field(c).to_numpy() for c in ("start", "n"))
            doc = np.repeat(of, n)
            at = np.repeat(words.first[of] + start, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            code = T.hash_runs(h, at, at + window)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id").take(pa.array(doc)), piece.column("tkey").take(pa.array(doc)), pa.array(T.signed(T.mix64(code + np.uint64(1)))),
                 pa.array(T.signed(code)), pa.array((at - words.first[doc]).astype(np.int32)), pa.array(np.ones(len(at), np.int32))],
                names=["doc_id", "tkey", "anchor", "seg", "start", "n"])

    return rows.mapInArrow(run, "doc_id long, tkey long, anchor long, seg long, start int, n int")


def unit_words(lists: DataFrame, window: int) -> DataFrame:
    """Each listed unit with its words, cut from its document's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            words = _words(piece)
            each = piece.column("units")
            doc = np.repeat(np.arange(piece.num_rows), np.diff(each.offsets.to_numpy()))
            u = each.flatten()
            start, n = (u.field(c).to_numpy() for c in ("start", "n"))
            first = words.first[doc] + start
            a, b = words.starts[first], words.ends[first + n + window - 2]
            raw = memoryview(words.data.tobytes())
            yield pa.RecordBatch.from_arrays(
                [u.field("anchor"), u.field("seg"), u.field("n"), piece.column("doc_id").take(pa.array(doc)),
                 pa.array([bytes(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())],
                names=["anchor", "seg", "n", "low", "words"])

    return lists.mapInArrow(run, "anchor long, seg long, n int, low long, words binary")


def search_shard(units: DataFrame, window: int) -> DataFrame:
    """Per unit the intervals of its windows that the index holds: ``spans``,
    also for a document smaller than the unit's first, and ``found``, at all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks().to_batches()[0]
        words = _words(table.set_column(4, "text", table.column("words").cast(pa.string())))
        _, code = np.unique(words.hashes(), return_inverse=True)
        first, low = words.first, table.column("low").to_numpy()
        index = FMIndex(code, first, window)
        group = index.matches(code, first)
        least = index.group_minimum(low)
        unit = np.repeat(np.arange(len(low)), np.diff(first))
        smallest = np.where(group >= 0, least[np.maximum(group, 0)], np.iinfo(np.int64).max)

        def intervals(hit: np.ndarray) -> pa.Array:
            at = np.flatnonzero(hit)
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1] + 1) | (unit[at[1:]] != unit[at[:-1]])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(at)))
            s = at[begin] - first[unit[at[begin]]]
            spans = pa.StructArray.from_arrays([pa.array(s.astype(np.int32)), pa.array((s + size).astype(np.int32))], names=["s", "e"])
            return T.lists(spans, np.bincount(unit[at[begin]], minlength=len(low)))

        yield pa.RecordBatch.from_arrays([*table.columns[:4], intervals(smallest < low[unit]), intervals(smallest <= low[unit])],
                                         names=["anchor", "seg", "n", "low", "spans", "found"])

    span = "array<struct<s:int,e:int>>"
    return units.mapInArrow(run, f"anchor long, seg long, n int, low long, spans {span}, found {span}")


def remove_covered(rows: DataFrame) -> DataFrame:
    """Digest of the kept words of each text, given its intervals of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            out = []
            for text, cut in zip(piece.column("text").to_pylist(), piece.column("cut").to_pylist(), strict=True):
                words = text.encode().split()
                gone = np.zeros(len(words), bool)
                for c in cut:
                    gone[c["s"] : c["e"]] = True
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("tkey"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
                names=["doc_id", "tkey", "n_removed", "kept"])

    return rows.mapInArrow(run, "doc_id long, tkey long, n_removed long, kept string")


def _rows_of(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """The texts of the listed (doc_id, tkey), one row each, with their lists."""
    ids = lists.select("doc_id", "tkey")
    return texts.join(keyed(ids, ids.count()), ["doc_id", "tkey"], "left_semi").dropDuplicates(["doc_id", "tkey"]).join(lists, ["doc_id", "tkey"])


def dedup_windows(docs: DataFrame, window: int = WINDOW, crowded: int = CROWDED, shard_words: int = SHARD_WORDS,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tkey", F.xxhash64("text"))
    rows = staged(index_documents(texts, window), "segments")
    parts = rows.select("doc_id", "tkey", F.inline("segs"))
    shared = parts.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("anchor")
    places = staged(parts.join(shared, "anchor").select("doc_id", "tkey", *_KEY, "start"), "places")

    def distinct(p: DataFrame) -> DataFrame:
        return p.groupBy(*_KEY).agg(F.min(F.struct("doc_id", "tkey", "start")).alias("rep"), F.max("doc_id").alias("hi"))

    units = staged(distinct(places), "units")
    hot = staged(units.groupBy("anchor").count().where(F.col("count") > crowded).select("anchor"), "crowded-anchors")
    n_hot = hot.count()
    if n_hot:
        hot = keyed(hot, n_hot)
        segs = staged(places.join(hot, "anchor", "left_semi").select("doc_id", "tkey", "start", "n").distinct()
                      .groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("start", "n")).alias("segs")), "crowded-segments")
        single = staged(crowded_windows(_rows_of(texts, segs).select("doc_id", "tkey", "text", "segs"), window), "crowded-windows")
        held = staged(single.groupBy("anchor", "seg", "n").agg(F.min(F.struct("doc_id", "tkey", "start")).alias("rep"), F.max("doc_id").alias("hi"))
                      .where("rep.doc_id <> hi"), "windows")
        places = places.join(hot, "anchor", "left_anti").unionByName(single.join(held.select(*_KEY), _KEY).select("doc_id", "tkey", *_KEY, "start"))
        units = staged(units.join(hot, "anchor", "left_anti").unionByName(held), "all-units")
    need = units.agg(F.coalesce(F.sum(F.col("n") + window - 1), F.lit(0))).first()[0]
    lists = staged(units.groupBy("rep.doc_id", "rep.tkey").agg(F.collect_list(F.struct("anchor", "seg", F.col("rep.start").alias("start"), "n")).alias("units")), "unit-lists")
    worded = unit_words(_rows_of(texts, lists).select("doc_id", "text", "units"), window)
    found = staged(search_shard(worded.repartition(max(1, -(-need // shard_words)), "anchor"), window), "found")
    later = F.col("doc_id") > F.col("low")
    spans = F.when(later, F.col("found")).otherwise(F.col("spans"))
    cut = (places.join(found, _KEY).select("doc_id", "tkey", "start", F.explode(spans).alias("x"))
           .select("doc_id", "tkey", (F.col("start") + F.col("x.s")).alias("s"), (F.col("start") + F.col("x.e") + window - 1).alias("e")))
    cuts = staged(cut.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("s", "e")).alias("cut")), "cuts")
    done = remove_covered(_rows_of(texts, cuts))
    return rows.select("doc_id", "tkey", "n_words", "sha").join(done, ["doc_id", "tkey"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))
