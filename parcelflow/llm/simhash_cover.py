"""SimHash near duplicates by anchor points of a covering code.

Fingerprints: A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, and each run
of three words (repeats included, joined by a space; a shorter text is one run)
is hashed by XXH64 with seed 42. A bit is 1 if more than half of the hashes have
it. Spark makes the hashes, numpy counts the votes.

Anchors: the fingerprint's first 46 bits are two blocks of 23, and the anchors are
the pairs of words of the perfect binary Golay code (2^12 words of length 23,
covering radius 3), 2^24 in all. Every fingerprint is within the covering radius,
6, of its home, the nearest anchor. If two fingerprints differ in 3 bits at most,
the one lies within 6 + 3 = 9 of the other's home. So each fingerprint is
replicated to every anchor within 9 (about 340 of the 16.8 million), and an anchor
compares the fingerprints at home there with all that visit it: no pair is lost.
In this code the number of words at each distance depends only on the distance to
the nearest one, so all replicas of a batch are one table look-up.

Replicas travel as sorted blocks of 12 bytes each. The buckets (hash of an anchor)
follow the counted fingerprints. Each anchor's visitors are dealt over four
buckets, its homes copied to them; an anchor that is home to more than
``CROWD`` fingerprints has its homes dealt over chunks too and its visitors copied
to these, so no task holds a crowd; its comparisons grow with the square of the
crowd. Comparing is xor and a bit count over arrays; only a spanning forest of the
links of a bucket leaves it.

Defined results: a null text is an empty one; texts without words have
fingerprint 0, linked like any other; every row is judged by its own text, repeated
rows too; a component is named by its smallest id, null if none of its rows has
one; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import components, keyed, small_batches, staged

#: Generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011
LENGTH, REDUNDANT, RADIUS = 23, 11, 3
#: Fingerprints at home in one anchor from which on they are dealt over chunks.
CROWD = 65_536
#: Buckets that an anchor's visitors are dealt over; replicas of a bucket.
SALTS, BUCKET_ENTRIES = 4, 2_000_000
#: Fingerprints whose replicas are made at a time; pairs compared at a time; hashes voted at a time.
FLUSH, PAIRS, VOTES = 4096, 2_000_000, 1 << 17
REPLICAS = 340
_U = np.uint64


def _word_hashes(text: Column, shingle: int) -> Column:
    """XXH64 of each run of words; ``text`` is the array of words."""
    size = F.size(text)
    run = lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(text, i + j) for j in range(shingle)]))
    return (F.when(size == 0, F.array().cast("array<long>")).when(size < shingle, F.array(F.xxhash64(F.array_join(text, " "))))
            .otherwise(F.transform(F.sequence(F.lit(0), size - shingle), run)))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("h")
        off = np.asarray(column.offsets, np.int64) - column.offsets[0].as_py()
        h = np.asarray(column.flatten()).view(_U)
        votes = np.zeros((len(column), 64), np.int64)
        for low in range(0, len(h), VOTES):
            high = min(low + VOTES, len(h))
            first, last = np.searchsorted(off, low, "right") - 1, np.searchsorted(off, high, "left")
            docs = np.arange(first, last)
            docs = docs[off[docs + 1] > np.maximum(off[docs], low)]  # with a hash here
            bits = np.unpackbits(h[low:high].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            votes[docs] += np.add.reduceat(bits, np.maximum(off[docs], low) - low, axis=0, dtype=np.int64)
        ones = votes * 2 > np.diff(off)[:, None]
        prints = np.packbits(ones, axis=1).view(">u8").ravel().astype(_U)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(T.signed(prints))], names=["doc_id", "print"])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print) of each row."""
    small_batches(docs.sparkSession)
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.regexp_extract_all(lower, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("w"))
    return words.select("doc_id", _word_hashes(F.col("w"), shingle).alias("h")).mapInArrow(_vote, "doc_id long, print long")


class Cover:
    """The anchors within ``RADIUS * 2 + bits`` of a fingerprint."""

    def __init__(self, bits: int):
        reach = 2 * RADIUS + bits
        self.low = self._remainders(1 << 12)
        self.high = self._remainders(1 << 11, 12)
        words = np.arange(1 << 12, dtype=np.uint32) << REDUNDANT
        words |= self.syndrome(words)
        self.leader = np.zeros(1 << REDUNDANT, np.uint32)
        single = np.uint32(1) << np.arange(LENGTH, dtype=np.uint32)
        errors = np.array([0], np.uint32)
        for _ in range(RADIUS):  # every syndrome is that of one error of up to three bits
            errors = np.unique((errors[:, None] ^ single).ravel())
            light = errors[np.bitwise_count(errors) <= RADIUS]
            self.leader[self.syndrome(light)] = light
        far = np.bitwise_count(self.leader[:, None] ^ words)
        self.near = np.argsort(far, axis=1, kind="stable").astype(np.uint16)  # code words by distance
        self.weight = np.bitwise_count(self.leader)
        self.spread = {}
        first = [int(np.flatnonzero(self.weight == w)[0]) for w in range(RADIUS + 1)]
        upto = [np.searchsorted(np.sort(far[s]), np.arange(reach + 2)) for s in first]
        for a in range(RADIUS + 1):
            for b in range(RADIUS + 1):
                pairs = [(i, j) for d in range(reach + 1) for i in range(upto[a][d], upto[a][d + 1]) for j in range(upto[b][reach - d + 1])]
                self.spread[a, b] = tuple(np.array(x, np.int64) for x in zip(*sorted(pairs, key=lambda x: x != (0, 0)), strict=True))

    @staticmethod
    def _remainders(n: int, shift: int = 0) -> np.ndarray:
        """Remainder of each polynomial below ``n`` times x^shift."""
        out = np.arange(n, dtype=np.uint32) << np.uint32(shift)
        for bit in range(LENGTH - 1, REDUNDANT - 1, -1):
            out = np.where(out >> bit & 1, out ^ np.uint32(GOLAY << (bit - REDUNDANT)), out)
        return out

    def syndrome(self, word: np.ndarray) -> np.ndarray:
        return self.low[word & 0xFFF] ^ self.high[word >> 12]

    def _blocks(self, prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of both blocks: the syndrome and the nearest code word's number."""
        out = []
        for shift in (0, LENGTH):
            word = (prints >> _U(shift) & _U((1 << LENGTH) - 1)).astype(np.uint32)
            s = self.syndrome(word)
            out.append((s, (word ^ self.leader[s]) >> REDUNDANT))
        return out

    def homes(self, prints: np.ndarray) -> np.ndarray:
        (_, a), (_, b) = self._blocks(prints)
        return (a << np.uint32(12) | b).astype(np.uint32)

    def anchors(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the fingerprint, anchor) of all replicas."""
        (s, a), (t, b) = self._blocks(prints)
        at, anchor = [], []
        for (u, v), (i, j) in self.spread.items():
            rows = np.flatnonzero((self.weight[s] == u) & (self.weight[t] == v))
            left = a[rows][:, None] ^ self.near[s[rows]][:, i]
            right = b[rows][:, None] ^ self.near[t[rows]][:, j]
            at.append(np.repeat(rows, len(i)))
            anchor.append((left << np.uint32(12) | right).ravel().astype(np.uint32))
        return np.concatenate(at), np.concatenate(anchor)


@cache
def cover(bits: int) -> Cover:
    return Cover(bits)


def _homes(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.asarray(batch.column("print")).view(_U)
            yield pa.RecordBatch.from_arrays([batch.column("print"), pa.array(cover(bits).homes(prints).astype(np.int32))], names=["print", "home"])
    return run


def _replicas(bits: int, slots: int, chunks: dict[int, int]):
    """Blocks (bucket, home, anchors, prints), sorted by anchor. ``chunks`` has the
    number of chunks of each crowded anchor."""
    crowded = np.array(sorted(chunks), np.uint32)
    number = np.array([chunks[c] for c in sorted(chunks)], np.int64)

    def dealt(anchor: np.ndarray) -> np.ndarray:
        if not len(crowded):
            return np.ones(len(anchor), np.int64)
        at = np.minimum(np.searchsorted(crowded, anchor), len(crowded) - 1)
        return np.where(crowded[at] == anchor, number[at], 1)

    def blocks(anchor, prints, chunk, salt, home):
        slot = T.mix64(anchor.astype(_U) << _U(32) | chunk.astype(_U) << _U(16) | (salt // SALTS).astype(_U)) % _U(slots)
        bucket = slot.astype(np.int64) * SALTS + salt % SALTS
        order = np.lexsort((anchor, bucket))
        bucket, anchor, prints = bucket[order], anchor[order], prints[order]
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(first[1:], len(bucket))
        cut = lambda x, w: pa.array([x[a:b].tobytes() for a, b in zip(first, ends, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.array([home] * len(first)), cut(anchor, 4), cut(prints, 8)],
                                         names=["bucket", "home", "anchors", "prints"])

    def copies(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each index n times, with a running number."""
        at = np.repeat(np.arange(len(n)), n)
        return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, FLUSH):
                prints = np.asarray(batch.column("print").slice(low, FLUSH)).view(_U)
                own = T.mix64(prints)
                home = cover(bits).homes(prints)
                k = dealt(home)
                at, salt = copies(SALTS * k)
                yield from blocks(home[at], prints[at], (own % k.astype(_U)).astype(np.int64)[at], salt, True)
                at, anchor = cover(bits).anchors(prints)
                k = dealt(anchor)
                more, chunk = copies(k)
                salt = (own[at] >> _U(20)) % (SALTS * k).astype(_U)
                yield from blocks(anchor[more], prints[at[more]], chunk, salt.astype(np.int64)[more], False)
    return run


def forest(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (smallest node known of each) after joining nodes a and b."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return label


def _compare(bits: int):
    def run(table: pa.Table) -> pa.Table:
        def read(home: bool) -> tuple[np.ndarray, np.ndarray]:
            rows = table.filter(pa.compute.equal(table["home"], home))
            anchor = np.frombuffer(b"".join(rows["anchors"].to_pylist()), np.uint32)
            prints = np.frombuffer(b"".join(rows["prints"].to_pylist()), _U)
            order = np.argsort(anchor, kind="stable")
            return anchor[order], prints[order]

        at_home, host = read(True)
        anchor, guest = read(False)
        start = np.searchsorted(at_home, anchor, "left")
        n = np.searchsorted(at_home, anchor, "right") - start
        guest, start, n = guest[n > 0], start[n > 0], n[n > 0]
        nodes = np.unique(np.concatenate([host, guest]))
        label = np.arange(len(nodes))
        host_at, guest_at = np.searchsorted(nodes, host), np.searchsorted(nodes, guest)
        upto = np.concatenate([[0], np.cumsum(n)])
        for low in range(0, int(upto[-1]), PAIRS):
            pair = np.arange(low, min(low + PAIRS, int(upto[-1])))
            g = np.searchsorted(upto, pair, "right") - 1
            h = start[g] + pair - upto[g]
            close = np.bitwise_count(guest[g] ^ host[h]) <= bits
            label = forest(guest_at[g[close]], host_at[h[close]], label)
        linked = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"a": T.signed(nodes[linked]), "b": T.signed(nodes[label[linked]])})
    return run


def links(prints: DataFrame, bits: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints that keep every component of
    those within ``bits`` of each other."""
    homes = staged(prints.select("print").distinct().mapInArrow(_homes(bits), "print long, home int"), "prints")
    # at most 1 / crowd of the fingerprints, and no more than there are anchors
    crowds = homes.groupBy("home").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).collect()
    replicas = homes.count() * REPLICAS
    slots = max(1, -(-replicas // (SALTS * BUCKET_ENTRIES)))
    # a fingerprint makes a few KB of replicas, so the few files of the prints are dealt over more tasks
    spread = homes.select("print").repartition(max(1, -(-replicas // BUCKET_ENTRIES)), "print")
    blocks = spread.mapInArrow(_replicas(bits, slots, {r.home: -(-r.n // crowd) for r in crowds}),
                               "bucket long, home boolean, anchors binary, prints binary")
    return blocks.groupBy("bucket").applyInArrow(_compare(bits), "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = 3, shingle: int = 3, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row."""
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    group = components(links(prints, bits, crowd))
    lowest = prints.groupBy("print").agg(F.min("doc_id").alias("low"))
    lowest = staged(lowest.join(group, lowest["print"] == group["node"], "left").select("print", "low", F.coalesce("component", "print").alias("root")), "roots")
    named = lowest.groupBy("root").agg(F.min("low").alias("component_id"))
    rows = lowest.count()
    named = staged(lowest.select("print", "root").join(keyed(named, rows), "root").select("print", "component_id"), "component-ids")
    return (prints.join(keyed(named, rows), "print")
            .select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"))
