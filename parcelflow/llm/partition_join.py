"""Jaccard self-join on word shingles by universe partition and pigeonhole.

A text's set is its distinct runs of ``shingle`` words (a shorter text is one
shingle), each hashed to a position of a universe of 2**52. Two sets with
Jaccard similarity of ``percent`` or more, sizes x and y, differ in at most
H = (x + y)(100 - percent) / (100 + percent) elements.

Size bands: a band's upper bound is the largest partner of the band below, so
partners lie in one band or in neighbours. Scheme k, for pairs whose smaller set
is in band k, cuts the universe into m segments, one more than its largest
difference; a set emits the hash of its part in each segment, and a pair within
the bound has at least one equal part. A set needs only the first U = H + 1
segments for its own largest H: that allocation goes by its own size, and both
sets of a pair hold at least as many as the pair needs.

An empty part says nothing and would gather strangers, so it is not indexed; it
costs one unit of the pigeonhole. A set with E empty parts pays by one-deletion
neighbourhoods (a part less any one element) of E of its parts with two or more
elements: the first E in the scheme's allocation order, cheapest first by the
counted frequencies of the signatures in each segment (``segment_costs``, over
all documents). No pair within the bound is lost, at any size and for any order:
let both sets lack e parts, let c parts be empty in one and hold two or more in
the other, and let no whole part be equal. Fewer differences than segments leave
fewer than e - c of the parts that both hold with two or more differences, so one
of the first e - c of these in the order differs in one element; before it, its
larger side has fewer than e - c such parts and at most c that the other lacks, so
it is among that side's first E. Where too few parts are held by both, 2 E + S
exceeds the number of segments in both sets (S: parts of one element); such sets
index their empty parts after all. The order is by cost among the segments that
all sets of the scheme use, and by position in the others, so it is the same for
both sets of a pair whatever their number of segments.

Signatures travel as sorted blocks of bytes, one per mapper flush and slot of
the signature range, and a slot's blocks are merged in one task to find the
signatures of several sets. Of equal signatures in a flush only one goes to the
slot; all of them are known to share a bucket, so they go on as bucket rows. A
signature that a third of all sets have is thus one row per flush.

Candidates are verified exactly, on the words of both texts. Equal sets count
as one class, found by grouping. Within an index bucket not all pairs are made:
first each member meets the smallest member of its buckets; then only members
of different components meet, pair by pair in small buckets. In crowded buckets
only members that chains of likely pairs connect (``likely_links``) are joined
block by block (``crowded_links``), which returns only links that join
components. A pair is likely if the sketches of its sets, bits that differ in no
more places than the sets, allow a link; only texts of likely pairs are moved, for
strangers that share a part grow faster than the documents. So no link between
components is lost.

Defined results: a null text is an empty one; texts without words have an empty
set, link with nothing and are their own component; a row without an id takes
part in no link and has a null component; rows that repeat an id are one node,
which has the links of each of its texts; ``keep_one`` judges each row by itself.
Other columns are ignored, or kept by ``keep_one``; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import components, free_name, keyed, small_batches, staged

_UNIVERSE = 52
#: Signatures have 56 bits; the low byte, of eight that travel, is empty.
_SIGNATURE = np.uint64(0xFFFFFFFFFFFFFF00)
#: Segments of all schemes are counted in so many slots, of so many counters.
SLOTS, COUNTERS = 4096, 16
#: Signatures that a mapper sorts and sends at a time.
FLUSH = 500_000
#: Pairs per bucket row up to which a bucket's pairs are made as rows.
PAIRS_PER_ROW = 4
#: Bounds of a block in a crowd.
BLOCK_SETS, BLOCK_ELEMENTS = 2000, 1_500_000
#: Least bits of a sketch, and words of 64 bits of sketches compared at a time.
SKETCH_BITS, SKETCH_WORDS = 256, 1 << 21
_COLUMNS = 4096
_LONG = (1 << 63) - 1


class Bands:
    """Size bands and schemes for one similarity bound."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        self.reach(1 << 16)

    def reach(self, size: int) -> None:
        while self.low[-1] <= size * 200 // self.percent + 1:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        self.bounds = np.array(self.low, np.int64)

    def differ(self, total):
        """Largest symmetric difference of two sets with ``total`` elements."""
        return total * (100 - self.percent) // (100 + self.percent)

    def partner(self, size):
        """Largest partner."""
        return size * 100 // self.percent

    def segments(self, k: np.ndarray) -> np.ndarray:
        top = self.bounds[k + 1] - 1
        return self.differ(top + self.partner(top)) + 1

    def common(self, k: np.ndarray) -> np.ndarray:
        """Segments that every set of the scheme uses, but for sets that only
        equal ones can match."""
        low, top = self.bounds[k], self.bounds[k + 1] - 1
        return np.maximum(self.differ(np.minimum(low + self.partner(low), 2 * top + 1)) + 1, 2)


def shingle_keys(words: T.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct (text << 52 | element) keys, and the number of each text."""
    h = words.hashes()
    left = words.left()
    at = np.flatnonzero(left >= k)
    doc, value = [words.doc[at]], [T.gram_hash(h, k)[at]]
    for short in range(1, k):  # the whole sequence of a text with fewer words
        at = words.first[:-1][words.counts == short]
        doc.append(words.doc[at])
        value.append(T.mix64(T.gram_hash(h, short)[at] + np.uint64(short)))
    key = np.unique(np.concatenate(doc).astype(np.uint64) << np.uint64(_UNIVERSE) | np.concatenate(value) >> np.uint64(64 - _UNIVERSE))
    return key, np.bincount((key >> np.uint64(_UNIVERSE)).astype(np.int64), minlength=len(words.counts))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


class Parts:
    """The parts of all sets of a piece in the schemes of their own band
    (``back`` 0) or the band below (1)."""

    def __init__(self, element: np.ndarray, doc: np.ndarray, n: np.ndarray, bands: Bands, back: int):
        bands.reach(int(n.max(initial=1)))
        band = np.searchsorted(bands.bounds, n, "right") - 1
        self.k = np.maximum(band - back, 0)
        top = bands.bounds[self.k + 1] - 1
        largest = bands.partner(n) if back == 0 else np.minimum(top, n)
        self.units = bands.differ(n + largest) + 1
        if back:  # the partner is in the band below
            self.units[(band < 1) | (top * 100 < n * bands.percent)] = 0
        self.units[n == 0] = 0
        self.units[self.units == 1] = 0  # only equal sets, which grouping finds
        m = bands.segments(self.k)
        segment = ((element >> np.uint64(_UNIVERSE - 32)) * m[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        take = np.flatnonzero(segment < self.units[doc])
        d, s = doc[take], segment[take]
        self.weight = T.mix64(element[take] + np.uint64(1))
        new = np.ones(len(take), bool)
        new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
        starts = np.flatnonzero(new)
        self.run = np.cumsum(new) - 1  # of each element its part
        self.size = np.diff(np.append(starts, len(take)))
        self.doc, self.segment, self.total = d[starts], s[starts], _sums(self.weight, starts)
        self.label = self.labels(self.k[self.doc], self.segment)
        self.empty = self.units - np.bincount(self.doc, minlength=len(n))

    @staticmethod
    def labels(k: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return T.mix64((k + 1).astype(np.uint64) << np.uint64(40) | segment.astype(np.uint64))

    def whole(self) -> np.ndarray:
        return T.mix64(self.total + self.label)

    def neighbours(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(part, signature) of the one-deletion neighbourhoods of the parts
        marked."""
        at = np.flatnonzero(parts[self.run])
        run = self.run[at]
        return run, T.mix64(self.total[run] - self.weight[at] + self.label[run])

    def slot(self) -> np.ndarray:
        return (self.label % np.uint64(SLOTS)).astype(np.int64)

    def allocated(self, bands: Bands, costs: np.ndarray) -> np.ndarray:
        """Marks of the parts whose neighbourhoods pay for their sets' empty
        parts."""
        at = np.flatnonzero((self.size > 1) & (self.empty[self.doc] > 0))
        d, s = self.doc[at], self.segment[at]
        late = s >= bands.common(self.k[d])
        at = at[np.lexsort((s, np.where(late, 0, costs[self.slot()[at]]), late, d))]
        d = self.doc[at]
        rank = np.arange(len(at)) - np.searchsorted(d, d)
        marks = np.zeros(len(self.doc), bool)
        marks[at[rank < self.empty[d]]] = True
        return marks

    def hollow(self, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
        """(text, signature) of the empty parts of sets that crowd into few
        segments."""
        single = np.bincount(self.doc[self.size == 1], minlength=len(self.units))
        least = bands.common(self.k)
        out_doc, out_sig = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for i in np.flatnonzero((self.empty > 0) & (2 * self.empty + single > np.minimum(least, self.units))).tolist():
            a, b = np.searchsorted(self.doc, (i, i + 1))
            held = np.zeros(self.units[i], np.int64)
            held[self.segment[a:b]] = self.size[a:b]
            short = np.cumsum(np.where(held == 0, 2, held == 1)) > np.arange(1, len(held) + 1)
            if short[least[i] - 1 :].any():
                seg = np.flatnonzero(held == 0)
                out_doc.append(np.full(len(seg), i))
                out_sig.append(T.mix64(self.labels(np.full(len(seg), self.k[i]), seg)))
        return np.concatenate(out_doc), np.concatenate(out_sig)


def signatures(element: np.ndarray, doc: np.ndarray, n: np.ndarray, bands: Bands, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, signature) of all indexed parts of all sets of a piece."""
    out_doc, out_sig = [], []
    for back in (0, 1):
        parts = Parts(element, doc, n, bands, back)
        run, near = parts.neighbours(parts.allocated(bands, costs))
        hollow_doc, hollow = parts.hollow(bands)
        out_doc += [parts.doc, parts.doc[run], hollow_doc]
        out_sig += [parts.whole(), near, hollow]
    return np.concatenate(out_doc), np.concatenate(out_sig) & _SIGNATURE


def _sets(piece: pa.RecordBatch, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of all sets of a piece, their text, and the sets' sizes."""
    data, off = T.text_buffer(piece.column("text"))
    key, n = shingle_keys(T.Words(T.lowered(data), off, T.NON_SPACE), shingle)
    return key & np.uint64((1 << _UNIVERSE) - 1), (key >> np.uint64(_UNIVERSE)).astype(np.int64), n


def _digests(element: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent digests of each set."""
    first = np.flatnonzero(n)
    starts = (np.cumsum(n) - n)[first]
    one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    one[first] = T.mix64(_sums(T.mix64(element + np.uint64(7)), starts))
    two[first] = T.mix64(_sums(T.mix64(element ^ np.uint64(0x5555555555555)), starts))
    return one, two


def _leaders(element: np.ndarray, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Marks, of equal sets of a piece, the one with the smallest id."""
    one, two = _digests(element, n)
    order = np.lexsort((ids, n, two, one))
    leader = np.ones(len(n), bool)
    leader[order[1:]] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1]) | (n[order][1:] != n[order][:-1])
    return leader


def segment_costs(docs: DataFrame, shingle: int, percent: int) -> np.ndarray:
    """Cost of each slot of segments, from all documents: the sum of squares of
    its counters of signatures (whole parts and all one-deletion neighbourhoods),
    an estimate of the pairs that meet there.

    A task sends ``SLOTS`` rows of ``COUNTERS`` counts whatever it read, and the
    driver takes ``SLOTS`` sums. Segments that share a slot share its cost; the
    costs decide what is cheap, never what is found."""
    names = [f"c{i}" for i in range(COUNTERS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, counts = Bands(percent), np.zeros(SLOTS * COUNTERS, np.int64)
        for piece in T.pieces(batches):
            element, doc, n = _sets(piece, shingle)
            keep = _leaders(element, n, piece.column("doc_id").to_numpy())
            element, doc, n = element[keep[doc]], doc[keep[doc]], np.where(keep, n, 0)
            for back in (0, 1):
                parts = Parts(element, doc, n, bands, back)
                slot = parts.slot()
                at, near = parts.neighbours(parts.size > 1)
                for where, sig in ((slot, parts.whole()), (slot[at], near)):
                    counts += np.bincount(where * COUNTERS + (sig >> np.uint64(32)).astype(np.int64) % COUNTERS, minlength=len(counts))
        T.release()
        table = counts.reshape(SLOTS, COUNTERS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SLOTS)), *(pa.array(table[:, i]) for i in range(COUNTERS))], names=["slot", *names])

    counted = (docs.where("doc_id is not null").mapInArrow(run, ", ".join(["slot long", *(f"{c} long" for c in names)]))
               .groupBy("slot").agg(*(F.sum(c).cast("double").alias(c) for c in names)))
    costs = np.zeros(SLOTS)
    for slot, cost in counted.select("slot", sum((F.col(c) * F.col(c) for c in names[1:]), F.col("c0") * F.col("c0"))).collect():
        costs[slot] = cost
    return costs


def _sketches(element: np.ndarray, doc: np.ndarray, n: np.ndarray, bands: Bands) -> pa.Array:
    """Sketch of each set: for each of its bits the parity of the elements dealt
    to it; as many bits as the least power of two over eight times the largest
    difference of two sets of that size. Sets that differ in d elements have
    sketches that differ in d bits at most, also when a wider one is folded."""
    bits = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(8 * bands.differ(2 * n) + 1)).astype(np.int64))
    bits[n == 0] = 0
    at = np.cumsum(bits) - bits
    spot = at[doc] + (T.mix64(element + np.uint64(3)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    data = np.packbits((np.bincount(spot, minlength=int(bits.sum())) & 1).astype(np.uint8))
    off = (np.append(at, bits.sum()) // 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off), pa.py_buffer(data)])


def index_rows(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Per row its set's size, digests and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for piece in T.pieces(batches):
            element, doc, n = _sets(piece, shingle)
            one, two = _digests(element, n)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(T.signed(one)), pa.array(T.signed(two)), _sketches(element, doc, n, bands)],
                                             names=["doc_id", "n", "one", "two", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n long, one long, two long, sketch binary")


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress in sorted values."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpack(blocks: list[bytes], kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.concatenate([np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(width, -1).T).view(kind).ravel() for b in blocks])


def bucket_rows(docs: DataFrame, shingle: int, percent: int, parts: int, costs: np.ndarray) -> DataFrame:
    """(sig, doc_id, n) of the signatures that several sets have. Of equal sets
    of one piece only the one with the smallest id is indexed; a set's smallest
    id always is."""
    slots = 8 * parts

    def block(slot: int, sig: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple:
        return slot, _pack(sig), _pack(ids), _pack(n)

    def flush(held: list[tuple]) -> pa.RecordBatch:
        sig, ids, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((ids, sig))
        sig, ids, n = sig[order], ids[order], n[order].astype(np.int32)
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        several = ~new
        several[:-1] |= ~new[1:]
        rows = []
        if several.any():
            rows.append(block(-1 - int(sig[0] >> np.uint64(40)), sig[several], ids[several], n[several]))
        sig, ids, n = sig[new], ids[new], n[new]
        slot = ((sig >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        at = np.searchsorted(slot, np.arange(slots + 1))
        rows += [block(k, sig[a:b], ids[a:b], n[a:b]) for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)) if a < b]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), *[pa.binary()] * 3], strict=True)],
                                          names=["slot", "sigs", "ids", "sizes"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, held, waiting = Bands(percent), [], 0
        for piece in T.pieces(batches):
            element, doc, n = _sets(piece, shingle)
            ids = piece.column("doc_id").to_numpy()
            leader = _leaders(element, n, ids)
            at, sig = signatures(element, doc, n, bands, costs)
            at, sig = at[leader[at]], sig[leader[at]]
            if len(sig):
                held.append((sig, ids[at], n[at]))
                waiting += len(sig)
            if waiting >= FLUSH:
                yield flush(held)
                held, waiting = [], 0
        if held:
            yield flush(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, blocks = None, []

        def close() -> pa.RecordBatch:
            sig, ids, n = (_unpack([b[c] for b in blocks], k) for c, k in enumerate((np.uint64, np.int64, np.int32)))
            if slot >= 0:
                order = np.argsort(sig, kind="stable")
                sig, ids, n = sig[order], ids[order], n[order]
                same = np.zeros(len(sig), bool)
                same[1:] = sig[1:] == sig[:-1]
                same[:-1] |= same[1:]
                sig, ids, n = sig[same], ids[same], n[same]
            return pa.RecordBatch.from_arrays([pa.array(T.signed(sig)), pa.array(ids), pa.array(n.astype(np.int64))], names=["sig", "doc_id", "n"])

        for batch in batches:
            for k, *block in zip(*(batch.column(c).to_pylist() for c in ("slot", "sigs", "ids", "sizes")), strict=True):
                if k != slot and blocks:
                    yield close()
                    blocks = []
                slot = k
                blocks.append(block)
        if blocks:
            yield close()
        blocks = []
        T.release()

    sent = docs.where("doc_id is not null").mapInArrow(send, "slot long, sigs binary, ids binary, sizes binary")
    return sent.repartition(parts, "slot").sortWithinPartitions("slot").mapInArrow(merge, "sig long, doc_id long, n long")


def shingle_set(text: str | None, k: int) -> set:
    words = (text or "").encode().translate(T.LOWER).split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k)), strict=False))


def verify(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) with their exact answer ``link``."""
    # only the texts that pairs name; narrow ids against whole texts
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "verify-ids")
    texts = staged(docs.join(keyed(ids, ids.count()), "doc_id", "left_semi"), "verify-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_id, kept = None, set()
        for batch in T.pieces(batches, "left"):
            link = []
            for b, left, right in zip(*(batch.column(c).to_pylist() for c in ("b", "left", "right")), strict=True):
                if kept_id != (b, right):
                    kept_id, kept = (b, right), shingle_set(right, shingle)
                x = shingle_set(left, shingle)
                both = len(x & kept)
                link.append(both > 0 and 100 * both >= percent * (len(x) + len(kept) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(link, pa.bool_())], names=["a", "b", "link"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    return (pairs.join(left, "a").join(right, "b").sortWithinPartitions("b").select("a", "b", "left", "right")
            .mapInArrow(run, "a long, b long, link boolean").groupBy("a", "b").agg(F.max("link").alias("link")))


def elements(texts: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, set) with the set's elements sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            data, off = T.text_buffer(piece.column("text"))
            key, n = shingle_keys(T.Words(T.lowered(data), off, T.NON_SPACE), shingle)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), T.lists(pa.array((key & np.uint64((1 << _UNIVERSE) - 1)).view(np.int64)), n)],
                                             names=["doc_id", "set"])

    return texts.mapInArrow(run, "doc_id long, set array<long>")


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of every left set with every right set, as products
    of 0/1 matrices over the elements that more than one set has."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    element, index, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[index]
    keep = shared[index]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    place = np.full((2, len(sets)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, (at, at + _COLUMNS))
        sides = []
        for side, n in ((place[0], len(left)), (place[1], len(right))):
            m = np.zeros((n, _COLUMNS), np.float32)
            r = side[row[a:b]]
            m[r[r >= 0], column[a:b][r >= 0] - at] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _folded(sketch: list[bytes]) -> np.ndarray:
    """Sketches as rows of words, the wider ones folded to the narrowest."""
    width = np.array([len(x) for x in sketch])
    out = np.empty((len(sketch), width.min() // 8), np.uint64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        rows = np.frombuffer(b"".join(sketch[i] for i in at), np.uint64).reshape(len(at), -1)
        while rows.shape[1] > out.shape[1]:
            rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
        out[at] = rows
    return out


def joined(head: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``head``, of each node the least one of its group, with the groups of
    each x and y made one."""
    while len(x):
        low, high = np.minimum(head[x], head[y]), np.maximum(head[x], head[y])
        x, y, low, high = (v[low < high] for v in (x, y, low, high))
        np.minimum.at(head, high, low)
        while (head[head] < head).any():
            head = head[head]
    return head


def likely(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches in ``marks(doc_id, n, sketch)``
    allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            most = bands.differ(batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy())
            left, right = (batch.column(c).to_pylist() for c in ("a_sketch", "b_sketch"))
            wide = np.array([(len(x), len(y)) for x, y in zip(left, right, strict=True)]).reshape(-1, 2)
            keep = np.zeros(len(most), bool)
            for w in np.unique(wide, axis=0):
                at = np.flatnonzero((wide == w).all(1))
                words = _folded([left[i] for i in at] + [right[i] for i in at])
                keep[at] = np.bitwise_count(words[: len(at)] ^ words[len(at) :]).sum(1, dtype=np.int64) <= most[at]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    for side in ("a", "b"):
        pairs = pairs.join(marks.select(F.col("doc_id").alias(side), F.col("n").alias(f"{side}_n"), F.col("sketch").alias(f"{side}_sketch")), side)
    return pairs.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch").mapInArrow(run, "a long, b long").distinct()


def likely_groups(n: np.ndarray, comp: np.ndarray, sketch: list[bytes], bands: Bands) -> np.ndarray:
    """Of each set the first one of its group: groups are connected by pairs of
    different components whose sizes and sketches allow a link."""
    order = np.argsort(n, kind="stable")
    size, comp, words = n[order], comp[order], _folded([sketch[i] for i in order])
    top = np.searchsorted(size, bands.partner(size), "right")  # larger ones can't be partners
    head = np.arange(len(n))
    step = max(1, min(1024, int((SKETCH_WORDS / words.shape[1]) ** 0.5)))
    for i in range(0, len(n), step):
        for j in range(i, int(top[i : i + step].max()), step):
            a, b = np.arange(i, min(i + step, len(n))), np.arange(j, min(j + step, len(n)))
            open_ = (comp[a][:, None] != comp[b][None, :]) & (head[a][:, None] != head[b][None, :]) & (a[:, None] < b[None, :]) & (b[None, :] < top[a][:, None])
            differ = np.bitwise_count(words[a][:, None, :] ^ words[b][None, :, :]).sum(2, dtype=np.int64)
            x, y = np.nonzero(open_ & (differ <= bands.differ(size[a][:, None] + size[b][None, :])))
            head = joined(head, a[x], b[y])
    out = np.empty(len(n), np.int64)
    out[order] = order[head]
    return out


def likely_links(left: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """(a, b), which connect the members of each bucket that chains of likely
    pairs of different components connect.

    A bucket gives at most one row a member, whatever the number of its pairs, and
    a sketch has a few bits an element: the rows grow as the buckets do, not as
    the crowds of strangers that buckets with shared members would make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, held, last = Bands(percent), [], None

        def close() -> pa.RecordBatch:
            ids, n, comp = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("doc_id", "n", "comp"))
            head = likely_groups(n, comp, [x for h in held for x in h.column("sketch").to_pylist()], bands)
            own = head != np.arange(len(head))
            return pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[head[own]])], names=["a", "b"])

        for batch in batches:
            sig = batch.column("sig").to_numpy()
            cuts = [0, *(np.flatnonzero(sig[1:] != sig[:-1]) + 1).tolist(), len(sig)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if held and sig[a] != last:
                    yield close()
                    held = []
                held.append(batch.slice(a, b - a))
                last = sig[a]
        if held:
            yield close()
        held = []
        T.release()

    return (left.select("sig", "doc_id", "comp").join(marks.select("doc_id", "n", "sketch"), "doc_id").repartition("sig").sortWithinPartitions("sig")
            .mapInArrow(run, "a long, b long").distinct())


def crowded_links(left: DataFrame, texts: DataFrame, marks: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that join the components of crowded buckets.

    Members that likely pairs connect form a crowd; its sets are
    dealt to blocks of bounded size, each pair of blocks is one group, and within
    it all pairs of different components are counted as matrix products. Of the
    links only those that join two components are returned, so neither pairs nor
    links are made by the square of the crowd."""
    crowd = components(likely_links(left, marks, percent))
    members = left.select("doc_id", "n", "comp").distinct().join(crowd, F.col("doc_id") == F.col("node")).drop("node")
    size = members.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
    members = staged(members.join(size, "component"), "crowds")
    ids = members.select("doc_id").distinct()
    sets = elements(texts.join(keyed(ids, ids.count()), "doc_id", "left_semi"), shingle)
    dealt = (members.join(sets, "doc_id").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
             .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "comp", "set"))

    def links(rows: list[tuple], i: int, j: int) -> list[tuple[int, int]]:
        own, ids, comp = (np.array([r[c] for r in rows]) for c in range(3))
        sets = [r[3] for r in rows]
        n = np.array([len(x) for x in sets])
        a, b = np.flatnonzero(own == i), np.flatnonzero(own == j)
        if not len(a) or not len(b):
            return []
        both = shared_counts(sets, a, b)
        x, y = np.nonzero((100 * both >= percent * (n[a][:, None] + n[b][None, :] - both)) & (both > 0) & (comp[a][:, None] != comp[b][None, :]))
        low, high = np.minimum(comp[a][x], comp[b][y]), np.maximum(comp[a][x], comp[b][y])
        _, first = np.unique(np.stack([low, high], 1), axis=0, return_index=True)
        parent, out = {}, []

        def root(c: int) -> int:
            while parent.setdefault(c, c) != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        for k in first:
            p, q = root(int(low[k])), root(int(high[k]))
            if p != q:
                parent[q] = p
                out.append((int(ids[a][x[k]]), int(ids[b][y[k]])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, out = None, [], []
        for batch in batches:
            flat, at = batch.column("set").flatten().to_numpy(), batch.column("set").offsets.to_numpy()
            at = at - at[0]
            for k, (g, i, j, own, doc, comp) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("component", "i", "j", "own", "doc_id", "comp")), strict=True)):
                if (g, i, j) != group:
                    if rows:
                        out += links(rows, *group[1:])
                    group, rows = (g, i, j), []
                rows.append((own, doc, comp, flat[at[k] : at[k + 1]].copy()))
        if rows:
            out += links(rows, *group[1:])
        yield pa.RecordBatch.from_arrays([pa.array([max(p) for p in out], pa.int64()), pa.array([min(p) for p in out], pa.int64())], names=["a", "b"])

    # one id's set comes once for each of its blocks; equal rows are dropped before
    return (dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "doc_id")
            .mapInArrow(run, "a long, b long").distinct())


def _near(percent: int):
    """Sizes that can reach the bound."""
    return 100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")


def similarity_components(docs: DataFrame, shingle: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component is the
    smallest id reachable. Links are verified only as far as components need
    them, so a document's number of links is not known."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(index_rows(texts, shingle, percent), "index")
    known = rows.where("doc_id is not null and n > 0")
    classes = staged(known.groupBy("one", "two", "n").agg(F.min("doc_id").alias("rep")), "classes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    costs = segment_costs(texts, shingle, percent)
    buckets = staged(bucket_rows(texts, shingle, percent, parts, costs).join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                     .distinct(), "buckets")
    # one id may stand for several sets
    same = known.select("doc_id", "one", "two", "n").join(classes, ["one", "two", "n"]).where("doc_id <> rep").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    # first each member and one pivot: the smallest member of its buckets
    pivots = buckets.groupBy("sig").agg(F.min(F.struct("doc_id", "n")).alias("p"))
    pairs = (buckets.join(pivots, "sig").select("doc_id", "n", F.col("p.doc_id").alias("b"), F.col("p.n").alias("pivot_n")).where("doc_id <> b").where(_near(percent))
             .groupBy("doc_id").agg(F.min("b").alias("b")).select(F.greatest("doc_id", "b").alias("a"), F.least("doc_id", "b").alias("b")).distinct())
    answers = staged(verify(staged(likely(pairs, known, percent), "pivot-pairs"), texts, shingle, percent), "pivot-answers")
    found = answers.where("link").select("a", "b")
    comp = components(found)
    left = buckets.join(comp.select(F.col("node").alias("doc_id"), F.col("component").alias("comp")), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    # then members of different components, where a bucket still has some
    sums = left.groupBy("sig", "comp").agg(F.count("*").alias("c")).groupBy("sig").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    open_ = sums.where("q < s * s").select("sig", (F.col("s") * F.col("s") - F.col("q") <= 2 * PAIRS_PER_ROW * F.col("s")).alias("small"))
    left = staged(left.join(open_, "sig"), "open")
    few = left.where("small")
    other = few.select("sig", F.col("doc_id").alias("b"), F.col("n").alias("pivot_n"), F.col("comp").alias("other"))
    pairs = few.join(other, "sig").where("comp < other").where(_near(percent)).select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b")).distinct()
    pairs = likely(pairs.join(answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), known, percent)
    near = staged(pairs.union(crowded_links(left.where("not small"), texts, known, shingle, percent)).distinct(), "pairs")
    found = staged(same.union(found).union(verify(near, texts, shingle, percent).where("link").select("a", "b")), "found")
    comp = components(found)
    return (rows.select("doc_id", F.col("n").alias("n_shingles")).join(comp, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def _row_nodes(docs: DataFrame, id_col: str, node: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id no other row has, which are their own nodes, and the
    rows with a null or repeated id, staged with a node each in the column ``node``
    beyond the ids of the others; None if there are none."""
    doc_id = F.col(id_col).cast("long")
    id_of = free_name(docs, "_several")
    several = staged(docs.groupBy(doc_id.alias(id_of)).agg(F.count("*").alias("c")).where(F.col(id_of).isNull() | (F.col("c") > 1)).select(id_of), "several")
    n = several.count()
    if not n:
        return docs, None
    same = doc_id.eqNullSafe(F.col(id_of))
    plain = docs.join(keyed(several, n), same, "left_anti")
    odd = staged(docs.join(keyed(several, n), same, "left_semi").withColumn(node, F.monotonically_increasing_id()), "odd-rows")
    low, high = plain.agg(F.min(doc_id), F.max(doc_id)).first()
    top = odd.agg(F.max(node)).first()[0]
    if high is None or high < _LONG - top:
        base = 0 if high is None else high + 1
    elif low >= top - _LONG:
        base = low - 1 - top
    else:  # ids at both ends of the range leave no room: every row gets a node
        return docs.where("false"), staged(docs.withColumn(node, F.monotonically_increasing_id()), "odd-rows")
    return plain, odd.withColumn(node, F.col(node) + F.lit(base).cast("long"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component one row, with all its columns: that of the smallest id.

    Rows are judged, not ids: a repeated row stays once, copies without an id go
    for one that has an id (or for one of them), and of rows that share an id
    each is judged by its own text. Rows without words link with nothing and all
    stay."""
    node, gone_id = free_name(docs, "_keep_node"), free_name(docs, "_gone")
    plain, odd = _row_nodes(docs, id_col, node)
    doc_id = F.col(id_col).cast("long")
    if odd is None:
        gone = similarity_components(docs, shingle, percent, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias(gone_id))
    else:
        nodes = plain.select(doc_id.alias("node"), F.col(text_col).alias("text")).union(odd.select(node, text_col))
        comp = staged(similarity_components(nodes, shingle, percent, "node", "text").select(F.col("doc_id").alias("node"), "component_id"), "row-components")
        # rows with an id come first, by id; a row alone with its id is its node
        own = odd.select(F.col(node).alias("node"), F.lit(1).alias("odd"), doc_id.alias("own"), F.xxhash64(text_col).alias("hash"))
        real = F.when(F.col("odd").isNull(), F.col("node")).otherwise(F.col("own"))
        ranked = comp.join(own, "node", "left").select("node", "component_id", F.struct(real.isNull().alias("none"), real.alias("id"), F.coalesce("hash", F.lit(0)).alias("hash"), "node").alias("rank"))
        first = ranked.groupBy("component_id").agg(F.min("rank").alias("first"))
        gone = comp.join(first, "component_id").where("node <> first.node").select(F.col("node").alias(gone_id))
    gone = staged(gone.distinct(), "gone")
    gone = keyed(gone, gone.count())
    kept = plain.join(gone, doc_id == F.col(gone_id), "left_anti")
    return kept if odd is None else kept.union(odd.join(gone, F.col(node) == F.col(gone_id), "left_anti").drop(node))
