"""Spelling variants grouped by asymmetric q-chunks.

Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased. With h the
crc32 of ``<doc_id>:<run>``, a run whose h is a multiple of 31 loses its code point
h % length (a planted slip). Results of ``least`` code points and more that occur
``rare`` times are the vocabulary. Spans, checksums and slips are numpy over the
bytes of many texts at a time.

Near words (one code point inserted, deleted or replaced): the shorter word x, of
length L, contributes two disjoint chunks, its halves; one edit touches only one
of them. A word of the same length has the other half at the same place, a word y
that is one longer has it at the same place (the first half) or shifted by one
(the second). So of y's positional grams those that a chunk can reach within shift
one are indexed, and two words meet on (L, chunk, gram); what is left of both,
around the chunk, is verified exactly.

A bucket with more than ``CROWD`` words isn't joined. Its words go to the next
level, where the half that isn't fixed is halved again: they meet on all but a
quarter, then all but an eighth, and so on, in the end on all but one code point,
where a bucket is bounded by the alphabet. So no bucket makes all its pairs, a
frequent beginning or end costs a count, and no pair is lost. A pair is taken only
at the part where the words first differ, so each is found once.

A word's form is its near word of largest n (ties: smallest), if that n is at
least ``ratio`` times its own; the root follows forms to the last, by doubling.

Defined results: a null text has no words; a null id reads as ''; each row is a
document; code points outside the class separate words, also within a word with
other letters; words without near words have n_near 0 and no form, and are their
own root; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import keyed, small_batches, staged

#: bytes of runs: letters, and the lead byte of U+00C0 to U+00FF
_LETTER = T.byte_table((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC3))
SLIP = 31
#: Words of a bucket up to which it is joined.
CROWD = 32
#: Bytes up to which checksums of runs are made together.
_TOGETHER = 64
_U = np.uint32


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=_U)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ _U(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, size: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run, continued from ``before``."""
    order = np.argsort(-size, kind="stable")
    state, start = before[order] ^ _U(0xFFFFFFFF), starts[order]
    long = int(np.searchsorted(-size[order], -_TOGETHER, "left"))  # runs beyond _TOGETHER come first
    upto = np.searchsorted(-size[order], -np.arange(1, _TOGETHER + 1), "right")
    for j, n in enumerate(upto.tolist()):
        if n > long:
            s = state[long:n]
            state[long:n] = _CRC[(s ^ data[start[long:n] + j]) & 0xFF] ^ s >> 8
    state ^= _U(0xFFFFFFFF)
    for k in range(long):
        i = order[k]
        state[k] = zlib.crc32(data[starts[i] : starts[i] + size[i]], int(before[i]))
    out = np.empty_like(state)
    out[order] = state
    return out


def _words(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            counts = pc.value_counts(pa.concat_arrays(list(_spelled(piece, least))))
            yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], names=["word", "n"])
    return run


def _spelled(piece: pa.RecordBatch, least: int) -> Iterator[pa.Array]:
    """The words of a piece's occurrences: those without a slip, then the others."""
    data, offsets = T.text_buffer(piece.column("text"))
    data = T.lowered(data)
    plain = data.copy()
    plain[1:][data[:-1] == 0xC3] = 0x61  # the second byte of U+00C0 to U+00FF counts as a letter
    words = T.Words(plain, offsets, _LETTER)
    twos = np.concatenate([[0], np.cumsum(data == 0xC3)])
    size = words.ends - words.starts
    points = size - (twos[words.ends] - twos[words.starts])
    at = np.flatnonzero(points >= least)
    starts, ends, size, points = words.starts[at], words.ends[at], size[at], points[at]
    ids = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in piece.column("doc_id").to_pylist()], _U)
    h = checksums(data, starts, size, ids[words.doc[at]]).astype(np.int64)
    slip = h % SLIP == 0
    right = ~slip
    mark = np.zeros(len(data) + 1, np.int8)
    np.add.at(mark, starts[right], 1)
    np.subtract.at(mark, ends[right], 1)
    upto = np.zeros(int(right.sum()) + 1, np.int64)
    np.cumsum(size[right], out=upto[1:])
    yield pa.LargeStringArray.from_buffers(len(upto) - 1, pa.py_buffer(upto), pa.py_buffer(data[np.cumsum(mark[:-1]) > 0])).cast(pa.string())
    changed = []
    for i in np.flatnonzero(slip & (points > least)).tolist():
        word, gone = data[starts[i] : ends[i]].tobytes().decode(), int(h[i] % points[i])
        changed.append(word[:gone] + word[gone + 1 :])
    yield pa.array(changed, pa.string())


def vocabulary(docs: DataFrame, least: int = 7, rare: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n)."""
    small_batches(docs.sparkSession)
    words = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_words(least), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rare)


_KEY = ["size", "low", "high", "gram"]


def _entries(parts: DataFrame) -> DataFrame:
    """Index rows: the word without code points ``low`` to ``high`` of the shorter
    word (one more of a longer word)."""
    return parts.where("high > low").withColumn("gram", F.expr("concat(left(word, low), substring(word, high + 1 + longer))"))


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n, other, other_n), once, of each pair of near words in
    ``words(word, n)``."""
    roles = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).withColumn("size", F.length("word") - F.col("longer"))
    halves = F.expr("array(struct(0 AS low, size div 2 AS high), struct(size div 2 AS low, size AS high))")
    parts = roles.select("word", "n", "longer", "size", F.inline(halves))
    found = []
    while True:
        index = staged(_entries(parts), "chunks")
        full = (index.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("c"), F.min("longer").alias("least")).where(F.col("c") > crowd)
                .where("high - low > 1"))
        full = staged(full.select(*_KEY, "least"), "crowded-chunks")
        n = full.count()
        rest = index.join(keyed(full.select(*_KEY), n), _KEY, "left_anti") if n else index
        x = rest.where("longer = 0").select(*_KEY, "word", "n")
        y = rest.select(*_KEY, "longer", F.col("word").alias("other"), F.col("n").alias("other_n"))
        met = x.join(y, _KEY).where(F.expr(
            "(longer = 1 AND (high = size OR substring(word, low + 1, high - low) <> substring(other, low + 1, high - low))) OR (longer = 0 AND word < other)"))
        found.append(staged(met.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n"), "near-words"))
        if not n:
            break
        open_ = index.join(keyed(full.where("least = 0").select(*_KEY), n), _KEY, "left_semi")  # without a shorter word no pair
        quarters = F.expr("array(struct(low, (low + high) div 2 AS high), struct((low + high) div 2 AS low, high))")
        parts = open_.select("word", "n", "longer", "size", F.inline(quarters))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``, whose steps never return."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    n = at.count()
    while True:
        further = keyed(at.select(F.col("word").alias("root"), F.col("root").alias("last")), n)
        step = staged(at.join(further, "root", "left").select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return at


def group_variants(docs: DataFrame, least: int = 7, rare: int = 2, ratio: int = 10, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of the vocabulary."""
    words = staged(vocabulary(docs, least, rare, id_col, text_col), "words")
    pairs = near_pairs(words, crowd)
    both = pairs.unionAll(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    # the largest n, then the smallest word
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("best"), F.max("n").alias("own"))
    fits = -F.col("best.minus") >= ratio * F.col("own")
    near = staged(near.select("word", "n_near", F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")), "near")
    last = roots(near.where("form IS NOT NULL"))
    return (words.join(near, "word", "left").join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
