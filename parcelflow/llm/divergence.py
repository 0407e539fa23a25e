"""Divergence of a language's sources by their term frequencies.

Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
A language keeps the V terms that stand in at least ``min_docs`` of its
documents. A group (language, source), and the language itself, gives each kept
term p = 1 + floor(10^9 (count + 2) / (N + 2 V)), N its occurrences of kept terms.
Two such p, q differ by floor((p - q)^2 / (p + q)).

Counting, in numpy within tasks, by length-bucketed packing: a term of up to 8
bytes is one big-endian uint64, of up to 16 bytes two, so integer order is byte
order (a term has no zero byte, so padding is unambiguous); these are radix-sorted
by 16-bit digits and counted as runs. Longer terms go to a bucket for each length
in multiples of 16 bytes, sorted as byte strings. Runs travel packed and are
summed by Spark.

Pairs of sources: a language's kept terms are cut in slices by hash, its sources
in blocks of 256. A task has a slice of two blocks and sums the differences of
all its pairs of sources, term by term, as dense matrices of a bounded number of
terms; a term that neither block has adds the difference of two zero counts, once
for each. So no task's rows follow the size of a source or language, and the rows
that leave a task are the pairs of two blocks.

Defined results: null text, language and source read as ''; each row is a
document, whatever its id; a group without terms, and a language without kept
terms, are groups too (all their differences are 0 where nothing is kept); a
source that is alone in its language has no pairs; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import keyed, small_batches, staged

#: bytes of terms `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`
TERM_BYTES = ~T.byte_table((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
UNIT = 1_000_000_000
#: Run rows that a task holds before it sorts, sums and sends them.
FLUSH = 1_000_000
#: Sources of a block; rows of a slice; terms of a dense matrix.
BLOCK, SLICE_ROWS, TERMS_AT_A_TIME = 256, 200_000, 1024
COUNTS = "lang string, source string, hi long, lo long, rest binary, n long, docs long"
_MASK = np.array([0, *(((1 << 8 * k) - 1) << 8 * (8 - k) for k in range(1, 9))], np.uint64)


def radix_order(keys: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """``order``, stably sorted by unsigned keys, the least significant first."""
    for key in keys:
        bits = key.dtype.itemsize * 8
        for shift in range(0, bits, 16):
            digit = ((key >> key.dtype.type(shift)) & key.dtype.type(0xFFFF)).astype(np.uint16)
            if (digit != digit[0]).any():  # numpy sorts 16-bit numbers by radix where the order must be stable
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def pack(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first ``size`` (0 to 8) bytes from each start as a big-endian uint64."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at_each_byte = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    return at_each_byte[np.minimum(starts, len(data))].astype(np.uint64) & _MASK[size]


def _heads(columns: list[np.ndarray]) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


class Runs:
    """Counted runs of one length bucket: key columns (a term's words or its
    bytes, then its group), occurrences and documents."""

    def __init__(self) -> None:
        self.parts: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, term: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> None:
        """Occurrences in the order of their documents."""
        if not len(group):
            return
        order = _term_order(term, radix_order([group], np.arange(len(group))))
        keys = [*(t[order] for t in term), group[order]]
        doc = doc[order]
        docs = _heads([*keys, doc])  # each is the first of its document in its run
        first = _heads(keys)
        n = np.diff(np.append(first, len(group)))
        self._keep([k[first] for k in keys], n, np.diff(np.append(np.searchsorted(docs, first), len(docs))))

    def _keep(self, keys: list[np.ndarray], n: np.ndarray, docs: np.ndarray) -> None:
        self.parts.append((keys, n, docs))
        self.rows += len(n)

    def merged(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        keys = [np.concatenate(k) for k in zip(*(p[0] for p in self.parts), strict=True)]
        n, docs = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2))
        order = _term_order(keys[:-1], radix_order([keys[-1]], np.arange(len(n))))
        keys = [k[order] for k in keys]
        first = _heads(keys)
        self.parts, self.rows = [], 0
        return [k[first] for k in keys], np.add.reduceat(n[order], first), np.add.reduceat(docs[order], first)


def _term_order(term: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    if term[0].dtype.kind == "S":
        return order[np.argsort(term[0][order], kind="stable")]
    return radix_order(term[::-1], order)


class Counter:
    """Terms of a task's texts by length bucket: 1 and 2 for words of 8 bytes,
    else the width of the byte strings."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.buckets: dict[int, Runs] = {}

    def add(self, piece: pa.RecordBatch) -> None:
        data, offsets = T.text_buffer(piece.column("text"))
        data = T.lowered(data)
        words = T.Words(data, offsets, TERM_BYTES)
        names = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), strict=True)
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in names], np.uint32)[words.doc]
        size = words.ends - words.starts
        for k in (1, 2):
            at = np.flatnonzero((size > 8 * (k - 1)) & (size <= 8 * k))
            term = [pack(data, words.starts[at] + 8 * i, np.minimum(size[at] - 8 * i, 8)) for i in range(k)]
            self.buckets.setdefault(k, Runs()).add(term, group[at], words.doc[at])
        long = np.flatnonzero(size > 16)
        width = -(-size[long] // 16) * 16
        for w in np.unique(width).tolist():
            at = long[width == w]
            for lot in np.array_split(at, -(-len(at) * w // T.PIECE_BYTES)):  # a lot's matrix stays near one piece
                self.buckets.setdefault(w, Runs()).add([_strings(data, words.starts[lot], size[lot], w)], group[lot], words.doc[lot])

    def held(self) -> int:
        return sum(r.rows * max(1, w // 16) for w, r in self.buckets.items())

    def flush(self) -> Iterator[pa.RecordBatch]:
        lang, source = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        for width, runs in self.buckets.items():
            if not runs.parts:
                continue
            (*term, group), n, docs = runs.merged()
            none = np.zeros(len(n), np.int64)
            hi = T.signed(term[0]) if width <= 2 else none
            lo = T.signed(term[1]) if width == 2 else none
            rest = pa.array(term[0].tolist(), pa.binary()) if width > 2 else pa.array([b""], pa.binary()).take(pa.array(none))
            for at in range(0, len(n), 100_000):
                cut = slice(at, at + 100_000)
                g = pa.array(group[cut])
                yield pa.RecordBatch.from_arrays([lang.take(g), source.take(g), pa.array(hi[cut]), pa.array(lo[cut]), rest[cut],
                                                  pa.array(n[cut]), pa.array(docs[cut])], names=[c.split()[0] for c in COUNTS.split(", ")])


def _strings(data: np.ndarray, starts: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    at = starts[:, None] + np.arange(width)
    filled = np.arange(width) < size[:, None]
    return np.ascontiguousarray(np.where(filled, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)).view(f"S{width}").ravel()


def _counting(flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for piece in T.pieces(batches):
            counter.add(piece)
            if counter.held() >= flush:
                yield from counter.flush()
        yield from counter.flush()
    return run


def _names(docs: DataFrame, lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", flush: int = FLUSH) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term."""
    small_batches(docs.sparkSession)
    runs = docs.select(*_names(docs, lang_col, source_col), F.col(text_col).alias("text")).mapInArrow(_counting(flush), COUNTS)
    packed = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("hi", "lo")]).cast("string")
    return (runs.groupBy("lang", "source", "hi", "lo", "rest").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .select("lang", "source", F.when(F.col("hi") == 0, F.col("rest").cast("string")).otherwise(F.translate(packed, "\0", "")).alias("term"), "n", "docs"))


def with_share(df: DataFrame, name: str, n: str, total: str) -> DataFrame:
    """p of the count column ``n``, exact by decimals; needs a column ``kept``."""
    under = f"cast({total} AS decimal(19,0)) + cast(2 * kept AS decimal(19,0))"
    return df.withColumn(name, F.expr(f"1 + (cast({n} + 2 AS decimal(19,0)) * cast({UNIT} AS decimal(10,0))) div ({under})"))


def shares(n: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """The same in numpy: nine decimal digits by three exact steps, for totals
    below 9 * 10^15."""
    under = total + 2 * kept
    whole, rest = np.divmod(n + 2, under)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, under)
        whole = whole * 1000 + more
    return whole + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _comparing(block: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """Differences of all pairs of sources of two blocks over one slice."""
        lang, first, second, _ = (k.as_py() for k in key)
        source, at = np.unique(table["number"].to_numpy(), return_inverse=True)
        total = np.zeros(len(source), np.int64)
        total[at] = table["total"].to_numpy()
        kept = table["kept"][0].as_py()
        left, right = np.flatnonzero(source // block == first), np.flatnonzero(source // block == second)
        sums = np.zeros((len(left), len(right)), np.int64)
        zero, seen = sums.copy(), 0
        if kept:
            none = shares(np.zeros(len(source), np.int64), total, kept)
            zero = differences(none[left][:, None], none[right])
            real = np.flatnonzero(table["n"].to_numpy() > 0)
            code = pc.dictionary_encode(table["term"].combine_chunks()).indices.to_numpy(zero_copy_only=False)[real].astype(np.int64)
            order = np.argsort(code, kind="stable")
            code, at, n = np.unique(code[order], return_inverse=True)[1], at[real][order], table["n"].to_numpy()[real][order]
            seen = int(code[-1]) + 1 if len(code) else 0
            for low in range(0, seen, TERMS_AT_A_TIME):
                cut = slice(*np.searchsorted(code, [low, low + TERMS_AT_A_TIME]))
                counts = np.zeros((min(TERMS_AT_A_TIME, seen - low), len(source)), np.int64)
                counts[code[cut] - low, at[cut]] = n[cut]
                p = shares(counts, total, kept)
                for i, a in enumerate(left):
                    sums[i] += differences(p[:, a : a + 1], p[:, right]).sum(0)
        i, j = np.nonzero(source[left][:, None] < source[right])
        rows = len(i)
        return pa.table({"lang": pa.array([lang] * rows, pa.string()), "a": source[left][i], "b": source[right][j], "part": sums[i, j],
                         "seen": np.full(rows, seen), "zero": zero[i, j], "kept": np.full(rows, kept)})

    return run


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, lang_col: str = "lang", source_col: str = "source",
                      text_col: str = "text", block: int = BLOCK, slice_rows: int = SLICE_ROWS, flush: int = FLUSH) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair``, each other source
    of the language with the summed differences; ``term``, the ``top`` terms that
    a group has oftener than its language."""
    counts = staged(term_counts(docs, lang_col, source_col, text_col, flush), "term-counts")
    kept = staged(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                  .where(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "kept-terms")
    used = staged(counts.join(keyed(kept, kept.count()), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "used-terms")
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    per_group = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    langs, numbered = Window.partitionBy("lang"), Window.partitionBy("lang").orderBy("source")
    zeros = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("total", "terms", "kept", "lang_total")}
    groups = (docs.select(*_names(docs, lang_col, source_col)).distinct()
              .join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left").withColumns(zeros)
              .withColumns({"number": (F.row_number().over(numbered) - 1).cast("long"), "sources": F.count(F.lit(1)).over(langs),
                            "slices": F.greatest(F.lit(1), F.ceil(F.sum("terms").over(langs) / slice_rows))}))
    groups = staged(groups, "groups")
    n_groups = groups.count()

    full = used.join(keyed(groups, n_groups), ["lang", "source"])
    term = with_share(with_share(full, "p", "n", "total"), "q", "lang_n", "lang_total").where("p > q")
    term = term.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))

    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(sources - 1) div {block}"))
    shared = ["lang", "number", "total", "kept"]
    rows = full.select(*shared, "term", "n", F.expr("pmod(xxhash64(term), slices)").alias("slice"), F.explode(blocks).alias("other")).unionAll(
        groups.select(*shared, F.explode(F.expr("sequence(0L, slices - 1)")).alias("slice"), blocks.alias("others"))
        .select(*shared, F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "slice", F.explode("others").alias("other")))
    own = F.expr(f"number div {block}")
    parts = (rows.withColumns({"first": F.least(own, F.col("other")), "second": F.greatest(own, F.col("other"))})
             .groupBy("lang", "first", "second", "slice")
             .applyInArrow(_comparing(block), "lang string, a long, b long, part long, seen long, zero long, kept long"))
    sums = parts.groupBy("lang", "a", "b").agg((F.sum("part") + (F.max("kept") - F.sum("seen")) * F.max("zero")).alias("value"))
    both = sums.select("lang", F.col("a").alias("number"), F.col("b").alias("with"), "value").unionAll(sums.select("lang", "b", "a", "value"))
    name = groups.select("lang", "number", "source")
    pair = (both.join(keyed(name, n_groups), ["lang", "number"])
            .join(keyed(name.select("lang", F.col("number").alias("with"), F.col("source").alias("item")), n_groups), ["lang", "with"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(by_value)) for x in (pair, term)]
    return ranked[0].unionAll(ranked[1].where(F.col("rank") <= top))
