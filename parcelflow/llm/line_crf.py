"""Quality classifier: a linear-chain conditional random field over lines.

Every line of a text is good (1) or bad (0). A line's features are shares of
byte classes, word and repetition measures of the line itself and of the lines
before and after it; two states with a transition matrix give the chain.
Forward-backward marginals, weighted by line length, are a document's raw
score, and a logistic curve fitted on the training documents maps that to the
probability of label 1.

Training: a document's label is known, its lines' are hidden. All lines of a good
document are good; of a bad one at least the share ``BAD_SHARE`` of its length is
bad, and which lines these are is learnt: after a first fit, in which a line takes
its document's label, rounds of expectation (the chain's marginals of bad
documents, shifted to bad only as far as the share asks for it) and maximisation
follow, so changes of state within a document are seen. The model is fitted on the
driver from all lines of at most ``per_class`` labelled documents a class (the
lowest hashes of the id), fewer where their lines come to ``train_lines`` in the
class; the document that reaches that bound is the last, and one that has more
lines on its own isn't used, so at most twice the bound is held. Lines are counted
before any feature is made. Both bounds are parameters. While the chain's weights
are fitted, a document of over ``CHAIN_LINES`` lines counts as several chains. Only rows whose crc32(doc_id as text) mod ``folds`` is not 0 are
used. Labels, lang, source and doc_id are never inputs of a score.

Defined results: a null text is an empty one; an empty text is one empty line,
so it has a score too; every input row gives one row, also with repeated or
null ids (a null id is not held out); labels that are null, or contradict each
other for one id, are not used; if the training rows lack a class, scores are
the share of label 1 (0.5 without any label). Other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T
from parcelflow.llm.frames import staged

THRESHOLD = 0.3
FOLDS = 5
PER_CLASS = 3000
#: Lines of the training documents of a class.
TRAIN_LINES = 64 * PER_CLASS
#: Lines of a chain up to which the fit follows it.
CHAIN_LINES = 1000
#: Least share of a bad document's length that is bad; rounds and steps that learn which lines.
BAD_SHARE, ROUNDS, ROUND_STEPS = 0.3, 4, 25

_CLASSES = {
    "upper": T.byte_table((65, 90)), "lower": T.byte_table((97, 122)), "digit": T.byte_table((48, 57)),
    "space": ~T.NON_SPACE, "wide": T.byte_table((128, 255)), "stop": T.byte_table((0x2E, 0x2E), (0x2C, 0x2C)),
    "bang": T.byte_table((0x21, 0x21), (0x3F, 0x3F)), "symbol": T.byte_table((0x23, 0x26), (0x2A, 0x2B), (0x40, 0x40), (0x5E, 0x60), (0x7E, 0x7E)),
    "bar": T.byte_table((0x7C, 0x7C), (0x3C, 0x3E), (0x5B, 0x5D), (0x7B, 0x7B), (0x7D, 0x7D)),
}
_NEWLINE = 0x0A
N_OWN = len(_CLASSES) + 7
N_FEATURES = 3 * N_OWN + 1


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all texts, line lengths in bytes plus one, and
    the index of each text's first line with the total at the end."""
    data, off = T.text_buffer(column)
    breaks = np.flatnonzero(data == _NEWLINE)
    n_lines = np.searchsorted(breaks, off[1:]) - np.searchsorted(breaks, off[:-1]) + 1
    first = np.zeros(len(n_lines) + 1, np.int64)
    np.cumsum(n_lines, out=first[1:])
    start = np.empty(first[-1], np.int64)
    head = np.zeros(first[-1], bool)
    head[first[:-1]] = True
    start[head], start[~head] = off[:-1], breaks + 1
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    end = np.empty_like(start)
    end[:-1], end[-1:] = np.where(head[1:], off[1:][doc[:-1]], start[1:] - 1), off[-1]
    size = end - start

    def per_line(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[end] - total[start]).astype(np.float64)

    whole = np.maximum(size, 1)
    own = np.empty((len(start), N_OWN))
    for j, table in enumerate(_CLASSES.values()):
        own[:, j] = per_line(table[data]) / whole
    words = T.Words(data, off, T.NON_SPACE)
    h = words.hashes()
    at = np.searchsorted(start, words.starts, "right") - 1  # an empty line starts where the next text does, never a word
    at = np.minimum(at, len(start) - 1)
    count = np.bincount(at, minlength=len(start)).astype(np.float64)
    some = np.maximum(count, 1)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (at[1:] == at[:-1])
    order = np.lexsort((h, at))
    new = np.ones(len(h))
    new[1:] = (h[order][1:] != h[order][:-1]) | (at[order][1:] != at[order][:-1])
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    odd_end = (_CLASSES["symbol"] | _CLASSES["bang"] | _CLASSES["bar"])[last]
    k = len(_CLASSES)
    own[:, k] = np.minimum(np.log1p(size), 8) / 8
    own[:, k + 1] = np.minimum(np.bincount(at, words.ends - words.starts, len(start)) / some, 30) / 10
    own[:, k + 2] = np.bincount(at, again, len(start)) / some
    own[:, k + 3] = 1 - np.bincount(at[order], new, len(start)) / some
    own[:, k + 4] = np.bincount(at, odd_end, len(start)) / some
    line = T.hash_runs(T._BYTE[data], start, end)
    seen = np.lexsort((np.arange(len(line)), line, doc))
    twice = np.zeros(len(line))
    twice[seen[1:]] = (line[seen][1:] == line[seen][:-1]) & (doc[seen][1:] == doc[seen][:-1])
    own[:, k + 5] = twice
    own[:, k + 6] = size == 0
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:][~head[1:]] = own[:-1][~head[1:]]
    after[:-1][~head[1:]] = own[1:][~head[1:]]
    return np.hstack([own, before, after, np.ones((len(own), 1))]), size + 1.0, first


@dataclass
class Crf:
    """Weights of the good state's features, transition scores [from, to], and
    the logistic curve over the raw score's log odds."""

    weights: np.ndarray
    transition: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, x: np.ndarray, first: np.ndarray, shift: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line, and the expected transition counts, with ``shift``
        added to the lines' scores."""
        score = np.clip(x @ self.weights + shift, -30, 30)
        local = np.stack([np.ones(len(score)), np.exp(score)], 1)
        local /= local.sum(1, keepdims=True)
        jump = np.exp(self.transition - self.transition.max())
        counts = np.diff(first)
        longest = np.argsort(-counts, kind="stable")
        ahead, back = local.copy(), np.ones_like(local)
        alive = np.searchsorted(-counts[longest], -np.arange(1, counts.max(initial=0) + 1), "right")
        for t in range(1, len(alive)):
            at = first[:-1][longest[: alive[t]]] + t
            a = (ahead[at - 1] @ jump) * local[at]
            ahead[at] = a / a.sum(1, keepdims=True)
        for t in range(len(alive) - 1, 0, -1):
            at = first[:-1][longest[: alive[t]]] + t
            b = (back[at] * local[at]) @ jump.T
            back[at - 1] = b / b.sum(1, keepdims=True)
        both = ahead * back
        good = both[:, 1] / both.sum(1)
        inner = np.ones(len(x), bool)
        inner[first[:-1]] = False
        at = np.flatnonzero(inner)
        pair = ahead[at - 1][:, :, None] * jump[None] * (local[at] * back[at])[:, None, :]
        return good, (pair / pair.sum((1, 2), keepdims=True)).sum(0) if len(at) else np.zeros((2, 2))

    def raw(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the line marginals, as log odds."""
        good, _ = self.marginals(x, first)
        p = np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    def score(self, column: pa.Array) -> np.ndarray:
        z = self.slope * self.raw(*line_features(column)) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def hidden_lines(model: Crf, x: np.ndarray, size: np.ndarray, first: np.ndarray, chains: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected lines and transitions given the documents' labels: good ones are
    good throughout; a bad one is shifted to bad until the share asked for is."""
    counts = np.diff(first)
    bad = label == 0
    push = np.where(bad, 0.0, 60.0)
    whole = np.add.reduceat(size, first[:-1])
    while True:
        y, jumps = model.marginals(x, chains, np.repeat(push, counts))
        short = bad & (np.add.reduceat((1 - y) * size, first[:-1]) < BAD_SHARE * whole) & (push > -30)
        if not short.any():
            return y, jumps
        push[short] -= 2.0


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray, class_share: float, steps: int = 100) -> Crf:
    """Maximise the chain likelihood (L2-penalised) by Adam, first with the
    documents' labels for their lines, then with the lines hidden; then fit the
    logistic curve with documents weighted to the labelled rows' class share."""
    y = np.repeat(label, np.diff(first)).astype(np.float64)
    chains = np.append(np.concatenate([np.arange(a, b, CHAIN_LINES) for a, b in zip(first[:-1], first[1:], strict=True)]), first[-1])
    inner = np.ones(len(x), bool)
    inner[chains[:-1]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(inner) - 1].astype(int), y[inner].astype(int)), 1)
    model = Crf(np.zeros(x.shape[1]), np.zeros((2, 2)))
    params = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    scale = 1 / len(x)
    for step in range(1, steps + ROUNDS * ROUND_STEPS + 1):
        if step > steps and (step - steps) % ROUND_STEPS == 1:
            y, seen = hidden_lines(model, x, size, first, chains, label)
        good, jumps = model.marginals(x, chains)
        grad = np.concatenate([x.T @ (y - good), (seen - jumps).ravel()]) * scale - 1e-4 * params
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params += 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        model.weights, model.transition = params[:-4], params[-4:].reshape(2, 2)
    raw = model.raw(x, size, first)
    weight = np.where(label == 1, class_share / max(label.mean(), 1e-9), (1 - class_share) / max(1 - label.mean(), 1e-9))
    curve = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps of a two-parameter logistic regression
        p = 1 / (1 + np.exp(-np.clip(curve[0] * raw + curve[1], -30, 30)))
        z = np.stack([raw, np.ones_like(raw)], 1)
        grad = z.T @ (weight * (label - p)) - 1e-2 * (curve - [1, 0])
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        curve = curve + move * min(1.0, 1.0 / max(np.abs(move).max(), 1e-9))
    model.slope, model.shift = float(curve[0]), float(curve[1])
    return model


def training_ids(labels: DataFrame, per_class: int = PER_CLASS, folds: int = FOLDS) -> DataFrame:
    """(doc_id, quality): at most ``per_class`` ids of each class outside the
    held-out fold."""
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
            .where("quality in (0, 1) and doc_id is not null").where(F.crc32(F.col("doc_id").cast("string")) % folds != 0)
            .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("high")).where("quality = high").drop("high"))
    order = F.xxhash64("doc_id")
    return good.where("quality = 0").orderBy(order, "doc_id").limit(per_class).union(
        good.where("quality = 1").orderBy(order, "doc_id").limit(per_class)), good


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, train_lines: int = TRAIN_LINES, folds: int = FOLDS) -> Crf | float:
    """The fitted model, or the constant score where a class is missing."""
    chosen, good = training_ids(labels, per_class, folds)
    totals = {r.quality: r["count"] for r in good.groupBy("quality").count().collect()}
    if len(totals) < 2:
        return float(totals.get(1, 0) / sum(totals.values())) if totals else 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            x, size, first = line_features(piece.column("text"))
            rows = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                rows.append((np.hstack([x[a:b], size[a:b, None]]).astype(np.float32)).tobytes())
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("quality"), pa.array(np.diff(first), pa.int64()), pa.array(rows, pa.binary())],
                                             names=["doc_id", "quality", "n", "lines"])

    ids = F.broadcast(chosen)  # at most 2 * per_class rows
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(ids, "doc_id")
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    texts = staged(texts.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct(lines.alias("n"), F.col("text"))).alias("row"))
                   .select("doc_id", "quality", "row.n", "row.text"), "train-texts")
    taken, total = [], {0: 0, 1: 0}
    for r in sorted(texts.select("doc_id", "quality", "n", F.xxhash64("doc_id").alias("order")).where(F.col("n") <= train_lines).collect(), key=lambda r: (r.order, r.doc_id)):
        if total[r.quality] < train_lines:
            total[r.quality] += r.n
            taken.append((r.doc_id,))
    taken = F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long"))
    rows = texts.join(taken, "doc_id").select("doc_id", "quality", "text").mapInArrow(run, "doc_id long, quality int, n long, lines binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    label = np.array([r.quality for r in rows], np.float64)
    if len(set(label)) < 2:
        return float(totals[1] / sum(totals.values()))
    each = [np.frombuffer(r.lines, np.float32).reshape(-1, N_FEATURES + 1) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(e) for e in each])])
    every = np.vstack(each).astype(np.float64)
    return fit(every[:, :-1], every[:, -1], first, label, totals[1] / sum(totals.values()))


def score_documents(docs: DataFrame, model: Crf | float, threshold: float = THRESHOLD, folds: int = FOLDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            p = model.score(piece.column("text")) if isinstance(model, Crf) else np.full(piece.num_rows, model)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(p, pa.float64()),
                                              pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    doc = F.col(id_col).cast("long")
    held = F.coalesce(F.crc32(doc.cast("string")) % folds == 0, F.lit(False))
    return docs.select(doc.alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Crf | float, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches, text_col):
            p = model.score(piece.column(text_col)) if isinstance(model, Crf) else np.full(piece.num_rows, model)
            yield piece.filter(pa.array(p >= threshold))

    return docs.mapInArrow(run, docs.schema)


def describe(model: Crf) -> str:
    """The fitted parameters as JSON, for a record of the run."""
    return json.dumps({"weights": model.weights.tolist(), "transition": model.transition.tolist(), "slope": model.slope, "shift": model.shift})
