"""Secret scan: Aho-Corasick keywords, anchored patterns near hits, checksums.

An automaton of all keywords walks each text once (A-Z lower-cased, so offsets
stay the same); a kind's pattern is tried only at its keyword's place. Hex runs
have no keyword: a run of 24 or more covers a position that is a multiple of
24, so only those positions are looked at and the run around one is measured.
Kinds with an embedded checksum keep a match only when the checksum holds.

Base kinds, leftmost and non-overlapping per kind, failing matches dropped:
``assign``, ``access``, ``hex``. Further kinds: ``github`` (base-62 CRC-32 of the
30 characters before), ``npm`` (the same), ``jwt`` (header and claims decode to
JSON objects, the header names an algorithm), ``pem`` (private-key block whose
body decodes as base 64).

Defined results: a null text is an empty one and has no spans; each input row
gives one row, also with repeated or null ids; other columns are ignored; an
empty table gives an empty table. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "pem")
BASE = KINDS[:3]

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"

_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """CRC-32 of the body as six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = _BASE62[r] + out
    return out


def _crc_ok(m: re.Match) -> bool:
    body = m[1]
    return crc_base62(body[:-6]) == body[-6:]


def _jwt_ok(m: re.Match) -> bool:
    def part(x: str):
        return json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4)))

    try:
        head, claims = part(m[1]), part(m[2])
    except ValueError:
        return False
    return isinstance(head, dict) and isinstance(claims, dict) and "alg" in head


def _pem_ok(m: re.Match) -> bool:
    body = re.sub(r"[^A-Za-z0-9+/=]", "", m[1])
    try:
        return len(base64.b64decode(body, validate=True)) >= 16
    except ValueError:
        return False


#: kind -> keywords (lower case), pattern anchored at the keyword, check.
PATTERNS: dict[str, tuple[tuple[str, ...], re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"),
               re.compile(r"""((?:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
               lambda m: len(m[2]) >= 6),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_ok),
    "npm": (("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_ok),
    "jwt": (("eyj",), re.compile(r"(eyJ[A-Za-z0-9_-]{4,})\.(eyJ[A-Za-z0-9_-]{2,})\.[A-Za-z0-9_-]{8,}"), _jwt_ok),
    "pem": (("-----begin",), re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----([A-Za-z0-9+/=\s]{16,}+)-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"), _pem_ok),
}

_HEX_RUN, _HEX = 24, re.compile(r"[0-9a-f]+")
_HEX_CHARS = frozenset("0123456789abcdef")


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, (words, _, _) in PATTERNS.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def hex_spans(text: str) -> list[tuple[int, int]]:
    """Maximal runs of 24 or more of 0-9a-f."""
    out, done = [], 0
    for i, c in enumerate(text[_HEX_RUN - 1 :: _HEX_RUN]):
        if c in _HEX_CHARS and (at := i * _HEX_RUN + _HEX_RUN - 1) >= done:
            start = at
            while start > done and text[start - 1] in _HEX_CHARS:
                start -= 1
            done = _HEX.match(text, at).end()
            if done - start >= _HEX_RUN:
                out.append((start, done))
    return out


def secret_spans(text: str, keywords: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    out = [("hex", s, e) for s, e in hex_spans(text)]
    done = dict.fromkeys(PATTERNS, 0)
    low = text.encode().translate(T.LOWER).decode()
    for last, (kind, n) in keywords.iter(low):
        start = last - n + 1
        if start < done[kind]:
            continue
        _, pattern, check = PATTERNS[kind]
        if m := pattern.match(text, start):
            done[kind] = m.end()
            if check(m):
                out.append((kind, start, m.end()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, overlapping ones joined, replaced by its first
    kind's mark. The keyword of an assignment stays."""
    out, at = [], 0
    for kind, s, e in spans:
        if kind == "assign":
            s = PATTERNS["assign"][1].match(text, s).start(2)
        if e <= at:
            continue
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = e
    return "".join([*out, text[at:]])


def _texts(piece: pa.RecordBatch) -> list[str]:
    return [x or "" for x in piece.column("text").to_pylist()]


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts of the base kinds, the digest of their
    spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for piece in T.pieces(batches):
            rows = [secret_spans(t, keywords) for t in _texts(piece)]
            base = [[x for x in r if x[0] in BASE] for r in rows]
            count = [pa.array([sum(x[0] == k for x in r) for r in base], pa.int64()) for k in BASE]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *count,
                 pa.array([hashlib.sha256(join_spans(r).encode()).hexdigest() for r in base], pa.string()),
                 pa.array([join_spans(r) for r in rows], pa.string()),
                 pa.array([len(r) - len(b) for r, b in zip(rows, base, strict=True)], pa.int64())],
                names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, secrets replaced by marks. A null text stays
    null; texts without a secret are unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for piece in T.pieces(batches, text_col):
            texts = piece.column(text_col).to_pylist()
            clean = [t if not t or not (s := secret_spans(t, keywords)) else redact(t, s) for t in texts]
            at = piece.schema.get_field_index(text_col)
            yield piece.set_column(at, piece.schema.field(at), pa.array(clean, piece.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
