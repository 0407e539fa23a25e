"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value that passes its kind's validation is replaced by another valid value of
the same format: its free characters are a number below the size of their
format's domain, a keyed Feistel network permutes that domain (cycle-walking
where it is no power of four), and check digits are computed anew. The
permutation depends on key, kind and format only, so equal values stay equal
in every document and different values of one format stay different.

Kinds, in the order in which they claim text: ``email`` (characters of the local
part within their class; the domain stays), ``iban`` (mod 97, plain or in groups of
four), ``card`` (Luhn, 13 to 19 digits, plain or grouped), ``ip`` (four octets, or
version 6 with at least three groups), ``date`` (calendar days within the same 200
years, 1900 to 2099 and so on), ``ssn`` (area, group and serial rules), ``phone``
(country code kept; a national number that begins with 0 after a word such as tel).

Defined results: a null text stays null and has no values; an empty text stays
empty; each input row gives one row; a text without a valid value is unchanged;
other columns are ignored; an empty table gives an empty table. Domains under
100 (an address with a one-letter local part) are permuted without a fixed point;
a permutation may leave a value of a larger one as it is, and an address whose
local part has no letter or digit has no other form. Such values keep their place
from later kinds, but aren't reported: what is counted was replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm import textspans as T

ROUNDS = 10
#: Years of a block of dates, counted from 1900 both ways.
_YEARS = 200
_SMALL_DOMAIN = 100
#: Characters that are permuted jointly in an address.
_LOCAL = 64


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a balanced Feistel network on the next
    even number of bits, walked until the value is in range again."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8

    def round_value(i: int, x: int) -> int:
        data = i.to_bytes(1, "big") + size.to_bytes(40, "big") + x.to_bytes(width, "big") + tweak.encode()
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=max(8, width)).digest(), "big") & mask

    while True:
        left, right = value >> half, value & mask
        if back:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ round_value(i, left), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ round_value(i, right)
        value = left << half | right
        if value < size:
            return value


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CLASS = {c: a for a in _ALPHABETS for c in a}


def displace(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1 that leaves no value in its place: the
    next value in a keyed order."""
    place = permute(value, size, key, tweak)
    return permute((place + (-1 if back else 1)) % size, size, key, tweak, True)


def permute_characters(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Letters and digits permuted jointly, each within its class; all other
    characters, and so the format, stay."""
    value, size, form = 0, 1, []
    for c in text:
        if a := _CLASS.get(c):
            value, size = value * len(a) + a.index(c), size * len(a)
        form.append(a[0] if a else c)
    if size == 1:
        return text
    value, out = (displace if size < _SMALL_DOMAIN else permute)(value, size, key, kind + "".join(form), back), []
    for c in reversed(text):
        if a := _CLASS.get(c):
            value, at = divmod(value, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _ALPHABETS[0])


def _refill(form: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c in _ALPHABETS[0] else c for c in form)


def _email(m: re.Match, key: bytes, back: bool) -> str:
    local, _, domain = m[0].partition("@")
    # beyond the length of a valid local part, stretch by stretch
    cuts = [local[i : i + _LOCAL] for i in range(0, len(local), _LOCAL)]
    return "".join(permute_characters(c, key, f"email{i or ''}", back) for i, c in enumerate(cuts)) + "@" + domain


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _iban(m: re.Match, key: bytes, back: bool) -> str | None:
    text = m[0]
    while True:  # a word after the last group may look like one
        plain = text.replace(" ", "")
        country, check, body = plain[:2], plain[2:4], plain[4:]
        if len(body) >= 11 and iban_check(country, body) == check:
            break
        if " " not in text:
            return None
        text = text[: text.rindex(" ")]
    body = permute_characters(body, key, "iban" + country, back)
    it = iter(country + iban_check(country, body) + body)
    return "".join(c if c == " " else next(it) for c in text)


def _card(m: re.Match, key: bytes, back: bool) -> str | None:
    d = _digits(m[0])
    if luhn_digit(d[:-1]) != d[-1]:
        return None
    body = permute_characters(d[:-1], key, "card", back)
    return _refill(m[0], body + luhn_digit(body))


def _ip(m: re.Match, key: bytes, back: bool) -> str | None:
    parts = m[0].split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


_HEX = "0123456789abcdef"


def _ip6(m: re.Match, key: bytes, back: bool) -> str | None:
    """All hexadecimal digits jointly; groups and their lengths stay."""
    text = m[0]
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return None
    if sum(map(bool, text.split(":"))) < 3:
        return None
    digits = text.replace(":", "").lower()
    form = "".join(":" if c == ":" else "0" for c in text)
    value = permute(int(digits, 16), 16 ** len(digits), key, "ip6" + form, back)
    new = f"{value:0{len(digits)}x}"
    it = iter(new.upper() if text != text.lower() else new)
    return "".join(c if c == ":" else next(it) for c in text)


def _year_block(year: int) -> tuple[int, int]:
    """First day and number of days of the years that a date is permuted in."""
    first = 1900 + (year - 1900) // _YEARS * _YEARS
    day0 = datetime.date(max(first, 1), 1, 1).toordinal()
    return day0, (datetime.date.max.toordinal() + 1 if first + _YEARS > 9999 else datetime.date(first + _YEARS, 1, 1).toordinal()) - day0


@cache
def _written_days(year: int, months: int, days: int) -> list[int]:
    """Days of a block whose month and day have so many digits as written: one
    digit is 1 to 9, two are any, zeros included."""
    day0, n = _year_block(year)
    every = map(datetime.date.fromordinal, range(day0, day0 + n))
    return [d.toordinal() for d in every if (months == 2 or d.month < 10) and (days == 2 or d.day < 10)]


def _date(m: re.Match, key: bytes, back: bool) -> str | None:
    text = m[0]
    sep = next(c for c in text if not c.isdigit())
    parts = text.split(sep)
    orders = ["ymd"] if len(parts[0]) == 4 else ["dmy"] if sep == "." else ["mdy", "dmy"]
    for order in orders:
        got = dict(zip(order, parts, strict=True))
        try:
            day = datetime.date(int(got["y"]), int(got["m"]), int(got["d"])).toordinal()
        except ValueError:
            continue
        day0, days = _year_block(int(got["y"]))
        form = len(got["m"]), len(got["d"])
        tweak = "date" + (f"{day0}" if int(got["y"]) // 100 not in (19, 20) else "") + ("" if form == (2, 2) else f"{form}")
        if form == (2, 2):
            new = permute(day - day0, days, key, tweak, back) + day0
        else:
            written = _written_days(max(int(got["y"]) // 100 * 100, 1), *form)
            new = written[permute(bisect_left(written, day), len(written), key, tweak, back)]
        new = datetime.date.fromordinal(new)
        return sep.join({"y": f"{new.year:04d}", "m": f"{new.month:0{form[0]}d}", "d": f"{new.day:0{form[1]}d}"}[x] for x in order)
    return None


def _ssn(m: re.Match, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, m[0].split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value = permute(value, len(areas) * 99 * 9999, key, "ssn", back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _national(m: re.Match, key: bytes, back: bool) -> str:
    return "0" + permute_characters(m[0][1:], key, "phone0", back)


def _phone(m: re.Match, key: bytes, back: bool) -> str | None:
    text = m[0]
    if not 8 <= len(_digits(text)) <= 15:
        return None
    keep = re.match(r"\+[0-9]{1,3}(?![0-9])|\+1|\+[0-9]{2}|1(?![0-9])", text)
    at = keep.end() if keep else 0
    return text[:at] + permute_characters(text[at:], key, "phone" + text[:at], back)


_NO_DIGIT = r"(?<![0-9])", r"(?![0-9])"
#: Right after one of these words and a space, colon or point.
_CALLED = "(?:" + "|".join(f"(?<=[{w[0].upper()}{w[0]}]{w[1:]}{end})" for w in ("tel", "phone", "fax", "mobile") for end in (" ", ": ", r"\. ")) + ")"
#: kind, character that any match holds (None: a digit), pattern, replacement.
KINDS = (
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), _email),
    ("iban", None, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9])"), _iban),
    ("card", None, re.compile(_NO_DIGIT[0] + r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[47][0-9]{2}([ -])[0-9]{6}\2[0-9]{5})" + _NO_DIGIT[1]), _card),
    ("ip", ".", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"), _ip),
    ("ip", ":", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])"), _ip6),
    ("date", None, re.compile(_NO_DIGIT[0] + r"(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})" + _NO_DIGIT[1]), _date),
    ("ssn", "-", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _ssn),
    ("phone", None, re.compile(_NO_DIGIT[0] + r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _NO_DIGIT[1]), _phone),
    ("phone", "0", re.compile(_CALLED + r"0[0-9]{1,5}[ /-]?[0-9]{3,8}(?:[ -]?[0-9]{2,5}){0,3}" + _NO_DIGIT[1]), _national),
    ("phone", "+", re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}" + _NO_DIGIT[1]), _phone),
)
_DIGIT = re.compile("[0-9]")


def find_values(text: str, key: bytes, back: bool = False) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of all replaced values by start; a stretch
    claimed by one kind is blank for the later ones."""
    has_digit, found, left = bool(_DIGIT.search(text)), [], text
    for kind, sign, pattern, replace in KINDS:
        if (sign is None or sign in left) and (has_digit or kind == "email"):
            taken = []
            for m in pattern.finditer(left):
                if (new := replace(m, key, back)) is not None:
                    # an account number may end before its match does, and keeps its length
                    taken.append((kind, m.start(), m.start() + len(new) if kind == "iban" else m.end(), new))
            for _, s, e, _ in reversed(taken):
                left = left[:s] + "\0" * (e - s) + left[e:]
            found += taken
    return sorted((x for x in found if x[3] != text[x[1] : x[2]]), key=lambda x: x[1])


def pseudonymise_text(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int, str]]]:
    found = find_values(text, key, back)
    if not found:
        return text, found
    out, at = [], 0
    for _, s, e, new in found:
        out += [text[at:s], new]
        at = e
    return "".join([*out, text[at:]]), found


SCHEMA = "doc_id long, text string, n_values long, kinds string, spans string"


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the text with pseudonyms, the number of replaced values,
    their kinds and their places (kind:start:end, code points, in the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in T.pieces(batches):
            rows = [(None, []) if t is None else pseudonymise_text(t, key) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([t for t, _ in rows], pa.string()), pa.array([len(f) for _, f in rows], pa.int64()),
                 pa.array([",".join(sorted({x[0] for x in f})) for _, f in rows], pa.string()),
                 pa.array([",".join(f"{k}:{s}:{e}" for k, s, e, _ in f) for _, f in rows], pa.string())],
                names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
