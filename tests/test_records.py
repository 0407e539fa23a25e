"""CSV files by byte ranges: same rows whatever the ranges."""

import csv
import io
import os
import random
from contextlib import contextmanager

import pytest

from parcelflow.sources import monthly
from parcelflow.sources.records import Records, line_effect


@pytest.fixture()
def ranges(spark):
    """Sets the size of a byte range within a block."""
    @contextmanager
    def use(size):
        keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
        before = {k: spark.conf.get(k) for k in keys}
        try:
            for k in keys:
                spark.conf.set(k, str(size))
            yield
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
    return use


def _file(folder, month, body):
    path = os.path.join(folder, f"CRMLSSold{month}.csv")
    with open(path, "wb") as fh:
        fh.write(body)
    return path


def _table(rng, n, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(["key", "city", "note"])
    rows = []
    for i in range(n):
        note = "".join(rng.choices(['"', "\n", "\r\n", ",", "é", "word ", "x", '""', "O’Neil"], k=rng.randrange(1, 9)))
        rows.append((str(i), rng.choice(["San\nDiego", "Irvine", "a,b", "Çity"]), "n" + note + "."))
        w.writerow(rows[-1])
    return out.getvalue(), rows


@pytest.mark.parametrize("size", [300, 1 << 27])
def test_any_range_gives_the_same_records(spark, tmpdir_path, ranges, size):
    rng = random.Random(4)
    text, rows = _table(rng, 200)
    dos, more = _table(rng, 100, "\r\n")
    _file(tmpdir_path, "202401", text.encode())
    _file(tmpdir_path, "202402", dos.encode("cp1252"))
    _file(tmpdir_path, "202403", b"")
    _file(tmpdir_path, "202404", b"key,note,city\n")
    files = monthly.list_monthly_files(spark, [tmpdir_path], "Sold")
    with ranges(size):
        table = monthly.MonthlyTable(spark, files)
    got = sorted((r.yyyymm, r.key, r.city, r.note) for r in table.df.collect())
    assert got == sorted([("202401", *r) for r in rows] + [("202402", *r) for r in more])
    assert {os.path.basename(r._source_file)[9:15]: r.rows for r in table.rows_per_file().collect()} == {"202401": 200, "202402": 100, "202404": 0}
    enc = {r.path[-10:-4]: r.encoding for r in monthly.classify_encoding(spark, [tmpdir_path]).collect()}
    assert enc == {"202401": "utf8", "202402": "cp1252", "202404": "utf8"}


def test_many_ranges_of_a_file(spark, tmpdir_path, ranges):
    """A record over many ranges, and a character whose bytes lie on both sides
    of a range's border."""
    body = 'key,city,note\n1,"' + "é\n" * 200 + '",x\n' + "2,éééé,y\n" * 100 + '3,"' + 'a ""b"",\n' * 50 + '",z\n'
    path = _file(tmpdir_path, "202401", body.encode())
    assert any(body.encode()[i] & 0xC0 == 0x80 for i in range(50, len(body.encode()), 50))
    with ranges(50):
        records = Records(spark, [path])
    assert records.ranges.count() > 20
    with ranges(50):
        df = monthly.read_monthly(spark, monthly.list_monthly_files(spark, [tmpdir_path], "Sold"))
    rows = df.collect()
    assert len(rows) == 102
    by = {r.key: r for r in rows}
    assert by["1"].city == "é\n" * 200 and by["2"].city == "éééé" and by["3"].city == 'a "b",\n' * 50 and by["3"].note == "z"


def test_stray_quotes_and_ends(spark, tmpdir_path):
    body = 'key,city,note\n\n1,5" pipe,a"b\r\n2,"x" y,z\n\n3,,\n4\n5,"NA",extra,more\n6,"last"'
    _file(tmpdir_path, "202401", b"\xef\xbb\xbf" + body.encode())
    df = monthly.read_monthly(spark, monthly.list_monthly_files(spark, [tmpdir_path], "Sold"))
    rows = {r.key: (r.city, r.note) for r in df.collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "6"}
    assert rows["1"] == ('5" pipe', 'a"b') and rows["3"] == (None, None) == rows["4"] and rows["5"] == (None, "extra") and rows["6"] == ("last", None)


def test_unbalanced_and_too_long(spark, tmpdir_path):
    path = _file(tmpdir_path, "202401", b'key,city\n1,"open\n2,x\n')
    with pytest.raises(ValueError, match="open at the end"):
        Records(spark, [path])
    path = _file(tmpdir_path, "202402", b'key,city\n1,"a\n' + b"b\n" * 200 + b'"\n')
    with pytest.raises(ValueError, match="more than 100 bytes"):
        Records(spark, [path], record_bytes=100)


def _effect_brute(line, inside):
    """Character by character."""
    state = "quoted" if inside else "begin"
    i = 0
    while i < len(line):
        c = line[i]
        if state == "begin":
            state = "quoted" if c == '"' else "begin" if c == "," else "plain"
        elif state == "plain":
            state = "begin" if c == "," else "plain"
        elif c == '"':
            if line[i + 1 : i + 2] == '"':
                i += 1
            else:
                state = "plain"
        i += 1
    return state == "quoted"


def test_line_effect():
    rng = random.Random(2)
    for _ in range(20_000):
        line = "".join(rng.choices('",a', k=rng.randrange(0, 12)))
        assert line_effect(line.encode()) == (_effect_brute(line, False), _effect_brute(line, True)), line
