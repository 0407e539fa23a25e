"""CSV records of files of any size, read by byte ranges.

Spark's text scan cuts files into ranges on line ends, so a range never cuts a
character and a line's bytes stay as they are. What a line end means depends on
the lines before: within quotes it belongs to a field. So each range follows two
cases at once, entered outside or inside quotes, and keeps for each line the line
on which its record begins, in either case. A prefix pass over the ranges of a
file (one row a range) composes their effect in order, which picks the case of
each range, and tells where a record that a range inherits began. Records of one
line, nearly all, are then complete; the lines of the others are brought together.

The ranges are read once: lines with both cases are a stage table, so the passes
agree on the ranges whatever the session's split settings. A quote opens a field
only at its beginning and is doubled inside, as in the usual CSV dialect; other
quotes are plain characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.session import stage_table

#: Bytes of one record of several lines; a file with a longer one is refused.
RECORD_BYTES = 1 << 24
#: Rows of the table of ranges (five longs each) that may be broadcast.
BROADCAST_RANGES = 500_000

_STAYS_OPEN = re.compile(rb'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+|,)*+"(?:[^"]++|"")*+')
_QUOTED = re.compile(rb'(?:[^"]++|"")*+')
_REST = re.compile(rb"[^,]*+")
LINES = "file long, range long, line long, value binary, start0 long, start1 long, open0 boolean, open1 boolean"


def line_effect(line: bytes) -> tuple[bool, bool]:
    """Whether a quoted field is open after the line, if none or one was before."""
    outside = _STAYS_OPEN.fullmatch(line) is not None
    at = _QUOTED.match(line).end()
    if at == len(line):
        return outside, True
    return outside, _STAYS_OPEN.fullmatch(line, _REST.match(line, at + 1).end()) is not None


class _Range:
    """Both cases of one range, line by line in order."""

    def __init__(self) -> None:
        self.open = [False, True]
        self.start = [-1, -1]
        self.lines = 0

    def read(self, values: pa.Array) -> list[np.ndarray]:
        """start0, start1, open0, open1 of each line."""
        n = len(values)
        marked = np.flatnonzero(np.asarray(pc.match_substring(values, '"')))
        effects = [line_effect(v) for v in values.take(pa.array(marked)).to_pylist()]
        number = np.arange(self.lines, self.lines + n)
        starts, opens = [], []
        for case in (0, 1):
            after = np.empty(len(marked), bool)
            now = self.open[case]
            for k, effect in enumerate(effects):
                after[k] = now = effect[now]
            last = np.searchsorted(marked, np.arange(n), "right") - 1  # lines without a quote change nothing
            open_ = np.where(last >= 0, after[last], self.open[case]) if len(marked) else np.full(n, self.open[case])
            before = np.concatenate([[self.open[case]], open_[:-1]])
            start = np.maximum(np.maximum.accumulate(np.where(before, -1, number)), self.start[case])
            starts.append(start)
            opens.append(open_)
            self.open[case], self.start[case] = bool(open_[-1]), int(start[-1])
        self.lines += n
        return [*starts, *opens]


def _both_cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state = None, _Range()
    for batch in batches:
        where = np.stack([np.asarray(batch.column("file")), np.asarray(batch.column("range"))], axis=1)
        cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low == high:
                continue
            if at != tuple(where[low]):
                at, state = tuple(where[low]), _Range()
            part = batch.slice(low, high - low)
            number = np.arange(state.lines, state.lines + high - low)
            cases = state.read(part.column("value"))
            yield pa.RecordBatch.from_arrays([part.column("file"), part.column("range"), pa.array(number), part.column("value"), *map(pa.array, cases)],
                                             names=[c.split()[0] for c in LINES.split(", ")])


def _text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, range, value): lines with their bytes unchanged."""
    lines = spark.read.format("text").option("lineSep", "\n").load(list(paths))
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"), "value")


def file_encodings(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, encoding): ``utf8`` where every line is valid UTF-8, else
    ``cp1252``. A line end is no part of a longer character, so a file is valid
    if its lines are."""
    if not paths:
        return spark.createDataFrame([], "path string, encoding string")
    return _text(spark, paths).groupBy("path").agg(
        F.when(F.bool_and(F.is_valid_utf8("value")), "utf8").otherwise("cp1252").alias("encoding"))


class Records:
    """The records of CSV files. ``paths`` are the files' URIs in the order of
    their numbers, ``rows`` is (file, range, line, value): the range and line on
    which a record begins and its bytes, without the line feed at the end. Empty
    lines are no records. A file that ends within quotes, or has a record longer than
    ``record_bytes``, raises."""

    def __init__(self, spark: SparkSession, paths: Sequence[str], record_bytes: int = RECORD_BYTES):
        listed = spark.read.format("binaryFile").load(list(paths)).select("_metadata.file_path")  # no body is read
        self.paths = sorted(r.file_path for r in listed.collect())
        numbers = spark.createDataFrame(list(enumerate(self.paths)), "file long, path string")
        text = _text(spark, paths).join(F.broadcast(numbers), "path", "left")
        known = F.coalesce("file", F.raise_error(F.concat(F.lit("file was not listed: "), "path")).cast("long"))
        lines = text.select(known.alias("file"), "range", F.col("value").cast("binary").alias("value"))
        self.lines = stage_table(lines.mapInArrow(_both_cases, LINES), "csv-lines")
        self.ranges = stage_table(self._ranges(), "csv-ranges")
        unclosed = [self.paths[r.file] for r in self.ranges.where("last AND open").select("file").collect()]
        if unclosed:
            raise ValueError(f"a quoted field is open at the end of {unclosed}")
        self.rows = self._rows(record_bytes)

    def _ranges(self) -> DataFrame:
        """(file, range, entered, open, last, from_range, from_line): whether the
        range is entered and left within quotes, and where the record that it
        inherits began."""
        ends = self.lines.groupBy("file", "range").agg(F.max_by(F.struct("open0", "open1", "start0", "start1"), "line").alias("e")).select("file", "range", "e.*")
        order = Window.partitionBy("file").orderBy("range")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        swaps = F.col("open0") & ~F.col("open1")
        ends = ends.withColumn("swaps", F.sum(swaps.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        fixed = F.when(F.col("open0") == F.col("open1"), F.struct(F.col("open0").cast("int").alias("open"), "swaps"))
        ends = ends.withColumns({"swapped": F.coalesce(F.lag("swaps").over(order), F.lit(0)), "fixed": F.last(fixed, ignorenulls=True).over(before)})
        # the last range that leaves a fixed state, and the swaps since
        entered = F.coalesce(F.col("fixed.open") + F.col("swapped") - F.col("fixed.swaps"), F.col("swapped")) % 2 == 1
        ends = ends.withColumn("entered", entered)
        ends = ends.withColumns({"open": F.when(F.col("entered"), F.col("open1")).otherwise(F.col("open0")),
                                 "start": F.when(F.col("entered"), F.col("start1")).otherwise(F.col("start0")),
                                 "last": F.lead("range").over(order).isNull()})
        begun = F.when(F.col("open") & (F.col("start") >= 0), F.struct(F.col("range"), F.col("start").alias("line")))
        ends = ends.withColumn("begun", F.last(begun, ignorenulls=True).over(before))
        return ends.select("file", "range", "entered", "open", "last", F.col("begun.range").alias("from_range"), F.col("begun.line").alias("from_line"))

    def _rows(self, record_bytes: int) -> DataFrame:
        ranges = self.ranges.drop("open", "last")
        if ranges.count() <= BROADCAST_RANGES:
            ranges = F.broadcast(ranges)
        start = F.when(F.col("entered"), F.col("start1")).otherwise(F.col("start0"))
        lines = (self.lines.join(ranges, ["file", "range"])
                 .withColumns({"start": start, "open": F.when(F.col("entered"), F.col("open1")).otherwise(F.col("open0"))}))
        single = (F.col("start") == F.col("line")) & ~F.col("open")
        own = F.col("start") >= 0
        parts = lines.where(~single).select("file", F.when(own, F.col("range")).otherwise(F.col("from_range")).alias("of_range"),
                                            F.when(own, F.col("start")).otherwise(F.col("from_line")).alias("of_line"), "range", "line", "value")
        long = (parts.groupBy("file", "of_range", "of_line").agg(F.sum(F.length("value") + 1).alias("n"))
                .where(F.col("n") > record_bytes).limit(10).collect())
        if long:
            raise ValueError(f"records of more than {record_bytes} bytes: {[(self.paths[r.file], r.of_range, r.of_line) for r in long]}")
        whole = (parts.groupBy("file", "of_range", "of_line").agg(F.sort_array(F.collect_list(F.struct("range", "line", "value"))).alias("l"))
                 .select("file", F.col("of_range").alias("range"), F.col("of_line").alias("line"),
                         F.array_join(F.transform("l", lambda x: x["value"].cast("string")), "\n").alias("value")))
        rows = lines.where(single).select("file", "range", "line", F.col("value").cast("string").alias("value")).unionAll(whole)
        return rows.where(~F.col("value").isin("", "\r"))

    def encodings(self) -> dict[int, str]:
        """Encoding by file number, see ``file_encodings``."""
        valid = self.lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8(F.col("value").cast("string"))).alias("valid"))
        return {r.file: "utf8" if r.valid else "cp1252" for r in valid.collect()}

    def headers(self) -> DataFrame:
        """(file, range, line, value) of each file's first record."""
        first = F.struct("range", "line")
        return (self.rows.groupBy("file").agg(F.min_by(F.struct("range", "line", "value"), first).alias("h")).select("file", "h.*"))
