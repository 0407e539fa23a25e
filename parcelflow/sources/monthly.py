"""Monthly extract files: discovery, encoding dispatch, header handling and
consolidation (S1, S2, S3, F13, G1, G2, G3, G23, G26, U1).

The file *list* is a DataFrame too (``binaryFile`` without its content
column, so no file body is read). Bodies are read by byte ranges, whatever the
size of a file (``sources.records``); the records of all files are parsed in one
pass, each by its own file's header, and land in columns by name.
"""

from __future__ import annotations

import csv
import functools
import io
import logging
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.sources.records import RECORD_BYTES, Records, file_encodings

log = logging.getLogger(__name__)

# Windows-1252 assigns printable characters to bytes 0x80-0x9F, which
# ISO-8859-1 maps to C1 controls. Reading as ISO-8859-1 and translating that
# range reproduces a cp1252 decode; the five bytes cp1252 leaves undefined
# stay as they are. Both strings are derived from Python's own codecs.
_C1 = bytes(range(0x80, 0xA0))
_LATIN1 = _C1.decode("latin-1")
_CP1252 = "".join(bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in _C1)


def list_monthly_files(spark: SparkSession, dirs: Sequence[str], prefix: str,
                       dedup: bool = True, missing: str = "skip") -> DataFrame:
    """S2 + S3 + F13: ``CRMLS<prefix><YYYYMM>.csv`` files under ``dirs``.

    Returns ``yyyymm, path, dir_rank, length, modified``. A folder that isn't
    there contributes no files, or raises with ``missing="raise"``. With ``dedup`` one file per
    month survives: the one from the earliest folder in ``dirs`` (then by
    path), the rule that lets a canonical folder beat stale copies."""
    pattern = C.MONTH_FILE_PATTERN.format(prefix=prefix)
    frames = []
    for rank, d in enumerate(dirs):
        try:
            df = (spark.read.format("binaryFile").option("pathGlobFilter", f"CRMLS{prefix}*.csv")
                  .load(d).select("path", "length", F.col("modificationTime").alias("modified")))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND" or missing == "raise":
                raise
            log.warning("folder of monthly files not found: %s", d)
            continue
        frames.append(df.withColumn("dir_rank", F.lit(rank)))
    if not frames:
        return spark.createDataFrame([], "yyyymm string, path string, dir_rank int, length long, modified timestamp")
    files = functools.reduce(DataFrame.unionByName, frames)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = (files.withColumn("yyyymm", F.regexp_extract(name, pattern, 1))
             .where(F.col("yyyymm") != ""))
    if dedup:
        w = Window.partitionBy("yyyymm").orderBy("dir_rank", "path")
        files = files.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return files.select("yyyymm", "path", "dir_rank", "length", "modified")


def classify_encoding(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Per file, ``utf8`` when its bytes are valid UTF-8, else
    ``cp1252``; read line by line, so a file may be of any size."""
    return file_encodings(spark, paths)


def _null_tokens(col: F.Column) -> F.Column:
    """The pandas default missing-value tokens become null."""
    return F.when(~col.isin(C.NULL_TOKENS), col)


def _names(record: str) -> tuple[str, ...]:
    """The raw names of a header record, duplicates kept (G1)."""
    return tuple(next(csv.reader(io.StringIO(record.removeprefix("\ufeff").rstrip("\r"), newline=""))))


def _decoded(raw: F.Column, encoding: str) -> F.Column:
    if encoding == "utf8":
        return raw
    return F.translate(F.decode(raw.cast("binary"), "ISO-8859-1"), _LATIN1, _CP1252)


class MonthlyTable:
    """U1 + S1: the listed monthly files as one table, aligned by column name
    across header variants and decoded per file.

    ``df`` has every column as string, ``_source_file`` and ``yyyymm``;
    ``rows_per_file`` is counted on the records of each file before they are
    parsed. Duplicate header names keep their first copy (G1), missing values are
    the usual tokens (G23), quoted fields may span lines and double their quotes
    (G26); absent fields at the end of a record are null, fields beyond the header
    are dropped, a file without a record gives no rows. Lists of files and their
    distinct headers are the only things read back."""

    def __init__(self, spark: SparkSession, files: DataFrame, record_bytes: int = RECORD_BYTES):
        listing = files.select("yyyymm", "path").collect()
        if not listing:
            raise ValueError("no monthly files")
        records = Records(spark, [r["path"] for r in listing], record_bytes)
        encoding = records.encodings()
        headers = records.headers()
        kinds: dict[tuple[tuple[str, ...], str], int] = {}
        kind_of = []
        for file, at, line, raw in headers.select("file", "range", "line", F.col("value").cast("binary")).collect():
            text = bytes(raw).decode("utf-8" if encoding[file] == "utf8" else "latin-1")
            names = _names(text if encoding[file] == "utf8" else text.translate(str.maketrans(_LATIN1, _CP1252)))
            kind_of.append((file, kinds.setdefault((names, encoding[file]), len(kinds)), records.paths[file], at, line))
        meta = F.broadcast(spark.createDataFrame(kind_of, "file long, _kind int, _source_file string, _range long, _line long"))  # a row a file
        rows = records.rows.join(meta, "file").where("range <> _range OR line <> _line")
        self._rows, self._meta = rows, meta
        width = max((len(names) for names, _ in kinds), default=1)
        schema = ", ".join(f"_c{i} string" for i in range(width))
        text = F.col("value")
        for (_, enc), kind in kinds.items():
            if enc != "utf8":
                text = F.when(F.col("_kind") == kind, _decoded(F.col("value"), enc)).otherwise(text)
        parsed = rows.select("_kind", "_source_file", F.from_csv(F.rtrim(text, F.lit("\r")), schema, {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}).alias("r"))
        place: dict[str, dict[int, int]] = {}
        for (names, _), kind in kinds.items():
            for i, name in enumerate(names):
                place.setdefault(name, {}).setdefault(kind, i)
        columns = []
        for name, at in place.items():
            c = F.lit(None).cast("string")
            for i in sorted(set(at.values())):
                c = F.when(F.col("_kind").isin([k for k, j in at.items() if j == i]), F.col(f"r._c{i}")).otherwise(c)
            columns.append(_null_tokens(c).alias(name))
        # the month is in the row's own file name, whatever its folder is called
        name = F.regexp_extract("_source_file", r"([^/]+)$", 1)
        month = F.regexp_extract(name, r"([0-9]{6})\.csv$", 1)
        month = F.when(month != "", month).otherwise(F.raise_error(F.concat(F.lit("no month in file name: "), name)))
        #: the file of each month
        self.months = {re.search(r"([0-9]{6})\.csv$", path)[1]: path for _, _, path, _, _ in kind_of}
        self.df = parsed.select(*columns, "_source_file", month.alias("yyyymm"))

    def rows_per_file(self) -> DataFrame:
        """(_source_file, rows) of every file with a header."""
        counts = self._rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows"))
        return self._meta.select("_source_file").join(counts, "_source_file", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


def read_monthly(spark: SparkSession, files: DataFrame) -> DataFrame:
    """The rows of the listed monthly files, see ``MonthlyTable``."""
    return MonthlyTable(spark, files).df
