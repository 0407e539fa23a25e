"""Two-phase publishing of tables and the incremental monthly table
(S6, S9, S14, U2).

A table is written aside, read back and compared with what the writing job
observed, and only then renamed into place; until then readers see the old one.
The monthly table is rebuilt by month: a manifest remembers each month's file, and
a run reads and replaces only the months whose file is new, changed or gone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.sources.monthly import MonthlyTable, list_monthly_files
from parcelflow.sources.sinks import write_monthly


class PublishError(ValueError):
    """What was written is not what was meant to be."""


class _Files:
    """The file system of a path, through Spark's own client."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, path: str, to: str) -> None:
        if not self._fs.rename(self._path(path), self._path(to)):
            raise PublishError(f"cannot rename {path} to {to}")


def _fingerprint(df: DataFrame) -> list[Column]:
    """Rows and an order-free checksum; maps, which have no hash, are left out."""
    cols = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(20,0)")).alias("checksum")]


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], str | None] | None = None) -> int:
    """Replace the Parquet table at ``path`` by ``df``; returns its rows.

    The new table is written beside the old one. It takes its place only if rows
    and checksum read back equal those that the writing job saw, and ``check`` of
    the written table gives no complaint; otherwise ``PublishError`` is raised and
    the old table stays. A reader between the two renames finds no table."""
    spark, mark = df.sparkSession, uuid.uuid4().hex
    files, aside, old = _Files(spark, path), f"{path}.new-{mark}", f"{path}.old-{mark}"
    seen = Observation("written")
    try:
        df.observe(seen, *_fingerprint(df)).write.parquet(aside)
        back = spark.read.schema(df.schema).parquet(aside)
        found = back.agg(*_fingerprint(back)).first().asDict()
        if found != seen.get:
            raise PublishError(f"{path}: wrote {seen.get}, read back {found}")
        complaint = check(back) if check else None
        if complaint:
            raise PublishError(f"{path}: {complaint}")
    except BaseException:
        files.delete(aside)
        raise
    had = files.exists(path)
    if had:
        files.rename(path, old)
    try:
        files.rename(aside, path)
    except BaseException:
        if had:
            files.rename(old, path)
        raise
    if had:
        files.delete(old)
    return found["rows"]


def write_lossless(table: MonthlyTable, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write the union of all files and compare, file by file, the rows that
    the writing job saw with those counted on each file's records beforehand. A
    part that was dropped, cut or doubled raises. Returns rows by file."""
    expected = {r["_source_file"]: r["rows"] for r in table.rows_per_file().collect()}
    seen = Observation("union")
    names = sorted(expected)
    per_file = [F.count_if(F.col("_source_file") == f).alias(f"f{i}") for i, f in enumerate(names)]
    write(table.df.observe(seen, F.count(F.lit(1)).alias("rows"), *per_file))
    got = seen.get
    wrong = {f: (expected[f], got[f"f{i}"]) for i, f in enumerate(names) if got[f"f{i}"] != expected[f]}
    if wrong or got["rows"] != sum(expected.values()):
        raise PublishError(f"the union is not lossless: {got['rows']} rows for {sum(expected.values())}, (records, rows) by file: {wrong}")
    return expected


MANIFEST = "yyyymm string, path string, length long, modified timestamp"


def month_changes(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """(yyyymm, change): ``new``, ``changed`` (another file, length or time) or
    ``gone``; months whose file is as the manifest has it are absent."""
    a, b = listing.alias("a"), manifest.alias("b")
    same = (F.col("a.path") == F.col("b.path")) & (F.col("a.length") == F.col("b.length")) & (F.col("a.modified") == F.col("b.modified"))
    change = F.when(F.col("b.path").isNull(), "new").when(F.col("a.path").isNull(), "gone").when(~same, "changed")
    return (a.join(b, F.col("a.yyyymm") == F.col("b.yyyymm"), "full")
            .select(F.coalesce("a.yyyymm", "b.yyyymm").alias("yyyymm"), change.alias("change")).where("change IS NOT NULL"))


def refresh_months(spark: SparkSession, dirs: Sequence[str], prefix: str, path: str, missing_dirs: str = "skip") -> Mapping[str, str]:
    """Bring the monthly table at ``path`` (partitions ``yyyymm``) up to date with
    the landed files; returns the changes by month. Only new and changed months
    are read and written; a month whose file is gone or empty is removed. The
    manifest is published last, so a run that fails is repeated by the next."""
    store = f"{path}.manifest"
    files = _Files(spark, path)
    listing = list_monthly_files(spark, dirs, prefix, missing=missing_dirs)
    manifest = spark.read.schema(MANIFEST).parquet(store) if files.exists(store) else spark.createDataFrame([], MANIFEST)
    changes = {r["yyyymm"]: r["change"] for r in month_changes(listing, manifest).collect()}  # a row a month
    todo = [m for m, c in changes.items() if c != "gone"]
    filled: set[str] = set()
    if todo:
        table = MonthlyTable(spark, listing.where(F.col("yyyymm").isin(todo)))
        rows = write_lossless(table, lambda df: write_monthly(df, path))
        filled = {month for month, file in table.months.items() if rows.get(file)}
    for month in changes:
        if month not in filled:
            files.delete(f"{path}/yyyymm={month}")
    if changes:
        publish(listing.select("yyyymm", "path", "length", "modified"), store)
    return changes


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The monthly table; months written with other columns are merged by name."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.withColumn("yyyymm", F.col("yyyymm").cast("string"))
