"""Stages 1-2: consolidation, filters, keep-list reduction and structure
reports (U1, U2, P1-P7, P9, A1-A5, A49)."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.functions.scalars import yyyymm_end, yyyymm_start


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union-all aligned by column name; a column missing from a part is null."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def residential(df: DataFrame) -> DataFrame:
    """PropertyType == 'Residential'."""
    return df.where(F.col("PropertyType") == "Residential")


def closed_in_month(df: DataFrame, yyyymm: str) -> DataFrame:
    """P2 + F14: closed sales with CloseDate in the half-open month."""
    start, end = yyyymm_start(F.lit(yyyymm)), yyyymm_end(F.lit(yyyymm))
    return df.where((F.col("MlsStatus") == "Closed") & (F.col("CloseDate") >= start)
                    & (F.col("CloseDate") < end))


def listed_in_month(df: DataFrame, yyyymm: str, date_col: str = "ListingContractDate") -> DataFrame:
    """P3 + F14: listings with the contract date in the half-open month."""
    start, end = yyyymm_start(F.lit(yyyymm)), yyyymm_end(F.lit(yyyymm))
    return df.where((F.col(date_col) >= start) & (F.col(date_col) < end))


def select_unique(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Project each name once, in first-seen order."""
    return df.select(*dict.fromkeys(names))


def keep_columns(df: DataFrame, keep: Sequence[str] = C.KEEP_COLUMNS) -> DataFrame:
    """P5: the keep-list columns that exist, in keep-list order."""
    return df.select(*[c for c in keep if c in df.columns])


def residential_reduced(df: DataFrame, dataset: str = "sold") -> DataFrame:
    """Residential filter then keep-list; the rate join key must survive."""
    out = keep_columns(residential(df))
    key = C.JOIN_KEYS[dataset]
    if key not in out.columns:
        raise ValueError(f"join key {key} was dropped by the keep-list")
    return out


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position."""
    return df.toDF(*names)


def row_checkpoints(parts: Sequence[DataFrame], whole: DataFrame) -> DataFrame:
    """A1 + U2: rows of every input part by its own scan, their sum, the rows of
    the concatenated table and its Residential rows; ``lossless`` says whether sum
    and total agree."""
    per = functools.reduce(DataFrame.unionAll, [p.agg(F.count(F.lit(1)).alias("rows")) for p in parts])
    tot = whole.agg(F.count(F.lit(1)).alias("rows_concat"), F.count_if(F.col("PropertyType") == "Residential").alias("rows_residential"))
    return (per.agg(F.count_if(F.col("rows") > 0).alias("parts"), F.sum("rows").alias("rows_sum")).crossJoin(tot)
            .select("parts", "rows_sum", "rows_concat", "rows_residential",
                    (F.col("rows_sum") == F.col("rows_concat")).alias("lossless")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A2: counts per value, nulls included, descending by count."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_last("value")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A3: sorted distinct non-null values."""
    return df.select(F.col(col).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def null_report(df: DataFrame) -> DataFrame:
    """A4: null count and percent (2 dp) per column; over_90pct_null compares
    the rounded percent (90.004 is not flagged); sorted by percent desc."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = one.unpivot(["_n"], cols, "column", "null_count")
    pct = F.round(F.col("null_count") * 100.0 / F.nullif(F.col("_n"), F.lit(0)), 2)
    return (long.select("column", F.col("null_count").cast("long").alias("null_count"),
                        pct.alias("null_pct"))
            .withColumn("over_90pct_null", F.col("null_pct") > 90)
            .orderBy(F.desc("null_pct"), "column"))


def column_drop_report(df: DataFrame, keep: Sequence[str] = C.KEEP_COLUMNS) -> DataFrame:
    """Every input column with its reason: kept / dropped_over_90pct_null /
    dropped_other."""
    keep_df = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(keep)],
                                              "column string, keep_pos int")
    return (null_report(df).join(F.broadcast(keep_df), "column", "left")
            .select("column", F.when(F.col("keep_pos").isNotNull(), "kept")
                    .when(F.col("over_90pct_null"), "dropped_over_90pct_null")
                    .otherwise("dropped_other").alias("reason")))


def column_drop_counts(df: DataFrame, keep: Sequence[str] = C.KEEP_COLUMNS) -> DataFrame:
    """Columns per reason and their share (%) of all input columns."""
    rep = column_drop_report(df, keep)
    return (rep.groupBy("reason").agg(F.count(F.lit(1)).alias("columns"))
            .withColumn("share_pct", F.col("columns") * 100.0 / F.lit(len(df.columns)))
            .orderBy("reason"))


def schema_report(df: DataFrame) -> DataFrame:
    """A5: position, name, Spark type and values that are not null of every
    column, from one aggregate over the table."""
    one = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])
    kinds = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    meta = df.sparkSession.createDataFrame(kinds, "position int, column string, dtype string")
    long = one.unpivot([], df.columns, "column", "non_null")
    return long.join(F.broadcast(meta), "column").select("position", "column", "dtype", "non_null").orderBy("position")


def shape(df: DataFrame) -> DataFrame:
    """A5: rows x columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview(df: DataFrame, cols: Sequence[str], n: int = 5) -> DataFrame:
    """P35 + T5: the first ``n`` rows of a projection. Ordered by the
    projected columns so the sample is the same on every run; the limit is
    the feature here (a stage preview), never a way to shrink work."""
    return df.select(*cols).orderBy(*[F.asc_nulls_first(c) for c in cols]).limit(n)
