"""Sinks (S6, S11-S14). Parquet inside the pipeline, CSV only at the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_monthly(df: DataFrame, path: str, month_col: str = "yyyymm") -> None:
    """One output partition per month; re-running a month replaces only
    that month (dynamic partition overwrite)."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        df.write.mode("overwrite").partitionBy(month_col).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full table; Parquet by default, CSV with header on request."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_small_table(df: DataFrame, path: str) -> None:
    """A report of a handful of rows (segment top-10) as one CSV file.
    Only for results whose size is bounded by construction."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_extract(df: DataFrame, path: str) -> int:
    """S13 + S14: publish a typed extract and return the row count read back."""
    from parcelflow.sources.publish import publish
    return publish(df, path)


def read_back_count(spark: SparkSession, path: str) -> int:
    """Rows in a written table (from Parquet footers where possible)."""
    return spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0]
