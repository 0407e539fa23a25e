"""Landed API pages: ``{"value": [...], "@odata.nextLink": ...}`` files, one
or more per month (S4, S5, P4). The records array becomes rows with
``explode``; listed fields absent from a record come out null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEXT = "@odata.nextLink"


def read_pages(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """S4 + P4: rows of every page under ``path``, projected to ``fields``
    (each name once, first-seen order), all as string, plus the source page."""
    names = list(dict.fromkeys(fields))
    rec = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([T.StructField("value", T.ArrayType(rec)),
                           T.StructField(NEXT, T.StringType())])
    pages = spark.read.schema(schema).option("multiLine", True).json(path)
    return (pages.select(F.input_file_name().alias("page"), F.explode("value").alias("r"))
            .select(*[F.col("r")[n].alias(n) for n in names], "page"))


def page_completeness(spark: SparkSession, path: str, month_pattern: str = r"(\d{6})") -> DataFrame:
    """Per month (taken from the page file name), pages seen and pages
    without a next link; a month is complete when exactly one page lacks it."""
    schema = T.StructType([T.StructField(NEXT, T.StringType())])
    pages = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1)
    return (pages.select(F.regexp_extract(name, month_pattern, 1).alias("yyyymm"),
                         F.col(f"`{NEXT}`").isNull().alias("last"))
            .groupBy("yyyymm")
            .agg(F.count(F.lit(1)).alias("pages"), F.count_if("last").alias("last_pages"))
            .withColumn("complete", F.col("last_pages") == 1))
