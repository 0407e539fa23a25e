"""Stage 2 profile: numeric distribution and the six EDA questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.functions.quantiles import exact_percentiles
from parcelflow.functions.scalars import rows_or_null
from parcelflow.session import cut_lineage


def _pname(p: float) -> str:
    return f"p{int(round(p * 100))}"


def numeric_distribution(df: DataFrame, fields: Sequence[str] = C.PROFILE_FIELDS,
                         probs: Sequence[float] = C.PERCENTILES, accuracy: int = 10_000) -> DataFrame:
    """Per field n, min, max, mean (2 dp), median and the percentiles."""
    probs = list(probs)
    allp = sorted(set(probs) | {0.5})
    df = cut_lineage(df.select(*fields))
    q = exact_percentiles(df, list(fields), allp, accuracy=accuracy, staged=True)
    wide = q.groupBy("field").agg(
        F.first("n").alias("n"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(_pname(p)) for p in probs])
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("v")) for f in fields])
    basic = (df.select(F.inline(arr)).where(F.col("v").isNotNull() & ~F.isnan("v"))
             .groupBy("field").agg(F.min("v").alias("min"), F.max("v").alias("max"),
                                   F.round(F.avg("v"), 2).alias("mean")))
    return wide.join(basic, "field").select("field", "n", "min", "max", "mean", "median",
                                            *[_pname(p) for p in probs])


def type_share(full: DataFrame) -> DataFrame:
    """PropertyType share (%) of rows with a non-null type."""
    typed = full.where(F.col("PropertyType").isNotNull())
    per = typed.groupBy("PropertyType").agg(F.count(F.lit(1)).alias("n"))
    return (per.select("PropertyType", "n", (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("share_pct"))
            .orderBy(F.desc("n"), "PropertyType"))


def price_center(res: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """ClosePrice median and mean."""
    res = cut_lineage(res.select("ClosePrice"))
    med = exact_percentiles(res, ["ClosePrice"], [0.5], accuracy=accuracy, staged=True).select(
        F.col("value").alias("median_price"))
    mean = res.agg(F.avg(F.col("ClosePrice").cast("double")).alias("mean_price"))
    return med.crossJoin(mean)


def dom_distribution(res: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """DaysOnMarket median, mean, p25, p75, max."""
    res = cut_lineage(res.select("DaysOnMarket"))
    q = exact_percentiles(res, ["DaysOnMarket"], [0.25, 0.5, 0.75], accuracy=accuracy, staged=True)
    wide = q.agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n)
                   for p, n in [(0.5, "median"), (0.25, "p25"), (0.75, "p75")]])
    basic = res.agg(F.avg(F.col("DaysOnMarket").cast("double")).alias("mean"),
                    F.max(F.col("DaysOnMarket").cast("double")).alias("max"))
    return wide.crossJoin(basic)


def vs_list_share(res: DataFrame) -> DataFrame:
    """A10 + P29: over rows with both prices and ListPrice > 0, the share (%)
    closing above, below and at the list price."""
    both = res.where(F.col("ClosePrice").isNotNull() & F.col("ListPrice").isNotNull()
                     & (F.col("ListPrice") > 0))
    cp, lp = F.col("ClosePrice"), F.col("ListPrice")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(cp > lp) * 100.0 / rows_or_null()).alias("above_pct"),
        (F.count_if(cp < lp) * 100.0 / rows_or_null()).alias("below_pct"),
        (F.count_if(cp == lp) * 100.0 / rows_or_null()).alias("at_pct"))


def close_before_list(res: DataFrame) -> DataFrame:
    """Rows with both dates; count and share (%) closing before listing."""
    dd = res.where(F.col("ListingContractDate").isNotNull() & F.col("CloseDate").isNotNull())
    bad = F.count_if(F.col("CloseDate") < F.col("ListingContractDate"))
    return dd.agg(F.count(F.lit(1)).alias("n"), bad.alias("close_before_list"),
                  (bad * 100.0 / rows_or_null()).alias("pct"))


def top_counties(res: DataFrame, top: int = 10, accuracy: int = 10_000) -> DataFrame:
    """A12 + T1: top counties by median ClosePrice (ties by name)."""
    q = exact_percentiles(res, ["ClosePrice"], [0.5], by=["CountyOrParish"], accuracy=accuracy)
    return (q.select("CountyOrParish", F.col("value").alias("median_price"))
            .orderBy(F.desc("median_price"), "CountyOrParish").limit(top))
