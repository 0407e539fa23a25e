"""Stage 7: dashboard extracts and the monthly worksheet queries
(A41-A47, P31-P33, P36, F5, F8, F11, S13).

A worksheet is one declarative plan: optional member filters on the four
dimensions, an optional IQR base and ratio range, then a group-by on the
truncated month. Medians go through the distributed exact quantile;
averages and counts are plain partial aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.functions.quantiles import exact_percentiles
from parcelflow.functions.scalars import month_key, month_start, postal_text


def dimension_filter(df: DataFrame, filters: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Multi-select member filters; a dimension without a selection
    keeps every member (including nulls)."""
    for dim, members in (filters or {}).items():
        if dim not in C.FILTER_DIMS:
            raise ValueError(f"not a filter dimension: {dim}")
        if members:
            df = df.where(F.col(dim).isin(list(members)))
    return df


def iqr_base(df: DataFrame) -> DataFrame:
    """The IQR-filtered base used by the average sheets."""
    return df.where(F.col("any_iqr_outlier_flag") == 0)


def ratio_range(df: DataFrame, lo: float = 0.0, hi: float = 2.0) -> DataFrame:
    """Inclusive price-ratio range."""
    return df.where(F.col("price_ratio").between(lo, hi))


def monthly_metric(df: DataFrame, date_col: str, measure: str, how: str,
                   filters: Mapping[str, Sequence[str]] | None = None,
                   iqr_only: bool = False, ratio_bound: tuple[float, float] | None = None,
                   out: str = "value", accuracy: int = 10_000) -> DataFrame:
    """One worksheet: ``how`` in {median, avg, count} of ``measure`` per month
    of ``date_col`` (``month`` = first day of the month). Rows without a date
    are dropped, as the month axis has no null member."""
    d = dimension_filter(df, filters)
    if iqr_only:
        d = iqr_base(d)
    if ratio_bound is not None:
        d = ratio_range(d, *ratio_bound)
    d = d.withColumn("month", month_start(date_col)).where(F.col("month").isNotNull())
    if how == "median":
        q = exact_percentiles(d, [measure], [0.5], by=["month"], accuracy=accuracy)
        months = d.select("month").distinct()
        return months.join(q.select("month", F.col("value").alias(out)), "month", "left")
    if how == "avg":
        return d.groupBy("month").agg(F.avg(F.col(measure).cast("double")).alias(out))
    if how == "count":
        return d.groupBy("month").agg(F.count(measure).alias(out))
    raise ValueError(how)


def monthly_median_price(sold: DataFrame, filters=None, accuracy: int = 10_000) -> DataFrame:
    """Median close price per close month, all rows."""
    return monthly_metric(sold, "CloseDate", "ClosePrice", "median", filters,
                          out="median_close_price", accuracy=accuracy)


def avg_dom(sold: DataFrame, filters=None) -> DataFrame:
    """Mean days on market per close month, IQR base."""
    return monthly_metric(sold, "CloseDate", "days_on_market", "avg", filters, iqr_only=True,
                          out="avg_days_on_market")


def avg_ratio(sold: DataFrame, filters=None, bounds: tuple[float, float] = (0.0, 2.0)) -> DataFrame:
    """Mean of per-sale ratios per close month, IQR base, ratio in [0, 2]."""
    return monthly_metric(sold, "CloseDate", "price_ratio", "avg", filters, iqr_only=True,
                          ratio_bound=bounds, out="avg_price_ratio")


def new_listings(listings: DataFrame, filters=None) -> DataFrame:
    """Listings per listing month (count of the month text)."""
    return monthly_metric(listings, "ListingContractDate", "ListYrMo", "count", filters,
                          out="new_listings")


def closed_sales(sold: DataFrame, filters=None) -> DataFrame:
    """Closed sales per month = non-null ClosePrice count."""
    return monthly_metric(sold, "CloseDate", "ClosePrice", "count", filters, out="closed_sales")


def rates_and_market(sold: DataFrame, filters=None, accuracy: int = 10_000) -> DataFrame:
    """Median close price and mean national rate on one month axis."""
    med = monthly_median_price(sold, filters, accuracy)
    rate = monthly_metric(sold, "CloseDate", "rate_30yr_fixed", "avg", filters, out="avg_rate")
    return med.join(rate, "month", "full")


def filter_members(df: DataFrame, dims: Sequence[str] = C.FILTER_DIMS) -> DataFrame:
    """The member list of every filter card (dimension, value)."""
    arr = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member"))
                    for d in dims])
    return df.select(F.inline(arr)).where(F.col("member").isNotNull()).distinct()


def extract_sold(iqr_flagged: DataFrame) -> DataFrame:
    """S13 + P36 + F8 + F11: the trimmed, typed sold extract (12 columns)."""
    return iqr_flagged.select(
        F.col("CloseDate").cast("date").alias("CloseDate"), F.col("YrMo").cast("string").alias("YrMo"),
        *[F.col(c).cast("double").alias(c) for c in ["ClosePrice", "price_ratio", "days_on_market"]],
        F.col("City").cast("string"), F.col("CountyOrParish").cast("string"),
        postal_text("PostalCode").alias("PostalCode"), F.col("PropertySubType").cast("string"),
        F.col("DistrictName").cast("string"), F.col("any_iqr_outlier_flag").cast("long"),
        F.col("rate_30yr_fixed").cast("double"))


def extract_listings(iqr_flagged: DataFrame) -> DataFrame:
    """S13 + P36: the trimmed, typed listings extract (7 columns)."""
    return iqr_flagged.select(
        F.col("ListingContractDate").cast("date").alias("ListingContractDate"),
        month_key("ListingContractDate").alias("ListYrMo"),
        F.col("City").cast("string"), F.col("CountyOrParish").cast("string"),
        postal_text("PostalCode").alias("PostalCode"), F.col("PropertySubType").cast("string"),
        F.col("any_iqr_outlier_flag").cast("long"))
