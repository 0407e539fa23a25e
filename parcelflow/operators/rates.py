"""Stage 3: weekly -> monthly rate series and the rate enrichment join
(A13, A14, P30, J1, J2, V5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from parcelflow.functions.scalars import lenient_date, month_key

# The monthly series has one row per calendar month since 1971 (~700 rows);
# its size bound is structural, so it is always broadcast to the fact side.
MAX_MONTHS = 12 * 400


def monthly_rates(weekly: DataFrame, digits: int = 4) -> DataFrame:
    """Mean of the weekly observations per calendar month, rounded."""
    return (weekly.where(F.col("date").isNotNull())
            .groupBy(month_key("date").alias("year_month"))
            .agg(F.round(F.avg("rate_30yr_fixed"), digits).alias("rate_30yr_fixed")))


def rate_window(monthly: DataFrame, first: str = "2024-01", last: str = "2026-06") -> DataFrame:
    """Clamp the monthly series to an inclusive month window."""
    return monthly.where(F.col("year_month").between(first, last))


def rate_extremes(monthly: DataFrame) -> DataFrame:
    """Lowest and highest month and rate, and the latest month's rate."""
    return monthly.agg(
        F.min_by("year_month", F.struct("rate_30yr_fixed", "year_month")).alias("min_month"),
        F.min("rate_30yr_fixed").alias("min_rate"),
        F.min_by("year_month", F.struct(-F.col("rate_30yr_fixed"), F.col("year_month"))).alias("max_month"),
        F.max("rate_30yr_fixed").alias("max_rate"),
        F.max("year_month").alias("latest_month"),
        F.max_by("rate_30yr_fixed", "year_month").alias("latest_rate"))


def rate_join(df: DataFrame, monthly: DataFrame, date_col: str) -> DataFrame:
    """Left join of the monthly rate on the month of ``date_col``.

    The month table is bounded by the calendar (``MAX_MONTHS``), so it is
    broadcast; the fact side is never shuffled."""
    d = F.col(date_col)
    if not isinstance(df.schema[date_col].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        d = lenient_date(d)  # raw text dates: unparseable -> no month, no rate
    keyed = df.withColumn("year_month", month_key(d))
    return keyed.join(F.broadcast(monthly.select("year_month", "rate_30yr_fixed")),
                      "year_month", "left").select(*keyed.columns, "rate_30yr_fixed")


def rate_unmatched(joined: DataFrame, top: int = 10) -> DataFrame:
    """J2 + V5: months whose rows found no rate, most frequent first."""
    return (joined.where(F.col("rate_30yr_fixed").isNull())
            .groupBy("year_month").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), F.asc_nulls_first("year_month")).limit(top))


def rate_null_count(joined: DataFrame) -> DataFrame:
    """V5: rows without a rate after the join (must be zero on real data)."""
    return joined.agg(F.count_if(F.col("rate_30yr_fixed").isNull()).alias("null_rates"),
                      F.count(F.lit(1)).alias("rows"))
