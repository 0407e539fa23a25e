"""Data-contract checks as DataFrames (V1-V7), month-set differences (J5,
U3), key overlap between the two datasets (J6) and the logged data-quality
probes (A50). Checks return one row per check with an ``ok`` column instead
of asserting, so a pipeline can persist and act on them."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions.quantiles import exact_percentiles_wide
from parcelflow.functions.scalars import rows_or_null
from parcelflow.session import cut_lineage


def expect_rows(df: DataFrame, expected: int, name: str = "rows") -> DataFrame:
    """V1: row-count anchor."""
    return df.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit(name).alias("check"), F.lit(expected).cast("long").alias("expected"), "actual",
        (F.col("actual") == expected).alias("ok"))


def row_conservation(flagged: DataFrame, kept: DataFrame, flag: str) -> DataFrame:
    """V2: the flagged table keeps every row and ``kept`` = all - flagged."""
    a = flagged.agg(F.count(F.lit(1)).alias("all_rows"), F.sum(F.col(flag).cast("long")).alias("flagged"))
    b = kept.agg(F.count(F.lit(1)).alias("kept_rows"))
    return a.crossJoin(b).withColumn("ok", F.col("kept_rows") == F.col("all_rows") - F.col("flagged"))


def schema_contract(spark: SparkSession, before: DataFrame, after: DataFrame, added: int,
                    required: Sequence[str] = ()) -> DataFrame:
    """V3: column-count delta, no name collision, required columns survive,
    upstream columns carried through (metadata only; no data is read)."""
    b, a = before.columns, after.columns
    rows = [("column_delta", len(a) - len(b) == added),
            ("no_duplicate_names", len(set(a)) == len(a)),
            ("upstream_carried", all(c in a for c in b))]
    rows += [(f"has:{c}", c in a) for c in required]
    return spark.createDataFrame(rows, "check string, ok boolean")


def single_value(df: DataFrame, col: str) -> DataFrame:
    """V4: exactly one distinct value left (after a filter)."""
    return df.agg(F.count_distinct(col).alias("distinct_values")).withColumn(
        "ok", F.col("distinct_values") == 1)


def no_nulls(df: DataFrame, col: str) -> DataFrame:
    """V5: no null left in ``col`` (e.g. after an enrichment join)."""
    return df.agg(F.count_if(F.col(col).isNull()).alias("nulls")).withColumn("ok", F.col("nulls") == 0)


def month_gaps(found: DataFrame, month_col: str, first: str, last: str) -> DataFrame:
    """J5 + U3 + V7: months missing from, and extra to, the contiguous
    ``first..last`` range (``yyyyMM``). Empty result = exact month set."""
    spark = found.sparkSession
    expected = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(first), "yyyyMM"), F.to_date(F.lit(last), "yyyyMM"),
        F.expr("INTERVAL 1 MONTH"))).alias("d")).select(F.date_format("d", "yyyyMM").alias("yyyymm"))
    have = found.select(F.col(month_col).alias("yyyymm")).where(F.col("yyyymm").isNotNull()).distinct()
    # both sides are bounded by the calendar (distinct months)
    missing = expected.join(F.broadcast(have), "yyyymm", "left_anti").withColumn("status", F.lit("missing"))
    extra = have.join(F.broadcast(expected), "yyyymm", "left_anti").withColumn("status", F.lit("extra"))
    return missing.unionByName(extra)


def key_overlap(sold: DataFrame, listings: DataFrame, key: str = "ListingKey") -> DataFrame:
    """Sold rows whose key also appears among listings, and listing rows
    that never sold (the anti-join used when combining). Both sides are counted
    per key in one shuffle; a null key meets no other key."""
    tagged = sold.select(key, F.lit(1).alias("s"), F.lit(0).alias("l")).unionAll(
        listings.select(key, F.lit(0).alias("s"), F.lit(1).alias("l")))
    per_key = tagged.groupBy(key).agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
    known = F.col(key).isNotNull()
    return per_key.agg(
        F.coalesce(F.sum(F.when(known & (F.col("l") > 0), F.col("s"))), F.lit(0)).alias("sold_keys_in_listings"),
        F.coalesce(F.sum(F.when(~known | (F.col("s") == 0), F.col("l"))), F.lit(0)).alias("listings_not_sold"))


def listings_not_sold(listings: DataFrame, sold: DataFrame, key: str = "ListingKey") -> DataFrame:
    """The listings whose key no sale has, the part of the listings that a
    combined table adds; a listing without a key is one of them."""
    return listings.join(sold.select(key).distinct(), key, "left_anti")


def contract_report(checks: Mapping[str, DataFrame], passed: Mapping[str, str] | None = None) -> DataFrame:
    """(check, ok) of many checks; a check with several rows holds if all do.
    ``passed`` names the column of checks that don't call it ``ok``."""
    passed = passed or {}
    rows = [df.agg(F.coalesce(F.bool_and(F.col(passed.get(name, "ok"))), F.lit(False)).alias("ok")).select(F.lit(name).alias("check"), "ok")
            for name, df in checks.items()]
    return functools.reduce(DataFrame.unionAll, rows)


def logged_probes(flagged_sold: DataFrame, iqr_sold: DataFrame, listings: DataFrame,
                  accuracy: int = 10_000, staged: bool = False) -> DataFrame:
    """DOM = close - list share; median price with vs without
    coordinates; median price of area <= 0 rows; ratio > 2 rows among
    IQR-kept; listings without a close price (share). The flagged rows are read
    several times, from a narrow stage table unless ``staged`` says that they are one."""
    f = flagged_sold.select("DaysOnMarket", "CloseDate", "ListingContractDate", "missing_coords_flag", "ClosePrice", "LivingArea")
    if not staged:
        f = cut_lineage(f)
    dom_eq = f.agg((F.count_if(F.col("DaysOnMarket") == F.datediff("CloseDate", "ListingContractDate"))
                    * 100.0 / rows_or_null()).alias("dom_equals_close_minus_list_pct"))
    med = exact_percentiles_wide(f, [
        ("median_price_no_coords", F.when(F.col("missing_coords_flag") == 1, F.col("ClosePrice")), 0.5),
        ("median_price_with_coords", F.when(F.col("missing_coords_flag") == 0, F.col("ClosePrice")), 0.5),
        ("median_price_area_le0", F.when(F.col("LivingArea") <= 0, F.col("ClosePrice")), 0.5),
    ], accuracy=accuracy, staged=True)
    ratio = iqr_sold.where(F.col("any_iqr_outlier_flag") == 0).agg(
        F.count_if(F.col("price_ratio") > 2).alias("ratio_gt2_iqr_kept"))
    lst = listings.agg((F.count_if(F.col("ClosePrice").isNull()) * 100.0 / rows_or_null())
                       .alias("listings_no_close_price_pct"))
    return dom_eq.crossJoin(med).crossJoin(ratio).crossJoin(lst)
