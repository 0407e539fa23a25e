"""Stage 5: engineered metrics and median segment tables
(F4, F6, F7, F9, F10, A23, A30, A31, A48)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.quantiles import FEW, exact_percentiles_wide
from parcelflow.functions.scalars import month_key, round_half_even, rows_or_null, safe_ratio
from parcelflow.session import cut_lineage


def engineer_metrics(df: DataFrame) -> DataFrame:
    """Ratios with guarded divisors, calendar parts and day differences.
    Negative durations are kept (those rows carry the timeline flag)."""
    ratio = safe_ratio("ClosePrice", "OriginalListPrice")
    return df.withColumns({
        "price_ratio": ratio,
        "close_to_original_list_ratio": ratio,
        "price_per_sqft": safe_ratio("ClosePrice", "LivingArea"),
        "days_on_market": F.col("DaysOnMarket").cast("double"),
        "Year": F.year("CloseDate"),
        "Month": F.month("CloseDate"),
        "YrMo": month_key("CloseDate"),
        "listing_to_contract_days": F.datediff("PurchaseContractDate", "ListingContractDate"),
        "contract_to_close_days": F.datediff("CloseDate", "PurchaseContractDate"),
    })


def null_metrics(enriched: DataFrame) -> DataFrame:
    """Null counts of the two engineered ratios."""
    return enriched.agg(F.count_if(F.col("price_ratio").isNull()).alias("null_price_ratio"),
                        F.count_if(F.col("price_per_sqft").isNull()).alias("null_price_per_sqft"))


def segment(df: DataFrame, by: str | Sequence[str], top: int = 10, accuracy: int = 10_000,
            digits: int | None = 2) -> DataFrame:
    """Rows per segment (all rows) and medians of price, price per
    sqft, price ratio and days on market; top ``top`` by rows, ties by key.
    Rows with a null key are dropped; medians ignore nulls and are rounded half
    to even. ``digits=None`` keeps them unrounded."""
    by = [by] if isinstance(by, str) else list(by)
    keyed = df.dropna(subset=by)
    counts = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n_sales"))
    top_keys = counts.orderBy(F.desc("n_sales"), *by).limit(top)
    specs = [("median_close", "ClosePrice", 0.5), ("median_ppsf", "price_per_sqft", 0.5),
             ("median_price_ratio", "price_ratio", 0.5), ("median_dom", "days_on_market", 0.5)]
    # medians only for the top segments, at most ``top`` keys
    if top * len(specs) <= FEW:
        top_keys = df.sparkSession.createDataFrame(top_keys.collect(), top_keys.schema)
        med = exact_percentiles_wide(keyed, specs, accuracy=accuracy, groups=top_keys.select(*by))
    else:
        sub = keyed.join(F.broadcast(top_keys.select(*by)), by, "left_semi")
        med = exact_percentiles_wide(sub, specs, by=by, accuracy=accuracy)
    meds = ["median_close", "median_ppsf", "median_price_ratio", "median_dom"]
    rnd = (lambda c: F.col(c)) if digits is None else (lambda c: round_half_even(c, digits).alias(c))
    return (top_keys.join(med, by, "left")
            .select(*by, "n_sales", *[rnd(c) for c in meds])
            .orderBy(F.desc("n_sales"), *by))


def ask_split(enriched: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """A48 (a): share (%) of sales above, at and below the original ask, and
    the median ratio, over rows with a defined ratio."""
    r = F.col("price_ratio")
    have = cut_lineage(enriched.where(r.isNotNull()).select("price_ratio"))
    shares = have.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(r > 1) * 100.0 / rows_or_null()).alias("above_pct"),
        (F.count_if(r == 1) * 100.0 / rows_or_null()).alias("at_pct"),
        (F.count_if(r < 1) * 100.0 / rows_or_null()).alias("below_pct"))
    med = exact_percentiles_wide(have, [("median_ratio", "price_ratio", 0.5)], accuracy=accuracy, staged=True)
    return shares.crossJoin(med)


def median_durations(enriched: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """A48 (b): median listing-to-contract and contract-to-close days."""
    return exact_percentiles_wide(enriched, [
        ("median_listing_to_contract", "listing_to_contract_days", 0.5),
        ("median_contract_to_close", "contract_to_close_days", 0.5),
    ], accuracy=accuracy)


def county_ppsf_ratio(enriched: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """A48 (c, d): median price per sqft and median ratio by county."""
    return exact_percentiles_wide(enriched, [
        ("median_ppsf", "price_per_sqft", 0.5),
        ("median_price_ratio", "price_ratio", 0.5),
    ], by=["CountyOrParish"], accuracy=accuracy)
