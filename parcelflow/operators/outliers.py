"""Stage 6: IQR fences, outlier flags, filtered view and the filter-skew
reports (P24-P28, A32-A40, F12, V6).

Fences come from one exact-quantile computation over all fields at once;
the result has one row per field, so it is read back once and the bounds
enter the flagging plan as literals: the fact side is never shuffled or
joined for flagging, and consumers do not re-run the quantile passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.functions.quantiles import exact_percentiles, exact_percentiles_wide
from parcelflow.functions.scalars import contains_ci, rows_or_null
from parcelflow.session import cut_lineage


def _pname(p: float) -> str:
    return f"p{int(round(p * 100))}"


def iqr_fences(df: DataFrame, fields: Sequence[str] = C.IQR_FIELDS, k: float = C.IQR_K,
               probs: Sequence[float] = C.PERCENTILES, accuracy: int = 10_000,
               with_counts: bool = True, minimal: bool = False, staged: bool = False) -> DataFrame:
    """Per field q1, q3, iqr, fences, n (non-null), min, max, the
    percentile evidence and, optionally, rows below / above the fences with
    their share of **all** rows (G13: two denominators). The fields are read
    several times, from a narrow stage table unless ``df`` is one (``staged``)."""
    fields = list(fields)
    if not staged:
        df = cut_lineage(df.select(*fields))
    allp = sorted(set(probs) | {0.25, 0.75})
    q = exact_percentiles(df, fields, allp, accuracy=accuracy, staged=True)
    pv = lambda p: F.max(F.when(F.col("p") == p, F.col("value")))
    fences = (q.groupBy("field").agg(F.first("n").alias("n"), pv(0.25).alias("q1"), pv(0.75).alias("q3"),
                                     *[pv(p).alias(_pname(p)) for p in probs])
              .withColumn("iqr", F.col("q3") - F.col("q1"))
              .withColumn("lo", F.col("q1") - k * F.col("iqr"))
              .withColumn("hi", F.col("q3") + k * F.col("iqr")))
    if minimal:  # only what flagging needs: no min/max/row-count pass
        return fences
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("v")) for f in fields])
    long = df.select(F.inline(arr))
    # one pass for min / max / all-row count and, optionally, the fence counts
    aggs = [F.min("v").alias("min"), F.max("v").alias("max"), F.count(F.lit(1)).alias("rows")]
    if with_counts:
        long = long.join(F.broadcast(fences.select("field", "lo", "hi")), "field")
        aggs += [F.count_if(F.col("v") < F.col("lo")).alias("below"),
                 F.count_if(F.col("v") > F.col("hi")).alias("above")]
    out = fences.join(long.groupBy("field").agg(*aggs), "field")
    if with_counts:
        out = (out.withColumn("flagged", F.col("below") + F.col("above"))
               .withColumn("flagged_pct_of_rows", F.col("flagged") * 100.0 / F.col("rows")))
    return out


def fence_values(fences: DataFrame) -> dict[str, tuple[float, float]]:
    """The fence table has one row per field, so it is read back once and
    the bounds enter the flagging plan as literals: no re-evaluation of the
    quantile passes by every consumer, no join on the fact side."""
    return {r["field"]: (r["lo"], r["hi"]) for r in fences.select("field", "lo", "hi").collect()}


def iqr_flags(df: DataFrame, fields: Sequence[str] = C.IQR_FIELDS,
              flag_of: dict[str, str] = C.IQR_FLAG_OF, k: float = C.IQR_K,
              accuracy: int = 10_000, fences: DataFrame | None = None) -> DataFrame:
    """P24 + P25: one 0/1 flag per field (null never flags) and the any-flag."""
    fields = list(fields)
    for f in fields:
        if flag_of[f] in df.columns:
            raise ValueError(f"flag name collision: {flag_of[f]}")
    if fences is None:
        fences = iqr_fences(df, fields, k, probs=[], accuracy=accuracy, with_counts=False, minimal=True)
    bounds = fence_values(fences)
    flags = {}
    for f in fields:
        v = F.col(f).cast("double")
        lo, hi = bounds.get(f, (None, None))
        if lo is None:  # no non-null value at all: nothing can flag
            flags[flag_of[f]] = F.lit(False)
        else:
            flags[flag_of[f]] = F.coalesce((v < F.lit(float(lo))) | (v > F.lit(float(hi))), F.lit(False))
    out = df.withColumns({n: c.cast("tinyint") for n, c in flags.items()})
    anyf = F.greatest(*[F.col(flag_of[f]) for f in fields]) if len(fields) > 1 else F.col(flag_of[fields[0]])
    out = out.withColumn("any_iqr_outlier_flag", anyf.cast("tinyint"))
    return out.select(*df.columns, *[flag_of[f] for f in fields], "any_iqr_outlier_flag")


def iqr_filtered(flagged: DataFrame) -> DataFrame:
    """Rows with no IQR flag."""
    return flagged.where(F.col("any_iqr_outlier_flag") == 0)


def iqr_share(flagged: DataFrame, band: tuple[float, float] = C.IQR_SHARE_BAND) -> DataFrame:
    """A33 + V6: any-flag rows, share (%) and whether it sits in the sanity band."""
    share = F.sum(F.col("any_iqr_outlier_flag").cast("long")) * 100.0 / rows_or_null()
    return (flagged.agg(F.sum(F.col("any_iqr_outlier_flag").cast("long")).alias("flagged"),
                        share.alias("share_pct"))
            .withColumn("in_band", F.col("share_pct").between(band[0], band[1])))


def iqr_diagnostics(enriched: DataFrame, fields: Sequence[str] = ("price_per_sqft", "close_to_original_list_ratio"),
                    k: float = C.IQR_K, accuracy: int = 10_000, staged: bool = False) -> DataFrame:
    """Would-be fences, median, p95, p99 and would-flag rows (share of
    all rows) for diagnostic fields; no column is added."""
    f = iqr_fences(enriched, list(fields), k, probs=[0.5, 0.95, 0.99], accuracy=accuracy, staged=staged)
    return f.select("field", F.col("p50").alias("median"), "p95", "p99", "lo", "hi",
                    F.col("flagged").alias("would_flag"), F.col("flagged_pct_of_rows").alias("would_flag_pct"))


def iqr_comparison(flagged: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Rows, mean and median price, median area and median DOM before and
    after the filter, with the share (%) of rows removed and retained. Before and
    after are two sets of columns of one pass, not two copies of the rows."""
    fields = ["ClosePrice", "LivingArea", "DaysOnMarket"]
    kept = F.col("any_iqr_outlier_flag") == 0
    narrow = cut_lineage(flagged.select(*fields, kept.alias("kept")))
    sides = {"before": F.lit(True), "after": F.col("kept")}
    med = exact_percentiles_wide(narrow, [(f"{d}_{f}", F.when(c, F.col(f)), 0.5) for d, c in sides.items() for f in fields], accuracy=accuracy, staged=True)
    base = narrow.agg(*[a for d, c in sides.items() for a in (F.count_if(c).alias(f"{d}_rows"),
                                                              F.avg(F.when(c, F.col("ClosePrice").cast("double"))).alias(f"{d}_mean"))])
    one = base.crossJoin(med)  # a row each
    share = lambda n: n * 100.0 / F.nullif(F.col("before_rows"), F.lit(0))
    sets = [F.struct(F.lit(d).alias("dataset"), F.col(f"{d}_rows").alias("rows"), F.col(f"{d}_mean").alias("mean_ClosePrice"),
                     *[F.col(f"{d}_{f}").alias(f"median_{f}") for f in fields],
                     share(F.col("before_rows") - F.col(f"{d}_rows")).alias("removed_pct"), share(F.col(f"{d}_rows")).alias("retained_pct")) for d in sides]
    return one.select(F.inline(F.array(*sets)))


def flag_rate_county(flagged: DataFrame, top: int = 6) -> DataFrame:
    """Any-flag rate (%) in the largest counties (T2 selector), which are
    the counties of most rows of the one aggregate."""
    per = flagged.where(F.col("CountyOrParish").isNotNull()).groupBy("CountyOrParish").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.sum(F.col("any_iqr_outlier_flag").cast("long")) * 100.0 / rows_or_null()).alias("flagged_pct"))
    return per.orderBy(F.desc("rows"), "CountyOrParish").limit(top)


def investor_tier(flagged: DataFrame, price: float = C.INVESTOR_TIER_PRICE,
                  flag_of: dict[str, str] = C.IQR_FLAG_OF) -> DataFrame:
    """P27 + A37: sub-``price`` rows; any-flag rate and fires/rate per fence."""
    tier = flagged.where(F.col("ClosePrice") < price)
    cols = [("any", "any_iqr_outlier_flag")] + list(flag_of.items())
    one = tier.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.sum(F.col(c).cast("long")).alias(name) for name, c in cols])
    long = one.unpivot(["_n"], [n for n, _ in cols], "fence", "fired")
    return long.select(F.col("_n").alias("rows"), "fence", "fired",
                       (F.col("fired") * 100.0 / F.nullif(F.col("_n"), F.lit(0))).alias("rate_pct"))


def dom_tail(flagged: DataFrame, price: float = C.INVESTOR_TIER_PRICE, county: str = "Riverside",
             pattern: str = C.NONMEMBER_PATTERN) -> DataFrame:
    """P28 + A38 + F12: slow-sale rows; share under ``price``, in ``county``
    and with a non-member buyer office."""
    slow = flagged.where(F.col("daysonmarket_iqr_outlier_flag") == 1)
    n = F.count(F.lit(1))
    return slow.agg(
        n.alias("rows"),
        (F.count_if(F.col("ClosePrice") < price) * 100.0 / rows_or_null()).alias("under_price_pct"),
        (F.count_if(F.col("CountyOrParish") == county) * 100.0 / rows_or_null()).alias("county_pct"),
        (F.count_if(contains_ci("BuyerOfficeName", pattern)) * 100.0 / rows_or_null()).alias("nonmember_pct"))


def status_counts(flagged: DataFrame) -> DataFrame:
    """District status counts carried through to the IQR output."""
    return flagged.groupBy("district_match_status").agg(F.count(F.lit(1)).alias("n"))


def fence_rates_both(sold: DataFrame, listings: DataFrame, accuracy: int = 10_000, staged: bool = False) -> DataFrame:
    """Fence table of both datasets side by side with a ``dataset`` column."""
    a = iqr_fences(sold, probs=[], accuracy=accuracy, staged=staged).withColumn("dataset", F.lit("sold"))
    b = iqr_fences(listings, probs=[], accuracy=accuracy, staged=staged).withColumn("dataset", F.lit("listings"))
    cols = ["dataset", "field", "q1", "q3", "lo", "hi", "below", "above", "flagged_pct_of_rows"]
    return a.select(*cols).unionByName(b.select(*cols))
