"""Registered queries: one Spark builder and (where SQL can express it) one
independent DuckDB oracle per operator of the inventory.

Every builder takes ``(spark, sf_dir)``, reads the driver tables through the
stand-in projections and returns a lazy DataFrame over the whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.operators import (
    contracts,
    dashboard,
    metrics,
    outliers,
    profile,
    quality,
    rates,
    shape,
    spatial,
)
from parcelflow.plans import oracle as O
from parcelflow.plans import pipeline as P
from parcelflow.plans import standin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def reg(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


S = O.chain("sold")
B = O.both()
ACC = P.REGISTRY_PARAMS.quantile_accuracy

# parameters of the registered queries (stand-in values where the reference
# names real places or months)
MONTH_SOLD, MONTH_LISTED = "199601", "199603"
RATE_FIRST, RATE_LAST = "1995-01", "1996-06"
CONTROL_CITY = "City_7"
TAIL_COUNTY = "NATION_1"
FILTERS = {"CountyOrParish": ["NATION_1", "NATION_2", "NATION_3"], "PropertySubType": ["MEDIUM", "LARGE"]}
COUNTY_ROWS = 100  # the reference asks for 2,000 rows; the stand-in has fewer
MONTHS_FIRST, MONTHS_LAST = "199201", "199812"
PART_YEARS = [0, *range(1990, 2010)]  # parts of the union: rows without a date, and each year
CITY_DISTRICTS = {"City_1": "FRANCE Unified", "City_2": "NATION_7 Unified", "City_40": "NATION_14 Unified", "Nowhere": "NATION_1 Unified"}

RAW_COLS = ["ListingKey", "ClosePrice", "ListPrice", "OriginalListPrice", "ListingContractDate",
            "PurchaseContractDate", "CloseDate", "DaysOnMarket", "MlsStatus", "PropertyType",
            "PropertySubType", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt",
            "CountyOrParish", "City", "PostalCode", "MLSAreaMajor", "Latitude", "Longitude",
            "ListOfficeName", "BuyerOfficeName", "Levels", "TaxYear"]


# Interpolated quantiles and averages are compared at 6 decimals: the two
# engines interpolate and sum in different orders, which moves the last bit.
D = 6


def rnd(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, D) for c in cols})


def R(x: str) -> str:
    return f"round({x}, {D})"


def _pct(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) * 100 / {den}"


def _q(col: str, p: float) -> str:
    return f"quantile_cont(CAST({col} AS DOUBLE), {p})"


# ---------------------------------------------------------------- phase 0

@reg("monthly_median_price", S + """
SELECT CAST(date_trunc('month', CloseDate) AS DATE) AS month, round(quantile_cont(ClosePrice, 0.5), 6) AS median_close_price
FROM iqr WHERE CloseDate IS NOT NULL GROUP BY 1""")
def q_monthly_median_price(spark, sf):
    return rnd(dashboard.monthly_median_price(P.sold(spark, sf).market_stage, accuracy=ACC), "median_close_price")


# ---------------------------------------------------------------- phase 1

@reg("row_checkpoints", S + """
, per AS (SELECT coalesce(year(CloseDate), 0) AS f, count(*) AS n,
                 count(*) FILTER (WHERE PropertyType = 'Residential') AS r FROM raw GROUP BY 1)
SELECT count(*) AS parts, CAST(sum(n) AS BIGINT) AS rows_sum, (SELECT count(*) FROM raw) AS rows_concat,
       CAST(sum(r) AS BIGINT) AS rows_residential, sum(n) = (SELECT count(*) FROM raw) AS lossless FROM per""")
def q_row_checkpoints(spark, sf):
    raw = P.sold(spark, sf).raw
    parts = [raw.where(F.coalesce(F.year("CloseDate"), F.lit(0)) == y) for y in PART_YEARS]
    return shape.row_checkpoints(parts, shape.union_by_name(parts))


@reg("residential", S + "SELECT * FROM res")
def q_residential(spark, sf):
    return P.sold(spark, sf).residential


@reg("closed_in_month", S + """
SELECT * FROM raw WHERE MlsStatus = 'Closed' AND CloseDate >= DATE '1996-01-01' AND CloseDate < DATE '1996-02-01'""")
def q_closed_in_month(spark, sf):
    return shape.closed_in_month(P.sold(spark, sf).raw, MONTH_SOLD)


@reg("listed_in_month", O.chain("listings") + """
SELECT * FROM raw WHERE ListingContractDate >= DATE '1996-03-01' AND ListingContractDate < DATE '1996-04-01'""")
def q_listed_in_month(spark, sf):
    return shape.listed_in_month(P.listings(spark, sf).raw, MONTH_LISTED)


@reg("keep_columns", S + "SELECT * FROM reduced")
def q_keep_columns(spark, sf):
    return P.sold(spark, sf).reduced


@reg("select_unique", S + "SELECT City, ClosePrice, CountyOrParish FROM raw")
def q_select_unique(spark, sf):
    return shape.select_unique(P.sold(spark, sf).raw, ["City", "ClosePrice", "City", "CountyOrParish", "ClosePrice"])


@reg("value_counts", S + "SELECT PropertyType AS value, count(*) AS count FROM raw GROUP BY 1")
def q_value_counts(spark, sf):
    return shape.value_counts(P.sold(spark, sf).raw, "PropertyType")


@reg("distinct_values", S + "SELECT DISTINCT CountyOrParish AS value FROM raw WHERE CountyOrParish IS NOT NULL")
def q_distinct_values(spark, sf):
    return shape.distinct_values(P.sold(spark, sf).raw, "CountyOrParish")


def _null_report_sql(cols: list[str], src: str) -> str:
    parts = [f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS null_count,
  round({_pct(f"count(*) FILTER (WHERE {c} IS NULL)", "count(*)")}, 2) AS null_pct FROM {src}""" for c in cols]
    return "\n UNION ALL ".join(parts)


_NR = f", nr AS ({_null_report_sql(RAW_COLS, 'raw')})\n"


@reg("null_report", S + _NR + 'SELECT "column", null_count, null_pct, null_pct > 90 AS over_90pct_null FROM nr')
def q_null_report(spark, sf):
    return shape.null_report(P.sold(spark, sf).raw)


_KEEP_IN = ", ".join(f"'{c}'" for c in C.KEEP_COLUMNS)
_NRR = f", nr AS ({_null_report_sql(RAW_COLS, 'res')})\n"


@reg("null_report_residential", S + _NRR + 'SELECT "column", null_count, null_pct, null_pct > 90 AS over_90pct_null FROM nr')
def q_null_report_residential(spark, sf):
    return shape.null_report(P.sold(spark, sf).residential)


_DROP = S + _NRR + f""", rep AS (SELECT "column", CASE WHEN "column" IN ({_KEEP_IN}) THEN 'kept'
  WHEN null_pct > 90 THEN 'dropped_over_90pct_null' ELSE 'dropped_other' END AS reason FROM nr)
"""


@reg("column_drop_report", _DROP + 'SELECT "column", reason FROM rep')
def q_column_drop_report(spark, sf):
    return shape.column_drop_report(P.sold(spark, sf).residential)


@reg("column_drop_counts", _DROP + f"""
SELECT reason, count(*) AS columns, {_pct('count(*)', str(len(RAW_COLS)))} AS share_pct FROM rep GROUP BY 1""")
def q_column_drop_counts(spark, sf):
    return shape.column_drop_counts(P.sold(spark, sf).residential)


_TYPEMAP = ("CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
            "WHEN 'DATE' THEN 'date' WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof({c})) END")


@reg("schema_report", S + "\n UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", min({_TYPEMAP.format(c=c)}) AS dtype, count({c}) AS non_null FROM raw"""
    for i, c in enumerate(RAW_COLS)))
def q_schema_report(spark, sf):
    return shape.schema_report(P.sold(spark, sf).raw)


@reg("shape", S + f"SELECT count(*) AS rows, {len(RAW_COLS)} AS columns FROM raw")
def q_shape(spark, sf):
    return shape.shape(P.sold(spark, sf).raw)


_UA = [c for c in RAW_COLS if c != "BuyerOfficeName"]
_UB = [c for c in reversed(RAW_COLS) if c != "ListOfficeName"]


@reg("union_by_name", S + f"""
SELECT {", ".join(_UA)} FROM raw WHERE MlsStatus = 'Closed'
UNION ALL BY NAME SELECT {", ".join(_UB)} FROM raw WHERE MlsStatus <> 'Closed'""")
def q_union_by_name(spark, sf):
    raw = P.sold(spark, sf).raw
    return shape.union_by_name([raw.where(F.col("MlsStatus") == "Closed").select(*_UA),
                                raw.where(F.col("MlsStatus") != "Closed").select(*_UB)])


# ---------------------------------------------------------------- phase 2

def _dist_sql(fields, probs, src):
    parts = []
    for f in fields:
        ps = ", ".join(f"{R(_q(f, p))} AS p{int(round(p * 100))}" for p in probs)
        parts.append(f"""SELECT '{f}' AS field, count({f}) AS n, min(CAST({f} AS DOUBLE)) AS min,
  max(CAST({f} AS DOUBLE)) AS max, round(avg(CAST({f} AS DOUBLE)), 2) AS mean, {R(_q(f, 0.5))} AS median, {ps}
  FROM {src}""")
    return "\n UNION ALL ".join(parts)


@reg("numeric_distribution", S + _dist_sql(C.PROFILE_FIELDS, C.PERCENTILES, "reduced"))
def q_numeric_distribution(spark, sf):
    return rnd(profile.numeric_distribution(P.sold(spark, sf).reduced, accuracy=ACC),
               "median", *[f"p{int(round(p * 100))}" for p in C.PERCENTILES])


@reg("type_share", S + f"""
SELECT PropertyType, count(*) AS n, {_pct('count(*)', '(SELECT count(*) FROM raw WHERE PropertyType IS NOT NULL)')} AS share_pct
FROM raw WHERE PropertyType IS NOT NULL GROUP BY 1""")
def q_type_share(spark, sf):
    return profile.type_share(P.sold(spark, sf).raw)


@reg("price_center", S + """
SELECT round(quantile_cont(ClosePrice, 0.5), 6) AS median_price, round(avg(ClosePrice), 6) AS mean_price FROM reduced""")
def q_price_center(spark, sf):
    return rnd(profile.price_center(P.sold(spark, sf).reduced, accuracy=ACC), "median_price", "mean_price")


@reg("dom_distribution", S + f"""
SELECT {R(_q('DaysOnMarket', 0.5))} AS median, {R(_q('DaysOnMarket', 0.25))} AS p25, {R(_q('DaysOnMarket', 0.75))} AS p75,
       {R('avg(CAST(DaysOnMarket AS DOUBLE))')} AS mean, max(CAST(DaysOnMarket AS DOUBLE)) AS max FROM reduced""")
def q_dom_distribution(spark, sf):
    return rnd(profile.dom_distribution(P.sold(spark, sf).reduced, accuracy=ACC), "median", "p25", "p75", "mean")


@reg("vs_list_share", S + f"""
SELECT count(*) AS n, {_pct('count(*) FILTER (WHERE ClosePrice > ListPrice)', 'count(*)')} AS above_pct,
  {_pct('count(*) FILTER (WHERE ClosePrice < ListPrice)', 'count(*)')} AS below_pct,
  {_pct('count(*) FILTER (WHERE ClosePrice = ListPrice)', 'count(*)')} AS at_pct
FROM reduced WHERE ClosePrice IS NOT NULL AND ListPrice IS NOT NULL AND ListPrice > 0""")
def q_vs_list_share(spark, sf):
    return profile.vs_list_share(P.sold(spark, sf).reduced)


@reg("close_before_list", S + f"""
SELECT count(*) AS n, count(*) FILTER (WHERE CloseDate < ListingContractDate) AS close_before_list,
  {_pct('count(*) FILTER (WHERE CloseDate < ListingContractDate)', 'count(*)')} AS pct
FROM reduced WHERE ListingContractDate IS NOT NULL AND CloseDate IS NOT NULL""")
def q_close_before_list(spark, sf):
    return profile.close_before_list(P.sold(spark, sf).reduced)


@reg("top_counties", S + """
SELECT CountyOrParish, round(quantile_cont(ClosePrice, 0.5), 6) AS median_price FROM reduced
WHERE CountyOrParish IS NOT NULL AND ClosePrice IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q_top_counties(spark, sf):
    return rnd(profile.top_counties(P.sold(spark, sf).reduced, accuracy=ACC), "median_price")


# ---------------------------------------------------------------- phase 3

@reg("monthly_rate", S + "SELECT year_month, rate_30yr_fixed FROM monthly")
def q_monthly_rate(spark, sf):
    return P.sold(spark, sf).monthly


@reg("rate_window", S + f"SELECT * FROM monthly WHERE year_month BETWEEN '{RATE_FIRST}' AND '{RATE_LAST}'")
def q_rate_window(spark, sf):
    return rates.rate_window(P.sold(spark, sf).monthly, RATE_FIRST, RATE_LAST)


@reg("rate_extremes", S + """
SELECT (SELECT year_month FROM monthly ORDER BY rate_30yr_fixed, year_month LIMIT 1) AS min_month,
       (SELECT min(rate_30yr_fixed) FROM monthly) AS min_rate,
       (SELECT year_month FROM monthly ORDER BY rate_30yr_fixed DESC, year_month LIMIT 1) AS max_month,
       (SELECT max(rate_30yr_fixed) FROM monthly) AS max_rate,
       (SELECT max(year_month) FROM monthly) AS latest_month,
       (SELECT rate_30yr_fixed FROM monthly ORDER BY year_month DESC LIMIT 1) AS latest_rate""")
def q_rate_extremes(spark, sf):
    return rates.rate_extremes(P.sold(spark, sf).monthly)


@reg("rate_join", S + "SELECT * FROM rated")
def q_rate_join(spark, sf):
    return P.sold(spark, sf).rated


@reg("rate_unmatched", S + """
SELECT year_month, count(*) AS rows FROM rated WHERE rate_30yr_fixed IS NULL GROUP BY 1
ORDER BY rows DESC, year_month ASC NULLS FIRST LIMIT 10""")
def q_rate_unmatched(spark, sf):
    return rates.rate_unmatched(P.sold(spark, sf).rated)


@reg("rate_nulls", S + "SELECT count(*) FILTER (WHERE rate_30yr_fixed IS NULL) AS null_rates, count(*) AS rows FROM rated")
def q_rate_nulls(spark, sf):
    return rates.rate_null_count(P.sold(spark, sf).rated)


# ---------------------------------------------------------------- phase 4

def _cols(*c):
    return list(c)


_HARD = _cols("ListingKey", *C.HARD_FLAGS, "hard_invalid_flag")
_DATE = _cols("ListingKey", *C.DATE_COLS, "listing_after_close_flag", "purchase_after_close_flag",
              "negative_timeline_flag")
_GEO = _cols("ListingKey", "Latitude", "Longitude", "missing_coords_flag", "zero_coord_flag",
             "positive_longitude_flag", "out_of_ca_flag")
_REV = _cols("ListingKey", "ClosePrice", "LivingArea", "YearBuilt", "suspicious_low_price_flag",
             "extreme_high_price_flag", "extreme_livingarea_flag", "implausible_yearbuilt_flag", "any_review_flag")

for _name, _cs in [("hard_invalid_flags", _HARD), ("date_flags", _DATE), ("geo_flags", _GEO),
                   ("review_flags", _REV)]:
    reg(_name, S + f"SELECT {', '.join(_cs)} FROM flagged")(
        (lambda cs: lambda spark, sf: P.sold(spark, sf).flagged.select(*cs))(_cs))


@reg("flagged", S + "SELECT * FROM flagged")
def q_flagged(spark, sf):
    return P.sold(spark, sf).flagged


@reg("clean_view", S + "SELECT * FROM clean")
def q_clean_view(spark, sf):
    return P.sold(spark, sf).clean


def _flag_summary_sql(flags, src):
    return "\n UNION ALL ".join(
        f"SELECT '{f}' AS flag, CAST(sum({f}) AS BIGINT) AS count, round({_pct(f'sum({f})', 'count(*)')}, 3) AS pct FROM {src}"
        for f in flags)


@reg("flag_summary", S + _flag_summary_sql(C.ALL_FLAGS, "flagged"))
def q_flag_summary(spark, sf):
    return quality.flag_summary(P.sold(spark, sf).flagged)


_FAM = """SELECT unnest(['invalid_closeprice_flag', 'invalid_livingarea_flag', 'negative_dom_flag', 'negative_beds_flag', 'negative_baths_flag']) AS flag, 'numeric-invalid' AS family
UNION ALL SELECT unnest(['listing_after_close_flag', 'purchase_after_close_flag', 'negative_timeline_flag']), 'date-consistency'
UNION ALL SELECT unnest(['missing_coords_flag', 'zero_coord_flag', 'positive_longitude_flag', 'out_of_ca_flag']), 'geographic'
UNION ALL SELECT unnest(['suspicious_low_price_flag', 'extreme_high_price_flag', 'extreme_livingarea_flag', 'implausible_yearbuilt_flag']), 'review-outlier'"""


@reg("flag_family", S + f", fs AS ({_flag_summary_sql(C.ALL_FLAGS, 'flagged')}), fam AS ({_FAM})\n"
     "SELECT family, fs.flag, count, pct FROM fs JOIN fam ON fs.flag = fam.flag WHERE count > 0")
def q_flag_family(spark, sf):
    return quality.flag_family(P.sold(spark, sf).flagged)


@reg("duplicate_keys", S + """
SELECT CAST(count(*) - count(DISTINCT ListingKey) - (CASE WHEN count(*) FILTER (WHERE ListingKey IS NULL) > 0 THEN 1 ELSE 0 END)
  AS BIGINT) AS duplicate_rows FROM flagged""")
def q_duplicate_keys(spark, sf):
    return quality.duplicate_keys(P.sold(spark, sf).flagged)


@reg("reversed_timeline", S + """
SELECT count(*) FILTER (WHERE ListingContractDate > PurchaseContractDate AND PurchaseContractDate > CloseDate) AS fully_reversed,
       CAST(sum(negative_timeline_flag) AS BIGINT) AS any_violation FROM flagged""")
def q_reversed_timeline(spark, sf):
    return quality.reversed_timeline(P.sold(spark, sf).flagged)


@reg("missing_by_year", S + """
SELECT substr(year_month, 1, 4) AS year, round(avg(missing_coords_flag) * 100, 1) AS miss_pct
FROM flagged WHERE year_month IS NOT NULL GROUP BY 1""")
def q_missing_by_year(spark, sf):
    return quality.missing_by_year(P.sold(spark, sf).flagged)


@reg("missing_by_county", S + f"""
SELECT CountyOrParish, count(*) AS n, round(avg(missing_coords_flag) * 100, 1) AS miss_pct FROM flagged
WHERE CountyOrParish IS NOT NULL GROUP BY 1 HAVING count(*) >= 100 ORDER BY 3 DESC, 1 LIMIT 5""")
def q_missing_by_county(spark, sf):
    return quality.missing_by_county(P.sold(spark, sf).flagged, min_rows=COUNTY_ROWS)


@reg("clean_summary", S + """
SELECT count(*) AS flagged_rows, CAST(sum(hard_invalid_flag) AS BIGINT) AS removed_rows,
  count(*) FILTER (WHERE hard_invalid_flag = 0) AS clean_rows,
  count(*) FILTER (WHERE hard_invalid_flag = 0 AND any_review_flag = 1) AS review_rows_kept FROM flagged""")
def q_clean_summary(spark, sf):
    return quality.clean_summary(P.sold(spark, sf).flagged)


_TYPED = [c for c in C.DATE_COLS + C.NUMERIC_COLS if c in O.KEPT or c == "rate_30yr_fixed"]


@reg("null_after_cast", S + ", na AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM typed""" for c in _TYPED)
    + ')\nSELECT * FROM na WHERE null_count > 0')
def q_null_after_cast(spark, sf):
    return quality.null_after_cast(P.sold(spark, sf).typed)


# ---------------------------------------------------------------- phase 5

_MET = ["ListingKey", "price_ratio", "close_to_original_list_ratio", "price_per_sqft", "days_on_market",
        "Year", "Month", "YrMo", "listing_to_contract_days", "contract_to_close_days"]


@reg("engineered_metrics", S + f"SELECT {', '.join(_MET)} FROM metrics")
def q_engineered_metrics(spark, sf):
    return P.sold(spark, sf).metrics.select(*_MET)


@reg("null_metrics", S + """
SELECT count(*) FILTER (WHERE price_ratio IS NULL) AS null_price_ratio,
       count(*) FILTER (WHERE price_per_sqft IS NULL) AS null_price_per_sqft FROM metrics""")
def q_null_metrics(spark, sf):
    return metrics.null_metrics(P.sold(spark, sf).metrics)


def _segment_sql(by: list[str]) -> str:
    keys = ", ".join(by)
    nn = " AND ".join(f"{b} IS NOT NULL" for b in by)
    return S + f""", top AS (SELECT {keys}, count(*) AS n_sales FROM districted WHERE {nn}
  GROUP BY {keys} ORDER BY n_sales DESC, {keys} LIMIT 10)
SELECT {", ".join(f"t.{b}" for b in by)}, t.n_sales,
  round(quantile_cont(d.ClosePrice, 0.5), 6) AS median_close, round(quantile_cont(d.price_per_sqft, 0.5), 6) AS median_ppsf,
  round(quantile_cont(d.price_ratio, 0.5), 6) AS median_price_ratio, round(quantile_cont(d.days_on_market, 0.5), 6) AS median_dom
FROM top t JOIN districted d ON {" AND ".join(f"t.{b} = d.{b}" for b in by)}
GROUP BY {", ".join(f"t.{b}" for b in by)}, t.n_sales"""


_MEASURES = ["ClosePrice", "price_per_sqft", "price_ratio", "days_on_market"]

for _name, _by in [("segment_subtype", ["PropertySubType"]), ("segment_county", ["CountyOrParish"]),
                   ("segment_area", ["MLSAreaMajor"]), ("segment_list_office", ["ListOfficeName"]),
                   ("segment_buyer_office", ["BuyerOfficeName"]),
                   ("segment_county_area", ["CountyOrParish", "MLSAreaMajor"])]:
    reg(_name, _segment_sql(_by))(
        (lambda by: lambda spark, sf: metrics.segment(P.sold(spark, sf).staged("metrics", *by, *_MEASURES).metrics, by, digits=D,
                                                      accuracy=ACC))(_by))


def _two_digits(sql: str) -> str:
    return re.sub(r"round\((quantile_cont\([^)]*\)), 6\)", r"round_even(\1 * 100, 0) / 100", sql)


@reg("segment_county_rounded", _two_digits(_segment_sql(["CountyOrParish"])))
def q_segment_county_rounded(spark, sf):
    return metrics.segment(P.sold(spark, sf).staged("metrics", "CountyOrParish", *_MEASURES).metrics, "CountyOrParish", accuracy=ACC)


@reg("ask_split", S + f"""
SELECT count(*) AS n, {_pct('count(*) FILTER (WHERE price_ratio > 1)', 'count(*)')} AS above_pct,
  {_pct('count(*) FILTER (WHERE price_ratio = 1)', 'count(*)')} AS at_pct,
  {_pct('count(*) FILTER (WHERE price_ratio < 1)', 'count(*)')} AS below_pct,
  round(quantile_cont(price_ratio, 0.5), 6) AS median_ratio FROM districted WHERE price_ratio IS NOT NULL""")
def q_ask_split(spark, sf):
    return rnd(metrics.ask_split(P.sold(spark, sf).metrics, accuracy=ACC), "median_ratio")


@reg("median_durations", S + f"""
SELECT {R(_q('listing_to_contract_days', 0.5))} AS median_listing_to_contract,
       {R(_q('contract_to_close_days', 0.5))} AS median_contract_to_close FROM districted""")
def q_median_durations(spark, sf):
    return rnd(metrics.median_durations(P.sold(spark, sf).metrics, accuracy=ACC),
               "median_listing_to_contract", "median_contract_to_close")


@reg("county_ppsf_ratio", S + """
SELECT CountyOrParish, round(quantile_cont(price_per_sqft, 0.5), 6) AS median_ppsf,
       round(quantile_cont(price_ratio, 0.5), 6) AS median_price_ratio FROM districted
WHERE CountyOrParish IS NOT NULL GROUP BY 1
HAVING count(price_per_sqft) + count(price_ratio) > 0""")
def q_county_ppsf_ratio(spark, sf):
    return rnd(metrics.county_ppsf_ratio(P.sold(spark, sf).staged("metrics", "CountyOrParish", "price_per_sqft", "price_ratio").metrics, accuracy=ACC), "median_ppsf", "median_price_ratio")


# ---------------------------------------------------------------- phase 6

@reg("district_join", S + """
SELECT ListingKey, Latitude, Longitude, DistrictName, district_match_status FROM districted""")
def q_district_join(spark, sf):
    return P.sold(spark, sf).enriched.select("ListingKey", "Latitude", "Longitude", "DistrictName",
                                             "district_match_status")


@reg("district_types", S + "SELECT DistrictType, count(DISTINCT DistrictName) AS n FROM verts GROUP BY 1")
def q_district_types(spark, sf):
    return spatial.district_types(P.sold(spark, sf).boundaries)


@reg("district_coverage", S + f"""
SELECT district_match_status, count(*) AS n, {_pct('count(*)', '(SELECT count(*) FROM districted)')} AS pct
FROM districted GROUP BY 1""")
def q_district_coverage(spark, sf):
    return spatial.district_coverage(P.sold(spark, sf).enriched)


@reg("district_match_summary", S + f"""
SELECT count(*) FILTER (WHERE district_match_status IN ('matched', 'no_unified_district')) AS valid_points,
  count(*) FILTER (WHERE district_match_status = 'matched') AS matched,
  {_pct("count(*) FILTER (WHERE district_match_status = 'matched')",
        "count(*) FILTER (WHERE district_match_status IN ('matched', 'no_unified_district'))")} AS match_rate_pct,
  count(*) FILTER (WHERE district_matches > 1) AS multi_match_points FROM districted_r""")
def q_district_match_summary(spark, sf):
    return spatial.district_match_summary(P.sold(spark, sf).enriched_counted)


@reg("district_modal_city", S + """
SELECT City, DistrictName AS modal_district FROM (
  SELECT City, DistrictName, row_number() OVER (PARTITION BY City ORDER BY count(*) DESC, DistrictName) AS rn
  FROM districted WHERE DistrictName IS NOT NULL AND City IS NOT NULL GROUP BY City, DistrictName) WHERE rn = 1""")
def q_district_modal_city(spark, sf):
    return spatial.district_modal_city(P.sold(spark, sf).enriched)


@reg("district_city_check", S + f""", modal AS (
  SELECT City, DistrictName AS modal_district FROM (
    SELECT City, DistrictName, row_number() OVER (PARTITION BY City ORDER BY count(*) DESC, DistrictName) AS rn
    FROM districted WHERE DistrictName IS NOT NULL AND City IS NOT NULL GROUP BY City, DistrictName) WHERE rn = 1),
want(City, expected) AS (VALUES {", ".join(f"('{c}', '{d}')" for c, d in CITY_DISTRICTS.items())})
SELECT City, expected, modal_district, coalesce(expected = modal_district, false) AS ok FROM want LEFT JOIN modal USING (City)""")
def q_district_city_check(spark, sf):
    return spatial.district_city_check(P.sold(spark, sf).enriched, CITY_DISTRICTS)


@reg("district_negative_control", S + f"""
SELECT district_match_status, count(*) AS n FROM districted WHERE City = '{CONTROL_CITY}' GROUP BY 1""")
def q_district_negative_control(spark, sf):
    return spatial.district_negative_control(P.sold(spark, sf).enriched, CONTROL_CITY)


@reg("district_top10", S + """
SELECT DistrictName, count(*) AS n FROM districted WHERE DistrictName IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q_district_top10(spark, sf):
    return spatial.district_top(P.sold(spark, sf).enriched)


_TOP6 = """top6 AS (SELECT CountyOrParish FROM {src} WHERE CountyOrParish IS NOT NULL GROUP BY 1
  ORDER BY count(*) DESC, 1 LIMIT 6)"""


@reg("district_county_rate", S + ", " + _TOP6.format(src="districted") + f"""
SELECT CountyOrParish, count(*) AS rows,
  {_pct("count(*) FILTER (WHERE district_match_status = 'matched')", 'count(*)')} AS matched_pct,
  {_pct("count(*) FILTER (WHERE district_match_status = 'missing_coords')", 'count(*)')} AS missing_pct
FROM districted WHERE CountyOrParish IN (SELECT CountyOrParish FROM top6) GROUP BY 1""")
def q_district_county_rate(spark, sf):
    return spatial.district_county_rate(P.sold(spark, sf).enriched)


# ---------------------------------------------------------------- phase 7

def _fences_sql(fields, probs, src, p=""):
    parts = []
    for f in fields:
        q1, q3 = _q(f, 0.25), _q(f, 0.75)
        ps = "".join(f", {R(_q(f, x))} AS p{int(round(x * 100))}" for x in probs)
        parts.append(f"""SELECT '{f}' AS field, count({f}) AS n, {R(q1)} AS q1, {R(q3)} AS q3{ps},
  {R(f"{q3} - {q1}")} AS iqr, {R(f"{q1} - 1.5 * ({q3} - {q1})")} AS lo, {R(f"{q3} + 1.5 * ({q3} - {q1})")} AS hi,
  min(CAST({f} AS DOUBLE)) AS min, max(CAST({f} AS DOUBLE)) AS max, count(*) AS rows FROM {p}{src}""")
    body = "\n UNION ALL ".join(parts)
    cnt = "\n UNION ALL ".join(
        f"""SELECT '{f}' AS field, count(*) FILTER (WHERE {f} < lo) AS below, count(*) FILTER (WHERE {f} > hi) AS above
  FROM {p}{src} CROSS JOIN (SELECT lo, hi FROM {p}fq WHERE field = '{f}')""" for f in fields)
    return f"""{p}fq AS ({body}), {p}fc AS ({cnt}),
{p}fall AS (SELECT {p}fq.*, below, above, below + above AS flagged, {_pct('below + above', 'rows')} AS flagged_pct_of_rows
  FROM {p}fq JOIN {p}fc USING (field))"""


@reg("iqr_fences", S + ", " + _fences_sql(C.IQR_FIELDS, C.PERCENTILES, "districted") + "\nSELECT * FROM fall")
def q_iqr_fences(spark, sf):
    return rnd(outliers.iqr_fences(P.sold(spark, sf).metrics, accuracy=ACC),
               "q1", "q3", "iqr", "lo", "hi", *[f"p{int(round(p * 100))}" for p in C.PERCENTILES])


_IQRC = ["ListingKey", "ClosePrice", "LivingArea", "DaysOnMarket", *C.IQR_FLAG_OF.values(), "any_iqr_outlier_flag"]


@reg("iqr_flags", S + f"SELECT {', '.join(_IQRC)} FROM iqr")
def q_iqr_flags(spark, sf):
    return P.sold(spark, sf).flaggable("ListingKey").iqr_core.select(*_IQRC)


@reg("iqr_filtered", S + "SELECT * FROM iqr WHERE any_iqr_outlier_flag = 0")
def q_iqr_filtered(spark, sf):
    return outliers.iqr_filtered(P.sold(spark, sf).staged("metrics").iqr)


@reg("iqr_share", S + f"""
SELECT CAST(sum(any_iqr_outlier_flag) AS BIGINT) AS flagged, {_pct('sum(any_iqr_outlier_flag)', 'count(*)')} AS share_pct,
  {_pct('sum(any_iqr_outlier_flag)', 'count(*)')} BETWEEN {C.IQR_SHARE_BAND[0]} AND {C.IQR_SHARE_BAND[1]} AS in_band FROM iqr""")
def q_iqr_share(spark, sf):
    return outliers.iqr_share(P.sold(spark, sf).flaggable().iqr_core)


@reg("iqr_diagnostics", S + ", " + _fences_sql(["price_per_sqft", "close_to_original_list_ratio"], [0.5, 0.95, 0.99],
                                               "districted") + """
SELECT field, p50 AS median, p95, p99, lo, hi, flagged AS would_flag, flagged_pct_of_rows AS would_flag_pct FROM fall""")
def q_iqr_diagnostics(spark, sf):
    return rnd(outliers.iqr_diagnostics(P.sold(spark, sf).metrics, accuracy=ACC),
               "median", "p95", "p99", "lo", "hi")


@reg("iqr_comparison", S + """, both_ AS (SELECT 'before' AS dataset, * FROM iqr
  UNION ALL SELECT 'after' AS dataset, * FROM iqr WHERE any_iqr_outlier_flag = 0)
SELECT dataset, count(*) AS rows, round(avg(ClosePrice), 6) AS mean_ClosePrice,
  round(quantile_cont(ClosePrice, 0.5), 6) AS median_ClosePrice,
  round(quantile_cont(LivingArea, 0.5), 6) AS median_LivingArea, round(quantile_cont(DaysOnMarket, 0.5), 6) AS median_DaysOnMarket,
  ((SELECT count(*) FROM iqr) - count(*)) * 100.0 / (SELECT count(*) FROM iqr) AS removed_pct,
  count(*) * 100.0 / (SELECT count(*) FROM iqr) AS retained_pct
FROM both_ GROUP BY 1""")
def q_iqr_comparison(spark, sf):
    return rnd(outliers.iqr_comparison(P.sold(spark, sf).flaggable().iqr_core, accuracy=ACC), "mean_ClosePrice", "median_ClosePrice",
               "median_LivingArea", "median_DaysOnMarket")


@reg("flag_rate_county", S + ", " + _TOP6.format(src="iqr") + f"""
SELECT CountyOrParish, count(*) AS rows, {_pct('sum(any_iqr_outlier_flag)', 'count(*)')} AS flagged_pct
FROM iqr WHERE CountyOrParish IN (SELECT CountyOrParish FROM top6) GROUP BY 1""")
def q_flag_rate_county(spark, sf):
    return outliers.flag_rate_county(P.sold(spark, sf).flaggable("CountyOrParish").iqr_core)


_TIER = [("any", "any_iqr_outlier_flag")] + list(C.IQR_FLAG_OF.items())


@reg("investor_tier", S + f", tier AS (SELECT * FROM iqr WHERE ClosePrice < {C.INVESTOR_TIER_PRICE})\n" + "\n UNION ALL ".join(
    f"SELECT count(*) AS rows, '{n}' AS fence, CAST(sum({c}) AS BIGINT) AS fired, {_pct(f'sum({c})', 'count(*)')} AS rate_pct FROM tier"
    for n, c in _TIER))
def q_investor_tier(spark, sf):
    return outliers.investor_tier(P.sold(spark, sf).flaggable().iqr_core)


@reg("dom_tail", S + f"""
SELECT count(*) AS rows, {_pct(f'count(*) FILTER (WHERE ClosePrice < {C.INVESTOR_TIER_PRICE})', 'count(*)')} AS under_price_pct,
  {_pct(f"count(*) FILTER (WHERE CountyOrParish = '{TAIL_COUNTY}')", 'count(*)')} AS county_pct,
  {_pct(f"count(*) FILTER (WHERE coalesce(regexp_matches(BuyerOfficeName, '{C.NONMEMBER_PATTERN}', 'i'), false))", 'count(*)')}
    AS nonmember_pct
FROM iqr WHERE daysonmarket_iqr_outlier_flag = 1""")
def q_dom_tail(spark, sf):
    return outliers.dom_tail(P.sold(spark, sf).flaggable("CountyOrParish", "BuyerOfficeName").iqr_core, county=TAIL_COUNTY)


@reg("status_counts", S + "SELECT district_match_status, count(*) AS n FROM iqr GROUP BY 1")
def q_status_counts(spark, sf):
    return outliers.status_counts(P.sold(spark, sf).enriched)


@reg("fence_rates_both", B + ", " + _fences_sql(C.IQR_FIELDS, [], "districted") + ", "
     + _fences_sql(C.IQR_FIELDS, [], "districted", p="l_") + """
SELECT 'sold' AS dataset, field, q1, q3, lo, hi, below, above, flagged_pct_of_rows FROM fall
UNION ALL SELECT 'listings' AS dataset, field, q1, q3, lo, hi, below, above, flagged_pct_of_rows FROM l_fall""")
def q_fence_rates_both(spark, sf):
    return rnd(outliers.fence_rates_both(P.sold(spark, sf).metrics, P.listings(spark, sf).metrics, accuracy=ACC),
               "q1", "q3", "lo", "hi")


# ---------------------------------------------------------------- phase 8

_M = "CAST(date_trunc('month', {d}) AS DATE)"


@reg("avg_dom", S + f"""
SELECT {_M.format(d='CloseDate')} AS month, round(avg(days_on_market), 6) AS avg_days_on_market FROM iqr
WHERE any_iqr_outlier_flag = 0 AND CloseDate IS NOT NULL GROUP BY 1""")
def q_avg_dom(spark, sf):
    return rnd(dashboard.avg_dom(P.sold(spark, sf).flaggable("CloseDate", "days_on_market").iqr_core), "avg_days_on_market")


@reg("avg_ratio", S + f"""
SELECT {_M.format(d='CloseDate')} AS month, round(avg(price_ratio), 6) AS avg_price_ratio FROM iqr
WHERE any_iqr_outlier_flag = 0 AND price_ratio BETWEEN 0 AND 2 AND CloseDate IS NOT NULL GROUP BY 1""")
def q_avg_ratio(spark, sf):
    return rnd(dashboard.avg_ratio(P.sold(spark, sf).flaggable("CloseDate", "price_ratio").iqr_core), "avg_price_ratio")


_LISTED = ["ListingContractDate", *C.FILTER_DIMS]


@reg("new_listings", O.chain("listings") + f"""
SELECT {_M.format(d='ListingContractDate')} AS month, count(strftime(ListingContractDate, '%Y-%m')) AS new_listings
FROM iqr WHERE ListingContractDate IS NOT NULL GROUP BY 1""")
def q_new_listings(spark, sf):
    return dashboard.new_listings(dashboard.extract_listings(P.listings(spark, sf).flaggable(*_LISTED).iqr_core))


@reg("closed_sales", S + f"""
SELECT {_M.format(d='CloseDate')} AS month, count(ClosePrice) AS closed_sales FROM iqr
WHERE CloseDate IS NOT NULL GROUP BY 1""")
def q_closed_sales(spark, sf):
    return dashboard.closed_sales(P.sold(spark, sf).metrics)


@reg("rates_and_market", S + f"""
SELECT {_M.format(d='CloseDate')} AS month, round(quantile_cont(ClosePrice, 0.5), 6) AS median_close_price,
  round(avg(rate_30yr_fixed), 6) AS avg_rate FROM iqr WHERE CloseDate IS NOT NULL GROUP BY 1""")
def q_rates_and_market(spark, sf):
    return rnd(dashboard.rates_and_market(P.sold(spark, sf).market_stage, accuracy=ACC), "median_close_price", "avg_rate")


@reg("filter_members", S + "\n UNION ".join(
    f"SELECT DISTINCT '{d}' AS dimension, CAST({d} AS VARCHAR) AS member FROM iqr WHERE {d} IS NOT NULL"
    for d in C.FILTER_DIMS))
def q_filter_members(spark, sf):
    return dashboard.filter_members(P.sold(spark, sf).metrics)


@reg("dashboard_filtered", S + f"""
SELECT {_M.format(d='CloseDate')} AS month, round(quantile_cont(ClosePrice, 0.5), 6) AS median_close_price FROM iqr
WHERE CountyOrParish IN ('NATION_1', 'NATION_2', 'NATION_3') AND PropertySubType IN ('MEDIUM', 'LARGE') AND CloseDate IS NOT NULL GROUP BY 1""")
def q_dashboard_filtered(spark, sf):
    return rnd(dashboard.monthly_median_price(P.sold(spark, sf).market_stage, FILTERS, accuracy=ACC), "median_close_price")


#: Columns that the district join reads.
_PLACE = ["Latitude", "Longitude", *C.BAD_GEO_FLAGS]
_EXTRACT = ["CloseDate", "YrMo", "price_ratio", "days_on_market", *C.FILTER_DIMS, "rate_30yr_fixed"]


@reg("extract_sold", S + """
SELECT CloseDate, YrMo, ClosePrice, price_ratio, days_on_market, City, CountyOrParish,
  split_part(CAST(PostalCode AS VARCHAR), '.', 1) AS PostalCode, PropertySubType, DistrictName,
  CAST(any_iqr_outlier_flag AS BIGINT) AS any_iqr_outlier_flag, rate_30yr_fixed FROM iqr""")
def q_extract_sold(spark, sf):
    return dashboard.extract_sold(P.sold(spark, sf).flaggable(*_EXTRACT, *_PLACE).iqr)


@reg("extract_listings", O.chain("listings") + """
SELECT ListingContractDate, strftime(ListingContractDate, '%Y-%m') AS ListYrMo, City, CountyOrParish,
  split_part(CAST(PostalCode AS VARCHAR), '.', 1) AS PostalCode, PropertySubType,
  CAST(any_iqr_outlier_flag AS BIGINT) AS any_iqr_outlier_flag FROM iqr""")
def q_extract_listings(spark, sf):
    return dashboard.extract_listings(P.listings(spark, sf).flaggable(*_LISTED).iqr_core)


# ---------------------------------------------------------------- phase 9

@reg("month_gaps", S + f"""
, expected AS (SELECT strftime(d, '%Y%m') AS yyyymm FROM
    generate_series(DATE '{MONTHS_FIRST[:4]}-{MONTHS_FIRST[4:]}-01', DATE '{MONTHS_LAST[:4]}-{MONTHS_LAST[4:]}-01', INTERVAL 1 MONTH) g(d)),
have AS (SELECT DISTINCT strftime(CloseDate, '%Y%m') AS yyyymm FROM raw WHERE CloseDate IS NOT NULL)
SELECT yyyymm, 'missing' AS status FROM expected WHERE yyyymm NOT IN (SELECT yyyymm FROM have)
UNION ALL SELECT yyyymm, 'extra' AS status FROM have WHERE yyyymm NOT IN (SELECT yyyymm FROM expected)""")
def q_month_gaps(spark, sf):
    raw = P.sold(spark, sf).raw
    return contracts.month_gaps(raw.select(F.date_format("CloseDate", "yyyyMM").alias("m")), "m",
                                MONTHS_FIRST, MONTHS_LAST)


@reg("key_overlap", B + """
SELECT (SELECT count(*) FROM reduced WHERE ListingKey IN (SELECT ListingKey FROM l_reduced)) AS sold_keys_in_listings,
       (SELECT count(*) FROM l_reduced WHERE ListingKey NOT IN (SELECT ListingKey FROM reduced WHERE ListingKey IS NOT NULL))
         AS listings_not_sold""")
def q_key_overlap(spark, sf):
    return contracts.key_overlap(P.sold(spark, sf).reduced, P.listings(spark, sf).reduced)


@reg("listings_not_sold", B + """
SELECT * FROM l_reduced WHERE ListingKey NOT IN (SELECT ListingKey FROM reduced WHERE ListingKey IS NOT NULL)""")
def q_listings_not_sold(spark, sf):
    return contracts.listings_not_sold(P.listings(spark, sf).reduced, P.sold(spark, sf).reduced)


#: Columns of the rules, the ratios and the checks.
_CHECKED = ["ClosePrice", "OriginalListPrice", *C.DATE_COLS, "DaysOnMarket", "PropertyType", "LivingArea", "BedroomsTotal",
            "BathroomsTotalInteger", "YearBuilt", "Latitude", "Longitude"]


@reg("contract_report", S + f"""
SELECT 'row_conservation' AS "check", (SELECT count(*) FROM clean) = (SELECT count(*) - sum(hard_invalid_flag) FROM flagged) AS ok
UNION ALL SELECT 'single_type', (SELECT count(DISTINCT PropertyType) = 1 FROM flagged)
UNION ALL SELECT 'rates', (SELECT count(*) = 0 FROM rated WHERE rate_30yr_fixed IS NULL)
UNION ALL SELECT 'outlier_share', (SELECT CAST(sum(any_iqr_outlier_flag) AS DOUBLE) * 100 / count(*) BETWEEN {C.IQR_SHARE_BAND[0]} AND {C.IQR_SHARE_BAND[1]} FROM iqr)
UNION ALL SELECT 'anchor', (SELECT count(*) FROM reduced) = (SELECT count(*) FROM res)
UNION ALL SELECT 'one_district_a_row', (SELECT count(*) FROM districted) = (SELECT count(*) FROM clean)""")
def q_contract_report(spark, sf):
    s = P.sold(spark, sf).staged("residential", *_CHECKED)
    joined = contracts.row_conservation(s.clean.select(F.lit(0).alias("gone")), s.enriched, "gone")
    residential = s.residential.agg(F.count(F.lit(1)).alias("n"))
    anchor = s.reduced.agg(F.count(F.lit(1)).alias("kept")).crossJoin(residential).select((F.col("kept") == F.col("n")).alias("ok"))
    return contracts.contract_report(
        {"row_conservation": contracts.row_conservation(s.flagged, s.clean, "hard_invalid_flag"),
         "single_type": contracts.single_value(s.flagged, "PropertyType"), "rates": contracts.no_nulls(s.rated, "rate_30yr_fixed"),
         "outlier_share": outliers.iqr_share(s.iqr_core), "anchor": anchor, "one_district_a_row": joined}, {"outlier_share": "in_band"})


@reg("row_conservation", S + """
SELECT (SELECT count(*) FROM flagged) AS all_rows, (SELECT CAST(sum(hard_invalid_flag) AS BIGINT) FROM flagged) AS flagged,
  (SELECT count(*) FROM clean) AS kept_rows,
  (SELECT count(*) FROM clean) = (SELECT count(*) FROM flagged) - (SELECT sum(hard_invalid_flag) FROM flagged) AS ok""")
def q_row_conservation(spark, sf):
    s = P.sold(spark, sf)
    return contracts.row_conservation(s.flagged, s.clean, "hard_invalid_flag")


@reg("single_value_check", S + """
SELECT count(DISTINCT PropertyType) AS distinct_values, count(DISTINCT PropertyType) = 1 AS ok FROM reduced""")
def q_single_value_check(spark, sf):
    return contracts.single_value(P.sold(spark, sf).reduced, "PropertyType")


_PROBED = ["ClosePrice", "OriginalListPrice", *C.DATE_COLS, "DaysOnMarket", "LivingArea", "missing_coords_flag", "hard_invalid_flag"]


@reg("logged_probes", B + f"""
SELECT (SELECT {_pct('count(*) FILTER (WHERE DaysOnMarket = CloseDate - ListingContractDate)', 'count(*)')} FROM flagged)
         AS dom_equals_close_minus_list_pct,
       (SELECT round(quantile_cont(ClosePrice, 0.5) FILTER (WHERE missing_coords_flag = 1), 6) FROM flagged) AS median_price_no_coords,
       (SELECT round(quantile_cont(ClosePrice, 0.5) FILTER (WHERE missing_coords_flag = 0), 6) FROM flagged) AS median_price_with_coords,
       (SELECT round(quantile_cont(ClosePrice, 0.5) FILTER (WHERE LivingArea <= 0), 6) FROM flagged) AS median_price_area_le0,
       (SELECT count(*) FILTER (WHERE price_ratio > 2) FROM iqr WHERE any_iqr_outlier_flag = 0) AS ratio_gt2_iqr_kept,
       (SELECT {_pct('count(*) FILTER (WHERE ClosePrice IS NULL)', 'count(*)')} FROM l_reduced) AS listings_no_close_price_pct""")
def q_logged_probes(spark, sf):
    s, lst = P.sold(spark, sf).staged("flagged", *_PROBED), P.listings(spark, sf)
    return rnd(contracts.logged_probes(s.flagged, s.iqr_core, lst.reduced, accuracy=ACC, staged=True), "median_price_no_coords",
               "median_price_with_coords", "median_price_area_le0")


@reg("office_key", S + r"""
SELECT DISTINCT BuyerOfficeName AS office, upper(trim(regexp_replace(BuyerOfficeName, '\s+', ' ', 'g'))) AS office_key
FROM raw WHERE BuyerOfficeName IS NOT NULL""")
def q_office_key(spark, sf):
    from parcelflow.functions.scalars import office_key
    raw = P.sold(spark, sf).raw
    return (raw.where(F.col("BuyerOfficeName").isNotNull())
            .select(F.col("BuyerOfficeName").alias("office"), office_key("BuyerOfficeName").alias("office_key"))
            .distinct())


_PREVIEW = ["ClosePrice", "LivingArea", "DaysOnMarket", "YrMo", "CountyOrParish"]


@reg("preview", S + f"""
SELECT {", ".join(_PREVIEW)} FROM iqr ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _PREVIEW)} LIMIT 5""")
def q_preview(spark, sf):
    return shape.preview(P.sold(spark, sf).flaggable(*_PREVIEW, *_PLACE).iqr, _PREVIEW, 5)


@reg("month_bounds", S + r"""
, m AS (SELECT DISTINCT strftime(CloseDate, '%Y%m') AS t FROM raw WHERE CloseDate IS NOT NULL
        UNION SELECT DISTINCT substr(strftime(CloseDate, '%Y%m'), 1, 4) || '13' FROM raw WHERE CloseDate IS NOT NULL
        UNION SELECT DISTINCT substr(strftime(CloseDate, '%Y%m'), 1, 5) FROM raw WHERE CloseDate IS NOT NULL)
SELECT t AS yyyymm,
  coalesce(regexp_full_match(t, '\d{6}') AND try_strptime(t || '01', '%Y%m%d') IS NOT NULL, false) AS valid,
  CASE WHEN regexp_full_match(t, '\d{6}') THEN CAST(try_strptime(t || '01', '%Y%m%d') AS DATE) END AS start,
  CASE WHEN regexp_full_match(t, '\d{6}') THEN CAST(try_strptime(t || '01', '%Y%m%d') + INTERVAL 1 MONTH AS DATE) END
    AS "end" FROM m""")
def q_month_bounds(spark, sf):
    from parcelflow.functions.scalars import yyyymm_end, yyyymm_start, yyyymm_valid
    raw = P.sold(spark, sf).raw.where(F.col("CloseDate").isNotNull())
    m = F.date_format("CloseDate", "yyyyMM")
    texts = (raw.select(m.alias("t"))
             .union(raw.select(F.concat(F.substring(m, 1, 4), F.lit("13")).alias("t")))
             .union(raw.select(F.substring(m, 1, 5).alias("t"))).distinct())
    return texts.select(F.col("t").alias("yyyymm"), yyyymm_valid("t").alias("valid"),
                        yyyymm_start("t").alias("start"), yyyymm_end("t").alias("end"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "standin"]
