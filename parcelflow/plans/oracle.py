"""DuckDB oracle: the stage chain written independently as plain SQL CTEs.

Only the stand-in projections are shared with the Spark side (verbatim
text). ``chain(dataset)`` returns ``WITH ...`` text ending in the CTEs
raw, res, reduced, weekly, monthly, rated, typed, flagged, clean, metrics,
verts, edges, districted, fences, iqr; a query appends its SELECT.
"""

from __future__ import annotations

from parcelflow import config as C
from parcelflow.plans import standin

# columns of the stand-in that survive the keep-list, in keep-list order
_STANDIN_COLS = [
    "ListingKey", "ClosePrice", "ListPrice", "OriginalListPrice", "ListingContractDate",
    "PurchaseContractDate", "CloseDate", "DaysOnMarket", "MlsStatus", "PropertyType",
    "PropertySubType", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt",
    "CountyOrParish", "City", "PostalCode", "MLSAreaMajor", "Latitude", "Longitude",
    "ListOfficeName", "BuyerOfficeName",
]
KEPT = [c for c in C.KEEP_COLUMNS if c in _STANDIN_COLS]
_DOUBLE = set(C.NUMERIC_COLS)

NEXT_YEAR = 2027


# columns that the stand-in has as text
_TEXT_DATES = {"PurchaseContractDate"}


def _typed_select() -> str:
    out = []
    for c in KEPT:
        if c in _TEXT_DATES:
            out.append(f"CAST(TRY_CAST({c} AS TIMESTAMP) AS DATE) AS {c}")
        else:
            out.append(f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in _DOUBLE else c)
    return ", ".join(out + ["year_month", "rate_30yr_fixed"])


_FLAGS_SQL = f"""
  SELECT *,
    CAST(coalesce(ClosePrice <= 0, false) AS TINYINT) AS invalid_closeprice_flag,
    CAST(coalesce(LivingArea <= 0, false) AS TINYINT) AS invalid_livingarea_flag,
    CAST(coalesce(DaysOnMarket < 0, false) AS TINYINT) AS negative_dom_flag,
    CAST(coalesce(BedroomsTotal < 0, false) AS TINYINT) AS negative_beds_flag,
    CAST(coalesce(BathroomsTotalInteger < 0, false) AS TINYINT) AS negative_baths_flag,
    CAST(coalesce(ClosePrice <= 0, false) OR coalesce(LivingArea <= 0, false)
         OR coalesce(DaysOnMarket < 0, false) OR coalesce(BedroomsTotal < 0, false)
         OR coalesce(BathroomsTotalInteger < 0, false) AS TINYINT) AS hard_invalid_flag,
    CAST(coalesce(ListingContractDate > CloseDate, false) AS TINYINT) AS listing_after_close_flag,
    CAST(coalesce(PurchaseContractDate > CloseDate, false) AS TINYINT) AS purchase_after_close_flag,
    CAST(coalesce(ListingContractDate > PurchaseContractDate, false)
         OR coalesce(PurchaseContractDate > CloseDate, false)
         OR coalesce(ListingContractDate > CloseDate, false) AS TINYINT) AS negative_timeline_flag,
    CAST(Latitude IS NULL OR Longitude IS NULL AS TINYINT) AS missing_coords_flag,
    CAST(coalesce(Latitude = 0 OR Longitude = 0, false) AS TINYINT) AS zero_coord_flag,
    CAST(coalesce(Longitude > 0, false) AS TINYINT) AS positive_longitude_flag,
    CAST(coalesce(NOT (Latitude BETWEEN {C.LAT_MIN} AND {C.LAT_MAX} AND Longitude BETWEEN {C.LON_MIN} AND {C.LON_MAX})
         AND Latitude IS NOT NULL AND Longitude IS NOT NULL AND Latitude <> 0 AND Longitude <> 0, false)
         AS TINYINT) AS out_of_ca_flag,
    CAST(coalesce(ClosePrice > 0 AND ClosePrice < {C.LOW_PRICE}, false) AS TINYINT) AS suspicious_low_price_flag,
    CAST(coalesce(ClosePrice > {C.HIGH_PRICE}, false) AS TINYINT) AS extreme_high_price_flag,
    CAST(coalesce(LivingArea > {C.HIGH_AREA}, false) AS TINYINT) AS extreme_livingarea_flag,
    CAST(coalesce(YearBuilt < {C.MIN_YEAR_BUILT} OR YearBuilt > {NEXT_YEAR}, false) AS TINYINT) AS implausible_yearbuilt_flag
  FROM typed"""

_REVIEW = " OR ".join(f"{f} = 1" for f in C.REVIEW_FLAGS)



def chain(dataset: str = "sold", p: str = "", head: bool = True) -> str:
    """CTE text of the whole chain; ``p`` prefixes every CTE name so two
    chains can share one statement."""
    raw_sql = standin.SOLD_SQL if dataset == "sold" else standin.LISTINGS_SQL
    key = C.JOIN_KEYS[dataset]
    bad_geo_p = " OR ".join(f"t.{f} = 1" for f in C.BAD_GEO_FLAGS)
    flags_sql = _FLAGS_SQL.replace("FROM typed", f"FROM {p}typed")
    return ("WITH " if head else "") + f"""{p}raw AS ({standin.for_duckdb(raw_sql)}),
{p}res AS (SELECT * FROM {p}raw WHERE PropertyType = 'Residential'),
{p}reduced AS (SELECT {", ".join(KEPT)} FROM {p}res),
{p}weekly AS ({standin.for_duckdb(standin.RATES_SQL)}),
{p}monthly AS (SELECT strftime(date, '%Y-%m') AS year_month, round(avg(rate_30yr_fixed), 4) AS rate_30yr_fixed
            FROM {p}weekly WHERE date IS NOT NULL GROUP BY 1),
{p}rated AS (SELECT r.*, strftime(r.{key}, '%Y-%m') AS year_month, m.rate_30yr_fixed
          FROM {p}reduced r LEFT JOIN {p}monthly m ON strftime(r.{key}, '%Y-%m') = m.year_month),
{p}typed AS (SELECT {_typed_select()} FROM {p}rated),
{p}flagged0 AS ({flags_sql}),
{p}flagged AS (SELECT *, CAST({_REVIEW} AS TINYINT) AS any_review_flag FROM {p}flagged0),
{p}clean AS (SELECT * FROM {p}flagged WHERE hard_invalid_flag = 0),
{p}metrics AS (SELECT *,
    ClosePrice / CASE WHEN OriginalListPrice > 0 THEN OriginalListPrice END AS price_ratio,
    ClosePrice / CASE WHEN OriginalListPrice > 0 THEN OriginalListPrice END AS close_to_original_list_ratio,
    ClosePrice / CASE WHEN LivingArea > 0 THEN LivingArea END AS price_per_sqft,
    CAST(DaysOnMarket AS DOUBLE) AS days_on_market,
    CAST(year(CloseDate) AS INTEGER) AS Year,
    CAST(month(CloseDate) AS INTEGER) AS Month,
    strftime(CloseDate, '%Y-%m') AS YrMo,
    CAST(PurchaseContractDate - ListingContractDate AS INTEGER) AS listing_to_contract_days,
    CAST(CloseDate - PurchaseContractDate AS INTEGER) AS contract_to_close_days
  FROM {p}clean),
{p}verts AS ({standin.for_duckdb(standin.DISTRICTS_SQL)}),
{p}edges AS (SELECT * FROM (
    SELECT DistrictName AS name, x AS x1, y AS y1,
           lead(x) OVER (PARTITION BY DistrictName, part, ring ORDER BY idx) AS x2,
           lead(y) OVER (PARTITION BY DistrictName, part, ring ORDER BY idx) AS y2
    FROM {p}verts WHERE DistrictType = 'Unified') WHERE x2 IS NOT NULL),
{p}pts AS (SELECT row_number() OVER () AS rid, * FROM {p}metrics),
{p}trusted AS (SELECT rid, Longitude AS px, Latitude AS py FROM {p}pts t WHERE NOT ({bad_geo_p})),
{p}pe AS (SELECT t.rid, e.name,
         sum(CASE WHEN (e.y1 > t.py) <> (e.y2 > t.py)
                   AND t.px < e.x1 + (t.py - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) THEN 1 ELSE 0 END) AS cr,
         max(CASE WHEN (e.x2 - e.x1) * (t.py - e.y1) - (e.y2 - e.y1) * (t.px - e.x1) = 0
                   AND t.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                   AND t.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) THEN 1 ELSE 0 END) AS on_edge
       FROM {p}trusted t CROSS JOIN {p}edges e GROUP BY t.rid, e.name),
{p}matched AS (SELECT rid, min(name) AS DistrictName, count(*) AS district_matches
            FROM {p}pe WHERE cr % 2 = 1 AND on_edge = 0 GROUP BY rid),
{p}districted_r AS (SELECT t.*, m.DistrictName,
    CASE WHEN t.missing_coords_flag = 1 THEN 'missing_coords'
         WHEN {bad_geo_p} THEN 'invalid_coords'
         WHEN m.DistrictName IS NULL THEN 'no_unified_district' ELSE 'matched' END AS district_match_status,
    coalesce(m.district_matches, 0) AS district_matches
  FROM {p}pts t LEFT JOIN {p}matched m ON t.rid = m.rid),
{p}districted AS (SELECT * EXCLUDE (rid, district_matches) FROM {p}districted_r),
{p}fences AS (SELECT
    quantile_cont(ClosePrice, 0.25) - 1.5 * (quantile_cont(ClosePrice, 0.75) - quantile_cont(ClosePrice, 0.25)) AS cp_lo,
    quantile_cont(ClosePrice, 0.75) + 1.5 * (quantile_cont(ClosePrice, 0.75) - quantile_cont(ClosePrice, 0.25)) AS cp_hi,
    quantile_cont(LivingArea, 0.25) - 1.5 * (quantile_cont(LivingArea, 0.75) - quantile_cont(LivingArea, 0.25)) AS la_lo,
    quantile_cont(LivingArea, 0.75) + 1.5 * (quantile_cont(LivingArea, 0.75) - quantile_cont(LivingArea, 0.25)) AS la_hi,
    quantile_cont(DaysOnMarket, 0.25) - 1.5 * (quantile_cont(DaysOnMarket, 0.75) - quantile_cont(DaysOnMarket, 0.25)) AS dom_lo,
    quantile_cont(DaysOnMarket, 0.75) + 1.5 * (quantile_cont(DaysOnMarket, 0.75) - quantile_cont(DaysOnMarket, 0.25)) AS dom_hi
  FROM {p}districted),
{p}iqr0 AS (SELECT d.*,
    CAST(coalesce(ClosePrice < cp_lo OR ClosePrice > cp_hi, false) AS TINYINT) AS closeprice_iqr_outlier_flag,
    CAST(coalesce(LivingArea < la_lo OR LivingArea > la_hi, false) AS TINYINT) AS livingarea_iqr_outlier_flag,
    CAST(coalesce(DaysOnMarket < dom_lo OR DaysOnMarket > dom_hi, false) AS TINYINT) AS daysonmarket_iqr_outlier_flag
  FROM {p}districted d CROSS JOIN {p}fences),
{p}iqr AS (SELECT *,
    CAST(greatest(closeprice_iqr_outlier_flag, livingarea_iqr_outlier_flag, daysonmarket_iqr_outlier_flag) AS TINYINT)
      AS any_iqr_outlier_flag
  FROM {p}iqr0)
"""


def both() -> str:
    """Sold chain (plain names) plus the listings chain (``l_`` names)."""
    return chain("sold").rstrip() + ",\n" + chain("listings", "l_", head=False)
