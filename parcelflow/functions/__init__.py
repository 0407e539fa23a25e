from parcelflow.functions.quantiles import exact_percentiles, exact_percentiles_wide
from parcelflow.functions.scalars import (
    any_of,
    as_flag,
    contains_ci,
    lenient_date,
    lenient_double,
    month_key,
    month_start,
    null_false,
    office_key,
    postal_text,
    safe_ratio,
    web_mercator_to_lonlat,
    year_prefix,
    yyyymm_end,
    yyyymm_start,
    yyyymm_valid,
)

__all__ = [
    "any_of", "as_flag", "contains_ci", "exact_percentiles", "exact_percentiles_wide",
    "lenient_date", "lenient_double", "month_key", "month_start", "null_false",
    "office_key", "postal_text", "safe_ratio", "web_mercator_to_lonlat", "year_prefix",
    "yyyymm_end", "yyyymm_start", "yyyymm_valid",
]
