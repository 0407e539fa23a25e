"""Scalar column functions (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lenient_double(x: ColLike) -> Column:
    """number parse, unparseable -> null; NaN is null too (pandas semantics)."""
    v = F.expr("try_cast(NULL AS double)") if x is None else _c(x)
    d = v.try_cast("double")
    # a Java type suffix (12d, 5f) is no number
    return F.when(~F.isnan(d) & ~F.rtrim(v.cast("string")).rlike("[0-9.][dDfF]$"), d)


def number(x: ColLike) -> Column:
    """F2 for a column that is a number already: double, NaN is null."""
    return F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))


def lenient_date(x: ColLike) -> Column:
    """ISO date or timestamp text -> date (truncated to the day); bad -> null."""
    v = _c(x)
    return F.coalesce(v.try_cast("date"), v.try_cast("timestamp").cast("date"))


def null_false(cond: Column) -> Column:
    """F16: a comparison whose null outcome counts as false."""
    return F.coalesce(cond, F.lit(False))


def any_of(conds: Iterable[Column]) -> Column:
    """row-wise OR."""
    return functools.reduce(operator.or_, list(conds))


def as_flag(cond: Column) -> Column:
    """P20: boolean -> 0/1 tinyint."""
    return null_false(cond).cast("tinyint")


def month_key(d: ColLike) -> Column:
    """month text yyyy-MM."""
    return F.date_format(_c(d), "yyyy-MM")


def month_start(d: ColLike) -> Column:
    """month truncation (first day of the month, as a date)."""
    return F.trunc(_c(d), "MM")


def rows_or_null() -> Column:
    """Row count as a divisor: shares of no rows are null."""
    return F.nullif(F.count(F.lit(1)), F.lit(0))


def round_half_even(x: ColLike, digits: int) -> Column:
    """the scaled value rounded to the nearest integer, ties to even, and
    scaled back: the steps of an array library's rounding, in doubles."""
    scale = F.lit(10.0 ** digits)
    return F.rint(_c(x) * scale) / scale


def safe_ratio(num: ColLike, den: ColLike) -> Column:
    """num / den, null where den <= 0 or null."""
    d = _c(den)
    return _c(num) / F.when(d > 0, d)


def postal_text(x: ColLike) -> Column:
    """postal code as text, everything after the first '.' dropped.
    Null stays null (deliberately not the text 'nan')."""
    return F.substring_index(_c(x).cast("string"), ".", 1)


def office_key(x: ColLike) -> Column:
    """office-name key: collapse whitespace, trim, upper-case."""
    return F.upper(F.trim(F.regexp_replace(_c(x), r"\s+", " ")))


def contains_ci(x: ColLike, pattern: str) -> Column:
    """case-insensitive regex test, null -> false."""
    return null_false(_c(x).rlike(f"(?i){pattern}"))


def yyyymm_valid(x: ColLike) -> Column:
    """exactly six digits forming a real month."""
    return null_false(yyyymm_start(x).isNotNull())


def yyyymm_start(x: ColLike) -> Column:
    """first day of the month named by yyyyMM (null unless six digits
    forming a real month)."""
    v = _c(x)
    return F.when(v.rlike(r"^\d{6}$"),
                  F.try_to_timestamp(F.concat(v, F.lit("01")), F.lit("yyyyMMdd")).cast("date"))


def yyyymm_end(x: ColLike) -> Column:
    """exclusive upper bound (first day of the next month)."""
    return F.add_months(yyyymm_start(x), 1)


def year_prefix(x: ColLike) -> Column:
    """first four characters of the text form."""
    return F.substring(_c(x).cast("string"), 1, 4)


def with_column_or_null(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    """The column if present, else a typed null (absent-column fallback)."""
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(dtype)


def web_mercator_to_lonlat(x: ColLike, y: ColLike) -> tuple[Column, Column]:
    """EPSG:3857 metres -> EPSG:4326 degrees (spherical inverse)."""
    r = 6378137.0
    lon = F.degrees(_c(x) / F.lit(r))
    lat = F.degrees(F.lit(2.0) * F.atan(F.exp(_c(y) / F.lit(r))) - F.lit(3.141592653589793 / 2))
    return lon, lat
