"""Registered queries vs their DuckDB oracle on the smallest driver tables."""

import pytest

from oracle_compare import compare, duck
from parcelflow.plans import catalog

SF = "/root/testdata/sf0.001"
SAMPLE = ["monthly_median_price", "null_report", "numeric_distribution", "rate_unmatched", "flag_summary",
          "duplicate_keys", "segment_county_area", "district_join", "district_match_summary", "iqr_fences",
          "iqr_flags", "avg_ratio", "extract_sold", "fence_rates_both", "month_gaps", "key_overlap", "union_by_name"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("name", SAMPLE)
def test_against_oracle(spark, con, name):
    r = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLE[name], SF)
    assert r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["exact"], r
