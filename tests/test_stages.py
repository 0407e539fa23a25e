"""The chain over the stand-in: joins of the input run once a query, whatever its passes."""
import datetime
import re

import pytest
from pyspark.sql import functions as F

from parcelflow import session
from parcelflow.plans import catalog, standin

DAY = datetime.date(1996, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Small tables with repeated and null keys."""
    d = "/tmp/" + tmp_path_factory.mktemp("t").name + f"-{id(spark)}"
    rows = {
        "region": ("r_regionkey long, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "NATION_0", 0), (1, "NATION_1", 1), (1, "NATION_1", 1), (2, "NATION_2", None)]),
        "customer": ("c_custkey long, c_nationkey long, c_mktsegment string",
                     [(k, k % 3 if k % 11 else None, "BUILDING" if k % 4 else "MACHINERY") for k in range(1, 40)] + [(3, 1, "FURNITURE"), (None, 0, "BUILDING")]),
        "supplier": ("s_suppkey long, s_name string", [(k, f"s{k}") for k in range(1, 9)] + [(2, "twice"), (None, "none")]),
        "part": ("p_partkey long, p_type string, p_size int", [(k, ["LARGE", "SMALL", None][k % 3], k % 30) for k in range(1, 60)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double, o_orderstatus string",
                   [(k, k % 45 if k % 13 else None, DAY + datetime.timedelta(k), 1000.0 * k, "FOP"[k % 3]) for k in range(1, 200)] + [(7, 5, DAY, 1.0, "F")]),
        "lineitem": ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
                     [(k if k % 17 else None, n, (k * 7 + n) % 60, (k + n) % 10, float(k % 50), 900.0 * (k % 37) + 11 * n, 0.01 * (k % 9), 0.01 * n)
                      for k in range(1, 220) for n in range(1, 5)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.mode("overwrite").parquet(f"{d}/{name}.parquet")
    return d


@pytest.mark.parametrize("text, read", [(standin.SOLD_SQL, standin.sold), (standin.LISTINGS_SQL, standin.listings)])
def test_joined_small_sides_first_are_the_rows_of_the_text(spark, tables, text, read):
    want, got = standin.load(spark, text, tables), read(spark, tables)
    assert got.columns == want.columns and got.count() > 100
    assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()


def _reads(monkeypatch, spark, tables, query):
    """Reads of lineitem by the stage tables of a query and by its result, and its rows."""
    plans = []
    write = session.stage_table
    plan = lambda df: re.sub(r"\s", "", df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(session, "stage_table", lambda df, name: (plans.append(plan(df)), write(df, name))[1])
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    out = catalog.queries()[query](spark, tables)
    return sum(p.count("lineitem.parquet") for p in [*plans, plan(out)]), out.collect()


@pytest.mark.parametrize("query, most", [("contract_report", 1), ("logged_probes", 2), ("extract_sold", 1),
                                         ("iqr_filtered", 1), ("extract_listings", 1), ("preview", 1), ("avg_dom", 1), ("avg_ratio", 1),
                                         ("iqr_fences", 1), ("fence_rates_both", 2), ("segment_area", 1), ("segment_subtype", 1)])
def test_a_query_joins_its_input_once(monkeypatch, spark, tables, query, most):
    reads, rows = _reads(monkeypatch, spark, tables, query)
    assert rows and reads == most


@pytest.mark.parametrize("query", ["iqr_fences", "segment_area", "segment_subtype"])
def test_medians_shuffle_no_values(monkeypatch, spark, tables, query):
    plans = []
    write = session.stage_table
    monkeypatch.setattr(session, "stage_table", lambda df, name: (plans.append(df.columns), write(df, name))[1])
    assert catalog.queries()[query](spark, tables).count()
    assert len(plans) == 1  # no stage of ranked values, only the clean rows
    assert len(plans[0]) <= 6


def test_medians_of_few_groups_equal_those_by_ranges(spark):
    from parcelflow.functions.quantiles import exact_percentiles, exact_percentiles_of
    big = 1.7e308
    rows = [(g, float((i * 37) % 101) if i % 7 else None, [-big, big, 0.0, float("nan"), 1e-3][i % 5]) for g in ("a", "b", None) for i in range(300)]
    rows += [("c", 5.0, None), ("d", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    keys = df.where("g IS NOT NULL").select("g").distinct()
    probs = [0.0, 0.25, 0.5, 0.99]
    want = exact_percentiles(df, ["x", "y"], probs, by=["g"]).collect()
    for accuracy, limit in ((10_000, 200_000), (3, 16)):
        got = exact_percentiles_of(df, keys, ["x", "y"], probs, accuracy=accuracy, bracket_limit=limit).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_many_brackets_of_a_column(spark):
    from parcelflow.functions.quantiles import exact_percentiles
    df = spark.range(5000).select((F.pmod(F.col("id") * 7919, F.lit(5003)) / 3).alias("x"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("y"))
    probs = [i / 40 for i in range(41)]
    got = {(r.field, r.p): r.value for r in exact_percentiles(df, ["x", "y"], probs, accuracy=4, small_n=1, bracket_limit=300).collect()}
    for f in ("x", "y"):
        want = df.selectExpr(f"percentile({f}, array({','.join(map(str, probs))})) AS q").first().q
        assert [got[f, p] for p in probs] == pytest.approx(want, abs=1e-9)
