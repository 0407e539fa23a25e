import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.functions.quantiles import exact_percentiles, exact_percentiles_wide


def _close(a, b):
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


@pytest.mark.parametrize("small_n", [None, 10])
def test_matches_linear_quantile_grouped(spark, small_n):
    rng = np.random.default_rng(7)
    n = 5000
    pdf = pd.DataFrame({"g": rng.integers(0, 4, n).astype(str),
                        "v": np.round(rng.lognormal(10, 1, n), 2)})
    pdf.loc[::17, "v"] = np.nan  # nulls are ignored
    df = spark.createDataFrame(pdf)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = exact_percentiles(df, ["v"], probs, by=["g"], accuracy=100, small_n=small_n).collect()
    assert len(got) == 4 * len(probs)
    for r in got:
        s = pdf.loc[pdf.g == r.g, "v"].dropna()
        assert r.n == len(s)
        assert _close(r.value, float(s.quantile(r.p)))


def test_hot_group_and_duplicates(spark):
    # one group holds most rows and many duplicates: the sketch path must
    # still land on the exact ranks
    vals = [5.0] * 30000 + list(np.arange(1000.0)) + [1e9]
    df = spark.createDataFrame(pd.DataFrame({"g": ["hot"] * len(vals), "v": vals}))
    got = {r.p: r.value for r in exact_percentiles(df, ["v"], [0.5, 0.99, 1.0], by=["g"], accuracy=100).collect()}
    s = pd.Series(vals)
    for p, v in got.items():
        assert _close(v, float(s.quantile(p)))


def test_wide_multiple_fields(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0], "b": [10.0, None, 30.0, 50.0]})
    r = exact_percentiles_wide(spark.createDataFrame(pdf), [("ma", "a", 0.5), ("mb", "b", 0.5),
                                                          ("q3b", "b", 0.75)]).first()
    assert r.ma == 2.5 and r.mb == 30.0 and r.q3b == 40.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=40),
       st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_property_small_lists(spark, xs, p):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    r = exact_percentiles(df, ["v"], [p]).first()
    assert _close(r.value, float(np.quantile(np.array(xs, dtype=float), p)))


def test_refinement_levels(spark):
    # tiny accuracy and bracket limit force the refinement path; the result
    # must still be the exact linear quantile
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 20000).astype(str), "v": rng.normal(0, 1, 20000)})
    df = spark.createDataFrame(pdf)
    for by in ([], ["g"]):
        got = exact_percentiles(df, ["v"], [0.01, 0.5, 0.9], by=by, accuracy=50, small_n=100,
                                bracket_limit=300).collect()
        for r in got:
            s = pdf.v if not by else pdf.loc[pdf.g == r.g, "v"]
            assert _close(r.value, float(s.quantile(r.p))), (by, r)


def _jobs(spark, work):
    """Spark jobs that ``work`` runs."""
    sc = spark.sparkContext
    sc.setJobGroup("counted", "counted jobs")
    try:
        out = work()
        return out, len(sc.statusTracker().getJobIdsForGroup("counted"))
    finally:
        sc.setJobGroup("", "")


def test_few_distinct_values_need_one_level(spark):
    xs = [0.0, 1.0, 2.0, 3.0, 1e300] * 4000
    df = spark.createDataFrame([(x,) for x in xs], "v double").repartition(4).cache()
    df.count()
    probs = [0.0, 0.1, 0.25, 0.5, 0.79995, 0.9, 1.0]
    got, jobs = _jobs(spark, lambda: {r.p: r.value for r in exact_percentiles(df, ["v"], probs, staged=True).collect()})
    assert got == {p: float(np.quantile(xs, p)) for p in probs}
    assert jobs <= 5  # the range, one histogram (each may be two with adaptive stages), the result


@pytest.mark.parametrize("xs", [
    [1e-320, 5e-324, 0.0, -5e-324, 1.0], [1e308, -1e308, 0.0, 5.0, 7.0, 7.0], [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
    [10.0 ** k for k in range(-300, 300, 14)], [2.0 ** -k for k in range(90)], [7.0] * 50, [3.0]])
def test_hard_ranges(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "v double")
    probs = [0.0, 0.5, 1.0] if len(xs) % 2 else [0.0, 1.0]
    for how in ({"by": []}, {"by": [], "accuracy": 3, "small_n": 0}, {"by": ["g"]}):
        got = exact_percentiles(df.selectExpr("'x' g", "v"), ["v"], probs, **how).collect()
        assert {r.p: r.value for r in got} == {p: sorted(xs)[int(p * (len(xs) - 1))] for p in probs}


def test_groups_over_many_partitions(spark):
    """Hot groups and hot values spread over range partitions, two keys, a null
    key, a group without values."""
    rng = np.random.default_rng(3)
    n = 20000
    pdf = pd.DataFrame({"a": np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 30, n).astype(str)), "b": rng.integers(0, 3, n),
                        "v": np.where(rng.random(n) < 0.4, 5.0, rng.normal(0, 3, n)), "w": rng.integers(0, 4, n).astype(float)})
    pdf.loc[::11, "v"] = np.nan
    pdf.loc[pdf.a == "7", "w"] = np.nan
    df = spark.createDataFrame(pdf).selectExpr("nullif(a, '9') a", "b", "v", "w")
    got = exact_percentiles(df, ["v", "w"], [0.25, 0.5, 0.99], by=["a", "b"], broadcast_rows=0).collect()
    want = pdf[pdf.a != "9"].melt(["a", "b"], ["v", "w"], "field", "x").dropna().groupby(["a", "b", "field"])["x"]
    assert len(got) == 3 * want.ngroups
    for r in got:
        s = want.get_group((r.a, r.b, r.field))
        assert r.n == len(s) and _close(r.value, float(s.quantile(r.p)))
