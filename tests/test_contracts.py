from parcelflow.operators import contracts


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double")
    assert contracts.expect_rows(df, 3).first().ok
    assert not contracts.expect_rows(df, 4).first().ok
    assert contracts.no_nulls(df, "v").first().nulls == 1
    assert contracts.single_value(df.where("k = 'a'"), "k").first().ok
    rep = {r.check: r.ok for r in contracts.schema_contract(spark, df, df.withColumn("f", df.v), 1, ["k"]).collect()}
    assert rep == {"column_delta": True, "no_duplicate_names": True, "upstream_carried": True, "has:k": True}
    gaps = {(r.yyyymm, r.status) for r in contracts.month_gaps(
        spark.createDataFrame([("202401",), ("202403",), ("202405",)], "m string"), "m", "202401", "202404").collect()}
    assert gaps == {("202402", "missing"), ("202404", "missing"), ("202405", "extra")}
