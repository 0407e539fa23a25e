import json
import os

from parcelflow.sources import monthly, pages, side, sinks


def _write(path, text, enc="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(enc))


def test_discovery_encoding_headers(spark, tmpdir_path):
    a, b = os.path.join(tmpdir_path, "canon"), os.path.join(tmpdir_path, "top")
    _write(f"{a}/CRMLSSold202401.csv", "ListingKey,City,ClosePrice\n1,O’Neil,100\n2,NA,200\n", "cp1252")
    _write(f"{a}/CRMLSSold202402.csv", 'ClosePrice,ListingKey,City\n300,3,"San\nDiego"\n400,4,"He said ""hi"""\n')
    _write(f"{b}/CRMLSSold202401.csv", "ListingKey,City,ClosePrice\n9,Stale,999\n")
    _write(f"{b}/CRMLSSold202403.csv", "ListingKey,City,ClosePrice,City\n5,Irvine,500,Dup\n")
    _write(f"{a}/CRMLSSold20240.csv", "x\n1\n")
    _write(f"{a}/CRMLSSold202401_old.csv", "x\n1\n")
    files = monthly.list_monthly_files(spark, [a, b], "Sold")
    got = {r.yyyymm: r.path for r in files.collect()}
    assert sorted(got) == ["202401", "202402", "202403"]
    assert "/canon/" in got["202401"]  # first folder wins
    enc = {os.path.basename(r.path): r.encoding for r in monthly.classify_encoding(spark, list(got.values())).collect()}
    assert enc["CRMLSSold202401.csv"] == "cp1252" and enc["CRMLSSold202402.csv"] == "utf8"
    df = monthly.read_monthly(spark, files)
    rows = {r.ListingKey: r for r in df.collect()}
    assert rows["1"].City == "O’Neil"          # 0x92 decoded as cp1252
    assert rows["2"].City is None                   # NA token is missing
    assert rows["3"].ClosePrice == "300" and rows["3"].City == "San\nDiego"  # by name, multi-line
    assert rows["4"].City == 'He said "hi"'
    assert rows["5"].City == "Irvine"               # duplicate header keeps the first copy
    assert rows["5"].yyyymm == "202403" and len(rows) == 5


def test_pages(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "pages")
    os.makedirs(d)
    with open(f"{d}/sold_202401_p1.json", "w") as fh:
        json.dump({"value": [{"ListingKey": "1", "City": "A"}, {"ListingKey": "2"}], "@odata.nextLink": "x"}, fh)
    with open(f"{d}/sold_202401_p2.json", "w") as fh:
        json.dump({"value": [{"ListingKey": "3", "City": "C", "Extra": "z"}]}, fh)
    with open(f"{d}/sold_202402_p1.json", "w") as fh:
        json.dump({"value": [{"ListingKey": "4"}], "@odata.nextLink": "y"}, fh)
    df = pages.read_pages(spark, d, ["ListingKey", "City", "ListingKey"])
    assert df.columns[:2] == ["ListingKey", "City"]
    assert {r.ListingKey: r.City for r in df.collect()} == {"1": "A", "2": None, "3": "C", "4": None}
    comp = {r.yyyymm: r.complete for r in pages.page_completeness(spark, d).collect()}
    assert comp == {"202401": True, "202402": False}


def test_rates_sinks(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "rates.csv")
    _write(p, "observation_date,MORTGAGE30US\n2024-01-04,6.62\n2024-01-11,6.66\n")
    r = side.read_rate_csv(spark, p)
    assert r.columns == ["date", "rate_30yr_fixed"] and r.count() == 2
    out = os.path.join(tmpdir_path, "monthly_out")
    df = spark.createDataFrame([("202401", 1), ("202402", 2)], "yyyymm string, v int")
    sinks.write_monthly(df, out)
    sinks.write_monthly(spark.createDataFrame([("202402", 3)], "yyyymm string, v int"), out)
    got = {str(r.yyyymm): r.v for r in spark.read.parquet(out).collect()}
    assert got == {"202401": 1, "202402": 3}  # only the re-run month replaced
    assert sinks.write_extract(df, os.path.join(tmpdir_path, "ext")) == 2


def test_month_of_a_folder_with_spaces(spark, tmpdir_path):
    import os
    from parcelflow.sources.monthly import list_monthly_files, read_monthly
    folder = os.path.join(tmpdir_path, "Listing & Sold (Jan 2024 - May 2026)")
    os.makedirs(folder)
    for month in ("202401", "202402"):
        with open(os.path.join(folder, f"CRMLSSold{month}.csv"), "w", encoding="utf-8") as f:
            f.write(f"ListingKey,City\nk{month},Irvine\n")
    rows = read_monthly(spark, list_monthly_files(spark, [folder, os.path.join(tmpdir_path, "missing")], "Sold")).collect()
    assert {(r.ListingKey, r.yyyymm) for r in rows} == {("k202401", "202401"), ("k202402", "202402")}


def test_number_with_a_type_suffix_is_missing(spark):
    from parcelflow.functions.scalars import lenient_double
    got = spark.createDataFrame([("12d",), ("5f",), ("12",), ("1e3",), (" 7.5 ",), ("NaN",), ("x",)], "v string").select(lenient_double("v").alias("d")).collect()
    assert [r.d for r in got] == [None, None, 12.0, 1000.0, 7.5, None, None]
