import os

import pytest
from test_sources import _write
from test_spatial import _geojson

from parcelflow.plans.run import ContractError, run_pipeline

HEAD = ("ListingKey,PropertyType,ClosePrice,OriginalListPrice,ListPrice,LivingArea,DaysOnMarket,"
        "CloseDate,ListingContractDate,PurchaseContractDate,Latitude,Longitude,CountyOrParish,City,"
        "PostalCode,PropertySubType,MLSAreaMajor,ListOfficeName,BuyerOfficeName,BedroomsTotal,"
        "BathroomsTotalInteger,YearBuilt,Extra\n")
RATES = "observation_date,MORTGAGE30US\n2023-12-07,7.0\n2024-01-04,6.6\n2024-01-11,6.7\n2024-02-01,6.6\n"


def landed(folder: str, rates: str = RATES) -> dict:
    """Two monthly files, a rate file and boundaries, as arguments of a run."""
    d = os.path.join(folder, "landing")
    rows1 = "".join(f"{i},Residential,{500000 + 1000 * i},{510000 + 900 * i},{505000 + 900 * i},{1500 + i},"
                    f"{10 + i % 30},2024-01-{1 + i % 28:02d},2023-12-01,2023-12-20,34.{i % 9 + 1},-119.{i % 9 + 1},"
                    f"Orange,Irvine,92618.0,SingleFamilyResidence,OC,Office A,Office B,3,2,1990,x\n" for i in range(60))
    rows2 = "".join(f"{100 + i},Residential,{700000 + 500 * i},{690000},{700000},{1800},{20},2024-02-10,"
                    f"2024-01-05,2024-01-20,,,Riverside,Corona,92880,Condominium,RV,Office C,NONMEMBER MRML,2,2,2005,y\n"
                    for i in range(20))
    _write(f"{d}/CRMLSSold202401.csv", HEAD + rows1 + "999,Land,1,1,1,1,1,2024-01-02,2024-01-01,,,,,,,,,,,,,,z\n")
    _write(f"{d}/CRMLSSold202402.csv", HEAD + rows2)
    rate = os.path.join(folder, "rates.csv")
    _write(rate, rates)
    geo = os.path.join(folder, "d.geojson")
    _geojson(geo)
    return {"dataset": "sold", "dirs": [d], "rate_csv": rate, "boundaries": geo, "out_dir": os.path.join(folder, "out")}


def test_end_to_end(spark, tmpdir_path):
    anchors = {"unfiltered": 81, "residential": 80, "enriched_rates": 80, "clean": 80, "enriched": 80, "iqr_flagged": 80, "extract": 80}
    args = landed(tmpdir_path)
    paths = run_pipeline(spark, **args, months=("202401", "202402"), expected_rows=anchors, expected_districts={"Irvine": "Square"}, control_city="Corona")
    flagged = spark.read.parquet(paths["flagged"])
    assert flagged.count() == 80  # the Land row is filtered out, nothing else dropped
    assert flagged.where("rate_30yr_fixed IS NULL").count() == 0
    enriched = spark.read.parquet(paths["enriched"])
    assert enriched.where("DistrictName = 'Square'").count() > 0
    assert int(paths["extract_rows"]) == spark.read.parquet(paths["iqr_flagged"]).count()
    assert spark.read.option("header", True).csv(paths["month_gaps"]).count() == 0
    for name in ("row_conservation", "row_anchor", "row_anchor_unfiltered", "row_anchor_extract", "rates", "single_type", "district_city_check"):
        assert spark.read.option("header", True).csv(paths[name]).first().ok == "true", name
    assert spark.read.option("header", True).csv(paths["outlier_share"]).first().in_band == "true"
    reasons = {r.column: r.reason for r in spark.read.option("header", True).csv(paths["column_drop"]).collect()}
    assert reasons["Extra"] == "dropped_other" and "yyyymm" not in reasons and "_source_file" not in reasons
    again = run_pipeline(spark, **args, months=("202401", "202402"), expected_rows=80)  # nothing landed since
    assert spark.read.option("header", True).csv(again["month_changes"]).count() == 0
    os.remove(os.path.join(args["dirs"][0], "CRMLSSold202402.csv"))
    with pytest.raises(ContractError, match="months_gone"):  # the files' own range has no gap
        run_pipeline(spark, **args)


@pytest.mark.parametrize("name,rates,more", [
    ("month_gaps", RATES, {"months": ("202401", "202403")}),
    ("rates", RATES.replace("2024-02-01", "2024-03-01"), {}),
    ("row_anchor", RATES, {"expected_rows": 81}),
])
def test_failed_contract_stops_the_run(spark, tmpdir_path, name, rates, more):
    with pytest.raises(ContractError, match=name):
        run_pipeline(spark, **landed(tmpdir_path, rates), **more)
