"""Two-phase publishing, the lossless union and the incremental monthly table."""

import glob
import os
import time

import pytest
from test_sources import _write

from parcelflow.sources import monthly, publish


def _csv(folder, month, keys, extra=False):
    head = "ListingKey,City" + (",Pool" if extra else "") + "\n"
    _write(os.path.join(folder, f"CRMLSSold{month}.csv"), head + "".join(f"{k},Irvine" + (",Y" if extra else "") + "\n" for k in keys))


def _written(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/yyyymm=*/*.parquet")}


def test_publish_keeps_the_old_table_on_failure(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "table")
    assert publish.publish(spark.range(10).toDF("v"), path) == 10
    assert publish.publish(spark.range(5).toDF("v"), path) == 5
    with pytest.raises(publish.PublishError, match="too few"):
        publish.publish(spark.range(2).toDF("v"), path, check=lambda t: "too few rows" if t.count() < 3 else None)
    with pytest.raises(Exception, match="stop"):
        publish.publish(spark.range(9).selectExpr("if(id = 7, raise_error('stop'), id) AS v"), path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(tmpdir_path) == ["table"]  # nothing is left beside it
    assert publish.publish(spark.range(0).selectExpr("id v", "map('a', 1) m"), path) == 0


def test_published_table_is_read_back(spark, tmpdir_path, monkeypatch):
    """A table that isn't on disk as it was written doesn't take its place."""
    path = os.path.join(tmpdir_path, "table")
    publish.publish(spark.range(5).toDF("v"), path)
    real = publish._fingerprint

    def spoilt(df):
        rows, checksum = real(df)
        return [rows, checksum] if os.listdir(tmpdir_path) == ["table"] else [rows, (checksum + 1).alias("checksum")]
    monkeypatch.setattr(publish, "_fingerprint", spoilt)
    with pytest.raises(publish.PublishError):
        publish.publish(spark.range(7).toDF("v"), path)
    assert spark.read.parquet(path).count() == 5


def test_dropped_part_raises(spark, tmpdir_path):
    _csv(tmpdir_path, "202401", range(5))
    _csv(tmpdir_path, "202402", range(7))
    out = os.path.join(tmpdir_path, "out")
    table = monthly.MonthlyTable(spark, monthly.list_monthly_files(spark, [tmpdir_path], "Sold"))
    rows = publish.write_lossless(table, lambda df: df.write.parquet(out))
    assert sorted(rows.values()) == [5, 7]
    whole = table.df
    for lossy in (whole.where("yyyymm <> '202401'"), whole.unionAll(whole.where("ListingKey = '3'")), whole.where("ListingKey <> '6'")):
        table.df = lossy
        with pytest.raises(publish.PublishError, match="not lossless"):
            publish.write_lossless(table, lambda df: df.write.format("noop").mode("overwrite").save())


def test_only_changed_months_are_written(spark, tmpdir_path):
    landing, path = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "monthly")
    _csv(landing, "202401", range(5))
    _csv(landing, "202402", range(7))
    assert publish.refresh_months(spark, [landing], "Sold", path) == {"202401": "new", "202402": "new"}
    first = _written(path)
    assert publish.refresh_months(spark, [landing], "Sold", path) == {}
    assert _written(path) == first
    _csv(landing, "202403", range(3), extra=True)
    assert publish.refresh_months(spark, [landing], "Sold", path) == {"202403": "new"}
    second = _written(path)
    assert {os.path.dirname(p)[-6:] for p in second.items() - first.items() for p in p[:1]} == {"202403"}  # one partition written
    rows = publish.read_months(spark, path)
    assert {r.yyyymm: r["count"] for r in rows.groupBy("yyyymm").count().collect()} == {"202401": 5, "202402": 7, "202403": 3}
    assert rows.where("Pool = 'Y'").count() == 3 and rows.where("Pool IS NULL").count() == 12
    time.sleep(0.01)
    _csv(landing, "202401", range(2))  # a corrected file
    _csv(landing, "202402", [])        # one without rows
    os.remove(os.path.join(landing, "CRMLSSold202403.csv"))
    assert publish.refresh_months(spark, [landing], "Sold", path) == {"202401": "changed", "202402": "changed", "202403": "gone"}
    assert {r.yyyymm: r["count"] for r in publish.read_months(spark, path).groupBy("yyyymm").count().collect()} == {"202401": 2}


def test_missing_folder_is_an_error_on_demand(spark, tmpdir_path):
    _csv(tmpdir_path, "202401", range(2))
    gone = os.path.join(tmpdir_path, "gone")
    assert monthly.list_monthly_files(spark, [tmpdir_path, gone], "Sold").count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        monthly.list_monthly_files(spark, [tmpdir_path, gone], "Sold", missing="raise")
