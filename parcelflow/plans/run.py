"""End-to-end run from landed files to stage tables, reports and extracts.

    run_pipeline(spark, dataset="sold", dirs=[...], rate_csv=..., boundaries=..., out_dir=...)

Stage outputs are Parquet tables under ``out_dir/<dataset>/``; each stage
that later stages read more than once is read back from its table, which
also cuts lineage. The landed files of new and changed months only are read into the
monthly table; the others stay as they are. Small reports (segment tables, dashboard sheets, checks)
are written as single CSV files. Nothing but bounded metadata (file list,
fence rows) is read back to the driver.
"""

from __future__ import annotations

import os
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import config as C
from parcelflow.operators import contracts, dashboard, metrics, outliers, profile, quality, rates, shape, spatial
from parcelflow.sources import monthly, publish, sinks
from parcelflow.sources.side import read_geojson_polygons, read_rate_csv

PREFIX = {"sold": "Sold", "listings": "Listing"}
#: Contracts that a run evaluates.
CHECKS = ("month_gaps", "months_gone", "rates", "flagged_schema", "single_type", "row_anchor", "row_conservation", "outlier_share")


class ContractError(ValueError):
    """A data contract that must hold does not."""


def _table(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def run_pipeline(spark: SparkSession, *, dataset: str, dirs: Sequence[str], rate_csv: str,
                 boundaries: str, out_dir: str, months: tuple[str, str] | None = None,
                 boundaries_in_3857: bool = True, params: C.Params = C.DEFAULT, expected_rows: int | Mapping[str, int] | None = None,
                 strict: Collection[str] = CHECKS, missing_dirs: str = "skip",
                 expected_districts: Mapping[str, str] | None = None, control_city: str | None = None) -> dict[str, str]:
    """A check named in ``strict`` that fails stops the run, any other is only
    reported. ``expected_rows`` anchors the rows of stages (V1): a number is for
    ``residential``, a mapping may name ``unfiltered``, ``residential``,
    ``enriched_rates``, ``clean``, ``enriched``, ``iqr_flagged``, ``iqr_filtered`` and
    ``extract``; all of them are the check ``row_anchor``. Without ``months`` the
    files' own range must have no gaps, and no month of an earlier run may be gone.
    ``expected_districts`` (by city) and ``control_city`` are for the reports that
    validate the spatial join."""
    anchors = {"residential": expected_rows} if isinstance(expected_rows, int) else dict(expected_rows or {})
    out = os.path.join(out_dir, dataset)
    paths: dict[str, str] = {}

    def report(name: str, df: DataFrame) -> None:
        p = os.path.join(out, "reports", name)
        sinks.write_small_table(df, p)
        paths[name] = p

    def check(name: str, df: DataFrame, failed: str = "NOT coalesce(ok, false)", stops: str | None = None) -> None:
        report(name, df)
        rows = df.where(failed).limit(10).collect()
        if rows and (stops or name) in strict:
            raise ContractError(f"{dataset}: check {name!r} failed: {[r.asDict() for r in rows]}")

    def anchor(stage: str, df: DataFrame) -> None:
        if stage in anchors:
            check("row_anchor" if stage == "residential" else f"row_anchor_{stage}",
                  contracts.expect_rows(df, anchors[stage], f"{stage}_rows"), stops="row_anchor")

    files = monthly.list_monthly_files(spark, dirs, PREFIX[dataset], missing=missing_dirs)
    if months is None:  # the files themselves must be a gapless range
        months = files.agg(F.min("yyyymm"), F.max("yyyymm")).first()
    check("month_gaps", contracts.month_gaps(files, "yyyymm", *months), failed="true")
    paths["monthly"] = os.path.join(out, "monthly")
    changes = publish.refresh_months(spark, dirs, PREFIX[dataset], paths["monthly"], missing_dirs)
    changed = spark.createDataFrame(list(changes.items()), "yyyymm string, change string")
    report("month_changes", changed)
    check("months_gone", changed.where("change = 'gone'"), failed="true")
    landed = publish.read_months(spark, paths["monthly"])
    report("file_rows", landed.groupBy("_source_file").agg(F.count(F.lit(1)).alias("rows")))
    raw = landed.drop("_source_file", "yyyymm")  # of the scan, no fields of the records
    anchor("unfiltered", raw)
    report("schema", shape.schema_report(raw))
    report("property_types", shape.value_counts(raw, "PropertyType"))
    report("null_report", shape.null_report(raw))
    residential = shape.residential(raw)
    anchor("residential", residential)
    report("null_report_residential", shape.null_report(residential))
    report("column_drop", shape.column_drop_report(residential))
    report("column_drop_counts", shape.column_drop_counts(residential))

    reduced = shape.residential_reduced(raw, dataset)
    monthly_rate = rates.monthly_rates(read_rate_csv(spark, rate_csv))
    rated = rates.rate_join(reduced, monthly_rate, C.JOIN_KEYS[dataset])
    report("rate_unmatched", rates.rate_unmatched(rated))
    check("rates", contracts.no_nulls(rated, "rate_30yr_fixed"))
    anchor("enriched_rates", rated)

    flagged = _table(quality.add_flags(quality.type_convert(rated), params), os.path.join(out, "flagged"))
    paths["flagged"] = os.path.join(out, "flagged")
    check("flagged_schema", contracts.schema_contract(spark, rated, flagged, len(C.ALL_FLAGS), C.ALL_FLAGS))
    check("single_type", contracts.single_value(flagged, "PropertyType"))
    clean = quality.clean_view(flagged)
    anchor("clean", clean)
    if dataset == "sold":
        report("numeric_distribution", profile.numeric_distribution(flagged, accuracy=params.quantile_accuracy))
        report("vs_list_share", profile.vs_list_share(flagged))
        report("top_counties", profile.top_counties(flagged, accuracy=params.quantile_accuracy))
    report("flag_family", quality.flag_family(flagged))
    check("row_conservation", contracts.row_conservation(flagged, clean, "hard_invalid_flag"))
    report("flag_summary", quality.flag_summary(flagged))
    report("clean_summary", quality.clean_summary(flagged))

    polys = spatial.unified(read_geojson_polygons(spark, boundaries, reproject_from_3857=boundaries_in_3857))
    enriched = _table(spatial.district_join(metrics.engineer_metrics(clean), polys, params),
                      os.path.join(out, "enriched"))
    paths["enriched"] = os.path.join(out, "enriched")
    anchor("enriched", enriched)
    report("district_coverage", spatial.district_coverage(enriched))
    report("district_county_rate", spatial.district_county_rate(enriched))
    report("district_top", spatial.district_top(enriched))
    if expected_districts:
        report("district_city_check", spatial.district_city_check(enriched, dict(expected_districts)))
    if control_city:
        report("district_negative_control", spatial.district_negative_control(enriched, control_city))
    if dataset == "sold":
        for dim in C.SEGMENT_DIMS:
            report(f"segment_{dim}", metrics.segment(enriched, dim, accuracy=params.quantile_accuracy))
        report("segment_" + "_x_".join(C.SEGMENT_PAIR),
               metrics.segment(enriched, C.SEGMENT_PAIR, accuracy=params.quantile_accuracy))

    fences = outliers.iqr_fences(enriched, accuracy=params.quantile_accuracy)
    report("iqr_fences", fences)
    iqr = _table(outliers.iqr_flags(enriched, fences=fences, accuracy=params.quantile_accuracy),
                 os.path.join(out, "iqr_flagged"))
    paths["iqr_flagged"] = os.path.join(out, "iqr_flagged")
    anchor("iqr_flagged", iqr)
    check("outlier_share", outliers.iqr_share(iqr), failed="NOT coalesce(in_band, false)")
    paths["iqr_filtered"] = os.path.join(out, "iqr_filtered")
    outliers.iqr_filtered(iqr).write.mode("overwrite").parquet(paths["iqr_filtered"])
    anchor("iqr_filtered", outliers.iqr_filtered(iqr))
    if dataset == "sold":
        report("iqr_diagnostics", outliers.iqr_diagnostics(enriched, accuracy=params.quantile_accuracy))
        report("flag_rate_county", outliers.flag_rate_county(iqr))
        report("investor_tier", outliers.investor_tier(iqr))
        report("dom_tail", outliers.dom_tail(iqr))
    report("iqr_comparison", outliers.iqr_comparison(iqr, accuracy=params.quantile_accuracy))

    ext = dashboard.extract_sold(iqr) if dataset == "sold" else dashboard.extract_listings(iqr)
    paths["extract"] = os.path.join(out, "extract")
    paths["extract_rows"] = str(sinks.write_extract(ext, paths["extract"]))
    anchor("extract", ext)
    if dataset == "sold":
        report("sheet_median_price", dashboard.monthly_median_price(iqr, accuracy=params.quantile_accuracy))
        report("sheet_avg_dom", dashboard.avg_dom(iqr))
        report("sheet_avg_ratio", dashboard.avg_ratio(iqr, bounds=params.ratio_bounds))
        report("sheet_closed_sales", dashboard.closed_sales(iqr))
        report("sheet_rates_and_market", dashboard.rates_and_market(iqr, accuracy=params.quantile_accuracy))
    else:
        report("sheet_new_listings", dashboard.new_listings(ext))
    return paths
