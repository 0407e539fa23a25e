"""Bench: run the headline queries over the whole tables at $BENCH_SF_DIR on
local[$BENCH_CPUS]; print one JSON line. Each query is fully executed with
the no-op sink (nothing is collected to the driver)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelflow.plans import catalog  # noqa: E402
from parcelflow.session import local_session  # noqa: E402

HEADLINE = [
    "monthly_median_price",   # whole chain: rates, flags, metrics, spatial join, IQR, median by month
    "district_join",          # grid-bucketed spatial join
    "flag_summary",           # 18 flags in one pass
    "iqr_fences",             # exact distributed percentiles
    "segment_county",         # top-k segments with medians
    "rate_join",              # broadcast enrichment join
    "avg_ratio",              # dashboard average with IQR base and ratio range
    "extract_sold",           # typed dashboard extract
    "fence_rates_both",       # both datasets
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="parcelflow-bench",
                          **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
                             "spark.driver.memory": "16g"})
    qs = catalog.queries()
    # warm-up: JVM, parquet footers, codegen caches
    qs["shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
