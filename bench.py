"""Times the headline queries: python bench.py prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from catchment.plans import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "j1_weighted_join", "a1_mean", "a2_masked_mean", "a6_masked_median", "a8_several_variables", "a9_multi_source_bounds", "a10_hourly_to_daily", "a16_composites_to_monthly",
    "w1_normalize", "w4_normalize_by_month_over_window", "w6_nearest_fill", "g5_weights", "g8_locate", "g9_mosaic",
    "e1_aggregate_source", "e2_runoff_bounds", "e3_aet_bounds", "e4_recharge_bounds", "e5_soil_moisture_monthly", "e6_swe_bounds", "e7_sca_inputs",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    queries["p1_metres_to_mm"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # starts the session's threads
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
