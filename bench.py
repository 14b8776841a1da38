"""Times the headline queries and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each query runs once to
warm up and then $BENCH_RUNS times; the median counts. Results go to a noop sink, so all rows are
computed and none reach the driver. Measures and reports read the star, whose build is timed on its
own as c20_sales_fact.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tradewell import entries  # noqa: E402

HEADLINE = [
    "s01_columnar_scan", "s04_read_pages", "a02_numeric_profile", "c03_validate_bronze", "d01_dedup",
    "p16_row_hash", "p17_clean_chain", "c06_merge_order_details", "a08_merge_counts", "c09_primary_keys",
    "c11_quality", "c13_referential_integrity", "w01_number_orders", "c18_dimproducts", "c19_dimdate",
    "c20_sales_fact", "m01_total_sales", "m06_products_sold", "m08_sales_last_year", "m10_sales_ytd",
    "m18_top10_share", "m20_on_time_rate", "m22_avg_delivery_days", "m43_category_top_product",
    "f06_shared_filters", "r02_totals_by_title", "r03_top_products", "r04_sales_by_category",
    "r11_top_employees", "r12_operations", "r13_reorder_table", "r17_insights_page",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tradewell-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registered = entries.queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in wanted:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(json.dumps({"metric": "headline queries, total of medians", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
