"""Times the headline queries and prints one JSON line.

Each query is computed in full into Spark's no-op sink after one warm-up; the
figure is the best of three runs.
"""

from __future__ import annotations

import json
import os
import time

from goldvein.checks import QUERIES
from goldvein.session import local_session

HEADLINE = (
    "sales_by_category",
    "fact_measures",
    "fact_order_items",
    "wide_view",
    "sales_trend",
    "sales_heatmap",
    "coupon_by_month",
    "channel_by_month",
    "channel_by_category",
    "filtered_sales",
    "filter_values_category",
    "top_brands",
    "average_basket",
    "customer_recurrence",
    "sales_by_day",
    "normalize_strings",
    "cast_map",
    "dim_products",
    "dim_customers_region",
    "latest_per_key",
    "duplicate_rejects",
    "duplicate_rejects_hot_keys",
    "upsert_result",
    "upsert_small_batch",
    "upsert_stats",
    "upsert_table_loads",
    "medallion_end_to_end",
)
ONCE = ("upsert_table_loads", "medallion_end_to_end")


def timed(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = 1 if name in ONCE else 4
        times = [timed(spark, sf_dir, name) for _ in range(runs)]
        seconds[name] = round(min(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
