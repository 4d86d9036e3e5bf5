"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores.
Results are computed in full and thrown away (noop sink).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tilldeck.plans.catalog import QUERIES
from tilldeck.session import build_session

HEADLINE = (
    "trade_order_detail",
    "payment_detail",
    "refund_detail",
    "user_behavior_detail",
    "inventory_detail",
    "order_fact",
    "trade_daily",
    "trade_by_order_date",
    "user_daily",
    "product_daily",
    "shop_daily",
    "category_daily",
    "user_retention",
    "inventory_daily",
    "retail_dashboard",
    "product_topn",
    "shop_rank",
    "rfm_segment",
    "refund_analysis",
    "inventory_turnover",
    "behavior_detail",
    "behavior_event_type_daily",
    "behavior_daily",
    "behavior_product_daily",
    "behavior_category_daily",
    "behavior_product_topn",
    "dq_checks",
    "latest_day_topn",
    "dashboard_payload",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = build_session("tilldeck-bench", f"local[{cpus}]", shuffle_partitions=partitions, driver_memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Untimed runs on the smallest tables load and compile what the queries need.
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    for name in names if os.path.isdir(smallest) else ():
        QUERIES[name](spark, smallest).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
