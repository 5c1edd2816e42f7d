"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerline.plans import warehouse
from ledgerline.plans.catalog import all_queries
from ledgerline.plans.feed import sales_feed
from ledgerline.session import local_session, write_stage

HEADLINE = [
    "d00_priority_history",
    "d00_priority_in_force",
    "d01_category_history",
    "d03_item_history",
    "d04_store_overlapping_batch",
    "d06_orders_fact",
    "s10_orders_upserted",
    "j01_interval_join",
    "j02_overlap_join",
    "a07_weekly_totals",
    "a18_yoy_ytd",
    "d12_store_months",
    "w09_parent_share",
    "p18_json_validity",
    "t01_decomposed",
    "t04_level_shifts",
    "t06_smoothing_scores",
    "t08_kmeans",
]


def order_view_apart(spark, folder: str) -> dict[str, float]:
    """Seconds to build the warehouse tables behind the order view, and to read the view over built ones."""
    feed = lambda columns: sales_feed(spark, folder, columns)
    start = time.time()
    tables = warehouse.build_warehouse(feed, ["store", "store_address", "county", "item", "item_detail", "category", "vendor"])
    known = {n: tables[n] for n in ("store", "item", "item_detail", "category", "vendor")}
    # Loading an order resolves the dimension rows in force on its day; the view joins by equality.
    orders = write_stage(warehouse.resolve_versions(warehouse.refresh_orders(None, feed(warehouse.INVOICE_COLUMNS)), **known), "orders")
    built = time.time()
    warehouse.orders_view(orders, **tables).write.format("noop").mode("overwrite").save()
    return {"d07_build": round(built - start, 3), "d07_view": round(time.time() - built, 3)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    registered = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    registered[wanted[0]](spark, folder).write.format("noop").mode("overwrite").save()  # starts workers and compiles
    seconds = {}
    for name in wanted:
        start = time.time()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    if not sys.argv[1:]:
        seconds |= order_view_apart(spark, folder)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
