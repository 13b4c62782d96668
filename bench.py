"""Benchmark: build the warehouse and run the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.

Phases: ``build_core`` (binding, staging, dimensions, the four core facts),
``build_enterprise`` (stores, assignment, cost, plans, marketing, inventory
roll-forward and the enterprise facts), then every registered query of the
warehouse, run to its last row without collecting it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopwright.plans import catalog  # noqa: E402
from shopwright.session import get_spark  # noqa: E402

CORE = ["dim_customer", "dim_product", "dim_seller", "dim_order_status", "dim_date", "fact_orders",
        "fact_order_items", "fact_payments", "fact_reviews"]
ENTERPRISE = ["gen_stores", "gen_assignment", "gen_product_supplier", "gen_product_cost", "gen_budget",
              "gen_targets", "gen_marketing", "gen_inventory", "fact_orders_ent", "fact_order_items_ent",
              "fact_inventory_monthly", "fact_store_plan", "fact_marketing_spend"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    w = catalog.warehouse(spark, sf_dir)
    timings: dict[str, float] = {}

    t = time.time()
    for name in CORE:
        w[name].count()
    timings["build_core"] = round(time.time() - t, 3)

    t = time.time()
    for name in ENTERPRISE:
        w[name].count()
    timings["build_enterprise"] = round(time.time() - t, 3)

    for name in catalog.REGISTRY:
        t = time.time()
        catalog.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t, 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
