"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  test tables, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default 8
Arguments     query names or prefixes; "all" times every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "mtr_on_time_by_nation", "mtr_on_time", "mtr_cost_per_order", "mtr_return_rate",
    "mtr_match_rate", "mtr_dso_proxy", "ask_period", "scorecard_carrier", "mart_i2d",
    "customer_xref", "customer_best_match", "employee_xref", "repair_refs", "three_way_match",
    "milestones", "fx_rates", "dim_customer", "fct_shipment", "fct_sales_order_line",
    "project_merge", "scd2", "median_global", "agg_basic", "filter_predicates",
)


def main() -> None:
    from procmetrics.plans.catalog import load
    from procmetrics.session import local_session

    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries, _ = load()
    wanted = sys.argv[1:]
    names = list(queries) if wanted == ["all"] else [
        n for n in queries if any(n.startswith(w) for w in wanted)] if wanted else list(HEADLINE)
    spark = local_session("bench", cpus)
    # one untimed query, so that the first timed one does not pay for the JVM's start
    queries["agg_basic"](spark, root).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.perf_counter()
        queries[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": root.rsplit("sf", 1)[-1],
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
