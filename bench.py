"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (all rows produced, none
shipped to Python).  One warm-up run of the flagship on the smallest tables
(JIT, codegen), then each query is timed once, cold: views and stored tables
of earlier queries are forgotten, so a query that needs gold rebuilds it.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_transform",        # PIP-1 flagship: parse, exclude, derive, exact value score
    "value_score",           # WIN-1/2 alone
    "scd2_history",          # SCD-2 replay of 30 daily batches
    "field_coverage",        # AGG-3 in one pass
    "validate_failures",     # VAL-* rule engine
    "upsert_coalesce",       # MRG-1/2
    "sql_audit",             # GTE-* over every logged statement
    "brand_model_trim",      # FN-1..6
    "profile_counts",        # Q16
    "q14_cte_brands",        # guarded query surface
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from lotwright.plans.registry import REGISTRY
    from lotwright.session import get_session
    from lotwright.sources import testviews

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                        app_name="lotwright-bench")

    def run(name: str, where: str = sf_dir) -> float:
        testviews.forget_views()
        t0 = time.perf_counter()
        REGISTRY[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("gold_transform", "/root/testdata/sf0.001")       # warm-up
    times = {}
    for name in HEADLINE:
        times[name] = round(run(name), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
