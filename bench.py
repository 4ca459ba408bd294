"""Benchmark: wall time of the headline queries over one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query reads the stored layer below it; the first query of a session that
needs a layer also stores it, so times depend on the order of the queries.
Results go to the ``noop`` sink: every row is computed and nothing is
collected to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakemarts import build_session  # noqa: E402
from lakemarts.plans.queries import queries  # noqa: E402

HEADLINE = [
    "silver_order_items",
    "silver_reviews",
    "fct_orders",
    "fct_order_items",
    "mart_daily_sales",
    "mart_product_performance",
    "mart_customer_summary",
    "mart_delivery_quality",
    "dq_results",
    "profile_order_items",
    "mart_tests",
    "layer_counts",
]


def run_pipeline(spark, sf_dir: str) -> float:
    """Optional (BENCH_PIPELINE=1): the staged run CSV → bronze → silver →
    gate → gold → marts into a scratch warehouse; CSV writing not timed."""
    import tempfile

    from lakemarts.contracts import SOURCE_FILES
    from lakemarts.plans.pipeline import run_all
    from lakemarts.sources.driver_tables import DriverTables

    scratch = tempfile.mkdtemp(prefix="lakemarts-bench-")
    raw = os.path.join(scratch, "raw")
    tables = DriverTables(spark, sf_dir)
    for dataset, name in SOURCE_FILES.items():
        tables.raw(dataset).write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(os.path.join(raw, name))
    t0 = time.perf_counter()
    run_all(spark, raw, prefix="bench", location=os.path.join(scratch, "warehouse"))
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app_name="lakemarts-bench",
        conf={
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
            "spark.driver.memory": "16g",
        },
    )
    registry = queries()

    def run(name: str, directory: str) -> float:
        t0 = time.perf_counter()
        registry[name](spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    # Warm-up pass over the smallest scale factor: JVM JIT and the whole-stage
    # codegen cache are fixed per-plan costs that do not grow with the data.
    # Both the cold (first) and the warm total are reported.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    cold = {name: run(name, warm_dir) for name in names}
    timings = {name: run(name, sf_dir) for name in names}
    extra = {}
    if os.environ.get("BENCH_PIPELINE") == "1":
        extra["pipeline_run_all_sec"] = run_pipeline(spark, sf_dir)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "warmup_dir": warm_dir,
                "cold_total_at_warmup_dir": round(sum(cold.values()), 3),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                **extra,
                "spark": spark.version,
                "python": platform.python_version(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
