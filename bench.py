"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is run in full (no-op sink) once to warm up and then
``BENCH_RUNS`` times; the median counts. Cached dimensions are dropped before
each run, so every timing includes deriving and counting them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from closebook.catalog.queries import REGISTRY

HEADLINE = (
    "bcm_balance_open",
    "bcm_balance_close",
    "actuals_balance_open",
    "csm_balance",
    "portfolio_balance_open",
    "sign_flag_remap",
    "portfolio_balance_close",
    "bcm_reduction",
    "ir_rollforward",
    "sm_closing",
    "bcm_detail",
    "onerous_check",
    "pl_movement_ir",
    "pl_movement_lrc",
    "pl_movement_lic_past",
    "pl_movement_lic_current",
    "ledger_reconcile",
    "portfolio_lookup",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("closebook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def timed(spark: SparkSession, name: str, folder: str) -> float:
    spark.catalog.clearCache()
    began = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else list(HEADLINE)
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds, cold = {}, {}
    for name in names:
        cold[name] = round(timed(spark, name, folder), 3)
        seconds[name] = round(
            statistics.median(timed(spark, name, folder) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
