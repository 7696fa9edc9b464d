"""Largest generated method of named queries, in bytes; the JVM's compiler skips those above 8,000.

    python tools/method_sizes.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from closebook.catalog.queries import REGISTRY  # noqa: E402

#: Methods beyond this size stay interpreted.
COMPILED = 8000


def method_sizes(df: DataFrame) -> list[int]:
    """The largest method of every generated stage of the plan, adaptive execution off."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = df.select("*")
        plan = again._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__(
            "MODULE$"
        ).codegenStringSeq(plan)
        return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    beyond = 0
    for name in wanted:
        most = max(method_sizes(REGISTRY[name](spark, folder)), default=0)
        beyond += most > COMPILED
        print(f"{name:28s} {most:8d}{' beyond' if most > COMPILED else ''}", flush=True)
    print(f"{len(wanted)} queries, {beyond} beyond {COMPILED}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
