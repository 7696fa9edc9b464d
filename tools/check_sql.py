"""Compare every named query with its SQL on one folder of tables.

    python tools/check_sql.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from closebook.catalog.oracles import STATEMENTS  # noqa: E402
from closebook.catalog.queries import REGISTRY  # noqa: E402

TABLES = ("lineitem", "orders", "supplier")


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if df[name].dtype == object or str(df[name].dtype).startswith("str"):
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    return df.sort_values(list(df.columns), na_position="last", kind="stable").reset_index(drop=True)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None if equal to the last bit, otherwise what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    a, b = canonical(spark_rows), canonical(sql_rows)
    for name in a.columns:
        x, y = a[name], b[name]
        if x.dtype.kind != y.dtype.kind:
            return f"type of {name}: {x.dtype} / {y.dtype}"
        if x.dtype.kind == "f":
            same = (x == y) | (x.isna() & y.isna())
            same &= ~(np.signbit(x) ^ np.signbit(y)) | x.isna()
        else:
            same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            return f"{name}: {(~same).sum()} of {len(a)} differ, first {x[~same].iloc[0]!r} / {y[~same].iloc[0]!r}"
    return None


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in wanted:
        began = time.perf_counter()
        rows = REGISTRY[name](spark, folder).toPandas()
        took = time.perf_counter() - began
        if name not in STATEMENTS:
            print(f"{name:28s} {len(rows):8d} {took:6.2f}s no SQL", flush=True)
            continue
        found = difference(rows, con.execute(STATEMENTS[name]).df())
        failed += found is not None
        print(f"{name:28s} {len(rows):8d} {took:6.2f}s {found or 'equal'}", flush=True)
    print(f"{len(wanted)} queries, {failed} different")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
