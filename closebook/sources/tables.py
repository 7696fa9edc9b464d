"""Result tables, stage hand-off and sampled scans."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.session import cut_lineage


#: Rows a file holds at most.
FILE_ROWS = 5_000_000


def gathered(df: DataFrame, partition_by: Iterable[str]) -> DataFrame:
    """Rows of one partition value together, before a partitioned write.

    Otherwise every task writes a file for every value it meets. Adaptive execution splits
    a value that holds many rows over several tasks again, by their bytes.
    """
    keys = list(partition_by)
    return df.hint("rebalance", *[F.col(f"`{key}`") for key in keys]) if keys else df


def write_result(
    df: DataFrame,
    path: str,
    partition_by: Iterable[str] = (),
    mode: str = "errorifexists",
    file_rows: int = FILE_ROWS,
) -> None:
    """Parquet, in a folder for each partition value, in files of at most ``file_rows`` rows."""
    keys = list(partition_by)
    writer = gathered(df, keys).write.mode(mode).option("maxRecordsPerFile", file_rows)
    writer.partitionBy(*keys).parquet(path)


def read_result(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def hand_off(df: DataFrame) -> DataFrame:
    """Boundary between two stages whose result several branches read."""
    return cut_lineage(df)


def first_rows(df: DataFrame, count: int, *order: str) -> DataFrame:
    """The first ``count`` rows in a given order: a trial sample, repeatable.

    Only ``count`` rows per partition reach the final merge; keep it small.
    """
    return df.orderBy(*[F.col(name) for name in order]).limit(count)
