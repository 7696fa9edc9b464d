"""Lookups against dimension tables.

No join here carries a broadcast hint. Spark compares the size of a dimension with
``spark.sql.autoBroadcastJoinThreshold``, adaptive execution does so again with the
bytes that a shuffled side really has, and beyond that limit the join is by
sort-merge with hot keys split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that would make a lookup multiply rows."""
    counted = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counted.filter(F.col("copies") > 1)


def checked(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dim`` for a lookup that must not multiply rows: a second row for a key stops the job.

    The check is an aggregate of the dimension in the plan of the lookup, so it costs
    no job of its own and cannot be forgotten. Rows with a null key match nothing and
    are left out.
    """
    values = F.struct(*[F.col(f"`{c}`") for c in dim.columns if c not in keys])
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    known = dim.filter(whole).select(*keys, values.alias("_values"))
    named = F.concat_ws(", ", *[F.col(key).cast("string") for key in keys])
    twice = F.raise_error(F.concat(F.lit("two rows for the lookup key "), named))
    kind = known.schema["_values"].dataType
    one = F.when(F.count(F.lit(1)) > 1, twice.cast(kind)).otherwise(F.max("_values"))
    return known.groupBy(*keys).agg(one.alias("_values")).select(*keys, "_values.*")


def left_lookup(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], keep: Sequence[str] | None = None
) -> DataFrame:
    """Left join on equal keys. Unmatched rows and rows with a null key stay with
    null; several dimension rows for one key multiply the row, unless ``dim`` is ``checked``."""
    if keep is not None:
        dim = dim.select(*keys, *keep)
    return df.join(dim, on=list(keys), how="left")


def tag_members(
    df: DataFrame,
    members: DataFrame,
    key: str,
    tag: str = "origin",
    inside: str = "old",
    outside: str = "new",
) -> DataFrame:
    """Mark rows by membership of a table's column, in one pass over ``df``."""
    hit = "_listed_"
    listed = members.select(key).distinct().withColumn(hit, F.lit(True))
    tagged = df.join(listed, key, "left")
    label = F.when(F.col(hit), F.lit(inside)).otherwise(F.lit(outside))
    return tagged.withColumn(tag, label).drop(hit)


def map_values(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    """Replace listed values; others pass through."""
    return df.replace(mapping, subset=[column])
