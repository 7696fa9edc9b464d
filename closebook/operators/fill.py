"""Forward fill over an explicit order, spread over the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.session import cut_lineage

#: Rows of a slice, on average: what one window of an unpartitioned fill holds.
SLICE_ROWS = 100_000


#: One column, or several of which each decides between rows equal in those before it.
Order = str | Sequence[str]


def _listed(order: Order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def with_slices(df: DataFrame, order: Order, slices: int | None = None) -> DataFrame:
    """Rows with ``_slice``, their range of the order; written once to the shared folder.

    Rows equal in the whole order are in one range. The number of slices follows from the
    row count, whatever it is. ``df`` is worked out once: the count and Spark's cutting of
    the ranges read what is written, and the ranges are written because a second run could
    cut them elsewhere.
    """
    if slices is None:
        df = cut_lineage(df, "rows")
        slices = df.count() // SLICE_ROWS + 1
    ranged = df.repartitionByRange(slices, *_listed(order)).withColumn("_slice", F.spark_partition_id())
    return cut_lineage(ranged, "slices")


def fill_slices(
    sliced: DataFrame, order: Order, columns: Sequence[str], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Forward fill of rows that hold their ``_slice``; several fills may follow each other."""
    keys = _listed(order)
    place = F.struct(*keys)
    # A struct equals another one with nulls in the same places, so null
    # partition values need no special join.
    group = F.struct(*[F.col(p) for p in partition_by]) if partition_by else F.struct(F.lit(0))
    grouped = sliced.withColumn("_group", group)
    ends = grouped.groupBy("_group", "_slice").agg(
        *[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(f"_end_{c}")
            for c in columns
        ]
    )
    before = (
        Window.partitionBy("_group")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = ends.select(
        "_group",
        "_slice",
        *[F.last(f"_end_{c}", ignorenulls=True).over(before).alias(f"_from_{c}") for c in columns],
    )
    within = (
        Window.partitionBy("_group", "_slice")
        .orderBy(*keys)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = grouped.withColumns(
        {c: F.last(c, ignorenulls=True).over(within) for c in columns}
    ).join(carried, ["_group", "_slice"], "left")
    return filled.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_from_{c}")) for c in columns}
    ).select(*sliced.columns)


def forward_fill(
    df: DataFrame,
    order: Order,
    columns: Sequence[str],
    partition_by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Blank cells take the last value above them, within each partition if given.

    ``order`` is one column or several; its values are unique as a whole (nulls first),
    so that slices, windows and carried values agree on the row above. Where a date is not
    unique, name a key after it. Ranges of the order cut the rows into slices, each slice is
    filled by its own window, and the last value of the slices before it (one row
    per slice) carries over. So neither an unpartitioned fill nor one huge
    partition runs in a single task.
    """
    return fill_slices(with_slices(df, order, slices), order, columns, partition_by).select(*df.columns)
