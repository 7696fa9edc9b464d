"""Group sums with the ledger's null rules, alignment and roll-ups.

Every sum is a partial aggregate before its shuffle, so a key that holds a
third of all rows reaches the final aggregate as one row per input task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions import money
from closebook.functions.money import row_total, zero_if_null


def group_sum(
    df: DataFrame,
    keys: Sequence[str],
    measures: Iterable[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """Groups with a null key drop out; a group whose values are all null gives 0.

    Rows with a null in a ``required`` column do not count either. All this is
    decided inside the aggregate: a filter on the keys would be pushed below
    the joins, and every derived key (parsed ids, buckets) would be evaluated
    there a second time.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    counts = F.lit(True)
    for column in required:
        counts = counts & F.col(column).isNotNull()
    sums = [
        F.sum(F.when(counts, F.col(m)) if required else F.col(m)).alias(m)
        for m in measures
    ]
    grouped = df.groupBy(*keys).agg(*sums, F.bool_or(whole & counts).alias("_whole"))
    return grouped.filter("_whole").select(
        *[F.col(f"`{key}`") for key in keys],
        *[zero_if_null(F.col(f"`{m}`")).alias(m) for m in measures],
    )


def group_sum_sets(
    df: DataFrame, grains: Mapping[str, Sequence[str]], measures: Iterable[str], name: str = "grain"
) -> DataFrame:
    """``group_sum`` to several grains from one pass: ``name`` tells a row's grain.

    Keys that a grain lacks are null in its rows. The rows of ``df`` are read once and
    summed to all grains before the shuffle.
    """
    keys = list(dict.fromkeys(key for grain in grains.values() for key in grain))
    label, whole = F.lit(None).cast("string"), F.lit(True)
    for key in keys:
        whole = whole & ((F.grouping(key) == 1) | F.col(key).isNotNull())
    for grain, own in grains.items():
        here = F.lit(True)
        for key in keys:
            here = here & (F.grouping(key) == (0 if key in own else 1))
        label = F.when(here, F.lit(grain)).otherwise(label)
    sets = [[F.col(key) for key in own] for own in grains.values()]
    grouped = df.groupingSets(sets, *keys).agg(
        *[F.sum(F.col(m)).alias(m) for m in measures], label.alias(name), whole.alias("_whole")
    )
    return grouped.filter("_whole").select(
        name,
        *[F.col(f"`{key}`") for key in keys],
        *[zero_if_null(F.col(f"`{m}`")).alias(m) for m in measures],
    )


def dropped_by_null_key(
    df: DataFrame, keys: Sequence[str], measures: Iterable[str], rows: str | None = None
) -> DataFrame:
    """One row: how many rows and how much ``group_sum`` leaves out.

    ``rows`` names the row counts of a table that is summed already.
    """
    dropped = F.count(F.lit(1)) if rows is None else F.coalesce(F.sum(rows), F.lit(0))
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    return df.filter(any_null).agg(
        dropped.alias("rows_dropped"),
        *[zero_if_null(F.sum(F.col(m))).alias(m) for m in measures],
    )


def control_total(df: DataFrame, measures: Iterable[str]) -> DataFrame:
    """One row with the grand total of every measure, the same in whatever order the rows are added."""
    return df.agg(*[zero_if_null(money.exact_sum(F.col(m))).alias(m) for m in measures])


def distinct_pairs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct combinations without nulls."""
    return group_sum(df, keys, [])


def fill_missing(
    df: DataFrame, measures: Iterable[str] = (), keys: Iterable[str] = ()
) -> DataFrame:
    """Measures become 0 and key columns '0', so null-key rows survive grouping."""
    types = {field.name: field.dataType.typeName() for field in df.schema}
    filled = {m: zero_if_null(F.col(m)) for m in measures}
    for key in keys:
        blank = F.lit("0") if types[key] == "string" else F.lit(0).cast(types[key])
        filled[key] = F.coalesce(F.col(key), blank)
    return df.withColumns(filled)


def union_books(books: Sequence[DataFrame]) -> DataFrame:
    """All rows of all books; a column one book lacks is null there."""
    merged = books[0]
    for book in books[1:]:
        merged = merged.unionByName(book, allowMissingColumns=True)
    return merged


def align(
    components: Sequence[DataFrame],
    keys: Sequence[str],
    measures: Sequence[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """Several balances side by side on common keys: one shuffle, no outer joins.

    Each component carries its own measures; a measure that a component lacks
    counts as 0, which is what filling an outer join gives. The components
    need not be grouped yet, the sum here is the only one required.
    """
    shaped = [
        part.select(
            *keys,
            *required,
            *[
                F.col(m) if m in part.columns else F.lit(0.0).alias(m)
                for m in measures
            ],
        )
        for part in components
    ]
    return group_sum(union_books(shaped), keys, measures, required)


def combine_runs(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, tuple[str | Column, str | Column]],
    sign: int = 1,
) -> DataFrame:
    """``left + sign * right`` per key, keys of either side kept, in one shuffle.

    ``measures`` maps a result name to its column on the left and on the right.
    """

    def side(df: DataFrame, position: int, factor: int) -> DataFrame:
        columns = []
        for name, pair in measures.items():
            value = F.col(pair[position]) if isinstance(pair[position], str) else pair[position]
            columns.append((value if factor == 1 else -value).alias(name))
        return df.select(*keys, *columns)

    both = side(left, 0, 1).unionByName(side(right, 1, sign))
    return group_sum(both, keys, list(measures))


def with_total(df: DataFrame, parts: Sequence[str], name: str = "total_balance") -> DataFrame:
    return df.withColumn(name, row_total(*[F.col(p) for p in parts]))


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], amount: str
) -> DataFrame:
    """Two extracts side by side per key; a side without the key stays null.

    Both sides are summed in one aggregate over their union, so the pair costs
    one shuffle instead of two aggregates and a sort-merge full join.
    """
    sides = {"amount_x": left, "amount_y": right}
    tagged = union_books(
        [df.select(*keys, F.col(amount), F.lit(n).alias("_side")) for n, df in sides.items()]
    )
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    columns = [F.bool_or(whole).alias("_whole")]
    for name in sides:
        here = F.col("_side") == name
        total = zero_if_null(F.sum(F.when(here, F.col(amount))))
        columns.append(F.when(F.bool_or(here), total).alias(name))
    return tagged.groupBy(*keys).agg(*columns).filter("_whole").drop("_whole")
