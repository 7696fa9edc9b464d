"""Different ids, so that what depends on the id alone is worked out once for each."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "_rows"


def once(df: DataFrame, keys: Sequence[str], measures: Iterable[str] = ()) -> DataFrame:
    """One row for each different value of ``keys``, nulls among them, with its row count in
    ``_rows`` and the sums of ``measures`` (null if all values are).

    A partial aggregate before the shuffle: an id that holds a third of all rows is
    one row per task. The keys of the result depend on the count, so that the
    optimizer does not move what is derived from them, or a condition on it, back
    below the sum to every row.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS), *sums)
    return counted.withColumns({key: F.when(F.col(ROWS) > 0, F.col(f"`{key}`")) for key in keys})


def id_dictionary(
    df: DataFrame, source: str, parse: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Every different id of ``source`` that is not null, with the columns ``parse`` adds."""
    listed = once(df.select(source), [source])
    return parse(listed.filter(F.col(source).isNotNull()).drop(ROWS))


def with_parsed(
    summed: DataFrame, source: str, parse: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``summed`` rows with the columns that ``parse`` adds to an id.

    The ids are reduced to different ones, parsed, and joined back; rows without id
    get what ``parse`` makes of a null. Worth it where an id has many summed rows.
    """
    listed = parse(once(summed.select(source), [source]).drop(ROWS))
    added = [name for name in listed.columns if name != source]
    named = listed.withColumnRenamed(source, "_id").withColumnsRenamed({c: f"_p_{c}" for c in added})
    joined = summed.join(named, F.col(source).eqNullSafe(F.col("_id")), "left")
    kept = [F.col(f"`{c}`") for c in summed.columns if c not in added]
    return joined.select(*kept, *[F.col(f"_p_{c}").alias(c) for c in added])
