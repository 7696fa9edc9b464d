"""Shards that all hold the same mixture of sources.

Rows are shuffled within their source by a seeded hash, given a fractional
rank there, put into one order by that fraction and cut into shards of equal
row count. All ranks are exact and come from counts by hash bucket and a rank
inside the bucket, so no task sees a whole source or the whole order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, text_key, unit, without

#: Rows that one bucket of a rank holds on average.
BUCKET_ROWS = 256


def _ahead(counts: DataFrame, within: list[str], order: str, n: str, before: str) -> DataFrame:
    """Adds the sum of ``n`` over the buckets before this one."""
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(before, F.coalesce(F.sum(n).over(window), F.lit(0)))


def _spread_copies(
    rows: DataFrame, own: list[str], s: str, h: str, n: str, most: int
) -> DataFrame:
    """``rows`` with new hashes where more than ``most`` of a source share one.

    Such rows are reduced to different ones with a count, a partial sum in every task, and
    the copies come back by exploding it: a hash of all columns and the copy number tells
    them apart.
    """
    crowded = rows.groupBy(s, h).agg(F.count("*").alias(n)).where(F.col(n) > most).select(s, h)
    crowded = hand_over(crowded, "crowded")
    if crowded.isEmpty():
        return rows
    alone = rows.join(crowded, [s, h], "left_anti").select(*rows.columns)
    met = rows.join(crowded, [s, h], "left_semi").groupBy(*rows.columns).agg(F.count("*").alias(n))
    met = met.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))))
    hashed = [F.col(f"`{c}`") for c, kind in met.select(*own).dtypes if "map<" not in kind]
    again = F.xxhash64(h, n, *[x for c in hashed for x in (c, F.isnull(c))])
    return alone.unionByName(met.withColumn(h, again).select(*rows.columns))


def interleave(
    docs: DataFrame,
    shards: int = 24,
    seed: int = 7,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """All rows of ``docs`` with ``shard``, ``slot`` and ``fraction``.

    ``shard`` runs from 0 to ``shards`` - 1 and shard sizes differ by one row at
    most. ``slot`` counts from 0 without gaps in each shard. Each source's share
    of a shard is its share of the corpus, to within a row or two.

    Rows without a source form a source of their own; null keys and null or
    empty texts are hashed like any value. Equal texts are dealt like any others, by the
    hash of key and text. Rows with equal key and text are interchangeable: each gets
    its own slot. Where more of them meet than a bucket holds, equal rows are counted and
    dealt out again by copy number, so no task ranks them all. No rows in, no rows out.
    Input columns named shard, slot or fraction are replaced.
    """
    docs = without(docs, "shard", "slot", "fraction")
    w = free_prefix(docs)
    s, h, b, k, n, c, size, place = (w + x for x in ("s", "h", "b", "k", "n", "c", "size", "place"))
    total = docs.count()
    buckets = total // bucket_rows + 1
    rows = docs.withColumns(
        {
            s: text_key(F.col(source)),
            h: F.xxhash64(F.lit(seed), F.col(key).cast("string"), F.col(text)),
            size: F.length(text),
        }
    )
    rows = _spread_copies(rows, docs.columns, s, h, n, bucket_rows)
    rows = rows.withColumn(b, F.floor(unit(F.col(h)) * buckets))

    # Rank in the source: rows in earlier hash buckets, then the order inside the bucket.
    counts = rows.groupBy(s, b).agg(F.count("*").alias(n))
    counts = _ahead(counts, [s], b, n, k + "0")
    counts = counts.withColumn(n, F.sum(n).over(Window.partitionBy(s)))
    inside = Window.partitionBy(s, b).orderBy(unit(F.col(h)), h, key, size)
    ranked = rows.withColumn(k, F.row_number().over(inside) - 1).join(counts, [s, b])
    ranked = ranked.withColumn(k, F.col(k) + F.col(k + "0"))
    # Each source starts at a hashed offset: sources of one row do not all meet in the middle.
    start = unit(F.xxhash64(F.lit(seed + 1), F.col(s)))
    ranked = ranked.withColumn("fraction", (F.col(k) + start) / F.col(n))
    ranked = ranked.withColumn(c, F.floor(F.col("fraction") * buckets))

    # Place in the whole order, in two levels: rows of earlier thousands of buckets, of earlier
    # buckets of the same thousand, of the same bucket.
    ahead = ranked.groupBy(c).agg(F.count("*").alias(n)).withColumn(b, F.floor(F.col(c) / 1000))
    levels = _ahead(ahead.groupBy(b).agg(F.sum(n).alias(n)), [], b, n, place + "0").drop(n)
    ahead = _ahead(ahead, [b], c, n, place + "1").join(levels, b).drop(b, n)
    within = Window.partitionBy(c).orderBy("fraction", s, k)
    ordered = ranked.withColumn(place, F.row_number().over(within) - 1).join(ahead, c)
    ordered = ordered.withColumn(place, F.expr(f"{place} + {place}0 + {place}1"))
    # Shard i begins at place ceil(i * total / shards).
    ordered = ordered.withColumn(c, F.expr(f"({place} * {shards}L) div {max(total, 1)}L"))
    first = F.expr(f"({c} * {total}L + {shards - 1}L) div {shards}L")
    return ordered.select(
        *[F.col(name) for name in docs.columns],
        F.col(c).cast("int").alias("shard"),
        (F.col(place) - first).cast("long").alias("slot"),
        F.col("fraction"),
    )
