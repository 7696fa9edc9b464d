"""Mixing sources to target weights.

Words are summed per source, a target per source gives its repetition rate,
and each document is emitted floor(rate) times plus once more with a
probability equal to the fraction, decided by a seeded hash of the document.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, text_key, without

#: A word: code points other than the six ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame, size: str, source: str = "source") -> DataFrame:
    """One row per source with its documents' summed ``size`` as ``source_size``."""
    return docs.groupBy(F.col(source)).agg(F.sum(size).alias("source_size"))


def cycled_weights(sizes: DataFrame, weights: tuple[float, ...], source: str = "source") -> DataFrame:
    """Adds ``weight``: the sources by code point, null last, take ``weights`` in turn.

    The order is made by range partitions written once, so no task holds all
    sources, however many there are.
    """
    w = free_prefix(sizes)
    part, n, before = w + "part", w + "n", w + "before"
    parts = hand_over(
        sizes.repartitionByRange(F.col(source).asc_nulls_last()).withColumn(part, F.spark_partition_id()),
        "mix-sources",
    )
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = parts.groupBy(part).agg(F.count("*").alias(n))
    counts = counts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    own = Window.partitionBy(part).orderBy(F.col(source).asc_nulls_last())
    ranked = parts.withColumn(n, F.row_number().over(own) - 1).join(counts, part)
    place = (F.col(n) + F.col(before)) % len(weights)
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    return ranked.withColumn("weight", F.element_at(cycle, (place + 1).cast("int"))).drop(part, n, before)


def source_targets(sizes: DataFrame, share: float, most: float) -> DataFrame:
    """Adds ``target``: the words each source is to give.

    All targets sum to ``share`` times all sizes, split by ``weight``. No target
    exceeds ``most`` times its source's size: the excess is dealt again by
    weight among the others until none is above. Only two sums a round reach
    the driver; a round fixes at least one more source, so it ends. If ``share``
    is not below ``most``, every source gets its limit. Sources of size 0 have
    target 0.
    """
    sizes = hand_over(sizes, "mix-weights")
    limit = F.col("source_size") * F.lit(most)
    wanted = (sizes.agg(F.sum("source_size")).first()[0] or 0) * share
    level, fixed = 0.0, -1
    while True:
        held = limit <= F.col("weight") * F.lit(level)
        row = sizes.agg(
            F.count_if(held).alias("n"),
            F.sum(F.when(held, limit)).alias("capped"),
            F.sum(F.when(~held, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"] or row["n"] == fixed:
            break
        fixed = row["n"]
        level = (wanted - (row["capped"] or 0.0)) / row["open"]
    target = F.when(held | F.lit(not row["open"]), limit).otherwise(F.col("weight") * F.lit(level))
    return sizes.withColumn("target", target.cast("double"))


def chance(seed: int, key: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on seed and key; on the text where the key is null."""
    named = F.coalesce(key.cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") * F.lit(2.0**-52)


def copies_of(
    docs: DataFrame,
    targets: DataFrame,
    seed: int = 17,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, how often the mix emits each.

    ``targets`` has one row per source: source, source_size, target. A document
    whose source has no row or no words gets 0 copies. Documents with the same
    key get the same decision. Input columns of the three names are replaced.
    """
    docs = without(docs, "source_size", "target", "copies")
    w = free_prefix(docs, targets)
    s, t = w + "s", w + "t"
    held = targets.select(text_key(F.col(source)).alias(t), "source_size", "target")
    # Spark compares the written size of the targets with its broadcast limit; beyond
    # that the join is by sort, and adaptive execution splits a hot source.
    found = docs.withColumn(s, text_key(F.col(source))).join(held, F.col(s) == F.col(t), "left")
    rate = F.try_divide(F.col("target"), F.col("source_size"))
    extra = chance(seed, F.col(key), F.col(text)) < rate - F.floor(rate)
    copies = F.coalesce(F.floor(rate) + extra.cast("long"), F.lit(0))
    return found.withColumn("copies", copies).drop(s, t)


def repeated(chosen: DataFrame) -> DataFrame:
    """Every row as often as ``copies`` says; the columns of the decision are dropped."""
    w = free_prefix(chosen)
    names = [c for c in chosen.columns if c not in ("copies", "source_size", "target")]
    some = chosen.where(F.col("copies") > 0)
    each = some.withColumn(w + "i", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*names)


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents of the mix, repeats as rows of their own; columns as in ``docs``.

    A null or empty text has no words but is emitted at its source's rate. No
    rows in, or no words at all, gives no rows.
    """
    w = free_prefix(docs)
    sized = docs.select(F.col(source), word_count(F.col(text)).alias(w + "size"))
    sizes = cycled_weights(source_sizes(sized, w + "size", source), weights, source)
    targets = source_targets(sizes, share, most)
    kept = {"source_size", "target", "copies"} & {c.lower() for c in docs.columns}
    if kept:
        moved = {c: w + c for c in docs.columns if c.lower() in kept}
        back = {v: k for k, v in moved.items()}
        return repeated(copies_of(docs.withColumnsRenamed(moved), targets, seed, source, key, text)).withColumnsRenamed(back)
    return repeated(copies_of(docs, targets, seed, source, key, text))
