"""Near duplicates by SimHash fingerprints and meet-in-the-middle ball hashing.

Each different fingerprint emits every variant within half the radius. Two
fingerprints within the radius share a variant, so one shuffle on variants
brings all linked fingerprints together. A variant is shared by no more
fingerprints than a ball holds, whatever the number of copies, because copies
are one fingerprint.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, small_batches, without
from closebook.llm.components import components

BITS = 64
#: Seed of the shingle hash.
SEED = 42
#: Bytes of a text whose shingles are hashed at once.
BLOCK = 1 << 19
#: The six ASCII white spaces.
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about ``BLOCK`` bytes of it at a time."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def _bit_counts(words: list[bytes], shingle: int) -> np.ndarray:
    """How many of the words' shingles have each bit set."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashed = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text, unsigned; zero for a text without words.

    A-Z are lower-cased and words split at the six ASCII white spaces, which is
    what lower() and split() of bytes do. A text of fewer words is one shingle.
    Long texts are read in blocks, so memory does not grow with them.
    """
    counts, shingles, held = np.zeros(BITS, dtype=np.int64), 0, []
    for words in _word_blocks(text or b""):
        words = held + words
        if len(words) >= shingle:
            counts += _bit_counts(words, shingle)
            shingles += len(words) - shingle + 1
            words = words[len(words) - shingle + 1 :]
        held = words
    if not shingles and held:
        counts, shingles = _bit_counts(held, len(held)), 1
    return int(np.packbits(counts * 2 > shingles, bitorder="little").view("<u8")[0])


def with_fingerprints(
    docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint"
) -> DataFrame:
    """``docs`` with the fingerprint as a signed long. Null and empty texts get zero."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        binary = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        found = np.fromiter(
            (fingerprint(t.as_py(), shingle) for t in texts.cast(binary)), np.uint64, len(texts)
        )
        return pa.array(found.view(np.int64))

    return without(docs, name).withColumn(name, prints(F.col(text)))


def _masks(most: int) -> list[int]:
    """Signed 64-bit masks of at most ``most`` set bits."""
    found = [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(prints: DataFrame, radius: int = 2, name: str = "fingerprint") -> DataFrame:
    """Pairs u, v of different fingerprints that join everything within ``radius`` bits.

    Variants reach ceil(radius / 2) bits; those within floor(radius / 2) are near.
    A near and any other owner of a variant are within the radius, so linking all
    owners to the smallest near one loses no connection and needs no pairs.
    """
    far, near = (radius + 1) // 2, radius // 2
    different = prints.select(F.col(name).alias("v")).where(F.col(name).isNotNull()).distinct()
    # A fingerprint becomes a whole ball: few bytes here are many rows in the next step, so
    # its tasks are not merged by size.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    different = different.repartition(tasks, "v")
    mask = F.explode(F.lit(_masks(far)).cast("array<bigint>"))
    balls = different.select("v", mask.alias("mask")).select(
        F.col("v").bitwiseXOR(F.col("mask")).alias("variant"),
        "v",
        *([(F.bit_count("mask") <= near).alias("near")] if far > near else []),
    )
    owner = F.when(F.col("near"), F.col("v")) if far > near else F.col("v")
    hub = F.min(owner).over(Window.partitionBy("variant"))
    met = balls.select("v", hub.alias("u")).where("u != v").distinct()
    return met.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def clusters(
    marked: DataFrame, radius: int = 2, key: str = "doc_id", name: str = "fingerprint"
) -> DataFrame:
    """Rows of ``marked`` with ``component_id``, the smallest key of the component.

    Fingerprints are linked if they differ in at most ``radius`` bits; equal ones
    are one node. Null keys never become a component's id unless all its keys are
    null (then it is null). Repeated rows stay, each with the same component.
    An input column component_id is replaced; no rows in, no rows out.
    """
    found, w = _rooted(marked, radius, key, name)
    return found.drop(w + "node", w + "root")


def _rooted(marked: DataFrame, radius: int, key: str, name: str) -> tuple[DataFrame, str]:
    """The clusters with their root, and the prefix of the working columns."""
    marked = hand_over(without(marked, "component_id"), "fingerprints")
    w = free_prefix(marked)
    nodes = marked.groupBy(F.col(name).alias("node")).agg(F.min(key).alias("least"))
    roots = components(links(marked, radius, name))
    rooted = nodes.join(roots, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    # A component's id by its root; copies and components meet as partial minima.
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(
        F.col("node").alias(w + "node"), F.col("root").alias(w + "root"), "component_id"
    )
    return marked.join(named, F.col(name) == F.col(w + "node")), w


def representatives(
    marked: DataFrame, radius: int = 2, key: str = "doc_id", name: str = "fingerprint"
) -> DataFrame:
    """One row per component, of the smallest key; without fingerprint and component.

    Of repeated rows with that key one stays. A component without any key keeps
    one row. Which of them does not depend on the order of the rows.
    """
    found, w = _rooted(marked, radius, key, name)
    found = found.where(F.col(key).eqNullSafe(F.col("component_id")))
    # Only repeated rows or rows without key still share a component here; the rank
    # is limited before its shuffle.
    rest = [F.col(f"`{c}`") for c, kind in marked.dtypes if "map<" not in kind]
    first = Window.partitionBy(w + "root").orderBy(
        name, *[x for c in rest for x in (F.xxhash64(c), F.isnull(c))]
    )
    kept = found.withColumn(w + "rank", F.row_number().over(first)).where(F.col(w + "rank") == 1)
    return kept.drop(w + "rank", w + "node", w + "root", "component_id", name)
