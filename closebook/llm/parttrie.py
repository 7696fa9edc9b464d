"""Codes for parts of vectors, learned and assigned over a trie of the different parts.

Vectors are cut into equal parts; every part position has a codebook. The
different parts of a position, in lexicographic order, are a trie whose nodes
are common prefixes. A depth-first traversal carries, for every node, the
squared distances of its prefix to all entries of the codebook, so a prefix is
measured once for all parts that share it; leaves take the nearest entry and
add their weighted components to its sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, without
from closebook.llm.wholevectors import exact, finite, floored, largest, long_sum, matrix, saturated

#: Different parts whose trie one task holds at once; distances a level of it holds.
ROWS, HELD = 1 << 16, 1 << 19

_PARTIAL = "position int, entry int, place int, n long, total decimal(38,0)"

#: One array of entries by components for each part position.
Codebooks = list[np.ndarray]


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part, of entries as near the first, and its squared distance.

    ``parts`` are best different and in lexicographic order: neighbours share the
    distances of their common prefix. Another order gives the same answers.
    """
    n, depth = parts.shape
    chosen = np.zeros(n, dtype=np.int64)
    parts, entries = exact(max(1, depth), largest(parts) + largest(entries), parts, entries)
    far = np.zeros(n, dtype=parts.dtype)
    # Where a prefix differs from that of the row before, a node of its length begins.
    begins = np.ones((n, depth), dtype=bool)
    begins[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)
    begins[:, -1:] = True
    block = max(1, HELD // (len(entries) * max(1, depth)))

    def visit(level: int, nodes: np.ndarray, stop: int, sums: np.ndarray) -> None:
        """``nodes``, first rows of neighbouring nodes, with the distances of their prefixes."""
        if level == depth:
            chosen[nodes] = sums.argmin(axis=1)
            far[nodes] = sums[np.arange(len(nodes)), chosen[nodes]]
            return
        below = nodes[0] + np.flatnonzero(begins[nodes[0] : stop, level])
        above = np.searchsorted(nodes, below, side="right") - 1
        for at in range(0, len(below), block):
            part = below[at : at + block]
            end = below[at + block] if at + block < len(below) else stop
            apart = parts[part, level][:, None] - entries[:, level][None]
            visit(level + 1, part, end, sums[above[at : at + block]] + apart * apart)

    if n:
        visit(0, np.zeros(1, dtype=np.int64), n, np.zeros((1, len(entries)), dtype=parts.dtype))
    return chosen, far


def _usable(vectors: DataFrame, vector: str, scale: float, parts: int, name: str) -> DataFrame:
    """Rows whose vector takes part, with its whole numbers in a column ``name``."""
    fine = vectors.where(finite(F.col(vector)) & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    sizes = fine.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    fine = fine.where(F.size(vector) == (sizes["n"] if sizes else 0))
    return fine.withColumn(name, floored(F.col(vector), scale))


def first_codebooks(rows: DataFrame, key: str, whole: str, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of the ``entries`` smallest keys, in order of the keys.

    Of a key stored with several vectors the smallest counts; null keys are none.
    """
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    least = [r["key"] for r in keys.distinct().orderBy("key").limit(entries).collect()]
    if not least:
        return []
    seeds = rows.where(F.col(key).isin(least)).groupBy(F.col(key).alias("key")).agg(F.min(whole).alias("v"))
    seeds = np.array([r["v"] for r in seeds.orderBy("key").collect()], dtype=np.int64)
    return np.split(seeds, parts, axis=1)


def different_parts(rows: DataFrame, whole: str, parts: int) -> DataFrame:
    """position, part and n: the different parts of each position, in order, and their rows."""
    size = (F.size(whole) / parts).cast("int")
    at = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    cut = rows.select(whole, size.alias("size"), at.alias("position"))
    cut = cut.select("position", F.slice(whole, F.col("position") * F.col("size") + 1, F.col("size")).alias("part"))
    counted = cut.groupBy("position", "part").agg(F.count("*").alias("n"))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def _moved(counted: DataFrame, now: Codebooks) -> Codebooks:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    shared = counted.sparkSession.sparkContext.broadcast(now)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition sends on one sum for each position, entry and component.
        books = shared.value
        totals = [np.zeros(book.shape, dtype=object) for book in books]
        used = [np.zeros(len(book), dtype=np.int64) for book in books]
        for table in _gathered(batches):
            where = table["position"].to_numpy()
            every, times = matrix(table["part"].combine_chunks()), table["n"].to_numpy()
            for position in np.unique(where):
                mine = where == position
                leaves, weights = every[mine], times[mine]
                chosen, _ = nearest_entries(leaves, books[position])
                fits = largest(leaves) * int(weights.sum()) < 2**62
                weighted = leaves * weights[:, None] if fits else leaves.astype(object) * weights[:, None]
                order = np.argsort(chosen, kind="stable")
                groups, first = np.unique(chosen[order], return_index=True)
                totals[position][groups] += np.add.reduceat(weighted[order], first, axis=0).astype(object)
                used[position][groups] += np.add.reduceat(weights[order], first)
        at = [(p, e, d) for p, book in enumerate(books) for e in np.flatnonzero(used[p]) for d in range(book.shape[1])]
        columns = [
            pa.array([p for p, _, _ in at], pa.int32()),
            pa.array([int(e) for _, e, _ in at], pa.int32()),
            pa.array([d for _, _, d in at], pa.int32()),
            pa.array([int(used[p][e]) for p, e, _ in at], pa.int64()),
            pa.array([int(totals[p][e, d]) for p, e, d in at], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["position", "entry", "place", "n", "total"])

    partial = counted.mapInArrow(sums, _PARTIAL).groupBy("position", "entry", "place")
    moved = [book.copy() for book in now]
    # As many rows as the codebooks have components.
    for r in partial.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        moved[r["position"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return moved


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches in tables of about ``ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS:
            yield pa.Table.from_batches(held)
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def codes_of(vectors: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Entries by row and part position, and the sums of their squared distances."""
    codes, error = np.zeros((len(vectors), len(books)), dtype=np.int64), np.zeros(len(vectors), dtype=object)
    for position, part in enumerate(np.split(vectors, len(books), axis=1)):
        leaves, row = np.unique(part, axis=0, return_inverse=True)
        chosen, far = nearest_entries(leaves, books[position])
        codes[:, position] = chosen[row.reshape(-1)]
        error += far[row.reshape(-1)].astype(object)
    return codes, error


def digest(books: Codebooks) -> str:
    """sha256 of all components by part, entry and place, as decimal numbers with commas."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def encode(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, Codebooks]:
    """Rows of ``vectors`` with ``code`` and ``error``, and the codebooks they refer to.

    Rows whose vector is null or holds a null or non-finite component are left out,
    as are those whose length cannot be cut into ``parts`` equal parts or is not the
    most frequent of such lengths (of two as frequent, the greater). Component x
    counts as floor(``scale`` * x). Codebooks start with the parts of the ``entries``
    smallest keys and move ``rounds`` times to the floors of the means of their
    parts; unused entries stay. ``code`` holds the entries in part order, in as many
    hexadecimal digits as the last one needs, two at least; ``error`` the squared
    distances summed over parts, beyond a long its end. Rows without key are coded
    but start no entry; without any key there are no codebooks and no rows. Repeated
    rows count as often as they occur. Input columns of the two names are replaced.

    The codebooks, and as many sums a round as they have components, pass the driver.
    """
    vectors = without(vectors, "code", "error")
    w = free_prefix(vectors)
    rows = _usable(vectors, vector, scale, parts, w + "v")
    books = first_codebooks(rows, key, w + "v", parts, entries)
    if not books:
        none = vectors.where("false")
        return none.withColumns({"code": F.lit(""), "error": F.lit(0).cast("long")}), []
    counted = hand_over(different_parts(rows, w + "v", parts), "parts")
    for _ in range(rounds):
        books = _moved(counted, books)
    final, digits = books, max(2, len(f"{entries - 1:x}"))

    @F.arrow_udf("struct<code: string, error: long>")
    def coded(column: pa.Array) -> pa.Array:
        codes, error = codes_of(matrix(column), final)
        text = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
        return pa.StructArray.from_arrays([pa.array(text, pa.string()), pa.array(saturated(error))], names=["code", "error"])

    found = rows.withColumn(w + "found", coded(F.col(w + "v")))
    return found.select(*vectors.columns, F.col(w + "found.code").alias("code"), F.col(w + "found.error").alias("error")), final


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, its errors summed over rows of equal label; nulls are one label."""
    coded = hand_over(without(coded, "label_error"), "codes")
    w = free_prefix(coded)
    totals = coded.groupBy(F.col(label).alias(w + "label")).agg(long_sum("error").alias("label_error"))
    return coded.join(totals, F.col(label).eqNullSafe(F.col(w + "label"))).drop(w + "label")
