"""Centroid clustering with a table of distances to pivots.

The distances of every vector to a few fixed pivots are stored once. In each
round the centroids' distances to the same pivots bound their distances to a
vector from below; only centroids whose bound is within the best distance
found so far get an exact distance, in whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, unit, without
from closebook.llm.wholevectors import exact, finite, floored, largest, long_sum, matrix, saturated

#: Pivots, rows on average of the sample they are chosen from, vectors compared at once.
PIVOTS, SAMPLE_ROWS, BLOCK = 8, 256, 2048
#: Part of a distance by which a bound is lowered against rounding of the roots.
SLACK = 1e-9

_PARTIAL = "cluster int, place int, n long, total decimal(38,0)"


@dataclass(frozen=True)
class Centroids:
    """Centroids by number, and the pivots all distances of the table belong to."""

    rows: np.ndarray
    pivots: np.ndarray

    def sha256(self, number: int) -> str:
        return hashlib.sha256(",".join(map(str, self.rows[number].tolist())).encode()).hexdigest()


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to points, rounded."""
    rows, found = rows.astype(np.float64), np.zeros((len(rows), len(points)))
    for at, point in enumerate(points.astype(np.float64)):
        apart = rows - point
        found[:, at] = np.sqrt(np.einsum("nd,nd->n", apart, apart))
    return found


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest in sum from those before it."""
    sample = np.unique(sample, axis=0)
    if not len(sample):
        return sample
    far = distances(sample, sample[:1])[:, 0]
    chosen = [0]
    while len(chosen) < min(count, len(sample)):
        far[chosen] = -1.0
        chosen.append(int(far.argmax()))
        far += distances(sample, sample[chosen[-1:]])[:, 0]
    return sample[chosen]


def assign(
    rows: np.ndarray, far: np.ndarray, centroids: np.ndarray, reach: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its squared distance, and how many exact distances it took.

    ``far`` are the rows' distances to the pivots, ``reach`` the centroids'. Of
    centroids as near, the smaller number. By the triangle inequality no distance
    is below the greatest difference of the two to a pivot: each row takes its
    centroids in order of that bound and stops at the first beyond its best.
    """
    n, count = len(rows), len(centroids)
    most = 2 * largest(rows, centroids)
    rows, centroids = exact(rows.shape[1], most, rows, centroids)
    below = np.zeros((n, count)) if not far.shape[1] else np.abs(far[:, None] - reach[None]).max(axis=2)
    below -= SLACK * (far.max(axis=1, initial=0.0)[:, None] + reach.max(axis=1, initial=0.0)[None] + 1.0)
    bound = np.maximum(below, 0.0) ** 2
    order = np.argsort(bound, axis=1, kind="stable")
    number, best = np.full(n, count), np.zeros(n, dtype=rows.dtype)
    open_, measured = np.arange(n), 0
    for turn in range(count):
        tried = order[open_, turn]
        if turn:
            near = bound[open_, tried] <= best[open_].astype(np.float64)
            open_, tried = open_[near], tried[near]
            if not len(open_):
                break
        apart = rows[open_] - centroids[tried]
        found = (apart * apart).sum(axis=1)
        measured += len(open_)
        held = best[open_]
        better = (number[open_] == count) | (found < held) | ((found == held) & (tried < number[open_]))
        number[open_[better]], best[open_[better]] = tried[better], found[better]
    return number, best, measured


def _usable(vectors: DataFrame, key: str, vector: str, dims: int, scale: float, w: str) -> DataFrame:
    whole = F.col(vector)
    kept = vectors.where(finite(whole) & (F.size(whole) == dims))
    return kept.withColumns({w + "id": F.col(key).cast("string"), w + "v": floored(whole, scale)})


def _with_distances(rows: DataFrame, pivots: np.ndarray, w: str) -> DataFrame:
    """The table of pivots: every row with its distances to them."""

    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        return pa.array(list(distances(matrix(column), pivots)), pa.list_(pa.float64()))

    return rows.withColumn(w + "p", measured(F.col(w + "v")))


def _assigned(v: pa.Array, p: pa.Array, held: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, and their centroids and squared distances."""
    rows = matrix(v)
    far = p.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
    reach = distances(held.rows, held.pivots)
    found = [assign(rows[a : a + BLOCK], far[a : a + BLOCK], held.rows, reach) for a in range(0, len(rows), BLOCK)]
    number, best, _ = zip(*found, strict=True) if found else ([np.zeros(0, int)], [np.zeros(0, int)], [])
    return rows, np.concatenate(number), np.concatenate(best)


def _moved(held: DataFrame, now: Centroids, w: str) -> Centroids:
    """Centroids at the componentwise floor of the mean of their rows; empty ones stay."""
    shared = held.sparkSession.sparkContext.broadcast(now)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition sends on one sum for each centroid and component.
        count, dims = shared.value.rows.shape
        totals, sizes = np.zeros((count, dims), dtype=object), np.zeros(count, dtype=np.int64)
        for batch in batches:
            rows, number, _ = _assigned(batch.column(0), batch.column(1), shared.value)
            (rows,) = exact(1, largest(rows) * max(1, len(rows)), rows)
            for c in np.unique(number):
                mine = rows[number == c]
                totals[c] += mine.sum(axis=0).astype(object)
                sizes[c] += len(mine)
        at = [(c, d) for c in np.flatnonzero(sizes) for d in range(dims)]
        columns = [
            pa.array([int(c) for c, _ in at], pa.int32()),
            pa.array([d for _, d in at], pa.int32()),
            pa.array([int(sizes[c]) for c, _ in at], pa.int64()),
            pa.array([int(totals[c, d]) for c, d in at], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "place", "n", "total"])

    partial = held.select(w + "v", w + "p").mapInArrow(sums, _PARTIAL)
    summed = partial.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = now.rows.copy()
    # As many rows as centroids have components.
    for r in summed.collect():
        rows[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return Centroids(rows, now.pivots)


def cluster(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64.0,
    seed: str = "1",
    pivots: int = PIVOTS,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Rows of ``vectors`` with cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Vectors of exactly ``dims`` components, none null or non-finite, take part; the
    others are left out. Component x counts as floor(``scale`` * x). Centroids start
    as the ``k`` vectors of smallest sha256 of "``seed``:key", in that order; rows
    without key come last, equal hashes go by the vector, and fewer vectors make
    fewer centroids. ``rounds`` times every vector goes to its nearest centroid and
    centroids move to the floor of the mean; empty ones stay. ``distance`` is squared,
    the inertias are its sums over the cluster and over all; sums beyond a long are
    its end. Repeated rows count as often as they occur. No vectors, no rows. Input
    columns of the five names are replaced.

    The centroids, and ``k`` times ``dims`` sums a round, pass the driver.
    """
    vectors = without(vectors, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    w = free_prefix(vectors)
    usable = _usable(vectors, key, vector, dims, scale, w)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(w + "id")), 256)
    first = usable.select(order.alias("o"), F.col(w + "v").alias("v")).orderBy(F.asc_nulls_last("o"), "v")
    seeds = np.array([r["v"] for r in first.limit(k).collect()], dtype=np.int64).reshape(-1, dims)
    total = usable.count()
    chance = F.xxhash64(F.lit(seed), F.col(w + "v"))
    sample = usable.where(unit(chance) < SAMPLE_ROWS / max(total, 1)).select(w + "v").distinct()
    sample = np.array([r[0] for r in sample.collect()], dtype=np.int64).reshape(-1, dims)
    now = Centroids(seeds, choose_pivots(np.concatenate((seeds, sample)), pivots))
    held = hand_over(_with_distances(usable.drop(w + "id"), now.pivots, w), "pivot-distances")
    for _ in range(rounds if total else 0):
        now = _moved(held, now, w)
    final = now

    @F.arrow_udf("struct<cluster: int, distance: long>")
    def nearest(v: pa.Array, p: pa.Array) -> pa.Array:
        _, number, best = _assigned(v, p, final)
        columns = [pa.array(number.astype(np.int32)), pa.array(saturated(best))]
        return pa.StructArray.from_arrays(columns, names=["cluster", "distance"])

    found = held.withColumn(w + "found", nearest(F.col(w + "v"), F.col(w + "p")))
    found = found.select(*vectors.columns, F.col(w + "found.cluster").alias("cluster"), F.col(w + "found.distance").alias("distance"))
    found = hand_over(found, "clusters")
    inertia = found.groupBy("cluster").agg(long_sum("distance").alias("cluster_inertia"))
    # As many rows as there are centroids.
    of = {r["cluster"]: r["cluster_inertia"] for r in inertia.collect()}
    whole = saturated(np.array([sum(of.values())], dtype=object))[0]
    named = [(c, i, int(whole), final.sha256(c)) for c, i in sorted(of.items())]
    names = f"`{w}c` int, cluster_inertia long, inertia long, centroid_sha256 string"
    named = F.broadcast(vectors.sparkSession.createDataFrame(named, names))
    return found.join(named, F.col("cluster") == F.col(w + "c")).drop(w + "c")
