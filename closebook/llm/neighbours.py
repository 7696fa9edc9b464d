"""Approximate nearest neighbours by cross-polytope hashing.

A vector's direction is turned by seeded pseudo-rotations (sign flips and fast
Hadamard transforms) and hashed to its nearest signed axis, in several
tables. A query probes the nearest axes of every table; what it meets there is
ranked by exact distance. How many axes are probed is measured on a sample of
queries against brute force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import hand_over

#: Tables; sample queries the number of probes is measured with and the recall it must
#: reach on them; rows of a bucket, and queries, that one task compares at once.
TABLES, SAMPLE_QUERIES, SAMPLE_RECALL, CHUNK = 8, 128, 0.96, 4096
ROUNDS = 3


def rotated(vectors: np.ndarray, seed: int, table: int) -> np.ndarray:
    """Rows turned by ``ROUNDS`` times signs and Hadamard, padded to a power of two."""
    n, dims = vectors.shape
    wide = 1 << max(0, dims - 1).bit_length()
    turned = np.zeros((n, wide))
    # Only directions count; rows of huge components would overflow.
    turned[:, :dims] = vectors / np.abs(vectors).max(axis=1, initial=1e-300, keepdims=True)
    signs = np.random.default_rng((seed, table)).choice((-1.0, 1.0), (ROUNDS, wide))
    for flips in signs:
        turned *= flips
        half = 1
        while half < wide:
            pairs = turned.reshape(n, -1, 2, half)
            turned = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2)
            turned = turned.reshape(n, wide)
            half *= 2
        turned /= np.sqrt(wide)
    return turned


def axes(vectors: np.ndarray, seed: int, table: int) -> np.ndarray:
    """The signed axis nearest to each row: twice the coordinate, plus one if negative."""
    turned = rotated(vectors, seed, table)
    place = np.abs(turned).argmax(axis=1)
    return 2 * place + (turned[np.arange(len(turned)), place] < 0)


def probed(vectors: np.ndarray, seed: int, table: int) -> np.ndarray:
    """All signed axes in the order in which each row probes them."""
    turned = rotated(vectors, seed, table)
    both = np.stack((turned, -turned), axis=2).reshape(len(turned), -1)
    return np.argsort(-both, axis=1, kind="stable")


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to a query; where squares overflow, of rows scaled down."""
    with np.errstate(over="ignore"):
        apart = vectors - query
        far = np.sqrt(np.square(apart).sum(axis=1))
    lost = np.flatnonzero(~np.isfinite(far))
    if len(lost):
        # Halves of finite components differ by finite numbers.
        apart = vectors[lost] / 2 - query / 2
        most = np.abs(apart).max(axis=1)
        with np.errstate(over="ignore"):
            far[lost] = np.sqrt(np.square(apart / most[:, None]).sum(axis=1)) * most * 2
    return far


def nearest(
    ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and Euclidean distances of the ``k`` nearest ids, each by its nearest row, ties to the smaller id."""
    far = distances(vectors, query)
    own, take = np.flatnonzero(ids != query_id), k
    while True:
        kept = own
        if len(own) > 4 * take:
            kept = own[far[own] <= np.partition(far[own], take - 1)[take - 1]]
        kept = _first(ids, far, kept, k)
        # Repeated rows of an id may have used up what was taken.
        if len(kept) == k or len(own) <= 4 * take:
            return kept, far[kept]
        take *= 4


def _first(ids: np.ndarray, far: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of ``places``, the nearest of each id, in order of distance and id, at most ``k``."""
    ordered = places[np.lexsort((ids[places], far[places]))]
    return ordered[np.sort(np.unique(ids[ordered], return_index=True)[1])][:k]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(whole), -1).astype(np.float64)


def usable(vectors: DataFrame, key: str, vector: str, dims: int | None = None) -> DataFrame:
    """Columns id and v of the rows that take part.

    Rows without id and vectors that are null, zero or hold a null or non-finite
    component take no part, nor do vectors of another length than ``dims``, or than
    the most frequent one (of two as frequent, the longer).
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    if dims is None:
        size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
        dims = size["n"] if size else 0
    return rows.where(F.size("v") == dims)


def _few_copies(rows: DataFrame, k: int) -> DataFrame:
    """At most the ``k`` + 1 smallest ids of equal vectors; no other can be among ``k`` nearest.

    Repeated rows of an id and vector are one before they are counted. The rank is limited before its shuffle, so copies of one vector never meet in a task.
    """
    copies = Window.partitionBy("v").orderBy("id")
    rows = rows.dropDuplicates(["id", "v"])
    return rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")


_FOUND = "query_id long, vec_id long, score double"


def brute_force(rows: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """Exact ``k`` nearest rows, with their vectors, of a bounded number of queries."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def compare(batches):
        # What a partition sends on is k ids for each query, however many rows it holds.
        held = {query_id: (np.zeros(0, np.int64), np.zeros(0), None) for query_id, _ in shared.value}
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for query_id, query in shared.value:
                at, far = nearest(ids, vectors, query_id, np.array(query), k)
                old_ids, old_far, old = held[query_id]
                own, far = np.append(old_ids, ids[at]), np.append(old_far, far)
                met = vectors[at] if old is None else np.concatenate((old, vectors[at]))
                best = _first(own, far, np.arange(len(own)), k)
                held[query_id] = own[best], far[best], met[best]
        for query_id, (own, far, met) in held.items():
            if len(own):
                columns = [np.full(len(own), query_id), own, far]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array(list(met), pa.list_(pa.float64()))],
                    names=["query_id", "vec_id", "score", "v"],
                )

    found = rows.select("id", "v").mapInArrow(compare, _FOUND + ", v array<double>")
    nearest_row = Window.partitionBy("query_id", "vec_id").orderBy("score", "v")
    found = found.withColumn("row", F.row_number().over(nearest_row)).where("row = 1").drop("row")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def probes_needed(rows: DataFrame, queries: DataFrame, k: int, tables: int, seed: int) -> int:
    """Axes to probe in each table so that sample queries find ``SAMPLE_RECALL`` of their neighbours."""
    # Of an id stored with several vectors one is enough to measure with.
    sample = queries.groupBy("id").agg(F.min("v").alias("v"))
    sample = sample.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(SAMPLE_QUERIES).collect()
    sample = [(r["id"], list(r["v"])) for r in sample]
    pairs = brute_force(rows, sample, k).select("query_id", "v").collect()
    if not pairs:
        return 1
    place = {query_id: i for i, (query_id, _) in enumerate(sample)}
    owner = np.array([place[p["query_id"]] for p in pairs])
    asked, met = np.array([q for _, q in sample]), np.array([p["v"] for p in pairs])
    needed = np.full(len(pairs), np.iinfo(np.int64).max)
    for table in range(tables):
        order = np.argsort(probed(asked, seed, table), axis=1)
        needed = np.minimum(needed, order[owner, axes(met, seed, table)] + 1)
    return int(np.sort(needed)[int(np.ceil(SAMPLE_RECALL * len(needed))) - 1])


def _met(base: DataFrame, queries: DataFrame, probes: int, k: int, tables: int, seed: int) -> DataFrame:
    """Best ``k`` ids of every bucket a query probes, by exact distance."""

    @F.arrow_udf("array<int>")
    def hashed(vectors: pa.Array) -> pa.Array:
        matrix = _matrix(vectors)
        codes = np.stack([axes(matrix, seed, t) for t in range(tables)], axis=1).astype(np.int32)
        return pa.array(list(codes), pa.list_(pa.int32()))

    @F.arrow_udf("array<array<int>>")
    def asked(vectors: pa.Array) -> pa.Array:
        matrix = _matrix(vectors)
        orders = [probed(matrix, seed, t)[:, :probes].tolist() for t in range(tables)]
        return pa.array([list(x) for x in zip(*orders, strict=True)], pa.list_(pa.list_(pa.int32())))

    stored = base.select("id", "v", F.posexplode(hashed("v")).alias("table", "axis"))
    probing = queries.select("id", "v", F.posexplode(asked("v")).alias("table", "axes"))
    probing = probing.select("id", "v", "table", F.explode("axes").alias("axis"))
    # Not more rows than tables times axes, whatever the data: safe to broadcast. A bucket
    # above CHUNK rows is dealt to several parts, as are the queries that probe it, and every
    # part of one meets every part of the other: a task holds at most about CHUNK of either.
    sizes = stored.groupBy("table", "axis").agg(_parts("parts"))
    sizes = F.broadcast(hand_over(sizes.join(probing.groupBy("table", "axis").agg(_parts("turns")), ["table", "axis"]), "buckets"))
    keys = ["table", "axis", "part", "turn"]
    stored = stored.join(sizes, ["table", "axis"]).select(
        "table", "axis", _dealt("parts").alias("part"), _every("turns").alias("turn"), "id", "v"
    )
    probing = probing.join(sizes, ["table", "axis"]).select(
        "table", "axis", _every("parts").alias("part"), _dealt("turns").alias("turn"), "id", "v"
    )

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            ids, vectors = left["id"].to_numpy(), _matrix(left["v"])
            for query_id, query in zip(right["id"].to_numpy(), _matrix(right["v"]), strict=True):
                at, far = nearest(ids, vectors, query_id, query, k)
                out.append((np.full(len(at), query_id), ids[at], far))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return stored.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInArrow(rank, _FOUND)


def _parts(name: str) -> Column:
    return F.ceil(F.count("*") / CHUNK).cast("int").alias(name)


def _dealt(parts: str) -> Column:
    return F.pmod(F.xxhash64("id", "v"), F.col(parts)).cast("int")


def _every(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def _best(found: DataFrame, k: int) -> DataFrame:
    """Ranks 1 to ``k`` of each query; a row met in several tables counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    tables: int = TABLES,
    seed: int = 3,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the nearest rows found for each query.

    ``queries`` has the columns of ``vectors``; a row is no neighbour of a query with
    its own id. Scores are Euclidean distances of the original vectors in double
    precision, ties go to the smaller id. A query that meets fewer than ``k`` rows
    probes every axis, which is exact, so it gets ``k`` rows or all there are. See
    ``usable`` for rows that take no part; the length of the rows is that of the
    queries. Repeated rows of one id are one neighbour, at the distance of the nearest
    of them, on either side: a query id stored with several vectors asks with all. No
    queries or no vectors, no rows.
    """
    rows = hand_over(_few_copies(usable(vectors, key, vector), k), "vectors")
    any_row = rows.first()
    asking = usable(queries, key, vector, len(any_row["v"]) if any_row else 0).dropDuplicates(["id", "v"])
    asking = hand_over(asking, "queries")
    probes = probes_needed(rows, asking, k, tables, seed)
    first = hand_over(_best(_met(rows, asking, probes, k, tables, seed), k), "nearest")
    short = first.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"))
    rest = hand_over(asking.join(short, "id", "left_anti"), "queries")
    if rest.isEmpty():
        found = first
    else:
        whole = 2 << max(0, len(rest.first()["v"]) - 1).bit_length()
        again = _best(_met(rows, rest, whole, k, 1, seed), k)
        found = first.join(short.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(again)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
