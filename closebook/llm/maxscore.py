"""Exact search for the largest inner products by MaxScore.

A dimension and a sign make a term; the posting of a term in a shard lists the
rows whose component has that sign, with its size. A query gains from the
terms of its own signs and loses from the others. Terms whose greatest gains
sum to less than the score to beat are non-essential: a row in none of the
other postings cannot get there. Essential postings are traversed, the rest is
probed for the rows found as long as they can still reach that score. The
best of every shard are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import hand_over, unit
from closebook.llm.wholevectors import LEAST, exact, finite, floored, largest, ragged, saturated

#: Rows of a shard and queries of a block on average; rows on average of the sample that
#: gives each query its first score to beat; dimensions probed between two prunings; the
#: part of a shard's rows (one by this number) from which a posting is read as a whole column.
SHARD_ROWS, BLOCK_QUERIES, SAMPLE_ROWS, PROBES, DENSE = 8192, 2048, 4096, 4, 8

_FOUND = "query_id long, vec_id long, score long"


class Shard:
    """Inverted index of some rows: a posting and a greatest size for each signed dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.columns = ids, np.ascontiguousarray(rows.T)
        # A posting of many rows is its column; of the others the rows and sizes are kept.
        self.postings: list[list[tuple[np.ndarray, np.ndarray] | None]] = []
        self.most = np.zeros((len(self.columns), 2), dtype=rows.dtype)
        for term, column in enumerate(self.columns):
            both = [np.flatnonzero(column > 0), np.flatnonzero(column < 0)]
            sized = [(where, np.abs(column[where])) for where in both]
            self.most[term] = [sizes.max() if len(sizes) else 0 for _, sizes in sized]
            self.postings.append([p if DENSE * len(p[0]) < len(ids) else None for p in sized])

    def search(self, query_id: int, query: np.ndarray, k: int, beat: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best ids but the query's own, none below ``beat``.

        Best first, ties to the smaller id; an id stored more than once counts by its
        best row. Rows that are worse than ``k`` others of the shard may be left out.
        """
        size, sign = np.abs(query), (query < 0).astype(np.int64)
        gains = size * self.most[np.arange(len(query)), sign]
        order = np.argsort(-gains, kind="stable")
        # What all terms from a place in the order on can add.
        rest = np.append(np.cumsum(gains[order][::-1])[::-1], 0)
        scores = np.zeros(len(self.ids), dtype=self.columns.dtype)
        if beat is None or beat <= 0:
            # Rows in no posting at all could get there.
            essential, left = order[:0], order
            found = np.arange(len(self.ids))
        else:
            split = int(np.argmax(rest < beat))
            essential, left = order[:split], order[split:]
            for term in essential:
                posting = self.postings[term][sign[term]]
                if posting is None:
                    # The column holds the other sign's posting too: nothing is left to take away.
                    scores += self.columns[term] * query[term]
                else:
                    scores[posting[0]] += size[term] * posting[1]
            found = np.flatnonzero(scores + rest[split] >= beat)
        scores, rest = scores[found], rest[len(essential) :]
        # Of the others, what was traversed only adds; what they take away comes first.
        losing = np.array([t for t in essential if self.postings[t][sign[t]] is not None], dtype=np.int64)
        losing = losing[np.argsort(-size[losing], kind="stable")]
        for at in range(0, len(losing), PROBES):
            terms = losing[at : at + PROBES]
            met = self.columns[terms[:, None], found[None]] * query[terms][:, None]
            scores = scores + np.minimum(met, 0).sum(axis=0)
            found, scores = _able(found, scores, rest[0], beat)
        for at in range(0, len(left), PROBES):
            terms = left[at : at + PROBES]
            met = self.columns[terms[:, None], found[None]] * query[terms][:, None]
            scores = scores + met.sum(axis=0)
            found, scores = _able(found, scores, rest[min(at + PROBES, len(left))], beat)
        own = self.ids[found] != query_id
        return best_of(self.ids[found][own], saturated(scores[own]), k)


def _able(found: np.ndarray, scores: np.ndarray, more: int, beat: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can still reach the score to beat with ``more`` to come."""
    if beat is None:
        return found, scores
    able = scores + more >= beat
    return found[able], scores[able]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best ids, each by its best row, best first, ties to the smaller id."""
    if len(ids) > 4 * k:
        # All rows of the 2k best scores; enough unless few ids hold them.
        high = np.flatnonzero(scores >= np.partition(scores, len(ids) - 2 * k)[len(ids) - 2 * k])
        if len(np.unique(ids[high])) >= k:
            ids, scores = ids[high], scores[high]
    # The complement falls as the score rises, at the ends of the range too.
    order = np.lexsort((ids, ~scores))
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return ids[order][first], scores[order][first]


def _rows(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """id and v of the rows that take part, equal ones once."""
    rows = vectors.where(finite(F.col(vector)) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("id"), floored(F.col(vector), scale).alias("v"))
    return rows.dropDuplicates(["id", "v"])


def _wide(rows: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, dims - rows.shape[1])))


def search_shard(ids: np.ndarray, rows: np.ndarray, asked: np.ndarray, queries: np.ndarray, beat: list, k: int):
    """query_id, vec_id and score of the best rows of a shard for each query, by MaxScore."""
    dims = max(rows.shape[1], queries.shape[1])
    most = largest(rows, queries)
    rows, queries = exact(dims, most, _wide(rows, dims), _wide(queries, dims))
    if dims * most * most < 2**53:
        # Doubles add up exactly too, and faster.
        rows, queries = rows.astype(np.float64), queries.astype(np.float64)
    shard = Shard(ids, rows)
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for query_id, query, least in zip(asked.tolist(), queries, beat, strict=True):
        # The lower end of the range may stand for any score below it.
        found, scores = shard.search(query_id, query, k, None if least == LEAST else least)
        out.append((np.full(len(found), query_id), found, scores))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def _primed(queries: DataFrame, sample: list, k: int) -> DataFrame:
    """``queries`` with ``beat``, the score of their ``k``-th best id of the sample; null if it has fewer."""
    shared = queries.sparkSession.sparkContext.broadcast(sample)

    @F.arrow_udf("long")
    def beaten(ids: pa.Array, vectors: pa.Array) -> pa.Array:
        held = shared.value
        asked, found = ragged(vectors), []
        names = np.array([r[0] for r in held], dtype=np.int64)
        rows = ragged(pa.array([r[1] for r in held], pa.list_(pa.int64())))
        dims = max(rows.shape[1], asked.shape[1])
        rows, asked = exact(dims, largest(rows, asked), _wide(rows, dims), _wide(asked, dims))
        for query_id, query in zip(ids.to_pylist(), asked, strict=True):
            other = names != query_id
            _, scores = best_of(names[other], saturated((rows @ query)[other]), k)
            found.append(int(scores[-1]) if len(scores) == k else None)
        return pa.array(found, pa.int64())

    return queries.withColumn("beat", beaten("id", "v"))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    scale: float = 64.0,
    seed: int = 11,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` largest inner products of each query.

    ``queries`` has the columns of ``vectors``; a row is no answer to a query of its
    own id. Component x counts as floor(``scale`` * x); scores are exact and beyond a
    long its end; ties go to the smaller id. Rows without key, and vectors that are
    null or hold a null or non-finite component, take no part; zero vectors do, and
    of vectors of different lengths the shorter is filled up with zeros. Repeated
    rows are one; an id stored with several vectors scores by the best of them, on
    either side. A query with fewer than ``k`` other ids gets all. No queries or no
    vectors, no rows.

    Rows are dealt to shards and queries to blocks, and every block meets every
    shard, so work grows with rows times queries: each task holds one of either.
    """
    rows = hand_over(_rows(vectors, key, vector, scale), "vectors")
    asking = hand_over(_rows(queries, key, vector, scale), "queries")
    n, asked = rows.count(), asking.count()
    shards, blocks = n // shard_rows + 1, asked // block_queries + 1
    mixed = F.xxhash64(F.lit(seed), "id", "v")
    sample = rows.where(unit(F.xxhash64(F.lit(seed + 1), "id", "v")) < SAMPLE_ROWS / max(n, 1))
    asking = _primed(asking, [(r["id"], list(r["v"])) for r in sample.collect()], k)
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    stored = rows.select(F.pmod(mixed, F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), "id", "v")
    probing = asking.select(
        F.pmod(mixed, F.lit(blocks)).cast("int").alias("block"), "id", "v", "beat"
    ).select(every(shards).alias("shard"), "block", "id", "v", "beat")
    # Few bytes here are much work in the next step, so its tasks are not merged by size.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards * blocks)
    keys = ["shard", "block"]

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [np.zeros(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            columns = search_shard(
                left["id"].to_numpy(),
                ragged(left["v"].combine_chunks()),
                right["id"].to_numpy(),
                ragged(right["v"].combine_chunks()),
                right["beat"].to_pylist(),
                k,
            )
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    stored, probing = stored.repartition(tasks, *keys), probing.repartition(tasks, *keys)
    found = stored.groupBy(*keys).cogroup(probing.groupBy(*keys)).applyInArrow(met, _FOUND)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
