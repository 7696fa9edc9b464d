"""Part codes, centroid clustering and inner products against plain Python."""

from __future__ import annotations

import hashlib
import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from closebook.llm import laesa, maxscore, parttrie
from closebook.llm.queries import ORACLES, QUERIES
from closebook.llm.wholevectors import LEAST, MOST, exact, ragged
from tools.check_sql import difference

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, Code string"
NAN, INF = float("nan"), float("inf")
UNUSABLE = [(900, None), (901, [1.0, NAN]), (902, [1.0, None]), (903, [-INF, 1.0])]


@pytest.mark.parametrize("name", ["op11_part_codes", "op12_centroids", "op13_top_products"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()) is None


def _rows(seed: int, n: int, dims: int, wide: float = 1.0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = [(i, (wide * rng.standard_normal(dims)).tolist(), int(rng.integers(3)), "kept") for i in range(n)]
    # Copies of one vector, rows that occur twice, rows without key or label.
    rows += [(n + i, rows[3][1], None, "kept") for i in range(n // 2)] + rows[:5]
    return rows + [(None, rows[4][1], 1, "kept"), (None, [0.0] * dims, 1, "kept")]


def _whole(vector: list[float], scale: int) -> list[int]:
    return [math.floor(scale * x) for x in vector]


def _far(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _nearest(row: list[int], points: list[list[int]]) -> tuple[int, int]:
    """Squared distance and number of the nearest point."""
    return min((_far(row, p), i) for i, p in enumerate(points))


def _mean(rows: list[list[int]]) -> list[int]:
    return [sum(c) // len(rows) for c in zip(*rows, strict=True)]


# Part codes


@pytest.mark.parametrize("most", [3, 200, 2**40, 2**62])
def test_trie_finds_the_first_nearest_entry(monkeypatch, most):
    rng = np.random.default_rng(most % 97)
    parts = np.unique(rng.integers(-most, most, (300, 3)), axis=0)
    entries = rng.integers(-most, most, (9, 3))
    entries[4] = entries[2]
    want = [_nearest(p, entries.tolist()) for p in parts.tolist()]
    for held in (1, 100, 1 << 19):
        monkeypatch.setattr(parttrie, "HELD", held)
        for order in (np.arange(len(parts)), rng.permutation(len(parts))):
            chosen, far = parttrie.nearest_entries(parts[order], entries)
            assert [(int(f), int(c)) for f, c in zip(far, chosen, strict=True)] == [want[i] for i in order]


def test_a_prefix_is_measured_once(monkeypatch):
    # All parts share two components: the trie has one node at each of the first two levels.
    parts = np.array([[5, 6, i, j] for i in range(10) for j in range(3)])
    begun = []

    def counting(nodes, below, side):
        begun.append(len(below))
        return nodes.searchsorted(below, side=side)

    monkeypatch.setattr(parttrie.np, "searchsorted", counting)
    parttrie.nearest_entries(parts, np.array([[0, 0, 0, 0], [5, 6, 7, 1]]))
    assert begun == [1, 1, 10, 30]


def _coded(rows: list[tuple], parts: int, entries: int, rounds: int, scale: int):
    """Codes, errors and codebooks of (key, vector) rows."""
    whole = [(k, _whole(v, scale)) for k, v in rows]
    size = len(whole[0][1]) // parts
    cut = [(k, [v[p * size : (p + 1) * size] for p in range(parts)]) for k, v in whole]
    first: dict = {}
    for k, c in cut:
        if k is not None:
            first[k] = min(first.get(k, c), c)
    seeds = [first[k] for k in sorted(first)[:entries]]
    books = [[s[p] for s in seeds] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            held: dict[int, list] = {}
            for _, c in cut:
                held.setdefault(_nearest(c[p], book)[1], []).append(c[p])
            books[p] = [_mean(held[e]) if e in held else old for e, old in enumerate(book)]
    found = []
    for k, c in cut:
        near = [_nearest(c[p], books[p]) for p in range(parts)]
        found.append((k, "".join(f"{e:02x}" for _, e in near), sum(f for f, _ in near)))
    return found, books


@pytest.mark.parametrize("parts, entries, n", [(4, 8, 120), (2, 64, 20), (8, 3, 60)])
def test_codes_equal_brute_force(frame, parts, entries, n):
    rows = _rows(parts, n, 8)
    table = frame(rows + [(k, v, 0, "kept") for k, v in UNUSABLE] + [(-1, [1.0] * 3, 0, "kept")], SCHEMA)
    got, books = parttrie.encode(table.drop("Code").withColumn("note", F.lit("x")), parts, entries, 2, 256.0)
    want, want_books = _coded([r[:2] for r in rows], parts, entries, 2, 256)
    assert [b.tolist() for b in books] == want_books
    assert sorted(map(str, ((r["vec_id"], r["code"], r["error"]) for r in got.collect()))) == sorted(map(str, want))
    assert parttrie.digest(books) == hashlib.sha256(
        ",".join(str(x) for b in want_books for e in b for x in e).encode()
    ).hexdigest()
    assert got.columns == ["vec_id", "embedding", "label", "note", "code", "error"]
    summed = parttrie.with_label_error(got)
    totals: dict = {}
    for r in summed.collect():
        totals.setdefault(r["label"], set()).add(r["label_error"])
    errors = [(r[2], w[2]) for r, w in zip(rows, want, strict=True)]
    assert totals == {x: {sum(e for label, e in errors if label == x)} for x in {label for label, _ in errors}}


def test_codes_of_edges(frame):
    rows = [(i, [float(i), -1e300, 1e300, 2.0], None, "kept") for i in range(3)]
    got, books = parttrie.encode(frame(rows, SCHEMA), parts=2, entries=4)
    assert got.columns[-2:] == ["code", "error"] and len(books) == 2
    assert {r["code"] for r in got.collect()} == {"0000", "0100", "0200"}
    assert books[1].tolist() == [[MOST, 512]] * 3 and books[0][0].tolist() == [0, LEAST]
    for none in ([], [(None, [1.0, 2.0], 1, "kept")], [(1, None, 1, "kept")], [(1, [], 1, "kept")]):
        empty, books = parttrie.encode(frame(none, SCHEMA), parts=2)
        assert parttrie.with_label_error(empty).count() == 0 and books == []
    many, _ = parttrie.encode(frame([(i, [i / 256.0], 0, "") for i in range(300)], SCHEMA), parts=1, entries=300)
    assert many.where("vec_id = 299").first()["code"] == "12b"


def test_a_hot_part_is_one_leaf(frame):
    rows = frame([(i, [1.0, 2.0, 3.0, i % 5 / 4], 0, "") for i in range(400)], SCHEMA)
    whole = parttrie._usable(rows, "embedding", 1.0, 2, "v")
    counted = parttrie.different_parts(whole, "v", 2).collect()
    assert sorted((r["position"], tuple(r["part"]), r["n"]) for r in counted) == [
        (0, (1, 2), 400), (1, (3, 0), 320), (1, (3, 1), 80),
    ]


# Centroids


@pytest.mark.parametrize("pivots", [0, 1, 8])
@pytest.mark.parametrize("most", [4, 300, 2**61])
def test_pivots_skip_no_centroid(pivots, most):
    rng = np.random.default_rng(most % 89 + pivots)
    centres = rng.integers(-most, most, (12, 6))
    centres[7] = centres[5]
    spread = max(1, most // 50)
    rows = centres[rng.integers(0, 12, 400)] + rng.integers(-spread, spread + 1, (400, 6))
    at = laesa.choose_pivots(rows[:100], pivots) if pivots else rows[:0]
    far, reach = laesa.distances(rows, at), laesa.distances(centres, at)
    number, best, measured = laesa.assign(rows, far, centres, reach)
    want = [_nearest(r, centres.tolist()) for r in rows.tolist()]
    assert [(int(b), int(n)) for b, n in zip(best, number, strict=True)] == want
    # Rows near their centroids need few exact distances.
    if pivots == 8 and most > 4:
        assert measured < 0.5 * len(rows) * len(centres)


def _clustered(rows: list[tuple], k: int, rounds: int, scale: int, seed: str):
    kept = [(key, _whole(v, scale)) for key, v in rows]
    hashed = [(key is None, "" if key is None else hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), v) for key, v in kept]
    centres = [v for _, _, v in sorted(hashed)[:k]]
    for _ in range(rounds):
        held: dict[int, list] = {}
        for _, v in kept:
            held.setdefault(_nearest(v, centres)[1], []).append(v)
        centres = [_mean(held[c]) if c in held else old for c, old in enumerate(centres)]
    near = [_nearest(v, centres) for _, v in kept]
    sums = [sum(f for f, n in near if n == c) for c in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(key, c, f, sums[c], sum(sums), names[c]) for (key, _), (f, c) in zip(kept, near, strict=True)]


@pytest.mark.parametrize("k, n", [(5, 80), (16, 6), (1, 30)])
def test_clusters_equal_brute_force(frame, k, n):
    rows = _rows(k, n, 8, 0.3)
    odd = [(*r, 0, "kept") for r in UNUSABLE] + [(-1, [0.5] * 7, 0, "kept"), (-2, [0.5] * 9, 0, "kept")]
    table = frame(rows + odd, SCHEMA.replace("Code", "Cluster"))
    got = laesa.cluster(table, k=k, rounds=3, dims=8, scale=64.0, seed="1")
    assert got.columns == ["vec_id", "embedding", "label", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    found = [tuple(r) for r in got.drop("embedding", "label").collect()]
    assert sorted(map(str, found)) == sorted(map(str, _clustered([r[:2] for r in rows], k, 3, 64, "1")))


def test_clusters_of_edges(frame):
    assert laesa.cluster(frame([], SCHEMA)).count() == 0
    assert laesa.cluster(frame([(1, [1.0], 0, "")], SCHEMA)).count() == 0
    big = frame([(i, [1e300 * (-1) ** i, float(i)], 0, "") for i in range(6)], SCHEMA)
    got = laesa.cluster(big, k=2, dims=2).collect()
    assert len(got) == 6 and {r["cluster"] for r in got} <= {0, 1}
    assert all(0 <= r["distance"] <= r["inertia"] <= MOST for r in got)


# Inner products


def _best(rows: list[tuple], asked, k: int, scale: int):
    whole = [(key, _whole(v, scale)) for key, v in rows if key is not None]
    found = {}
    for q, a in whole:
        if asked(q):
            for r, b in whole:
                if r != q:
                    score = min(max(sum(x * y for x, y in zip(a, b, strict=False)), LEAST), MOST)
                    found.setdefault(q, {}).setdefault(r, []).append(score)
    return {
        q: sorted(((max(s), r) for r, s in of.items()), key=lambda x: (-x[0], x[1]))[:k] for q, of in found.items()
    }


@pytest.mark.parametrize("shard_rows, block_queries, wide", [(8192, 2048, 1.0), (16, 4, 1.0), (50, 3, 0.02), (16, 5, 3e9)])
def test_products_equal_brute_force(frame, shard_rows, block_queries, wide):
    rows = _rows(shard_rows, 90, 6, wide) + [(7, [wide] * 6, 0, ""), (40, [-wide] * 6, 0, ""), (95, [wide] * 4, 0, ""), (200, [], 0, "")]
    table = frame(rows + [(*r, 0, "") for r in UNUSABLE], SCHEMA.replace("label int, Code", "label int, rank"))
    got = maxscore.top_k(table, table.where("vec_id % 20 = 0"), 7, shard_rows=shard_rows, block_queries=block_queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found: dict = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert found == _best([r[:2] for r in rows], lambda q: q % 20 == 0, 7, 64)


@pytest.mark.parametrize("most", [2, 30, 2**40])
def test_a_score_to_beat_loses_no_answer(most):
    rng = np.random.default_rng(most % 13)
    ids, rows = np.arange(500), rng.integers(-most, most + 1, (500, 12))
    rows[20:60] = rows[20]
    query = rng.integers(-most, most + 1, 12)
    scores = [min(max(sum(int(a) * int(b) for a, b in zip(query, r, strict=True)), LEAST), MOST) for r in rows]
    rows_, query_ = exact(12, most, rows, query)
    shard = maxscore.Shard(ids, rows_)
    order = sorted(range(500), key=lambda i: (-scores[i], i))
    order.remove(33)
    for beat in (None, -5, 0, scores[order[399]], scores[order[40]], scores[order[9]]):
        found, got = shard.search(33, query_, 10, beat)
        assert found.tolist() == order[:10] and got.tolist() == [scores[i] for i in order[:10]]
    assert scores[order[0]] == MOST or len(shard.search(33, query_, 10, scores[order[0]] + 1)[0]) == 0


def test_non_essential_rows_are_not_probed():
    # The second dimension alone cannot reach the score to beat.
    rows = np.array([[9, 0]] * 3 + [[0, 1]] * 97)
    shard = maxscore.Shard(np.arange(100), rows)
    probed = []
    shard.columns = _Counting(shard.columns, probed)
    found, scores = shard.search(-1, np.array([5, 1]), 2, 45)
    assert found.tolist() == [0, 1] and scores.tolist() == [45, 45] and max(probed) == 3


class _Counting:
    """Columns that note how many rows are looked up."""

    def __init__(self, held: np.ndarray, seen: list[int]) -> None:
        self.held, self.seen, self.dtype = held, seen, held.dtype

    def __getitem__(self, at):
        self.seen.append(at[1].shape[1])
        return self.held[at]


def test_products_of_edges(frame):
    empty, one = frame([], SCHEMA), frame([(0, [1.0], 0, "")], SCHEMA)
    assert maxscore.top_k(empty, empty).count() == maxscore.top_k(one, one).count() == 0
    assert maxscore.top_k(empty, one).count() == maxscore.top_k(one, empty).count() == 0
    zeros = frame([(i, [0.0, 0.0], 0, "") for i in range(30)], SCHEMA)
    got = maxscore.top_k(zeros, zeros.where("vec_id = 0"), 20).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, 0) for i in range(1, 21)]
    # A third of all rows are one vector, of which most ids are no answer.
    hot = [(i, [1.0, 1.0], 0, "") for i in range(500)] + [(500 + i, [i / 64, -i / 64], 0, "") for i in range(900)]
    table = frame(hot, SCHEMA)
    got = maxscore.top_k(table, table.where("vec_id = 100"), 5, shard_rows=64).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(i, 8192) for i in range(5)]


def test_ragged_rows():
    assert ragged(pa.array([[1, 2], [], [3]], pa.list_(pa.int64()))).tolist() == [[1, 2], [0, 0], [3, 0]]
    assert ragged(pa.array([], pa.list_(pa.int64()))).shape == (0, 0)
