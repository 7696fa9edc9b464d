from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from closebook.llm import mixing, sharding
from closebook.llm.common import text_key, unit
from closebook.llm.queries import op9_shards
from tests.llm.brute import DOCS

FOLDER = "/root/testdata/sf0.001"

EDGE = [
    (1, "a b c", "en", "s1", 5),
    (2, None, "en", "s1", None),
    (3, "", None, None, 0),
    (None, "lone words here", "de", None, 15),
    (4, "x " * 30_000, "en", "s2", 60_000),
    (5, "a b c", "en", "s3", 5),
    (5, "a b c", "en", "s3", 5),
    (6, " one word \t\n two", None, "", 9),
]


def level_fill(sizes: dict, weights: dict, share: float, most: float) -> dict:
    """Targets by handing the excess out again until nothing is above its limit."""
    wanted, full, level = share * sum(sizes.values()), set(), 0.0
    while len(full) < len(sizes):
        open_ = [s for s in sizes if s not in full]
        level = (wanted - sum(most * sizes[s] for s in full)) / sum(weights[s] for s in open_)
        above = {s for s in open_ if weights[s] * level >= most * sizes[s]}
        if not above:
            break
        full |= above
    return {s: most * sizes[s] if s in full else weights[s] * level for s in sizes}


def test_word_count(frame):
    df = frame(EDGE, DOCS).select(mixing.word_count(F.col("text")).alias("n"))
    assert [r["n"] for r in df.collect()] == [3, 0, 0, 3, 30_000, 3, 3, 2]


@pytest.mark.parametrize("share", [0.5, 1.5, 1.99, 2.0])
def test_targets_are_filled_by_weight(frame, share):
    rows = [("a", 10), ("b", 1000), ("c", 500), ("é", 3), ("z", 0), (None, 700)]
    sizes = frame(rows, "source string, source_size long")
    weighed = mixing.cycled_weights(sizes, (5.0, 2.0, 1.0))
    got = {r["source"]: r for r in mixing.source_targets(weighed, share, 2.0).collect()}
    order = ["a", "b", "c", "z", "é", None]
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    assert {s: got[s]["weight"] for s in order} == weights
    want = level_fill(dict(rows), weights, share, 2.0)
    for s in order:
        assert math.isclose(got[s]["target"], want[s], abs_tol=1e-9)


def test_mix_repeats_whole_documents(frame):
    docs = frame(EDGE, DOCS)
    mixed = mixing.mix(docs, share=1.5)
    assert mixed.columns == docs.columns
    once = Counter(map(tuple, docs.collect()))
    many = Counter(map(tuple, mixed.collect()))
    assert set(many) <= set(once)
    assert all(many[row] <= 2 * once[row] for row in many)
    assert many == Counter(map(tuple, mixing.mix(docs, share=1.5).collect()))


def test_mix_keeps_columns_of_its_own_names(frame):
    docs = frame([(1, "a b", "s", 7, "t")], "doc_id long, text string, source string, copies int, Target string")
    mixed = mixing.mix(docs, share=2.0)
    assert mixed.columns == docs.columns
    assert [tuple(r) for r in mixed.collect()] == [(1, "a b", "s", 7, "t")] * 2


def test_empty_tables(frame):
    empty = frame([], DOCS)
    assert mixing.mix(empty).count() == 0
    assert sharding.interleave(empty).count() == 0


def test_interleave_cuts_equal_mixtures(frame):
    rows = [(i, f"t{i % 7}", "en", "hot" if i % 3 else f"s{i % 11}", i) for i in range(3000)]
    got = sharding.interleave(frame(rows, DOCS), shards=24, bucket_rows=64).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(125)) for s in slots.values())
    share = Counter(r[3] for r in rows)
    for shard in slots:
        held = Counter(r["source"] for r in got if r["shard"] == shard)
        for source, n in share.items():
            assert abs(held[source] - n / 24) <= 2
    # The order is by fraction: ranks of a source are spread evenly.
    ordered = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert [r["fraction"] for r in ordered] == sorted(r["fraction"] for r in got)


def test_interleave_edges(frame):
    docs = frame([(*r, "kept") for r in EDGE], DOCS + ", Shard string")
    got = sharding.interleave(docs, shards=5).collect()
    assert len(got) == len(EDGE)
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    single = frame([(i, "t", "en", f"s{i}", 1) for i in range(40)], DOCS)
    spread = Counter(r["shard"] for r in sharding.interleave(single, shards=4).collect())
    assert set(spread.values()) == {10}


def test_query_of_all_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = op9_shards(spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        body = docs[r["doc_id"]]["text"].encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 8, zlib.crc32(body))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
    again = sorted(tuple(r) for r in op9_shards(spark, FOLDER).collect())
    assert again == sorted(tuple(r) for r in got)


def _ranked(docs, shards: int, seed: int) -> list[tuple]:
    """Key, shard, slot and fraction of rows whose hashes differ, by sorting all of them."""
    hashed = docs.select(
        "doc_id", text_key(F.col("source")).alias("s"), F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "text").alias("h")
    )
    starts = {r["s"]: r["u"] for r in hashed.select("s", unit(F.xxhash64(F.lit(seed + 1), "s")).alias("u")).distinct().collect()}
    by_source, placed = defaultdict(list), []
    for r in hashed.collect():
        by_source[r["s"]].append((r["h"] % 2**64 >> 11, r["h"], r["doc_id"]))
    for s, rows in by_source.items():
        for k, (_, _, doc) in enumerate(sorted(rows)):
            placed.append(((k + starts[s]) / len(rows), s, k, doc))
    total, found = len(placed), []
    for place, (fraction, _, _, doc) in enumerate(sorted(placed)):
        shard = place * shards // total
        found.append((doc, shard, place - -(-shard * total // shards), fraction))
    return sorted(found)


@pytest.mark.parametrize("bucket_rows", [4, 256])
def test_ranks_equal_a_plain_sort(spark, bucket_rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sharding.interleave(docs, shards=24, seed=7, bucket_rows=bucket_rows)
    assert sorted(tuple(r) for r in got.select("doc_id", "shard", "slot", "fraction").collect()) == _ranked(docs, 24, 7)
    if bucket_rows == 256:
        queried = op9_shards(spark, FOLDER).select("doc_id", "shard", "slot", "fraction").collect()
        assert sorted(map(tuple, queried)) == _ranked(docs, 24, 7)


def test_equal_rows_are_dealt_to_many_buckets(frame):
    rows = [(None, None, "en", "s", 1)] * 5000 + [(7, "same", "en", "s", i % 3) for i in range(900)]
    rows += [(i, f"t{i}", "en", "s" if i % 2 else None, 1) for i in range(600)]
    docs = frame(rows, DOCS).repartition(7)
    cut = docs.select("*", F.col("source").alias("_s"), F.xxhash64("doc_id", "text").alias("_h"), F.length("text").alias("_size"))
    dealt = sharding._spread_copies(cut, docs.columns, "_s", "_h", "_n", 64)
    assert dealt.columns == cut.columns
    assert dealt.groupBy("_s", "_h").count().agg(F.max("count")).first()[0] == 1
    got = sharding.interleave(docs, shards=24, bucket_rows=64).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, rows))
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append((r["slot"], r["fraction"]))
    assert {len(s) for s in slots.values()} <= {270, 271} and len(slots) == 24
    for held in slots.values():
        assert [s for s, _ in sorted(held)] == list(range(len(held)))
        assert [f for _, f in sorted(held)] == sorted(f for _, f in held)
    share = Counter((r["source"], r["shard"]) for r in got)
    for source, n in Counter(r[3] for r in rows).items():
        assert all(abs(share[source, shard] - n / 24) <= 2 for shard in range(24))
