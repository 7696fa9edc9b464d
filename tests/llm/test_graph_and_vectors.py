from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

import corpus_pipeline
from closebook.llm import langid, neighbours, urlfilter
from closebook.llm.common import fold_of
from closebook.llm.queries import ORACLES, QUERIES, URL_RULES
from tests.llm import brute
from tools.check_sql import difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_mix_sources", "op2_url_filter"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()) is None


def _pages() -> list[tuple]:
    rng = np.random.default_rng(5)
    hosts = [f"h{i}.example.{t}" for i in range(14) for t in ("org", "com", "net")]
    rows = []
    for page in range(400):
        host = hosts[min(int(rng.exponential(6)), len(hosts) - 1)]
        lang = ["fr", "de", "es", "en"][page % 4]
        links = "".join(f"<A class=x href='//{rng.choice(hosts).upper()}/p?q=1'>l</a>" for _ in range(page % 4))
        links += f'<a href="https://{rng.choice(hosts)}/x">m</a><a href="/own">o</a><a href=mailto:x>p</a>'
        rows.append((page, f"http{'s' * (page % 2)}://{host}/{lang}/{page}?a#b", links))
    odd = [None, "", "no scheme", "x://", "HTTPS://ORG", "a://org/", "a://ORG?x", "http://notorg/fr/1", "http://u:p@a.com:80/fr/"]
    rows += [(1000 + i, url, None if i % 2 else "") for i, url in enumerate(odd)]
    return rows + rows[:3]


def test_link_graph_equals_sql(frame):
    pages = frame(_pages(), "page_id long, url string, html string")
    con = duckdb.connect()
    held = pages.toPandas()
    con.register("pages", held)
    got = urlfilter.judge(pages, URL_RULES).drop("url", "html").toPandas()
    assert difference(got, con.execute(ORACLES["op2_url_filter"]).df()) is None
    free = got[got["rule"].isna()]
    assert set(free["verdict"]) == {"allow", "block"}
    assert (free["trust"] > 0).any() and (free["distrust"] > 0).any()


def test_trust_spreads_until_nothing_changes(frame):
    rng = np.random.default_rng(8)
    hosts, damping = 25, 0.5
    links = {(int(a), int(b)): int(n) for a, b, n in rng.integers(0, hosts, (60, 3)) + [0, 0, 1] if a != b}
    seeds = {"trust": {0: 10**12, 3: 10**11}, "distrust": {1: 10**12, 4: 5 * 10**11}}
    got = urlfilter.spread(
        frame([(k, str(h), r) for k, of in seeds.items() for h, r in of.items()], "kind string, host string, rank long"),
        frame([(str(a), str(b), n) for (a, b), n in links.items()], "src string, dst string, n long"),
        damping,
    )
    ranks = {(r["kind"], int(r["host"])): r["rank"] for r in got.collect()}
    for kind, of in seeds.items():
        passed = np.zeros((hosts, hosts))
        for (a, b), n in links.items():
            passed[(b, a) if kind == "trust" else (a, b)] = n
        passed /= np.maximum(passed.sum(axis=0), 1)
        seeded = np.array([of.get(h, 0) for h in range(hosts)], dtype=float)
        exact = np.linalg.solve(np.eye(hosts) - damping * passed, (1 - damping) * seeded)
        # Each link and seed may lose a unit a round, and half of that in every later round.
        assert all(abs(ranks.get((kind, h), 0) - exact[h]) < 2 * (len(links) + hosts) for h in range(hosts))


def test_distrust_reaches_hosts_of_many_links_away(spark, tmp_path):
    rows = [(0, "https://example.org/es/1", None)]
    rows += [(i, f"https://h{i}.net/", f"<a href='https://{f'h{i - 1}.net' if i > 1 else 'example.org'}/'>l</a>") for i in range(1, 15)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = QUERIES["op2_url_filter"](spark, str(tmp_path)).collect()
    assert {r["verdict"] for r in got} == {"block"} and min(r["distrust"] for r in got) > 0


def test_only_href_is_a_link(frame):
    html = "<a data-href='//evil.net/'>x</a><a class=y HREF=//good.org/z>l</a><a\nhref = 'x://Other.com?q'>m</a><abbr href='//no.net'>"
    links = urlfilter.host_links(frame([("https://own.org/", html)], "url string, html string")).collect()
    assert sorted(r["dst"] for r in links) == ["good.org", "other.com"]


def test_url_edges(frame):
    rows = [(1, None, None, "kept"), (2, "x", "", "kept")]
    pages = frame(rows, "page_id long, url string, html string, Verdict string")
    got = urlfilter.judge(pages, URL_RULES).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == [
        (1, "", "", None, "allow"),
        (2, "", "", None, "allow"),
    ]
    assert urlfilter.judge(pages.where("false"), URL_RULES).count() == 0


def _exact(rows: dict[int, np.ndarray], asked: int, k: int) -> list[tuple[float, int]]:
    own = rows[asked]
    return sorted((float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in rows.items() if i != asked)[:k]


def test_neighbours_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["vec_id"]: np.array(r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    got: dict[int, list] = {}
    for r in QUERIES["op10_neighbours"](spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert sorted(got) == [i for i in sorted(rows) if i % 100 == 0]
    hits = 0
    for asked, found in got.items():
        exact = _exact(rows, asked, 10)
        assert found == sorted(found) and len(found) == 10
        assert all(np.isclose(s, np.sqrt(((rows[v] - rows[asked]) ** 2).sum()), atol=1e-12) for s, v in found)
        hits += len({v for _, v in exact} & {v for _, v in found})
    assert hits >= 0.9 * 10 * len(got)


def test_neighbours_of_copies_and_unusable_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(300)] + [(1000 + i, [float(i % 7), 1.0, -2.0]) for i in range(40)]
    rows += [(2000, None), (2001, [0.0, 0.0, 0.0]), (2002, [1.0, nan, 0.0]), (2003, [1.0, None, 0.0]), (2004, [inf, 0.0, 0.0])]
    rows += [(2005, [1.0]), (None, [1.0, 0.0, 0.5]), (1001, [1.0, 1.0, -2.0])]
    vectors = frame([(*r, "kept") for r in rows], "vec_id long, embedding array<double>, rank string")
    got = neighbours.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    held = {i: np.array(v) for i, v in rows[:340]}
    for asked in (0, 100, 200, 1000):
        found = [(r["score"], r["vec_id"]) for r in got.where(f"query_id = {asked}").orderBy("rank").collect()]
        assert len(found) == 10
        if asked < 300:
            assert found == [(0.0, i) for i in range(11) if i != asked][:10]
        else:
            assert found[0] == _exact(held, asked, 1)[0]
    assert got.where("query_id >= 2000").count() == 0


def test_repeated_rows_use_up_no_place(frame):
    schema = "vec_id long, embedding array<double>"
    # One id eleven times before others of the same vector.
    rows = [(5, [1.0, 2.0])] * 11 + [(i, [1.0, 2.0]) for i in range(6, 20)] + [(i, [-3.0, float(i)]) for i in range(20, 40)]
    got = neighbours.search(frame(rows, schema), frame([(5, [1.0, 2.0])], schema), k=10)
    assert [(r["vec_id"], r["score"]) for r in got.orderBy("rank").collect()] == [(i, 0.0) for i in range(6, 16)]
    # A clustered table stored three times, each time turned by less than the clusters are apart.
    rng = np.random.default_rng(4)
    centres = 20 * np.eye(6)
    held = {i: centres[i % 6] + 0.1 * rng.standard_normal(6) for i in range(120)}
    rows = [(i, (v + turn).tolist()) for turn in (0.0, 1e-4, 2e-4) for i, v in held.items()]
    asked = frame([(i, held[i].tolist()) for i in range(12)], schema)
    for stored in (rows, [r for r in rows[:120] for _ in range(2)]):
        found: dict[int, list] = {}
        for r in neighbours.search(frame(stored, schema), asked, k=10).orderBy("query_id", "rank").collect():
            found.setdefault(r["query_id"], []).append(r["vec_id"])
        for i in range(12):
            least: dict[int, float] = {}
            for j, v in stored:
                if j != i:
                    least[j] = min(least.get(j, np.inf), float(np.sqrt(((np.array(v) - held[i]) ** 2).sum())))
            assert found[i] == sorted(least, key=lambda j: (least[j], j))[:10]


def _ranked(found) -> dict[int, list[int]]:
    got: dict[int, list] = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    return got


def test_rows_and_queries_have_one_length(frame):
    schema = "vec_id long, embedding array<double>"
    rows = [(i, [float(i), 1.0]) for i in range(49)] + [(100 + i, [1.0, 2.0, float(i)]) for i in range(30)]
    asked = frame([(200 + i, [0.5, 1.0, float(i)]) for i in range(9)] + [(300, [2.2, 1.0])], schema)
    assert _ranked(neighbours.search(frame(rows, schema), asked, k=3)) == {300: [2, 3, 1]}


def test_a_query_id_asks_with_all_its_vectors(frame):
    schema = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(6)
    held = {i: rng.standard_normal(4) for i in range(200)}
    rows = frame([(i, v.tolist()) for i, v in held.items()], schema)
    asked = [(7, [5.0, 0.0, 0.0, 0.0]), (7, [0.0, -5.0, 0.0, 0.0]), (7, [5.0, 0.0, 0.0, 0.0]), (8, [1.0, 1.0, 1.0, 1.0])]
    want = {}
    for asking in (7, 8):
        least = {
            i: min(float(np.sqrt(((v - np.array(q)) ** 2).sum())) for a, q in asked if a == asking)
            for i, v in held.items() if i != asking
        }
        want[asking] = sorted(least, key=lambda i: (least[i], i))[:5]
    for order in (asked, asked[::-1]):
        got = neighbours.search(rows, frame(order, schema).coalesce(1), k=5)
        assert _ranked(got) == want


def test_no_group_holds_more_than_a_chunk(frame, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 64)
    schema = "vec_id long, embedding array<double>"
    rng = np.random.default_rng(9)
    vectors = frame([(i, rng.standard_normal(3).tolist()) for i in range(900)], schema)

    def kept(self, func, kind):
        def noted(left, right):
            if left.num_rows > 2 * 64 or right.num_rows > 2 * 64:
                raise ValueError(f"{left.num_rows} rows, {right.num_rows} queries in a group")
            return func(left, right)

        return plain_apply(self, noted, kind)

    plain_apply = PandasCogroupedOps.applyInArrow
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", kept)
    got = _ranked(neighbours.search(vectors, vectors.where("vec_id < 700"), k=4))
    held = np.array([r["embedding"] for r in vectors.orderBy("vec_id").collect()])
    hits = 0
    for i, found in got.items():
        far = np.sqrt(((held - held[i]) ** 2).sum(axis=1))
        far[i] = np.inf
        hits += len(set(found) & set(np.argsort(far, kind="stable")[:4].tolist()))
    assert len(got) == 700 and hits >= 0.9 * 4 * 700


def test_huge_components_keep_their_distances():
    vectors = np.array([[1e200, 0.0], [3e200, 4e200], [-1.7e308, 1.0], [0.0, 1.0]])
    far = neighbours.distances(vectors, np.array([1.7e308, 0.0]))
    assert far[0] == far[1] == 1.7e308 and np.isinf(far[2])
    far = neighbours.distances(vectors, np.zeros(2))
    assert np.allclose(far / [1e200, 5e200, 1.7e308, 1.0], 1.0)
    assert neighbours.axes(vectors, 3, 0).shape == (4,)


@pytest.mark.parametrize("repeats", [1, 30])
def test_nearest_counts_ids(repeats):
    rng = np.random.default_rng(repeats)
    ids = np.repeat(np.arange(200), repeats)
    vectors = np.repeat(rng.standard_normal((200, 4)), repeats, axis=0) + 1e-6 * rng.standard_normal((200 * repeats, 4))
    at, far = neighbours.nearest(ids, vectors, 7, vectors[7 * repeats], 10)
    least = np.sqrt(np.square(vectors - vectors[7 * repeats]).sum(axis=1)).reshape(200, repeats).min(axis=1)
    want = [i for i in np.argsort(least) if i != 7][:10]
    assert ids[at].tolist() == want and np.allclose(far, least[want])


def test_few_rows_give_all_and_none(frame):
    schema = "vec_id long, embedding array<float>"
    few = frame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.5])], schema)
    assert neighbours.search(few, few, k=10).count() == 6
    assert neighbours.search(frame([], schema), few, k=3).count() in (0, 9)
    assert neighbours.search(few, frame([], schema), k=3).count() == 0


# Pipeline


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], FOLDER).write.parquet(str(tmp_path / name))
        kept.append(spark.read.parquet(str(tmp_path / name)))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [k.collect() for k in kept]
    model = langid.fit(docs.where(fold_of(docs["doc_id"]) != 0))
    needed = dict(zip(model.names, model.margins, strict=True))
    told = {r["doc_id"]: langid.judge(r["text"], model) for r in rows[0]}
    spoken = {k for k, (name, margin, length) in told.items() if margin > 0 and margin >= needed[name][length]}
    assert {r["doc_id"] for r in rows[1]} == spoken and len(spoken) > 0.97 * len(rows[0])
    least = brute.linked({r["doc_id"]: brute.simhash(r["text"]) for r in rows[1]}, 2)
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(set(least.values()))
    before = {r["doc_id"]: r["text"] for r in rows[2]}
    leaks = {k for k, t in before.items() if brute.contaminated(t, items)[1]}
    assert leaks
    for r in rows[3]:
        assert not brute.contaminated(r["text"], items)[1]
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] != before[r["doc_id"]]) == (r["doc_id"] in leaks)
    texts = {r["doc_id"]: tuple(r) for r in rows[3]}
    assert all(tuple(r) == texts[r["doc_id"]] for r in rows[4])
    assert sorted(tuple(r)[:5] for r in rows[5]) == sorted(map(tuple, rows[4]))
    counts = kept[5].groupBy("shard").count().toPandas()["count"]
    assert len(counts) == 24 and counts.max() - counts.min() <= 1
    again = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert again == sorted(map(tuple, rows[5]))


def test_pipeline_reads_what_the_stage_before_wrote(spark, monkeypatch):
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs.inputFiles())
        return docs.where("doc_id % 2 = 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage)])
    read.append(corpus_pipeline.run(spark, FOLDER).inputFiles())
    assert [any(f.endswith("documents.parquet") for f in files) for files in read] == [True, False, False]


def test_pipeline_of_no_documents(spark):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0
