from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from closebook.llm import decontaminate, extract, langid, simhash, tokencount, toxicity
from closebook.llm.components import components
from closebook.llm.fmindex import FMIndex, suffix_order
from closebook.llm.queries import ORACLES, QUERIES, VOCABULARY
from tests.llm import brute
from tests.llm.brute import DOCS

FOLDER = "/root/testdata/sf0.001"

EDGE = [
    (1, "The quick Brown fox", "en", "s", 1),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (None, "the QUICK brown\tfox", "en", "s", 1),
    (4, "lorem " * 40_000, "la", "s", 1),
    (5, "!!! 123 ...", "en", "s", 1),
    (5, "!!! 123 ...", "en", "s", 1),
    (6, "\u00c9t\u00e9 \U0001f600 \u4e2d\u6587", "fr", "s", 1),
]


# SimHash


@pytest.mark.parametrize("row", EDGE)
def test_fingerprint(row):
    text = row[1]
    assert simhash.fingerprint(None if text is None else text.encode()) == brute.simhash(text)


def test_fingerprint_does_not_depend_on_blocks(monkeypatch):
    text = " ".join(str(i % 977) * (i % 5 + 1) for i in range(5000))
    monkeypatch.setattr(simhash, "BLOCK", 100)
    assert simhash.fingerprint(text.encode()) == brute.simhash(text)


def _prints(seed: int) -> dict[int, int]:
    rng = random.Random(seed)
    found = {}
    for key in range(160):
        near = rng.choice(list(found.values())) if found and rng.random() < 0.7 else rng.getrandbits(64)
        for _ in range(rng.randrange(4)):
            near ^= 1 << rng.randrange(64)
        found[key] = near
    return found


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_clusters_equal_all_pairs(frame, radius):
    prints = _prints(radius)
    signed = [(k, v - (1 << 64) if v >> 63 else v) for k, v in prints.items()]
    got = simhash.clusters(frame(signed, "doc_id long, fingerprint long"), radius=radius).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute.linked(prints, radius)


def test_clusters_and_representatives_of_edges(frame):
    marked = simhash.with_fingerprints(frame(EDGE, DOCS))
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.clusters(marked).collect())
    assert got == [("1", 1), ("2", 2), ("3", 2), ("4", 4), ("5", 5), ("5", 5), ("6", 6), ("None", 1)]
    kept = simhash.representatives(marked)
    assert kept.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5, 6]
    keyless = frame([(None, "a"), (None, "a"), (None, "b c d e f")], "doc_id long, text string")
    assert simhash.representatives(simhash.with_fingerprints(keyless)).count() == 2
    assert simhash.representatives(simhash.with_fingerprints(frame([], DOCS))).count() == 0


def test_representatives_do_not_depend_on_the_order_of_rows(frame):
    rows = [(i, "a b c d", s) for i in (None, 3) for s in ("x", "y", None, "z")]
    rows += [(None, "e f g h i", s) for s in ("x", "y", None, "z")]
    kept = []
    for at in (0, 1, 5, 10):
        turned = frame(rows[at:] + rows[:at], "doc_id long, text string, source string").coalesce(1)
        kept.append({tuple(r) for r in simhash.representatives(simhash.with_fingerprints(turned)).collect()})
    assert all(k == kept[0] and len(k) == 2 for k in kept)


def test_components_of_a_chain_and_a_star(frame):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(frame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert components(frame([], "u long, v long")).count() == 0


def test_simhash_query(spark):
    docs = {r["doc_id"]: brute.simhash(r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    least = brute.linked(docs, 2)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_simhash"](spark, FOLDER).collect()}
    assert got == {k: (f"{docs[k]:016x}", least[k]) for k in docs}


# FM-index and decontamination


@pytest.mark.parametrize("n, symbols", [(1, 3), (40, 2), (600, 4), (900, 1)])
def test_index_finds_every_place(n, symbols):
    rng = np.random.default_rng(n)
    text = rng.integers(1, symbols + 1, n)
    closed = np.append(text, 0)
    assert suffix_order(closed).tolist() == sorted(range(n + 1), key=lambda i: closed[i:].tolist())
    index = FMIndex(text, size=symbols + 1)
    for length in (1, 2, 6):
        patterns = rng.integers(1, symbols + 1, (30, length))
        which, low, high = index.search(patterns)
        found = {w: sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, low, high)}
        for i, pattern in enumerate(patterns):
            places = [p for p in range(n - length + 1) if (text[p : p + length] == pattern).all()]
            assert found.get(i, []) == places


ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
    (2, "Short ITEM"),
    (3, None),
    (4, " ... "),
    (10, "short item"),
    (None, "nameless thing"),
]
LEAKS = [
    (1, "x alpha beta gamma DELTA epsilon, zeta eta theta iota kappa y"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (3, "a short-item and a nameless thing; short item"),
    (4, None),
    (4, "short item"),
    (5, "item short " * 30_000 + "short item"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"),
]


def _check_found(got, texts, items):
    for r in got:
        n, hit, ids = brute.contaminated(r["text"], items)
        named = sorted(str(i) for i in ids if i is not None)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), named)
        assert r["contaminated"] == (len(hit) > 0) and r["n_items"] == len(named)
        assert hit == {p for s in r["spans"] for p in range(s["first"], s["last"] + 1)}
    assert len(got) == len(texts)


@pytest.mark.parametrize("shard, block, benchmark", [(1 << 18, 1 << 20, 1 << 24), (50, 64, 1 << 24), (1 << 18, 1 << 20, 30)])
def test_passages_equal_brute_force(frame, monkeypatch, shard, block, benchmark):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", benchmark)
    items = frame(ITEMS, "item_id long, text string")
    docs = LEAKS if shard > 50 else LEAKS[:4]
    found = decontaminate.find(frame(docs, "doc_id long, text string"), items)
    _check_found(found.collect(), docs, ITEMS)
    monkeypatch.setattr(decontaminate, "SHARD", shard)
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    phrases = decontaminate.phrases_of(ITEMS)
    texts = [t for _, t in LEAKS]
    for (n, spans, ids), text in zip(
        decontaminate.find_passages([None if t is None else t.encode() for t in texts], phrases), texts, strict=True
    ):
        words, hit, own = brute.contaminated(text, ITEMS)
        assert (n, ids) == (words, sorted(str(i) for i in own if i is not None))
        assert hit == {p for a, b in spans for p in range(a, b + 1)}


def test_items_of_one_text_are_dealt_to_blocks(frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 400)
    sent, plain = [], decontaminate.phrases_of
    monkeypatch.setattr(decontaminate, "phrases_of", lambda items, window: plain(sent.append(list(items)) or sent[-1], window))
    body = "one two three four five six seven eight nine ten"
    items = frame([(i % 40, body) for i in range(400)], "item_id long, text string")
    got = decontaminate.find(frame([(1, f"x {body} y", "en", "s", 1)], DOCS), items).first()
    assert (got["n_hit"], got["n_items"], got["items"]) == (10, 40, sorted(map(str, range(40))))
    assert sum(map(len, sent)) == 40 and max(map(len, sent)) < 30 and len(sent) > 3


def test_spans_merge():
    assert decontaminate.merged([(5, 6), (0, 1), (2, 3), (9, 9), (5, 8)]) == [(0, 3), (5, 9)]


def test_removal(frame):
    items = frame(ITEMS, "item_id long, text string")
    rows = [(*r, "kept") for r in LEAKS[:5]] + [(9, "...", "kept")]
    docs = frame(rows, "doc_id long, text string, spans string")
    got = {(r["doc_id"], r["text"]) for r in decontaminate.remove_passages(docs, items).collect()}
    # Two passages side by side are one span. Document 4 with a text was a passage and nothing else.
    assert got == {
        (1, "x  y"),
        (2, LEAKS[1][1]),
        (3, "a  and a "),
        (4, None),
        (9, "..."),
    }
    assert decontaminate.remove_passages(docs, items).columns == docs.columns
    none = frame([], "item_id long, text string")
    assert decontaminate.remove_passages(docs, none).count() == len(rows)
    assert decontaminate.find(frame([], "doc_id long, text string"), items).count() == 0


def test_decontamination_query_equals_sql_and_brute_force(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    got = {r["doc_id"]: r for r in QUERIES["op3_decontaminate"](spark, FOLDER).collect()}
    for row in con.execute(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({ORACLES['op3_decontaminate']})").fetchall():
        r = got[row[0]]
        assert row[1:] == (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
    clean = hashlib.sha256(b"").hexdigest()
    assert {r["items_sha256"] for r in got.values() if not r["contaminated"]} == {clean}
    assert any(r["contaminated"] for r in got.values())


# Language


def test_language(frame, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = langid.fit(learned)
    assert model == langid.fit(learned)
    assert set(model.names) == {"en", "de", "fr", "es"}
    assert all(0 < len(words) <= langid.DICTIONARY_BYTES for words in model.dictionaries)
    tried = [r for r in docs.select("doc_id", "text", "lang").collect() if brute.fold(r["doc_id"]) == 0]
    right = sum(langid.classify(r["text"], model)[0] == r["lang"] for r in tried)
    assert right >= 0.95 * len(tried)
    rows = [(*r, "kept", 1.0) for r in EDGE]
    found = langid.identify(frame(rows, DOCS + ", lang_pred string, extra double"), model)
    assert found.columns == [*"doc_id text lang source n_chars extra lang_pred score rejected".split()]
    got = found.collect()
    assert len(got) == len(EDGE)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0.0 <= r["score"] <= 1.0
        assert r["rejected"] if not letters else r["lang_pred"] in model.names
    # The query's own rows are those of the classifier with its margins.
    queried = {r["doc_id"]: r for r in QUERIES["op7_language"](spark, "/root/testdata/sf0.01").collect()}
    for r in docs.where("doc_id % 9 = 0").collect():
        name, margin, length = langid.judge(r["text"], model)
        own = dict(zip(model.names, model.margins, strict=True)).get(name, (0.0,) * 5)[length]
        got = queried[r["doc_id"]]
        assert (got["lang_pred"], got["score"], got["held_out"]) == (name, margin, brute.fold(r["doc_id"]) == 0)
        assert got["rejected"] == (name == "und" or margin <= 0 or margin < own)


def test_language_rejects_narrow_margins_and_learns_from_little(frame):
    docs = frame([(1, "der die das", "de", "s", 1), (2, "the of and", "en", "s", 1)], DOCS)
    model = langid.fit(docs)
    found = langid.identify(docs, model, min_margin=1.0)
    assert all(r["rejected"] for r in found.collect())
    assert langid.classify("text", langid.fit(frame([], DOCS))) == ("und", 0.0)
    single = langid.fit(frame([(1, "der die das", "de", "s", 1), (2, None, "fr", "s", 1)], DOCS))
    assert langid.classify("der", single) == ("de", 1.0)
    assert langid.identify(frame([], DOCS), model).count() == 0


def _sentences(words: str, n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(rng.choice(words.split()) for _ in range(rng.randrange(20, 120))) for _ in range(n)]


_DE = "der die das und ist nicht ein auf mit sich auch es dem Haus gehen schnell wieder \u00fcber zwischen warum Stra\u00dfe"
_EN = "the of and is not one on with itself also it house going quickly again over between why street which"
_ES = "el la los y es no uno sobre con tambi\u00e9n casa ir r\u00e1pido otra vez entre por qu\u00e9 calle cual"
_NL = "het een en niet met zich ook huis gaan snel weer over tussen waarom straat welke geweest worden zijn onze"


def test_a_language_of_copies_is_learned(frame):
    copies = _sentences(_DE, 1, 3) * 4000
    rows = [(i, t, "de", "s", 1) for i, t in enumerate(copies)]
    rows += [(10_000 + i, t, "en", "s", 1) for i, t in enumerate(_sentences(_EN, 300, 4))]
    model = langid.fit(frame(rows, DOCS))
    assert model.names == ("de", "en") and all(model.dictionaries)
    assert len(model.dictionaries[0]) <= len(copies[0].encode()) + langid.SAMPLE_PIECES
    assert all(langid.classify(t, model)[0] == "de" for t in _sentences(_DE, 30, 5))
    assert all(langid.classify(t, model)[0] == "en" for t in _sentences(_EN, 30, 6))


@pytest.mark.parametrize("size", [0, 1, 20, 200])
def test_little_text_is_no_advantage(size):
    much = " ".join(_sentences(_EN, 200, 7)).encode()
    model = langid.Model(("en", "x"), (much, b"q" * size), ((0.0,) * 5,) * 2)
    for text in _sentences(_EN, 20, 8):
        for level, slices in langid.PASSES:
            right, other, _ = langid._sizes(text, model, level, slices)
            assert right < other
    assert langid.classify("the", model)[0] == "en"


def test_an_unlearned_language_is_rejected(frame):
    rows = [(i, t, name, "s", 1) for name, words in (("de", _DE), ("en", _EN), ("es", _ES))
            for i, t in enumerate(_sentences(words, 400, len(name) + i_of(name)))]
    model = langid.fit(frame(rows, DOCS))
    assert all(any(own) for own in model.margins)
    tried = frame([(i, t, name, "s", 1) for name, words in (("de", _DE), ("en", _EN), ("es", _ES), ("nl", _NL))
                   for i, t in enumerate(_sentences(words, 100, 90 + i_of(name)))], DOCS)
    found = langid.identify(tried, model).collect()
    assert sum(r["rejected"] for r in found if r["lang"] == "nl") > 60
    clean = [r for r in found if r["lang"] != "nl"]
    assert sum(not r["rejected"] and r["lang_pred"] == r["lang"] for r in clean) >= 0.97 * len(clean)


def test_margins_come_from_all_texts_beside_the_dictionaries(frame):
    texts = [(t, n) for n, words in (("de", _DE), ("en", _EN)) for t in _sentences(words, 400, i_of(n))]
    docs = frame([(i, t, n, "s", 1) for i, (t, n) in enumerate(texts + texts[::7])], DOCS)
    model = langid.fit(docs, sample_docs=20)
    drawn = docs.where("doc_id < 800").withColumn("u", langid.unit(F.xxhash64(F.lit(5), "text"))).collect()
    for name, margins in zip(model.names, model.margins, strict=True):
        by_length = {}
        for r in drawn:
            told, margin, length = langid.judge(r["text"], model)
            if r["lang"] == told == name and r["u"] >= 20 / 400:
                by_length.setdefault(length, []).append(margin)
        assert sum(map(len, by_length.values())) > 300
        for length, found in by_length.items():
            if len(found) >= langid.MEASURED:
                level = np.percentile(found, 100 * (1 - langid.KEPT)) * langid.NEEDED
                assert margins[length] > 0 and level - 2 / langid.GRID <= margins[length] <= level


def i_of(name: str) -> int:
    return sum(map(ord, name))


def test_many_languages_share_the_bytes(frame, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 30_000)
    rng = random.Random(12)
    rows = []
    for n in range(300):
        words = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(20))
        rows += [(n, t, f"l{n:03}", "s", 1) for t in _sentences(words, 3, n)]
    model = langid.fit(frame(rows, DOCS))
    assert len(model.names) == 300 and all(0 < len(d) <= 100 for d in model.dictionaries)
    tried = [r for r in rows if r[0] % 25 == 0]
    assert sum(langid.classify(r[1], model)[0] == r[2] for r in tried) > 0.8 * len(tried)


# Toxicity


def test_the_model_does_not_depend_on_the_order_of_rows(frame):
    rows = [(i, f"{'vile bad' if i % 3 == 0 else 'kind good'} word{i}", "en", "s", 1) for i in range(60)]
    rows += [(0, "another text of the key", "de", "s", 1), (1, "more of one", None, "s", 1), (2, None, "en", "s", 1)]
    labels = [(i, int(i % 3 == 0)) for i in range(60)]
    seen = set()
    for order in (1, 2, 3):
        dealt = rows * order
        random.Random(order).shuffle(dealt)
        model = toxicity.fit(frame(dealt, DOCS).repartition(order), frame(labels, "doc_id long, toxic int"))
        seen.add(tuple(toxicity.scores([r[1] and r[1].encode() for r in rows], model, model.tables())))
    assert len(seen) == 1


def test_copies_of_a_key_do_not_reach_the_driver(frame, monkeypatch):
    rows = [(i % 4, f"text {i % 2}", "en", "s", 1) for i in range(4000)]
    sent = []
    plain = toxicity.sampled
    monkeypatch.setattr(toxicity, "sampled", lambda *a: sent.append(plain(*a).count()) or plain(*a))
    toxicity.fit(frame(rows, DOCS), frame([(i, i % 2) for i in range(4)], "doc_id long, toxic int"))
    assert sent == [4]


def test_long_documents_teach_toxicity(frame):
    texts = [f"{'vile ' if i % 3 == 0 else 'kind '}" + f"word{'abc'[i % 2]} " * (5000 if i % 3 == 0 else 20) for i in range(90)]
    docs = frame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    model = toxicity.fit(docs, frame([(i, int(i % 3 == 0)) for i in range(90)], "doc_id long, toxic int"))
    tried = [b"kind words", b"vile words"]
    assert [x >= 0.5 for x in toxicity.scores(tried, model, model.tables())] == [False, True]


@pytest.mark.parametrize("shard", [1000, 1 << 20])
def test_all_labelled_documents_teach_toxicity(frame, monkeypatch, shard):
    # Every word is in 12 documents: two thirds of a label left out would leave most of them unlearned.
    monkeypatch.setattr(toxicity, "SHARD_DOCS", shard, raising=False)
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(1000)]
    rows = [(i, f"so it goes {words[i % 1000]}", "en", "s", 1) for i in range(12_000)]
    labels = [(i, i % 2) for i in range(12_000)]
    model = toxicity.fit(frame(rows, DOCS), frame(labels, "doc_id long, toxic int"))
    found = toxicity.scores((w.encode() for w in words), model, model.tables())
    assert sum((x >= 0.5) == i % 2 for i, x in enumerate(found)) > 950


def test_documents_of_labelled_keys_are_never_left_out(frame, monkeypatch):
    docs = frame([(i if i % 50 else None, f"text {i}", "en", "s", 1) for i in range(3000)], DOCS)
    known = frame([(i, 1) for i in range(0, 3000, 7)], "sample_key long, label int")
    keys = {r[0] for r in known.collect() if r[0] % 50}
    near = {r[0] for r in toxicity.labelled(docs, known, known.count(), "doc_id").select("doc_id").collect()}
    assert keys <= near and len(near) < 1200
    short = known.select(F.col("sample_key").cast("int"), "label")
    assert toxicity.labelled(docs, short, 1, "doc_id") is docs
    monkeypatch.setattr(toxicity, "MOST_KEYS", 10)
    assert toxicity.labelled(docs, known, known.count(), "doc_id") is docs


def test_thresholds_of_toxicity_are_the_middle_of_the_best(frame):
    # A network whose output is the number of the word: one embedding, one filter.
    words = [toxicity._packed(toxicity.hashed_words(w)) for w in (b"one", b"two", b"three", b"four")]
    like = toxicity._start(np.zeros((2, toxicity.ROWS)), np.zeros(2), 1)
    model = toxicity._nothing(like)
    for i, body in enumerate(words):
        model.embed[toxicity._unpacked(body)[0, 0], 0] = i + 1
    model.filters[1, 0][0, 0] = model.out[0] = 1
    model = toxicity.replace(model, language_words=np.zeros((toxicity.ROWS, 1), np.float32))
    for labels, want in (([0, 0, 1, 1], 2.5), ([0, 1, 0, 1], 2.5), ([0, 0, 0, 0], 5.0), ([1, 1, 1, 1], 0.0)):
        docs = frame([(bytearray(w), m) for w, m in zip(words, labels, strict=True)], "ids binary, label int")
        assert toxicity._offsets(docs, model).tolist() == [want]


def test_toxicity_held_out(spark):
    got = QUERIES["op6_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    assert len(got) == 10_000 and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    held = labels.merge(got, on="doc_id").query("held_out")
    assert (held["toxic"] == held["predicted"]).mean() > 0.97
    toxic = held[held["toxic"] == 1]
    assert (toxic["predicted"] == 1).mean() > 0.85


def test_toxicity_edges(frame):
    texts = ["bad vile words", "good kind words", None, "", "x" * 100_000, "bad vile words"]
    rows = [(i, t, "en" if i % 2 else None, "s", 1) for i, t in enumerate(texts)] * 12
    docs = frame(rows, DOCS)
    labels = frame([(0, 1), (1, 0), (2, 0), (3, None), (None, 1), (5, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.withColumn("score", F.lit("kept?")), model)
    assert got.columns == [*docs.columns, "score", "predicted"]
    found = got.collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["text"] in (None, "")}) == 1
    one = toxicity.fit(docs, labels.where("toxic = 1"))
    assert {r["predicted"] for r in toxicity.score(docs, one).collect()} == {1}
    none = toxicity.fit(docs, labels.where("false"))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_long_texts_score_like_short_ones():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50, (n, 2)) + [0, toxicity.BUCKETS] for n in (5, 700, 0, 90_000, 3)]
    labels = np.array([1, 0, 1, 0, 1])
    model = toxicity.train([d[:50] for d in docs] * 4, np.tile(labels, 4), seed=1)
    tables = model.tables()
    for doc, got in zip(docs, toxicity._logits(docs, model, tables), strict=True):
        ids, places = toxicity._joined([doc])
        top = toxicity._convolved(ids, tables)[places[0, 0] : places[0, 1]].max(axis=0)
        want = np.maximum(top + model.bias, 0) @ model.out + model.out_bias
        assert np.isclose(got, want, atol=1e-4)


# Pages


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<nav>menu</nav><footer>foot</footer>", ""),
        ("<p>only &amp; plain\n\t words</p>", "only & plain words"),
        ("<article><h1>T</h1><p>a <b>b<br><p>c&#233;</article><div class=ad>buy</div>", "T\na b\nc\u00e9"),
        ("<article><p>one</p><section id='comments'><p>noise</p></section><p>two</p></article>", "one\ntwo"),
        ("<article><p>x <span class='ad'>buy</span> y</p><script>var t='</p>';</script></article>", "x y"),
        ("<main><p>a</p><aside>side</aside><form><p>mail</p></form><!-- c --><p>b</p></main>", "a\nb"),
        ("<p>broken <![if x]> markup < 3</p>", "broken markup < 3"),
        ("<ul class=menu><li>a</ul><div><p>A long enough paragraph of text.</p><p>short</p></div>", "A long enough paragraph of text.\nshort"),
    ],
)
def test_main_text(html, text):
    assert extract.main_text(html) == text


def _page(inner: str, outer: str = "div") -> str:
    links = "<div>" + "".join(f"<p><a href=/{i}>link {i}</a></p>" for i in range(12)) + "</div>"
    long = "<p>" + "word " * 80 + "</p>"
    return f"<body>{links}<{outer}>{long * 3}{inner}{long * 3}</{outer}>{links}</body>"


@pytest.mark.parametrize("outer", ["div", "section"])
@pytest.mark.parametrize(
    "inner",
    [
        *("<ul>" + "".join(f"<li>item of the list {i:02}</li>" for i in range(n)) + "</ul>" for n in (4, 6, 8, 12, 200)),
        "<table>" + "".join(f"<tr><td>row {i:02}</td><td>{i * i}</td></tr>" for i in range(20)) + "</table>",
        "<dl>" + "".join(f"<dt>term {i}</dt><dd>said {i}</dd>" for i in range(9)) + "</dl>",
        *(f"<{t}>" + "<p>short text</p>" * 9 + f"</{t}>" for t in ("blockquote", "section", "div")),
        "<div><div>" + "<p>short text</p>" * 9 + "</div></div>",
    ],
)
def test_lists_and_tables_stay_with_the_text_around_them(inner, outer):
    lines = extract.main_text(_page(inner, outer)).split("\n")
    blocks = [" ".join(b.split()) for b in re.split("<[^>]*>", inner)]
    assert lines[3:-3] == [b for b in blocks if b]
    assert {*lines[:3], *lines[-3:]} == {("word " * 80).strip()}


_LONG = "word " * 80


@pytest.mark.parametrize("body", [f"<article><p>{_LONG}</p><p>short</p></article>", f"<div><p>{_LONG}</p><p>short</p></div>"])
@pytest.mark.parametrize(
    "start",
    [
        *(f"div id=page class='{c}'" for c in ("has-sidebar", "no-sidebar", "content with-nav", "ad-free", "post-share-wrap")),
        *("div class='search-result-page'", "div class='content sidebar'", "div id=search", "form id=aspnetForm action=x"),
        "form><div class=sidebar><div class=social",
    ],
)
def test_wrappers_do_not_take_the_article_away(start, body):
    html = f"<body><nav>{_LONG}</nav><{start}>{body}<div class=comments><p>noise</p></div></body>"
    assert extract.main_text(html) == _LONG.strip() + "\nshort"


def test_what_is_set_apart_beside_the_article_goes():
    aside = "<div class='box sidebar'><article><p>teaser</p></article></div><form><p>mail</p></form>"
    assert extract.main_text(f"<article><p>{_LONG}</p></article>{aside}") == _LONG.strip()
    assert extract.main_text(f"<div><p>{_LONG}</p></div>{aside}") == _LONG.strip()
    small = "<div class=search><main><p>small</p></main></div>"
    assert extract.main_text(f"{small}<div><p>{_LONG}</p></div>") == "small"


_TALK = "".join(f"<p>{_LONG}{i}</p>" for i in range(4))


@pytest.mark.parametrize(
    "aside",
    [
        f"<div class='comments'>{_TALK}</div>",
        f"<section id='comments'><ul>{_TALK.replace('p>', 'li>')}</ul></section>",
        f"<div class='comment-list'>{_TALK}</div>",
        f"<section id=comments><article class=comment>{_TALK}</article><article>{_TALK}</article></section>",
        f"<article class=comment>{_TALK}</article><article class='comment-body'>{_TALK}</article>",
        f"<form class=x action=y>{_TALK}</form>",
        f"<div class='cookie'>{_TALK}</div><div class='cookie-banner'>{_TALK}</div>",
        f"<div id=newsletter-signup>{_TALK}</div><div class='related-posts'>{_TALK}</div><div role=modal class=modal>{_TALK}</div>",
        "<div class='site-header'><p>name of the site</p></div><header><p>claim</p></header>",
    ],
)
@pytest.mark.parametrize(
    "body", ["<article>{}</article>", "<div>{}</div>", "<main>{}</main>", "<div class='comments-open has-sidebar'>{}</div>"]
)
def test_notes_are_not_the_article_however_long(body, aside):
    article = f"<h1>Title</h1><p>{_LONG}</p><p>short</p>"
    want = f"Title\n{_LONG.strip()}\nshort"
    assert extract.main_text(f"<body>{body.format(article)}{aside}</body>") == want
    assert extract.main_text(f"<body>{body.format(article + aside if 'header' not in aside else article)}</body>") == want


def test_a_byline_belongs_to_the_article():
    html = f"<header>site</header><article><header><h1>T</h1><p class=byline>by A</p></header><p>{_LONG}</p></article>"
    assert extract.main_text(html) == f"T\nby A\n{_LONG.strip()}"


def test_a_page_of_nothing_but_a_note_gives_its_text():
    assert extract.main_text(f"<div class=notice><p>{_LONG}</p></div>") == _LONG.strip()


@pytest.mark.parametrize("seed", range(120))
def test_planted_articles_come_back_alone(seed):
    """Articles of 1 to 50 blocks with comments up to 20 times as long, with and without article tags."""
    rng = random.Random(seed)

    def block(most: int) -> str:
        return " ".join(rng.choice(["word", "longer", "texts", "of", "it"]) for _ in range(rng.randrange(8, most)))

    blocks = [block(90) for _ in range(rng.choice([1, 2, 3, 8, 20, 50]))]
    size, talk = sum(map(len, blocks)), []
    while sum(map(len, talk)) < rng.choice([0, 1, 5, 20]) * size and sum(map(len, talk)) < 20 * size:
        talk.append(block(120))
    article = "".join(f"<p>{b}</p>" for b in blocks)
    remarks = "".join(rng.choice(["<div>{}</div>", "<p>{}</p>", "<li>{}</li>"]).format(t) for t in talk)
    remarks = rng.choice(
        [
            "<div class=comments>{}</div>", "<section id=comments><ol>{}</ol></section>", "<div class='comment-list x'>{}</div>",
            "<div id=disqus>{}</div>", "<article class=comment>{}</article>",
        ]
    ).format(remarks)
    menu = "".join(f"<li><a href=/{i}>go {i}</a></li>" for i in range(rng.randrange(2, 15)))
    tag = rng.choice(["article", "main", "div", "section", "div class=content"])
    inside = f"<{tag}>{article}{remarks}</{tag.split()[0]}>" if rng.random() < 0.4 else f"<{tag}>{article}</{tag.split()[0]}>{remarks}"
    page = rng.choice(["{}", "<div id=page class='no-sidebar'>{}</div>", "<form id=aspnetForm>{}</form>"]).format(
        f"<nav><ul>{menu}</ul></nav><div class=ad>buy this</div>{inside}<div class=sidebar><p>see also</p></div>"
    )
    html = f"<html><head><title>t</title></head><body>{page}<footer>&copy; them</footer></body></html>"
    assert extract.main_text(html) == "\n".join(blocks)


def test_main_text_does_not_depend_on_blocks(monkeypatch):
    html = "<article>" + "".join(f"<p>par&amp;agraph {i} &#8364;</p>" for i in range(300)) + "</article>"
    whole = extract.main_text(html)
    monkeypatch.setattr(extract, "BLOCK", 7)
    assert extract.main_text(html) == whole


def test_extract(frame, spark):
    pages = frame([(1, "<p>a</p>", "u", 3), (2, None, None, None), (2, None, None, None)], "page_id long, html string, Text string, n_chars int")
    got = extract.extract(pages)
    assert [c.lower() for c in got.columns] == ["page_id", "html", "text", "n_chars"]
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in got.collect()) == [(1, "a", 1), (2, "", 0), (2, "", 0)]
    assert extract.extract(pages.where("false")).count() == 0
    # The articles of the given pages by their markup.
    for r in QUERIES["op5_main_text"](spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        import html as entities

        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        blocks = [re.sub("<[^>]*>", " ", b) for b in re.split("</?(?:p|h1)>", inner)]
        lines = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert r["text"] == "\n".join(line for line in lines if line)
        assert r["n_chars"] == len(r["text"])


# Token files


def test_counts_equal_the_encoder(spark):
    docs = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    encode = tokencount.encoding(VOCABULARY).encode_ordinary
    got = QUERIES["op4_token_counts"](spark, FOLDER).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(encode(t or "")) for t in docs)
    assert all(r["closed"] for r in got)


@pytest.mark.parametrize("block", [1, 3, 64, 1 << 20])
def test_stitching_over_blocks(spark, tmp_path, block):
    rng, want = np.random.default_rng(3), []
    for file, size in enumerate([0, 1, 7, 999, 1000]):
        tokens = rng.choice([1, 2, 3, 4, 5, 8, 9], size)
        (tmp_path / f"part-{file}").write_bytes(tokens.astype("<u4").tobytes())
        first = 0
        for at, token in enumerate([*tokens, None]):
            if token in (8, 9) or (token is None and at > first):
                want.append((file, first, at - first, token is not None))
                first = at + 1
    found = tokencount.count_tokens(spark, str(tmp_path), ends=(8, 9), token="<u4", block=block)
    got = [(int(r["file"][-1]), r["first_token"], r["n_tokens"], r["closed"]) for r in found.collect()]
    assert sorted(got) == want


def test_null_and_empty_texts_are_documents(frame, tmp_path, spark):
    docs = frame([(None,), ("",), ("a b",), ("a b",)], "text string")
    tokencount.write_tokens(docs, str(tmp_path / "flat"), VOCABULARY)
    got = tokencount.count_tokens(spark, str(tmp_path / "flat")).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 0, 2, 2]
    tokencount.write_tokens(docs.where("false"), str(tmp_path / "none"), VOCABULARY)
    assert tokencount.count_tokens(spark, str(tmp_path / "none")).count() == 0


def test_files_are_bounded_by_bytes(frame, tmp_path, spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["word", "many", "x1"]) for _ in range(rng.choice([0, 1, 5, 40, 900]))) for _ in range(120)]
    path = tmp_path / "flat"
    tokencount.write_tokens(frame([(t,) for t in texts], "text string").coalesce(2), str(path), VOCABULARY, file_bytes=200)
    encode = tokencount.encoding(VOCABULARY).encode_ordinary
    sizes = sorted(len(encode(t)) for t in texts)
    files = [f.stat().st_size for f in path.rglob("part-*")]
    assert len(files) > 20 and max(files) < 200 + 2 * sizes[-1] + 2
    assert sum(files) == 2 * (sum(sizes) + len(texts))
    got = tokencount.count_tokens(spark, str(path), block=64).collect()
    assert sorted(r["n_tokens"] for r in got) == sizes and all(r["closed"] for r in got)
