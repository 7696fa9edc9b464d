"""Named queries over the document tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import (
    decontaminate,
    extract,
    laesa,
    langid,
    maxscore,
    mixing,
    neighbours,
    parttrie,
    sharding,
    simhash,
    tokencount,
    toxicity,
    urlfilter,
)
from closebook.llm.common import fold_of, hand_over, remove, table
from closebook.session import fresh_path


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of 150 % of all words, weights 5, 2, 1 in turn."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", mixing.word_count(F.col("text")).alias("size")
    )
    sizes = mixing.cycled_weights(mixing.source_sizes(docs, "size"), (5.0, 2.0, 1.0))
    targets = mixing.source_targets(sizes, share=1.5, most=2.0)
    chosen = mixing.copies_of(docs, targets, seed=17)
    return chosen.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


#: Rules of the url filter, as host and path.
URL_RULES = [
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by rules, and else by trust spread over host links."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urlfilter.judge(pages, URL_RULES).drop("url", "html")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of 10 consecutive benchmark words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


#: Vocabulary the token files are written with; at this place on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in the flat token files made of all texts."""
    path = fresh_path(spark, "tokens")
    tokencount.write_tokens(table(spark, sf_dir, "documents").select("text"), path, VOCABULARY)
    # A row for each block of a file; the files themselves are not needed after it.
    blocks = hand_over(tokencount.scan(spark, path), "token-blocks")
    remove(spark, path)
    found = tokencount.stitch(blocks)
    part = F.concat_ws("-", F.regexp_extract("file", r"part-(\d+)", 1), F.regexp_extract("file", r"piece=(\d+)", 1))
    return found.withColumn("file", part)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels").where(fold_of(F.col("doc_id")) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.drop("lang"), model).select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(fold_of(F.col("doc_id")) != 0).select("text", "lang"))
    return langid.identify(docs.drop("lang"), model).select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 or fewer differing bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = simhash.with_fingerprints(docs, shingle=3).drop("text")
    return simhash.clusters(marked, radius=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row count, each with the corpus' mixture of sources."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "text",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.interleave(docs, shards=24, seed=7).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
        "fraction",
    )


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 16 parts of every vector over codebooks of 64 entries."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = parttrie.encode(vectors, parts=16, entries=64, rounds=2, scale=256.0)
    return parttrie.with_label_error(coded.drop("embedding")).select(
        "vec_id", "code", "error", "label_error", F.lit(parttrie.digest(books)).alias("codebooks_sha256")
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector in the nearest of 16 centroids after 3 rounds."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return laesa.cluster(vectors, k=16, rounds=3, dims=64, scale=64.0, seed="1").drop("embedding")


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return maxscore.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20, scale=64.0)


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_url_filter": op2_url_filter,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_counts": op4_token_counts,
    "op5_main_text": op5_main_text,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_simhash": op8_simhash,
    "op9_shards": op9_shards,
    "op10_neighbours": op10_neighbours,
    "op11_part_codes": op11_part_codes,
    "op12_centroids": op12_centroids,
    "op13_top_products": op13_top_products,
}

_OP1 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) AS named
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS lim,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight
  FROM sizes),
ratios AS (
  SELECT *, lim / weight AS ratio, 1.5::DOUBLE * (SELECT sum(source_size) FROM sizes)::DOUBLE AS wanted FROM weighed),
levels AS (
  SELECT r.ratio,
         (min(r.wanted) - coalesce(sum(o.lim) FILTER (WHERE o.ratio < r.ratio), 0))
           / sum(o.weight) FILTER (WHERE o.ratio >= r.ratio) AS level
  FROM (SELECT DISTINCT ratio, wanted FROM ratios) r, ratios o GROUP BY r.ratio),
chosen AS (SELECT level FROM levels WHERE level < ratio ORDER BY ratio LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM chosen) IS NULL OR lim <= weight * (SELECT level FROM chosen) THEN lim
              ELSE weight * (SELECT level FROM chosen) END AS target
  FROM ratios),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, s.source, t.target / nullif(t.source_size, 0) AS rate,
         CAST('0x' || substr(md5('17:' || s.named), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(coalesce(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 0) AS BIGINT) AS copies FROM rated)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM counted
"""

_OP3 = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS doc_row, doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
doc_windows AS (
  SELECT doc_row, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_row, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
met AS (SELECT d.doc_row, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.gram = b.gram),
hits AS (
  SELECT doc_row, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_row, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_row),
items AS (
  SELECT doc_row, count(*) AS n_items, string_agg(named, ',' ORDER BY named) AS listed
  FROM (SELECT DISTINCT doc_row, CAST(item_id AS VARCHAR) AS named FROM met WHERE item_id IS NOT NULL) GROUP BY doc_row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (doc_row) LEFT JOIN items USING (doc_row)
"""

_OP2 = r"""
WITH RECURSIVE cut AS (
  SELECT *, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(act, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
numbered AS (SELECT row_number() OVER () AS page_row, * FROM cut),
fits AS (
  SELECT page_row, arg_max(rhost || rpath, len(rhost || rpath)) AS rule, arg_max(act, len(rhost || rpath)) AS act
  FROM numbered JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_row),
judged AS (SELECT n.*, f.rule, f.act FROM numbered n LEFT JOIN fits f USING (page_row)),
targets AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']?([^"''\s>]*)', 1)) AS target
  FROM judged),
named AS (
  SELECT src, translate(regexp_extract(CASE WHEN starts_with(target, '//') THEN ':' || target ELSE target END,
                        '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM targets WHERE contains(target, '://') OR starts_with(target, '//')),
links AS (SELECT src, dst, count(*) AS n FROM named WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
both_ways AS (
  SELECT 'trust' AS kind, src AS host, dst AS dest, n FROM links
  UNION ALL SELECT 'distrust', dst, src, n FROM links),
edges AS (SELECT *, sum(n) OVER (PARTITION BY kind, host) AS total FROM both_ways),
hosts AS (
  SELECT host, count(*) AS pages, count(*) FILTER (WHERE act = 'allow') AS trust,
         count(*) FILTER (WHERE act = 'block') AS distrust
  FROM judged WHERE host <> '' GROUP BY host),
seeds AS (
  SELECT kind, host, CAST(floor(1000000000000.0::DOUBLE * seeded / pages) AS BIGINT) AS rank
  FROM (SELECT 'trust' AS kind, host, pages, trust AS seeded FROM hosts
        UNION ALL SELECT 'distrust', host, pages, distrust FROM hosts) WHERE seeded > 0),
base AS (SELECT kind, host, CAST(floor(rank * CAST(1 - 0.85::DOUBLE AS DOUBLE)) AS BIGINT) AS rank FROM seeds),
-- Ranks never fall: the sum of all ranks stands still when a round changes nothing.
spread AS (
  SELECT 0 AS round, kind, host, rank, CAST(-1 AS HUGEINT) AS before, (SELECT sum(rank) FROM base) AS total FROM base
  UNION ALL
  SELECT round, kind, host, rank, before, sum(rank) OVER () AS total FROM (
    SELECT round + 1 AS round, kind, host, CAST(sum(rank) AS BIGINT) AS rank, max(total) AS before FROM (
      SELECT s.round, s.total, e.kind, e.dest AS host, CAST(floor(s.rank * 0.85::DOUBLE * e.n / e.total) AS BIGINT) AS rank
      FROM spread s JOIN edges e ON s.kind = e.kind AND s.host = e.host WHERE s.total <> s.before
      UNION ALL
      SELECT t.round, t.total, b.kind, b.host, b.rank
      FROM base b, (SELECT DISTINCT round, total, before FROM spread) t WHERE t.total <> t.before)
    GROUP BY round, kind, host)),
scored AS (
  SELECT host, CAST(coalesce(sum(rank) FILTER (WHERE kind = 'trust'), 0) AS BIGINT) AS trust,
         CAST(coalesce(sum(rank) FILTER (WHERE kind = 'distrust'), 0) AS BIGINT) AS distrust
  FROM spread WHERE round = (SELECT max(round) FROM spread) GROUP BY host)
SELECT page_id, host, path, rule,
       coalesce(act, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM judged LEFT JOIN scored USING (host)
"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

_OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS vec_row, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE}),
cut AS MATERIALIZED (
  SELECT vec_row, vec_id, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS part
  FROM kept, (SELECT unnest(range(16)) AS p)),
leaves AS MATERIALIZED (SELECT p, part, count(*) AS n FROM cut GROUP BY p, part),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
c0 AS MATERIALIZED (SELECT p, entry, part AS e FROM cut JOIN seeds USING (vec_id)),
""" + "".join(
    f"""a{i} AS MATERIALIZED (
  SELECT l.p, l.part, min(l.n) AS n,
         arg_min(entry, [list_sum(list_transform(list_zip(part, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry]) AS entry,
         CAST(min(list_sum(list_transform(list_zip(part, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS BIGINT) AS far
  FROM leaves l JOIN c{i} c ON l.p = c.p GROUP BY l.p, l.part),
""" + (f"""s{i} AS (
  SELECT p, entry, d, sum(n) AS m, sum(n * part[d]) AS s
  FROM (SELECT *, unnest(range(1, len(part) + 1)) AS d FROM a{i}) GROUP BY p, entry, d),
m{i} AS (
  SELECT p, entry, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY d) AS e FROM s{i} GROUP BY p, entry),
c{i + 1} AS MATERIALIZED (SELECT c.p, c.entry, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (p, entry)),
""" if i < 2 else "")
    for i in range(3)
) + """coded AS (
  SELECT vec_row, string_agg(printf('%02x', entry), '' ORDER BY c.p) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM cut c JOIN a2 a ON c.p = a.p AND c.part = a.part GROUP BY vec_row)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, entry)) FROM c2) AS codebooks_sha256
FROM kept JOIN coded USING (vec_row)
"""

_OP12 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS vec_row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE} AND len(embedding) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS e
  FROM kept ORDER BY sha256('1:' || vec_id), v LIMIT 16),
""" + "".join(
    f"""f{i} AS (
  SELECT vec_row, v, c, list_sum(list_transform(list_zip(v, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far FROM kept, c{i}),
a{i} AS MATERIALIZED (
  SELECT vec_row, any_value(v) AS v, arg_min(c, [far, c]) AS c, CAST(min(far) AS BIGINT) AS far FROM f{i} GROUP BY vec_row),
""" + (f"""s{i} AS (
  SELECT c, d, count(*) AS m, sum(v[d]) AS s FROM (SELECT c, v, unnest(range(1, 65)) AS d FROM a{i}) GROUP BY c, d),
m{i} AS (SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY d) AS e FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (c)),
""" if i < 3 else "")
    for i in range(4)
) + """named AS (SELECT c, sha256(array_to_string(e, ',')) AS centroid_sha256 FROM c3)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, far AS distance, CAST(sum(far) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(far) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a3 a USING (vec_row) JOIN named n ON a.c = n.c
"""

_OP13 = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE {_FINITE} AND vec_id IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         max(CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2])) AS BIGINT)) AS score
  FROM kept q JOIN kept r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id GROUP BY q.vec_id, r.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""

ORACLES = {
    "op1_mix_sources": _OP1,
    "op2_url_filter": _OP2,
    "op3_decontaminate": _OP3,
    "op11_part_codes": _OP11,
    "op12_centroids": _OP12,
    "op13_top_products": _OP13,
}
