"""A corpus pipeline: documents in, shards of a cleaned and mixed corpus out.

Every stage takes what the one before kept, with the columns of documents, and
its decisions take effect: documents whose language is rejected go, one
document of each group of near duplicates stays, benchmark passages are cut
out of the texts, sources are repeated to their weights, and the last stage
gives every row its shard and place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closebook.llm import decontaminate, langid, mixing, sharding, simhash
from closebook.llm.common import fold_of, remove, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells. Those without a letter go, and those
    whose margin is below what texts of that language and length have."""
    model = langid.fit(docs.where(fold_of(F.col("doc_id")) != 0))
    found = langid.identify(docs, model)
    return found.where(~F.col("rejected")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group linked by fingerprints of 3-word shingles
    that differ in 2 or fewer bits."""
    return simhash.representatives(simhash.with_fingerprints(docs, shingle=3), radius=2)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 10 or more words they share with the benchmark."""
    clean = decontaminate.remove_passages(docs, table(spark, sf_dir, "benchmark"), window=10)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 in turn, 150 % of all words; copies are rows of their own."""
    return mixing.mix(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0, seed=17)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """24 shards of equal row count and equal mixture; adds shard, slot and fraction."""
    return sharding.interleave(docs, shards=24, seed=7)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Compressed sizes, fingerprints and the index are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents, each written once and read by the next.

    What a stage has read is deleted when its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), name)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
