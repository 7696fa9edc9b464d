"""Token counts of flat token files by scanning for end-of-document identifiers.

A flat file is nothing but token identifiers of fixed width, documents one after
the other, each closed by an end-of-document identifier; there is no index. Each
file is searched in blocks with vector comparisons, and a prefix scan over the
blocks' counts and last separators stitches documents that cross blocks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closebook.llm.common import small_batches

#: Fixed values of the token format: big-endian 16-bit identifiers, and an end of document
#: above the vocabulary whose two bytes are one UTF-8 character, so that Spark's text
#: writer can put it after every document as line separator.
TOKEN, END_OF_DOCUMENT, SEPARATOR = ">u2", 0xC480, "Ā"
#: Fixed value: how the public vocabularies of byte-level BPE cut a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Tokens searched at once; bytes of a file, which Spark reads as one value. A file may end one
#: document later.
BLOCK, FILE_BYTES = 1 << 20, 1 << 25


@lru_cache(maxsize=2)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """Byte-level BPE of a vocabulary file: a base64 token and its rank on each line."""
    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if max(ranks.values()) >= END_OF_DOCUMENT:
        raise ValueError("the vocabulary does not fit the 16-bit token format")
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, text: str = "text", file_bytes: int = FILE_BYTES
) -> None:
    """Write all texts as flat token files below ``path``, a new folder all executors share.

    ``vocabulary`` is a file at the same place on every executor. A null or empty text
    is a document without tokens. A task begins a new file, in a folder ``piece=<n>``, when
    ``file_bytes`` are full, however many or few documents that takes; a document is
    never cut.
    """
    small_batches(docs.sparkSession)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, full = encoding(vocabulary).encode_to_numpy, 0
        for batch in batches:
            flat = [encode(t.as_py() or "").astype(TOKEN).tobytes() for t in batch.column(0)]
            pieces = []
            for tokens in flat:
                pieces.append(full // file_bytes)
                full += len(tokens) + len(SEPARATOR.encode())
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.binary()), pa.array(pieces, pa.int64())], names=["value", "piece"])

    flat = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(coded, "value binary, piece long")
    # The writer copies the bytes of a value as they are.
    flat = flat.select(F.col("value").cast("string").alias("value"), "piece")
    flat.write.partitionBy("piece").option("lineSep", SEPARATOR).text(path)


def scan(
    spark: SparkSession, path: str, ends: tuple[int, ...] = (END_OF_DOCUMENT,), token: str = TOKEN, block: int = BLOCK
) -> DataFrame:
    """file, block, tokens and seps, the places of separators, for each block of each file.

    A file whose length is no multiple of the token width is refused.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                tokens = np.frombuffer(content.as_buffer(), dtype=token)
                for number, at in enumerate(range(0, len(tokens), block)):
                    part = tokens[at : at + block]
                    found = part == ends[0] if len(ends) == 1 else np.isin(part, ends)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name.as_py()]),
                            pa.array([number], pa.int64()),
                            pa.array([len(part)], pa.int64()),
                            pa.array([np.flatnonzero(found)], pa.list_(pa.int64())),
                        ],
                        names=["file", "block", "tokens", "seps"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(
        search, "file string, block long, tokens long, seps array<long>"
    )


def stitch(blocks: DataFrame) -> DataFrame:
    """file, document (from 0), first token, n_tokens and closed for each document.

    Tokens after a file's last separator are a document that is not closed; a file
    that ends in a separator has none. Separators are in no document.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    placed = blocks.withColumns(
        {
            "before": F.coalesce(F.sum("tokens").over(earlier), F.lit(0)),
            "documents": F.coalesce(F.sum(F.size("seps")).over(earlier), F.lit(0)),
            "total": F.sum("tokens").over(whole),
        }
    )
    placed = placed.withColumn("seps", F.transform("seps", lambda s: s + F.col("before")))
    last = F.max(F.try_element_at("seps", F.lit(-1))).over(earlier)
    placed = placed.withColumn("opens", F.coalesce(last + 1, F.lit(0)))
    # The last block of a file closes what is left over.
    firsts = F.concat(F.array("opens"), F.transform("seps", lambda s: s + 1))
    open_ = (F.col("before") + F.col("tokens") == F.col("total")) & (F.element_at(firsts, -1) < F.col("total"))
    stops = F.when(open_, F.concat("seps", F.array("total"))).otherwise(F.col("seps"))
    pairs = F.arrays_zip(F.slice(firsts, F.lit(1), F.size(stops)).alias("first"), stops.alias("stop"))
    each = placed.select("file", "documents", F.size("seps").alias("closed"), F.posexplode(pairs).alias("i", "pair"))
    return each.select(
        "file",
        (F.col("documents") + F.col("i")).alias("document"),
        F.col("pair.first").alias("first_token"),
        (F.col("pair.stop") - F.col("pair.first")).alias("n_tokens"),
        (F.col("i") < F.col("closed")).alias("closed"),
    )


def count_tokens(
    spark: SparkSession, path: str, ends: tuple[int, ...] = (END_OF_DOCUMENT,), token: str = TOKEN, block: int = BLOCK
) -> DataFrame:
    """Documents of all flat files below ``path`` with their token counts; see ``stitch``.

    Empty files and folders give no rows, equal documents a row each.
    """
    return stitch(scan(spark, path, ends, token, block))
