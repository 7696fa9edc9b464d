"""Language identification by compression.

A text is cut into pieces, each piece is compressed with a raw-content
dictionary of every language, and the language whose pieces come out smallest
in sum is the answer. A narrow margin to the second smallest is a rejection;
how narrow is measured, by language and length of the text, on texts that are
not in the dictionaries.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, small_batches, unit, without

UNKNOWN = "und"
#: Characters of a text that are cleaned at once, bytes compressed at once.
BLOCK, PIECE = 1 << 20, 1024
#: Compression level and number of slices of a dictionary, in the first pass and in
#: the pass that breaks a tie: sizes against many slices differ by less than a byte.
PASSES = ((3, 1), (19, 16))
#: Bounds of the sample the dictionaries are made of: texts of a language, pieces of a
#: text, bytes of a dictionary, bytes of all dictionaries.
SAMPLE_DOCS, SAMPLE_PIECES, DICTIONARY_BYTES, MODEL_BYTES = 400, 2, 1 << 17, 1 << 26
#: Margins: the part of the rightly told texts of a language and length that reach a level, the
#: part of that level that is needed, how many texts it takes to measure it, the cleaned bytes at
#: which a length ends, the texts of a language from which a quarter is held back to measure, and
#: the parts of 1 that margins are counted in, so that what a group is counted by stays small.
KEPT, NEEDED, MEASURED, LENGTHS, SPARED, GRID = 0.995, 0.5, 40, (64, 256, 1024, 4096), 160, 1 << 16

_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first, with their dictionaries and, by length of the text,
    the margins below which they are rejected."""

    names: tuple[str, ...] = ()
    dictionaries: tuple[bytes, ...] = ()
    margins: tuple[tuple[float, ...], ...] = ()


def _pieces(text: str) -> Iterator[bytes]:
    """The lower-cased letters of a text, other runs as one space, in pieces."""
    for at in range(0, len(text), BLOCK):
        clean = _NO_LETTERS.sub(" ", text[at : at + BLOCK].lower()).strip().encode()
        for start in range(0, len(clean), PIECE):
            yield clean[start : start + PIECE]


def fit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    seed: int = 5,
    sample_docs: int = SAMPLE_DOCS,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> Model:
    """Dictionaries from about ``sample_docs`` different texts of each language, and margins
    from all others.

    Rows without language, and texts without a letter, teach nothing. Texts are chosen by
    a seeded hash among the different ones, so the same rows give the same model, copies
    count once and a language of few texts uses them all, for the dictionary alone. With many languages the
    dictionaries are smaller, so that all take at most ``MODEL_BYTES``. The counts and
    pieces of the languages pass the driver.
    """
    small_batches(docs.sparkSession)
    w = free_prefix(docs)
    known = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    known = known.select(F.col(lang).alias(w + "lang"), F.col(text).alias(w + "text"))
    known = known.withColumn(w + "order", F.xxhash64(F.lit(seed), F.col(w + "text")))
    # Different texts: hashes meet as partial sums, the texts stay where they are.
    different = known.groupBy(w + "lang", w + "order").agg(F.count("*").alias("n"))
    counts = different.groupBy(w + "lang").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), w + "lang").collect()
    if not found:
        return Model()
    share = min(1.0, MODEL_BYTES / (len(found) * dictionary_bytes))
    dictionary_bytes, sample_docs = int(dictionary_bytes * share), max(8, int(sample_docs * share))
    rates = {r[0]: min(0.75, sample_docs / r["texts"]) if r["texts"] >= SPARED else 1.0 for r in found}
    rates = [F.lit(x) for pair in rates.items() for x in pair]
    rate, drawn = F.create_map(*rates)[F.col(w + "lang")], unit(F.col(w + "order"))
    chosen = known.where(drawn < rate).groupBy(w + "lang", w + "order").agg(F.min(w + "text").alias(w + "text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for named, body, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pieces = list(_pieces(body))
                step = max(1, len(pieces) // SAMPLE_PIECES)
                first = at % step
                kept += [(named, at, i, p) for i, p in enumerate(pieces[first::step][:SAMPLE_PIECES])]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("lang", "at", "i", "piece"), k, strict=True)) for k in kept],
                schema=pa.schema([("lang", pa.string()), ("at", pa.int64()), ("i", pa.int32()), ("piece", pa.binary())]),
            )

    sampled = chosen.select(w + "lang", w + "text", w + "order").mapInArrow(
        cut, "lang string, at long, i int, piece binary"
    )
    held: dict[str, bytes] = {row[0]: b"" for row in found}
    for named, _, _, piece in sorted(map(tuple, sampled.collect())):
        if len(held[named]) < dictionary_bytes:
            held[named] += bytes(piece) + b" "
    model = Model(tuple(held), tuple(held[named][:dictionary_bytes] for named in held))
    spared = known.where(drawn >= rate).toDF("lang", "text", "order")
    return Model(model.names, model.dictionaries, _margins(spared, model))


def _margins(texts: DataFrame, model: Model) -> tuple[tuple[float, ...], ...]:
    """Half the margin that ``KEPT`` of the rightly told texts reach, by language and length.

    Every row is judged where it is; rows of equal language and ``order`` are one text. Levels
    are those of margins rounded down to 1 / ``GRID``.
    Of a length with fewer than ``MEASURED`` texts, that of the next shorter one with
    enough: margins grow with the text. Without one, only ties are rejected.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, margin: double, length: int>")
    def judged(bodies: pa.Array) -> pa.Array:
        return _told(bodies, shared.value)

    told = texts.select("lang", "order", judged("text").alias("found"))
    # Verdicts meet, not texts.
    told = told.groupBy("lang", "order").agg(F.min("found").alias("found")).where("lang = found.lang")
    margin = F.floor(F.col("found.margin") * GRID) / GRID
    level = F.percentile(margin, F.lit(1 - KEPT)).alias("level")
    levels = told.groupBy("lang", "found.length").agg(level, F.count("*").alias("n")).collect()
    enough = {(r["lang"], r["length"]): r["level"] * NEEDED for r in levels if r["n"] >= MEASURED}
    margins = []
    for name in model.names:
        own, last = [], 0.0
        for length in range(len(LENGTHS) + 1):
            last = enough.get((name, length), last)
            own.append(last)
        margins.append(tuple(own))
    return tuple(margins)


def _told(bodies: pa.Array, model: Model) -> pa.StructArray:
    found = [judge(t.as_py(), model) for t in bodies]
    columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.int32()))]
    return pa.StructArray.from_arrays(columns, names=["lang", "margin", "length"])


@lru_cache(maxsize=4)
def _compressors(model: Model, level: int, slices: int) -> list[list[zstandard.ZstdCompressor]]:
    """As many compressors for each language, over equal slices of its dictionary.

    A short dictionary has short slices, so little text is no advantage.
    """
    made = []
    for content in model.dictionaries:
        ends = [len(content) * i // slices for i in range(slices + 1)]
        coders = []
        for start, end in zip(ends, ends[1:], strict=False):
            words = zstandard.ZstdCompressionDict(content[start:end], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            coders.append(
                zstandard.ZstdCompressor(
                    level=level,
                    dict_data=words,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )
        made.append(coders)
    return made


def _sizes(text: str, model: Model, level: int, slices: int) -> list[int]:
    """Compressed bytes of the text by language, summed over pieces and slices, and last its cleaned bytes."""
    coders = _compressors(model, level, slices)
    sizes = [0] * (len(coders) + 1)
    for piece in _pieces(text):
        sizes[-1] += len(piece)
        for i, own in enumerate(coders):
            sizes[i] += sum(len(coder.compress(piece)) for coder in own)
    return sizes


def judge(text: str | None, model: Model) -> tuple[str, float, int]:
    """Language, margin and the number of the length a text has, see ``classify`` and ``LENGTHS``."""
    if not text or not model.names or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0
    for level, slices in PASSES:
        *sizes, size = _sizes(text, model, level, slices)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        rest = sizes[:best] + sizes[best + 1 :]
        margin = 1.0 - sizes[best] / min(rest) if rest else 1.0
        if margin > 0:
            break
    return model.names[best], margin, sum(size >= end for end in LENGTHS)


def classify(text: str | None, model: Model) -> tuple[str, float]:
    """Language and margin, the part by which the smallest size is below the second.

    A null text or one without a letter is unknown with margin 0, as is every
    text if nothing was learned. If the two smallest sizes are equal, the slower
    pass decides; if that ties too, the more frequent language. With a single
    language the margin is 1.
    """
    return judge(text, model)[:2]


def identify(
    docs: DataFrame,
    model: Model,
    min_margin: float | None = None,
    text: str = "text",
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the margin, 0 to 1) and ``rejected``.

    Whole texts are compressed. A document is rejected if its language is unknown, on a
    tie, and if its margin is below the one measured for its language and length, or not
    above ``min_margin`` if that is given; ``lang_pred`` names the best language all the
    same. Input columns of the three names are replaced.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, margin: double, length: int>")
    def judged(texts: pa.Array) -> pa.Array:
        return _told(texts, shared.value)

    docs = without(docs, "lang_pred", "score", "rejected")
    w = free_prefix(docs)
    found = docs.withColumn(w + "found", judged(F.col(text)))
    of, margin = F.col(w + "found"), F.col(w + "found.margin")
    narrow = margin <= (F.lit(0.0) if min_margin is None else F.lit(min_margin))
    if min_margin is None and model.names:
        pairs = zip(model.names, model.margins, strict=True)
        needed = F.create_map(*[x for name, own in pairs for x in (F.lit(name), F.array(*map(F.lit, own)))])
        narrow = narrow | F.coalesce(margin < needed[of["lang"]][of["length"]], F.lit(False))
    return found.select(
        *docs.columns,
        of["lang"].alias("lang_pred"),
        margin.alias("score"),
        ((of["lang"] == UNKNOWN) | narrow).alias("rejected"),
    )
