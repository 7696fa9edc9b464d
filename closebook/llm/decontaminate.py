"""Benchmark decontamination: passages of a benchmark found in documents and cut out.

The documents of a batch are put together to shards of bounded size. Words
that no benchmark item holds are one symbol, and a run of them is kept once.
Each shard gets an FM-index in which all windows are searched backwards;
their places come from sampled suffix positions, and overlapping places
merge to removal spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, hand_over, small_batches, without
from closebook.llm.fmindex import FMIndex

#: Words of a window; symbols of one index; bytes of a text read at once; bytes of
#: benchmark text that are searched, and sent to the executors, at once.
WINDOW, SHARD, BLOCK, BENCHMARK_BYTES = 10, 1 << 18, 1 << 20, 1 << 24
#: Symbol of words outside the benchmark and of the ends of documents.
OTHER = 1

#: A-Z to lower case, ASCII that is no digit or letter to space.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_FOUND = "struct<n_words: bigint, spans: array<struct<first: bigint, last: bigint>>, items: array<string>>"

_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII digits and letters and of all other code points."""
    return (text or b"").translate(_PLAIN).split()


@dataclass(frozen=True)
class Phrases:
    """Windows of a block of the benchmark by length, and the items each is from."""

    symbols: dict[bytes, int]
    windows: dict[int, np.ndarray]
    owners: dict[int, list[list[str]]]


def phrases_of(items: Iterable[tuple[object, str | None]], window: int = WINDOW) -> Phrases:
    """All windows of ``window`` consecutive words; an item of fewer words is one window."""
    symbols: dict[bytes, int] = {}
    owners: dict[int, dict[tuple[int, ...], set[str]]] = {}
    for item, text in items:
        coded = [symbols.setdefault(w, len(symbols) + OTHER + 1) for w in words_of((text or "").encode())]
        length = min(window, len(coded))
        for at in range(len(coded) - length + 1) if length else ():
            own = owners.setdefault(length, {}).setdefault(tuple(coded[at : at + length]), set())
            own |= set() if item is None else {str(item)}
    return Phrases(
        symbols,
        {n: np.array(list(own), dtype=np.int64) for n, own in owners.items()},
        {n: [sorted(items) for items in own.values()] for n, own in owners.items()},
    )


def _coded(text: bytes | None, phrases: Phrases) -> np.ndarray:
    """A text's words as symbols, a block of the text at a time."""
    parts, at, known = [], 0, phrases.symbols.get
    text = text or b""
    while at < len(text):
        cut = _BREAK.search(text, at + BLOCK)
        end = cut.start() if cut else len(text)
        words = text[at:end].translate(_PLAIN).split()
        parts.append(np.fromiter((known(w, OTHER) for w in words), np.int32, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)


def _occurrences(symbols: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, window numbers and first positions of all windows that occur."""
    if not phrases.windows:
        return
    plain = symbols == OTHER
    kept = np.flatnonzero(~plain | ~np.concatenate(([False], plain[:-1])))
    short = symbols[kept]
    overlap = max(phrases.windows, default=1) - 1
    for start in range(0, len(short), SHARD):
        part = short[start : start + SHARD + overlap]
        index = FMIndex(part, size=len(phrases.symbols) + OTHER + 1)
        for length, windows in phrases.windows.items():
            which, low, high = index.search(windows)
            counts = high - low
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            for a in range(0, total, SHARD):
                wanted = np.arange(a, min(a + SHARD, total))
                owner = np.searchsorted(ends, wanted, side="right")
                rows = low[owner] + wanted - (ends[owner] - counts[owner])
                yield length, which[owner], kept[start + index.locate(rows)]


def _search(coded: list[np.ndarray], phrases: Phrases) -> tuple[list, list]:
    """Spans and items of each of the documents of one shard."""
    sizes = np.array([len(c) + 1 for c in coded])
    opens = np.cumsum(sizes) - sizes
    joined = np.full(int(sizes.sum()), OTHER, dtype=np.int32)
    for at, symbols in zip(opens.tolist(), coded, strict=True):
        joined[at : at + len(symbols)] = symbols
    steps = np.zeros(len(joined) + 1, dtype=np.int64)
    items: dict[int, set[str]] = {}
    for length, which, first in _occurrences(joined, phrases):
        steps += np.bincount(first, minlength=len(steps)) - np.bincount(first + length, minlength=len(steps))
        doc = np.searchsorted(opens, first, side="right") - 1
        for d, w in np.unique(np.stack((doc, which)), axis=1).T.tolist():
            items.setdefault(d, set()).update(phrases.owners[length][w])
    hit = np.cumsum(steps) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit)).astype(np.int8)))
    spans: list[list[tuple[int, int]]] = [[] for _ in coded]
    for first, end in edges.reshape(-1, 2).tolist():
        doc = int(np.searchsorted(opens, first, side="right")) - 1
        spans[doc].append((first - int(opens[doc]), end - 1 - int(opens[doc])))
    return spans, [sorted(items.get(d, ())) for d in range(len(coded))]


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (first and last word) in order, those that touch or overlap as one."""
    found: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if found and first <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(found[-1][1], last))
        else:
            found.append((first, last))
    return found


def find_passages(texts: Iterable[bytes | None], phrases: Phrases) -> Iterator[tuple[int, list, list]]:
    """For each text: number of words, spans hit and items found, indexing a shard at a time."""
    held: list[np.ndarray] = []
    symbols = 0
    for text in texts:
        held.append(_coded(text, phrases))
        symbols += len(held[-1])
        if symbols >= SHARD:
            yield from zip(map(len, held), *_search(held, phrases), strict=True)
            held, symbols = [], 0
    if held:
        yield from zip(map(len, held), *_search(held, phrases), strict=True)


def _binary(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())


def _with_block(docs: DataFrame, phrases: Phrases, text: str, name: str) -> DataFrame:
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    @F.arrow_udf(_FOUND)
    def found(texts: pa.Array) -> pa.Array:
        rows = list(find_passages((t.as_py() for t in _binary(texts)), shared.value))
        columns = [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], _SPANS),
            pa.array([r[2] for r in rows], pa.list_(pa.string())),
        ]
        return pa.StructArray.from_arrays(columns, names=["n_words", "spans", "items"])

    # So named, it is not evaluated again where a filter and the result both need it.
    return docs.withColumn(name, found.asNondeterministic()(F.col(text)))


def _merged(spans: Column) -> Column:
    @F.arrow_udf("array<struct<first: bigint, last: bigint>>")
    def joined(spans: pa.Array) -> pa.Array:
        return pa.array([merged((s["first"], s["last"]) for s in x) for x in spans.to_pylist()], _SPANS)

    return joined(spans)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with n_words, spans, items, n_hit, n_items and contaminated.

    ``spans`` are the merged first and last words of passages that occur, ``items``
    the ids, as sorted strings, of the items they are from, ``n_hit`` the words in
    spans. Null and empty texts have no words; items without words have no
    window; an item without id marks words but is not listed. Repeated documents
    and items are handled like any. Input columns of the six names are replaced.

    The benchmark goes to the executors in blocks of about ``BENCHMARK_BYTES`` bytes of
    text; beyond one block the documents are written between blocks, so memory
    does not grow with the benchmark.
    """
    docs = without(docs, "n_words", "spans", "items", "n_hit", "n_items", "contaminated")
    w = free_prefix(docs)
    given = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text"))
    # Repeated items are one; items of one text are dealt to the blocks by their ids.
    given = given.where(F.octet_length("text") > 0).distinct()
    blocks = (given.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BENCHMARK_BYTES + 1
    found = docs
    for b in range(blocks):
        if b:
            found = hand_over(found, "passages")
        part = given.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        phrases = phrases_of(((r["item"], r["text"]) for r in part.toLocalIterator()), window)
        found = _with_block(found, phrases, text, f"{w}{b}")
    names = [F.col(f"{w}{b}") for b in range(blocks)]
    spans = names[0]["spans"] if blocks == 1 else _merged(F.concat(*[n["spans"] for n in names]))
    items = F.array_sort(F.array_distinct(F.concat(*[n["items"] for n in names])))
    found = found.withColumns({w + "spans": spans, w + "items": items})
    hit = F.aggregate(w + "spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        *docs.columns,
        names[0]["n_words"].alias("n_words"),
        F.col(w + "spans").alias("spans"),
        F.col(w + "items").alias("items"),
        hit.alias("n_hit"),
        F.size(w + "items").cast("long").alias("n_items"),
        (hit > 0).alias("contaminated"),
    )


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the characters from the first to the last word of each span."""
    kept, done, at, spans = [], 0, 0, list(spans)
    for number, word in enumerate(_WORD.finditer(text)):
        if at < len(spans) and number == spans[at][0]:
            kept.append(text[done : word.start()])
        if at < len(spans) and number == spans[at][1]:
            done, at = word.end(), at + 1
    return b"".join([*kept, text[done:]])


def _without_spans(text: Column, spans: Column) -> Column:
    @F.arrow_udf("string")
    def left(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(_binary(texts), spans, strict=True)
        return pa.array([_cut_row(t.as_py(), x.as_py()) for t, x in pairs], pa.string())

    return left(text, spans)


def _cut_row(text: bytes | None, spans: list[dict] | None) -> str | None:
    return cut(text, [(s["first"], s["last"]) for s in spans]).decode() if text and spans else None


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` with the spans cut from the text, in the columns of ``docs``.

    A text without a hit stays as it is, byte for byte. A document of which no
    word is left goes; one that had no word to begin with stays.
    """
    w = free_prefix(docs)
    moved = docs.withColumnsRenamed({c: w + c for c in docs.columns})
    found = find(moved, benchmark, window, w + text, item, item_text)
    left = found.where(~F.col("contaminated") | (F.col("n_hit") < F.col("n_words")))
    whole = F.col(w + text)
    # Only texts with a hit go to Python a second time.
    hit = F.when(F.col("contaminated"), whole)
    body = F.when(F.col("contaminated"), _without_spans(hit, F.col("spans"))).otherwise(whole)
    return left.select(*[(body if c == text else F.col(w + c)).alias(c) for c in docs.columns])
