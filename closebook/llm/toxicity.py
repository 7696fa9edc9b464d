"""Toxicity by a convolutional classifier over hashed words, trained in numpy.

Words and their first letters are hashed to embeddings, so that unseen forms of
a known word are read too; filters of several widths run over the whole
text; the maximum of each filter is its feature; a logistic layer reads the
features. All labelled documents teach: each partition trains a copy of the
network for an epoch, and the copies are averaged. The threshold is calibrated
by language, which is told from the text itself, and the score is shifted so
that 0.5 is the threshold everywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.llm.common import free_prefix, small_batches, unit, without

#: Hash buckets, size of an embedding, filter widths, filters of each width.
BUCKETS, DIMS, WIDTHS, FILTERS = 1 << 15, 8, (1, 2, 3), 8
#: Documents a bucket must occur in to be learned.
LEAST_SEEN = 4
#: Labelled documents for each copy of the network that is trained on its own in an epoch.
SHARD_DOCS = 16384
#: Bits for each labelled key by which other documents are left out before the join, and the most keys.
KEY_BITS, MOST_KEYS = 8, 1 << 25
#: Languages whose words a task counts before it hands the counts on.
COUNTED = 64
#: Parts of 1 that parameters are averaged in, and their bound; parts of 1 that logits are counted
#: in. Whole numbers add up to the same in any order.
FINE, BOUND, STEPS = 1 << 32, 1 << 8, 1 << 10
EPOCHS, BATCH, RATE, DECAY = 3, 32, 0.01, 1e-4
#: Words that are convolved at once, bytes of a text that are hashed at once.
WORDS, BLOCK = 1 << 15, 1 << 20
#: Part of the labelled documents that only sets thresholds, and its least documents of a language.
CALIBRATED, LEAST_DOCS = 0.25, 40

_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Leading bytes of a word that are hashed beside the word, to buckets of their own.
STEM = 4
#: The symbol between documents; its embedding stays zero.
PAD = 2 * BUCKETS
ROWS = PAD + 1


def hashed_words(text: bytes | None) -> np.ndarray:
    """A row for each lower-cased word of a text: its bucket and its stem's; none for a null text."""
    text, at, parts = text or b"", 0, [np.zeros((0, 2), dtype=np.int32)]
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        words = text[at:end].translate(_PLAIN).split()
        whole = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS
        stems = np.fromiter((zlib.crc32(w[:STEM]) for w in words), np.int64, len(words)) % BUCKETS
        parts.append(np.stack((whole, stems + BUCKETS), axis=1).astype(np.int32))
        at = end
    return np.concatenate(parts)


@dataclass
class Model:
    """Embeddings, filters by (width, offset), output layer, and what tells a language."""

    embed: np.ndarray
    filters: dict[tuple[int, int], np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    language_words: np.ndarray
    offsets: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """For each offset, what a word adds to the filters that reach that far, widest last."""
        return [
            np.concatenate([self.embed @ self.filters[w, j] for w in WIDTHS if w > j], axis=1)
            for j in range(max(WIDTHS))
        ]


def _joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents in one row with room for the widest filter between them, and their places."""
    gap = np.full((max(WIDTHS) - 1, 2), PAD, dtype=np.int32)
    empty = np.full((1, 2), PAD, dtype=np.int32)
    docs = [d if len(d) else empty for d in docs]
    sizes = np.array([len(d) for d in docs])
    starts = np.cumsum(sizes + len(gap)) - sizes - len(gap)
    return np.concatenate([x for d in docs for x in (d, gap)]), np.stack((starts, starts + sizes), axis=1)


def _convolved(ids: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    whole, stems = ids.T
    total = tables[0][whole] + tables[0][stems]
    for j, table in enumerate(tables[1:], start=1):
        total[:-j, -table.shape[1] :] += table[whole[j:]] + table[stems[j:]]
    return total


def _features(ids: np.ndarray, places: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The greatest value of each filter in each document."""
    return np.maximum.reduceat(_convolved(ids, tables), places.ravel()[: places.size], axis=0)[::2]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


class _Adam:
    def __init__(self, first: np.ndarray, second: np.ndarray, steps: int):
        self.first, self.second, self.steps = first, second, steps

    def step(self, value: np.ndarray, slope: np.ndarray) -> None:
        self.steps += 1
        self.first += 0.1 * (slope - self.first)
        self.second += 0.001 * (slope * slope - self.second)
        rate = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        value -= rate * self.first / (np.sqrt(self.second) + 1e-8)


def _evidence(seen: np.ndarray, ones: float) -> np.ndarray:
    """By bucket: documents of label 1 above expectation, in standard deviations.

    ``seen`` counts documents by label and bucket, ``ones`` is the part of label 1 in all.
    """
    expected = seen.sum(axis=0) * ones
    return np.clip((seen[1] - expected) / np.sqrt(expected + 1), -6, 6) / 2


def _start(seen: np.ndarray, sizes: np.ndarray, seed: int) -> Model:
    """The network before the first epoch, by documents of a label and bucket and of a label."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (ROWS, DIMS)).astype(np.float32)
    # One component starts as the word's evidence; the rest is random. Words too rare to
    # learn from are like no word.
    embed[:, 0] = _evidence(seen, sizes[1] / max(1, sizes.sum()))
    embed[seen.sum(axis=0) < LEAST_SEEN] = 0
    shapes = {(w, j): (DIMS, FILTERS) for w in WIDTHS for j in range(w)}
    filters = {k: rng.normal(0, (DIMS * k[0]) ** -0.5, s).astype(np.float32) for k, s in shapes.items()}
    bias = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
    out = rng.normal(0, 0.1, len(bias)).astype(np.float32)
    return Model(embed, filters, bias, out, 0.0, np.zeros(0), np.zeros(0))


def _peaks(docs: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The greatest value of each filter in each document, and the words from where it is.

    About ``WORDS`` words are convolved at once; long documents are read in overlapping parts.
    """
    reach = max(WIDTHS) - 1
    parts = [(n, d[a : a + WORDS + reach]) for n, d in enumerate(docs) for a in range(0, max(1, len(d)), WORDS)]
    tops = np.full((len(docs), len(model.bias)), -np.inf, dtype=np.float32)
    at_top = np.full((len(docs), len(model.bias), reach + 1, 2), PAD, dtype=np.int32)
    while parts:
        size = np.cumsum([len(d) for _, d in parts])
        held, parts = parts[: (n := max(1, int((size <= WORDS).sum())))], parts[n:]
        ids, places = _joined([d for _, d in held])
        words, small = np.unique(ids, return_inverse=True)
        tables = replace(model, embed=model.embed[words]).tables()
        total = _convolved(small.reshape(ids.shape), tables)
        for (n, _), (a, b) in zip(held, places, strict=True):
            at = a + total[a:b].argmax(axis=0)
            top = total[at, np.arange(len(at))]
            better = top > tops[n]
            tops[n, better] = top[better]
            at_top[n, better] = ids[at[better, None] + np.arange(reach + 1)]
    return tops, at_top


def _nothing(like: Model) -> Model:
    """A model of the same shape that is all zero: moments before the first step."""
    filters = {k: np.zeros_like(v) for k, v in like.filters.items()}
    zeros = {"embed": np.zeros_like(like.embed), "bias": np.zeros_like(like.bias), "out": np.zeros_like(like.out)}
    return replace(like, **zeros, filters=filters, out_bias=0.0)


def _parts(model: Model) -> tuple[Model, np.ndarray]:
    """A copy whose parts can be changed, and its output bias as a part."""
    filters = {k: v.copy() for k, v in model.filters.items()}
    copies = {"embed": model.embed.copy(), "bias": model.bias.copy(), "out": model.out.copy()}
    return replace(model, **copies, filters=filters), np.array([model.out_bias], dtype=np.float32)


def learned(
    state: tuple[Model, Model, Model],
    steps: int,
    rare: np.ndarray,
    weights: np.ndarray,
    docs: Iterable[tuple[np.ndarray, int]],
) -> tuple[tuple[Model, Model, Model], np.ndarray, int]:
    """A network and its two moments after one pass over hashed documents and their labels, in how
    many batches each bucket was changed, and the number of batches.

    ``steps`` batches were seen before. Rare buckets are not learned.
    """
    (model, level), (first, first_level), (second, second_level) = map(_parts, state)
    embed, filters, bias, out = model.embed, model.filters, model.bias, model.out
    moves = {k: _Adam(first.filters[k], second.filters[k], steps) for k in filters}
    moves["embed"] = _Adam(first.embed, second.embed, steps)
    moves["bias"], moves["out"] = _Adam(first.bias, second.bias, steps), _Adam(first.out, second.out, steps)
    moves["level"] = _Adam(first_level, second_level, steps)
    changed, count = np.zeros(ROWS, dtype=np.int64), 0
    for batch in batched(docs, BATCH):
        labels = np.array([label for _, label in batch])
        tops, words = _peaks([ids for ids, _ in batch], model)
        top = tops + bias
        kept = np.maximum(top, 0)
        error = _sigmoid(kept @ out + level) - labels
        error = (error * weights[labels] / len(batch)).astype(np.float32)
        back = error[:, None] * out * (top > 0)
        slope = np.zeros_like(embed)
        for n, w in enumerate(WIDTHS):
            part = slice(n * FILTERS, (n + 1) * FILTERS)
            for j in range(w):
                word, pull = words[:, part, j], back[:, part]
                grad = np.einsum("bfpd,bf->df", embed[word], pull)
                share = pull[:, :, None] * filters[w, j].T
                np.add.at(slope, word[:, :, 0], share)
                np.add.at(slope, word[:, :, 1], share)
                moves[w, j].step(filters[w, j], grad + DECAY * filters[w, j])
        slope[rare] = 0
        slope[PAD] = 0
        changed += slope.any(axis=1)
        count += 1
        moves["embed"].step(embed, slope)
        moves["bias"].step(bias, back.sum(axis=0))
        moves["out"].step(out, kept.T @ error + DECAY * out)
        moves["level"].step(level, error.sum(keepdims=True))
    levels = ((model, level), (first, first_level), (second, second_level))
    return tuple(replace(m, out_bias=float(x[0])) for m, x in levels), changed, count


def train(docs: list[np.ndarray], labels: np.ndarray, seed: int) -> Model:
    """The network for hashed documents that are at hand; both labels weigh the same."""
    seen, sizes = np.zeros((2, ROWS)), np.bincount(labels, minlength=2)
    for doc, label in zip(docs, labels, strict=True):
        seen[label, np.unique(doc)] += 1
    model, rng = _start(seen, sizes, seed), np.random.default_rng(seed)
    state, steps, rare = (model, _nothing(model), _nothing(model)), 0, seen.sum(axis=0) < LEAST_SEEN
    for _ in range(EPOCHS):
        order = ((docs[i], labels[i]) for i in rng.permutation(len(docs)))
        state, _, count = learned(state, steps, rare, _balance(sizes), order)
        steps += count
    return state[0]


def _balance(sizes: np.ndarray) -> np.ndarray:
    """What a document of each label weighs, so that both labels weigh the same."""
    return sizes.sum() / (2.0 * np.maximum(sizes, 1))


def _rows(model: Model) -> np.ndarray:
    """All parameters as rows of ``DIMS`` numbers, those of the embedding first."""
    rest = [*(model.filters[k].ravel() for k in sorted(model.filters)), model.bias, model.out, [model.out_bias]]
    rest = np.concatenate(rest)
    return np.concatenate((model.embed, np.pad(rest, (0, -len(rest) % DIMS)).reshape(-1, DIMS)))


def _of_rows(rows: np.ndarray, like: Model) -> Model:
    """The model of the shape of another with these parameters."""
    rows = rows.astype(np.float32)
    names = sorted(like.filters)
    ends = np.cumsum([*(like.filters[k].size for k in names), len(like.bias), len(like.out)])
    *parts, bias, out, last = np.split(rows[ROWS:].ravel(), ends)
    filters = {k: p.reshape(like.filters[k].shape) for k, p in zip(names, parts, strict=True)}
    return replace(like, embed=rows[:ROWS], filters=filters, bias=bias, out=out, out_bias=float(last[0]))


def _logits(docs: list[np.ndarray], model: Model, tables: list[np.ndarray]) -> Iterator[float]:
    """Output of the network for each document, convolving about ``WORDS`` words at once."""
    held: list[np.ndarray] = []
    size = 0

    def read(held: list[np.ndarray]) -> np.ndarray:
        top = _features(*_joined(held), tables)
        return np.maximum(top + model.bias, 0) @ model.out + model.out_bias

    reach = max(WIDTHS) - 1
    for doc in docs:
        if len(doc) > WORDS:
            # A long text in overlapping parts: its features are the greatest of theirs.
            parts = [doc[a : a + WORDS + reach] for a in range(0, len(doc), WORDS)]
            if held:
                yield from read(held)
                held, size = [], 0
            top = np.max([_features(*_joined([p]), tables)[0] for p in parts], axis=0)
            yield float(np.maximum(top + model.bias, 0) @ model.out + model.out_bias)
            continue
        held.append(doc)
        size += len(doc)
        if size >= WORDS:
            yield from read(held)
            held, size = [], 0
    if held:
        yield from read(held)


def _language(doc: np.ndarray, language_words: np.ndarray) -> int:
    """The most probable language by the words' log probabilities; the first if there are none."""
    return int(language_words[doc[:, 0]].sum(axis=0).argmax()) if len(doc) else 0


def _packed(ids: np.ndarray) -> bytes:
    """Buckets of words and stems in two bytes each."""
    return (ids - [0, BUCKETS]).astype(np.uint16).tobytes()


def _unpacked(body: bytes) -> np.ndarray:
    return np.frombuffer(body, dtype=np.uint16).reshape(-1, 2).astype(np.int32) + np.array([0, BUCKETS], dtype=np.int32)


def _docs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, int]]:
    """Hashed documents and labels of batches of ids and labels."""
    for batch in batches:
        for body, label in zip(batch.column("ids"), batch.column("label").to_pylist(), strict=True):
            yield _unpacked(body.as_py()), label


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    seed: int = 11,
) -> Model:
    """A model from all labelled documents and their whole texts.

    Rows without key, label or text teach nothing; of a key's different labels the
    greatest counts, and of its different texts the one of the smallest hash (and of
    that text's languages the first), so neither repeated keys nor the order of the
    rows change the model; documents without language count for the shared threshold.
    A quarter of the documents, by a seeded hash of the key, only sets the thresholds;
    the others train the network, on as many partitions as their number asks for.
    Counts of words, parameters of the network and one threshold a language pass the
    driver. Without both labels the model scores every text by the label it has seen
    (0.5 if none).
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy(F.col(key).alias("sample_key")).agg(F.max(label).alias("label"))
    many = known.count()
    shards = max(1, -(-many // SHARD_DOCS))

    @F.arrow_udf("binary")
    def coded(texts: pa.Array) -> pa.Array:
        return pa.array([_packed(hashed_words(t.as_py())) for t in texts.cast(pa.binary())], pa.binary())

    # So named, it runs on the labelled rows and is not moved below the join to all documents.
    ids = coded.asNondeterministic()(F.col("text")).alias("ids")
    near = labelled(docs, known, many, key)
    rows = sampled(near, known, key, text, lang).select("sample_key", F.col("label").cast("int"), "lang", ids)
    held = unit(F.xxhash64(F.lit(seed), "sample_key")) < CALIBRATED
    rows = rows.withColumn("held", held).repartition(shards, "sample_key").persist(StorageLevel.DISK_ONLY)
    try:
        return _fitted(rows, shards, seed)
    finally:
        rows.unpersist()


def _fitted(rows: DataFrame, shards: int, seed: int) -> Model:
    """The model of one row for each key, of which each of so many partitions trains a copy."""
    sizes, marks = np.zeros(2, dtype=np.int64), set()
    for r in rows.groupBy("label", "held").count().collect():
        marks.add(r["label"])
        sizes[r["label"]] += 0 if r["held"] else r["count"]
    if len(marks) < 2:
        level = 0.0 if not marks else 30.0 if marks == {1} else -30.0
        none = {(w, j): np.zeros((DIMS, FILTERS), np.float32) for w in WIDTHS for j in range(w)}
        zero = np.zeros(FILTERS * len(WIDTHS), np.float32)
        return Model(
            np.zeros((ROWS, DIMS), np.float32), none, zero, zero, level, np.zeros((ROWS, 1)), np.zeros(1)
        )
    seen, names, words = _counts(rows)
    model, rare = _start(seen, sizes, seed), seen.sum(axis=0) < LEAST_SEEN
    own = rows.where(~F.col("held"))
    state, batches = (model, _nothing(model), _nothing(model)), int(sizes.sum()) // (shards * BATCH)
    for epoch in range(EPOCHS):
        order = F.xxhash64(F.lit(seed), F.lit(epoch), "sample_key")
        dealt = own.sortWithinPartitions(order, "sample_key").select("ids", "label")
        state = _averaged(dealt, state, epoch * batches, rare, _balance(sizes))
    model = state[0]
    spread = np.full((ROWS, max(1, len(names))), 0.05)
    spread[:BUCKETS] += words
    model = replace(model, language_words=np.log(spread / spread.sum(axis=0)).astype(np.float32))
    return replace(model, offsets=_offsets(rows.where("held").select("ids", "label"), model))


def _counts(rows: DataFrame) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Documents that train, by label and bucket of words and stems; languages; words by bucket and language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, words = np.zeros((2, ROWS), dtype=np.int64), {}

        def part(mark: int | None, name: str | None, found: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(found)
            columns = [pa.array([mark] * len(at), pa.int32()), pa.array([name] * len(at), pa.string())]
            columns += [pa.array(at, pa.int32()), pa.array(found[at], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["label", "lang", "bucket", "n"])

        for batch in batches:
            langs, held = batch.column("lang").to_pylist(), batch.column("held").to_pylist()
            for (doc, label), name, spared in zip(_docs([batch]), langs, held, strict=True):
                if not spared:
                    seen[label, np.unique(doc)] += 1
                if name:
                    own = words.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                    own += np.bincount(doc[:, 0], minlength=BUCKETS)
            if len(words) > COUNTED:
                yield from (part(None, name, found) for name, found in words.items())
                words = {}
        yield from (part(None, name, found) for name, found in words.items())
        yield from (part(mark, None, seen[mark]) for mark in (0, 1))

    found = rows.select("ids", "label", "lang", "held").mapInArrow(counted, "label int, lang string, bucket int, n long")
    found = found.groupBy("label", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    at, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    seen = np.zeros((2, ROWS))
    marks = found["label"].to_numpy(zero_copy_only=False)
    names = sorted({x for x in found["lang"].unique().to_pylist() if x})
    place = {name: i for i, name in enumerate(names)}
    langs = np.array([place.get(x, -1) for x in found["lang"].to_pylist()], dtype=np.int64)
    words = np.zeros((BUCKETS, max(1, len(names))))
    for mark in (0, 1):
        seen[mark, at[marks == mark]] = n[marks == mark]
    words[at[langs >= 0], langs[langs >= 0]] = n[langs >= 0]
    return seen, names, words


def _averaged(
    docs: DataFrame, state: tuple[Model, Model, Model], steps: int, rare: np.ndarray, weights: np.ndarray
) -> tuple[Model, Model, Model]:
    """The mean of the networks, and of their moments, that the partitions learn in one pass.

    A partition's row of the embedding weighs as many batches as changed it, the rest as
    many as it has.
    """
    shared = docs.sparkSession.sparkContext.broadcast((state, steps, rare, weights))
    columns = [f"v{i}" for i in range(DIMS)]

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, changed, count = learned(*shared.value, _docs(batches))
        if not count:
            return
        rows = _state_rows(new)
        weight = np.tile(np.concatenate((changed, np.full(len(rows) // len(new) - ROWS, count))), len(new))
        at = np.flatnonzero(weight)
        fine = np.rint(np.clip(rows[at], -BOUND, BOUND) * FINE).astype(np.int64) * weight[at, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(weight[at]), *(pa.array(c) for c in fine.T.copy())],
            names=["at", "weight", *columns],
        )

    found = docs.mapInArrow(passed, "at int, weight long, " + ", ".join(f"{c} long" for c in columns))
    sums = found.groupBy("at").agg(F.sum("weight").alias("weight"), *(F.sum(c).alias(c) for c in columns)).toArrow()
    shared.unpersist()
    rows = _state_rows(state)
    total = np.stack([sums[c].to_numpy() for c in columns], axis=1)
    rows[sums["at"].to_numpy()] = total / sums["weight"].to_numpy()[:, None] / FINE
    model, first, second = (_of_rows(part, like) for part, like in zip(np.split(rows, len(state)), state, strict=True))
    return model, first, _of_rows(_rows(second) ** 2, second)


def _state_rows(state: tuple[Model, Model, Model]) -> np.ndarray:
    """Rows of a network, of its first moments and of the roots of its second, which are squares."""
    model, first, second = map(_rows, state)
    return np.concatenate((model, first, np.sqrt(second))).astype(np.float64)


def _offsets(docs: DataFrame, model: Model) -> np.ndarray:
    """For each language the threshold with the most right answers, the middle of such thresholds.

    Logits are counted in steps of 1 / ``STEPS``. A language with too few documents, or without
    both labels, takes the threshold of all.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, model.tables()))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batched(_docs(batches), 256):
            ids, marks = [ids for ids, _ in some], [label for _, label in some]
            logits = np.fromiter(_logits(ids, *shared.value), float, len(ids))
            spoken = [_language(d, shared.value[0].language_words) for d in ids]
            columns = [pa.array(spoken, pa.int32()), pa.array(np.rint(logits * STEPS).astype(np.int64)), pa.array(marks, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["spoken", "step", "label"])

    found = docs.mapInArrow(judged, "spoken int, step long, label long").groupBy("spoken", "step")
    found = found.agg(F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros"))
    found = found.withColumn("spoken", F.explode(F.array(F.lit(-1), "spoken"))).groupBy("spoken", "step")
    found = found.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    own = Window.partitionBy("spoken")
    order = own.orderBy("step")
    below = F.sum("zeros").over(order) - F.col("zeros")
    above = F.sum("ones").over(own) - F.sum("ones").over(order)
    # Twice the cut below each step, and above the last one.
    between = F.lag("step").over(order) + F.col("step")
    cut = F.struct((below + above + F.col("ones")).alias("right"), F.coalesce(between, 2 * F.col("step") - 2 * STEPS).alias("twice"))
    end = F.struct(F.sum("zeros").over(own).alias("right"), (2 * F.col("step") + 2 * STEPS).alias("twice"))
    sums = (F.sum("ones").over(own).alias("ones"), F.sum("zeros").over(own).alias("zeros"))
    cuts = found.select("spoken", *sums, F.array(cut, F.when(F.lead("step").over(order).isNull(), end)).alias("cuts"))
    cuts = cuts.select("spoken", "ones", "zeros", F.explode("cuts").alias("cut")).where("cut is not null")
    best = cuts.groupBy("spoken", "ones", "zeros", "cut.right").agg(F.avg(F.col("cut.twice").cast("double")).alias("twice"))
    best = best.groupBy("spoken", "ones", "zeros").agg(F.max_by("twice", "right").alias("twice"))
    found = {r["spoken"]: r for r in best.collect()}
    shared.unpersist()
    common = found[-1]["twice"] / 2 / STEPS if found else 0.0
    offsets = np.full(model.language_words.shape[1], common)
    for n, r in found.items():
        if n >= 0 and r["ones"] + r["zeros"] >= LEAST_DOCS and r["ones"] and r["zeros"]:
            offsets[n] = r["twice"] / 2 / STEPS
    return offsets


def labelled(docs: DataFrame, known: DataFrame, many: int, key: str) -> DataFrame:
    """The documents whose key may be one of the ``many`` labelled ones: all of these, few others.

    A bit for each hash of a key, ``KEY_BITS`` bits a key, spares the other texts the shuffle
    of the join. More keys than ``MOST_KEYS``, and keys of two types, are left to the join alone.
    """
    if not 0 < many <= MOST_KEYS or docs.select(key).schema[0].dataType != known.schema["sample_key"].dataType:
        return docs
    w = free_prefix(docs)
    place = F.pmod(F.xxhash64("sample_key"), F.lit(many * KEY_BITS))
    bits = known.select(F.bitmap_bucket_number(place).alias(w + "part"), F.bitmap_bit_position(place).alias("bit"))
    bits = bits.groupBy(w + "part").agg(F.bitmap_construct_agg("bit").alias(w + "bits"))
    own = F.pmod(F.xxhash64(F.col(key)), F.lit(many * KEY_BITS))
    met = docs.withColumn(w + "part", F.bitmap_bucket_number(own)).withColumn(w + "bit", F.bitmap_bit_position(own))
    met = met.join(F.broadcast(bits), w + "part")
    byte = F.conv(F.hex(F.substring(w + "bits", F.floor(F.col(w + "bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.getbit(byte, (F.col(w + "bit") % 8).cast("int")) == 1
    return met.where(set_).select(*docs.columns)


def sampled(docs: DataFrame, known: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """sample_key, label, text and lang: one row for each labelled key that has a text."""
    own = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("own_key"), F.struct(F.xxhash64(text).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text")).alias("own")
    )
    met = own.join(known, F.col("own_key") == F.col("sample_key"))
    # Copies of a key are one row for each task before the shuffle.
    one = met.groupBy("sample_key", "label").agg(F.min("own").alias("own"))
    return one.select("sample_key", "label", "own.text", "own.lang")


def scores(texts: Iterable[bytes | None], model: Model, tables: list[np.ndarray]) -> list[float]:
    """Score of each text, 0 to 1, 0.5 at the threshold of the text's language."""
    docs = [hashed_words(t) for t in texts]
    logits = np.fromiter(_logits(docs, model, tables), float, len(docs))
    spoken = [_language(d, model.language_words) for d in docs]
    return _sigmoid(logits - model.offsets[spoken]).tolist()


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is 0.5 or more).

    Whole texts are read; null and empty texts are scored as texts without words.
    Input columns of the two names are replaced.
    """
    small_batches(docs.sparkSession)
    docs = without(docs, "score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast((model, model.tables()))

    @F.arrow_udf("double")
    def judged(texts: pa.Array) -> pa.Array:
        binary = texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary())
        found: list[float] = []
        for a in range(0, len(binary), 256):
            found += scores((t.as_py() for t in binary[a : a + 256]), *shared.value)
        return pa.array(found, pa.float64())

    w = free_prefix(docs)
    found = docs.withColumn(w + "score", judged(F.col(text)))
    found = found.withColumn("predicted", (F.col(w + "score") >= 0.5).cast("int"))
    return found.select(*docs.columns, F.col(w + "score").alias("score"), "predicted")
