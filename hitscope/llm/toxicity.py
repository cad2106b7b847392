"""Toxicity by a convolutional text classifier (operator 5).

A word is the sum of hashed embeddings: of the word and of its first bytes, so that endings it
was not trained with still share its stem. Filters over one, two and three consecutive words,
max pooling over the whole text and a logistic layer give a probability. The model is learned from every
labelled row that is not held out, but for a quarter that calibrates. It starts from a fit in numpy on the driver
(at most ``SAMPLE`` rows of each label, texts of any length: a word is one number there, and what it hashes to is
kept once a distinct word). Then the tasks count the rows that each bucket occurs in, which tells what gets an
embedding, and train that model on all rows, each task on a shard of about ``SHARD`` rows, both labels weighing the
same in all; what the shards changed is averaged in Spark (an embedding over the shards that changed it). The driver
and a task hold one model of fixed size (``BUCKETS`` x ``WIDTH`` floats); the tasks score whole texts with it.

Thresholds are calibrated by language on all labelled rows that were not trained on, in ``BINS`` bins of the
probability. The
language is guessed from function words in the text; no column but the text enters a score.
A probability is then rescaled so that its language's threshold becomes ``DECISION``.

Defined results: null text counts as empty; a text without words scores what the bias gives;
rows are independent, so repeated rows and ties need no rule; labels that are null are not
learned from, and of several labels of a document the largest holds; without labels of both
kinds every score is 0; an empty table gives an empty table; a text of any length is scored whole, in memory in
proportion to the longest text of a slice; only doc_id and the text column are
read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from hitscope.llm.textio import Words, mix, slices, words
from hitscope.session import scratch_path

DECISION = 0.7
#: Labelled rows of each label that the fit starts from, of any length.
SAMPLE = 3000
#: Labelled rows in a shard of the training on all rows.
SHARD = 4000
#: Rate of the training on all rows.
SHARD_RATE = 0.05
#: Times that a shard goes over its rows: once, but more often the fewer rows there are in all (as long as they are below STEPS * BATCH).
PASSES = 8
#: Parts in which counts and changed embeddings are summed.
PARTS = 16
#: Bins of the probability in which labels are counted for a threshold.
BINS = 1 << 10
#: Parts in which the sample comes to the driver, one after the other.
SAMPLE_PARTS = 16
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
WIDTH = 12
FILTERS = 12
SIZES = (1, 2, 3)
STEMS = (4, 5, 6)
#: Training rows that a bucket must occur in to get an embedding.
LEAST_ROWS = 6
#: Training steps, whatever the size of the sample.
STEPS = 1000
BATCH = 50
SLICE_BYTES = 1 << 20
# Frequent function words by which the language of a text is guessed.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "is", "that", "it", "for", "was", "on", "with", "as", "be", "this"],
    "fr": ["le", "les", "et", "des", "du", "une", "que", "dans", "est", "pour", "qui", "sur", "pas", "au"],
    "de": ["der", "die", "und", "den", "das", "von", "zu", "mit", "ist", "sich", "des", "auf", "für", "nicht"],
    "es": ["el", "los", "y", "que", "del", "las", "por", "un", "con", "no", "una", "su", "para", "es"],
}
LANGUAGES = [*FUNCTION_WORDS, "other"]

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _features(found: Words) -> np.ndarray:
    """Buckets of each word: the word itself and its stems of ``STEMS`` bytes."""
    out = np.empty((len(found.start), 1 + len(STEMS)), np.int64)
    length = found.end - found.start
    out[:, 0] = found.hashes(lower=True) >> np.uint64(64 - BUCKET_BITS)
    stem = np.zeros(len(found.start), np.uint64)
    for k in range(max(STEMS)):
        has = length > k
        byte = np.zeros(len(stem), np.uint64)
        byte[has] = _LOWER[found.data[found.start[has] + k]]
        stem = stem * np.uint64(257) + byte + np.uint64(1)
        if k + 1 in STEMS:
            out[:, 1 + STEMS.index(k + 1)] = mix(stem ^ np.uint64(k)) >> np.uint64(64 - BUCKET_BITS)
    return out


_HINTS = {name: words(pa.array(listed)).hashes() for name, listed in FUNCTION_WORDS.items()}


def _languages(found: Words) -> np.ndarray:
    """Index in LANGUAGES of each text: most function words, at least three."""
    hashes = found.hashes(lower=True)
    counts = np.empty((len(found.first) - 1, len(_HINTS)), np.int64)
    for i, hints in enumerate(_HINTS.values()):
        sums = np.append(0, np.cumsum(np.isin(hashes, hints)))
        counts[:, i] = np.diff(sums[found.first])
    best = counts.argmax(1)
    return np.where(counts.max(1) >= 3, best, len(LANGUAGES) - 1)


@dataclass
class Model:
    embeddings: np.ndarray
    filters: list[np.ndarray]  # per size: (size, WIDTH, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    thresholds: np.ndarray = field(default_factory=lambda: np.full(len(LANGUAGES), 0.5))

    def pooled(self, vectors: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
        """Max over each text's positions; vectors have max(SIZES) zero rows after each text."""
        out, where = [], []
        n = len(first) - 1
        past = (first[1:, None] - np.arange(1, max(SIZES))).ravel()  # windows from here would reach the next text
        for size, kernel, bias in zip(SIZES, self.filters, self.biases, strict=True):
            scores = vectors @ kernel[0]
            for j in range(1, size):
                scores[:-j] += vectors[j:] @ kernel[j]
            scores += bias
            scores[past] = -np.inf
            top = np.maximum.reduceat(scores, first[:-1], axis=0)
            out.append(np.maximum(top, 0))
            where.append(scores)
        return np.concatenate(out, 1).reshape(n, -1), where

    def vectors(self, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word vectors with zero rows after each text, the texts' offsets in them, and the words' rows."""
        pad = max(SIZES)
        rows = np.arange(len(buckets)) + pad * np.repeat(np.arange(len(first) - 1), np.diff(first))
        out = np.zeros((len(buckets) + pad * (len(first) - 1), WIDTH), np.float32)
        total = self.embeddings[buckets[:, 0]]
        for k in range(1, buckets.shape[1]):
            total = total + self.embeddings[buckets[:, k]]
        out[rows] = total
        return out, first + pad * np.arange(len(first)), rows

    def probabilities(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        vectors, at, _ = self.vectors(buckets, first)
        pooled, _ = self.pooled(vectors, at)
        return 1 / (1 + np.exp(-(pooled @ self.weights + self.bias)))

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = words(texts, _APART)
        p = self.probabilities(_features(found), found.first)
        cut = self.thresholds[_languages(found)]
        return np.where(p < cut, DECISION * p / cut, DECISION + (1 - DECISION) * (p - cut) / (1 - cut))


def _fit(texts: list[tuple[np.ndarray, int]], known_words: np.ndarray, seed: int = 11) -> Model:
    """Adagrad on the logistic loss; the gradient of a max goes to the position that has it. Texts are rows of ``known_words``."""
    rng = np.random.default_rng(seed)
    seen = np.zeros(BUCKETS, np.int32)
    for ids, _ in texts:
        seen[np.unique(known_words[np.unique(ids)])] += 1
    known = seen >= LEAST_ROWS
    model = Model(
        np.where(known[:, None], rng.normal(0, 0.1, (BUCKETS, WIDTH)), 0).astype(np.float32),
        [rng.normal(0, 0.3, (s, WIDTH, FILTERS)).astype(np.float32) for s in SIZES],
        [np.zeros(FILTERS, np.float32) for _ in SIZES],
        rng.normal(0, 0.3, FILTERS * len(SIZES)),
        0.0,
    )
    order = np.concatenate([rng.permutation(len(texts)) for _ in range(-(-STEPS * BATCH // len(texts)))])
    _descend(model, [[texts[i] for i in order[a : a + BATCH]] for a in range(0, STEPS * BATCH, BATCH)], known_words, known)
    return model


def _descend(model: Model, batches: Iterable[list[tuple[np.ndarray, int]]], known_words: np.ndarray, known: np.ndarray, rate: float = 0.15, weigh: tuple[float, float] = (1.0, 1.0)) -> None:
    """Steps of the model, one a batch of texts and labels, which count as much as ``weigh`` says."""
    squares = {"e": np.full(BUCKETS, 0.1), "w": np.full(len(model.weights), 0.1), "b": 0.1} | {("f", i): np.full(k.shape, 0.1) for i, k in enumerate(model.filters)} | {("c", i): np.full(FILTERS, 0.1) for i in range(len(SIZES))}
    decay = 1e-4
    for batch in batches:
        buckets = known_words[np.concatenate([b for b, _ in batch])]
        first = np.append(0, np.cumsum([len(b) for b, _ in batch]))
        label = np.array([y for _, y in batch], float)
        vectors, at, rows = model.vectors(buckets, first)
        pooled, scores = model.pooled(vectors, at)
        error = (1 / (1 + np.exp(-(pooled @ model.weights + model.bias))) - label) / len(batch) * np.where(label > 0, weigh[1], weigh[0])
        down = (error[:, None] * model.weights) * (pooled > 0)
        word_of = np.full(len(vectors) + max(SIZES), -1)
        word_of[rows] = np.arange(len(rows))
        grad_words: list[np.ndarray] = []
        grad_rows: list[np.ndarray] = []
        for i, size in enumerate(SIZES):
            part = down[:, i * FILTERS : (i + 1) * FILTERS]
            spot = np.stack([scores[i][x:y].argmax(0) + x for x, y in zip(at[:-1], at[1:], strict=True)])
            grad = np.zeros(model.filters[i].shape)
            text, unit = np.nonzero(part)
            g, t = part[text, unit], spot[text, unit]
            for j in range(size):
                here = np.minimum(t + j, len(vectors) - 1)
                np.add.at(grad[j].T, unit, vectors[here] * g[:, None])
                grad_rows.append(word_of[t + j])
                grad_words.append(model.filters[i][j].T[unit] * g[:, None])
            grad += decay * model.filters[i]
            squares["f", i] += grad**2
            model.filters[i] -= (rate * grad / np.sqrt(squares["f", i])).astype(np.float32)
            bias = part.sum(0)
            squares["c", i] += bias**2
            model.biases[i] -= (rate * bias / np.sqrt(squares["c", i])).astype(np.float32)
        weights = pooled.T @ error + decay * model.weights
        squares["w"] += weights**2
        model.weights = model.weights - rate * weights / np.sqrt(squares["w"])
        squares["b"] += error.sum() ** 2
        model.bias -= rate * error.sum() / np.sqrt(squares["b"])
        word, change = np.concatenate(grad_rows), np.concatenate(grad_words)
        word, change = word[word >= 0], change[word >= 0]
        bucket = buckets[word].ravel()
        change = np.repeat(change, buckets.shape[1], 0)
        change, bucket = change[known[bucket]], bucket[known[bucket]]
        own, place = np.unique(bucket, return_inverse=True)
        total = np.zeros((len(own), WIDTH))
        np.add.at(total, place, change)
        squares["e"][own] += (total**2).sum(1)
        model.embeddings[own] -= (rate * total / np.sqrt(squares["e"][own])[:, None]).astype(np.float32)


def _cut(bins: list) -> float:
    """The probability that parts the labels best by F1, in the middle of the gap it stands in; ``bins`` are rows of
    the bin, the label, how many rows it has, and their least and largest probability."""
    found = sorted({r.bin for r in bins}, reverse=True)
    at = {k: i for i, k in enumerate(found)}
    hits, rows, low, high = np.zeros(len(found)), np.zeros(len(found)), np.ones(len(found)), np.zeros(len(found))
    for r in bins:
        i = at[r.bin]
        hits[i] += r.n * r.y
        rows[i] += r.n
        low[i], high[i] = min(low[i], r.low), max(high[i], r.high)
    f1 = 2 * np.cumsum(hits) / (np.cumsum(rows) + hits.sum())
    best = int(f1.argmax())
    below = high[best + 1] if best + 1 < len(found) else 0.0
    return float(np.clip((low[best] + below) / 2, 0.05, 0.95))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _labelled(documents: DataFrame, labels: DataFrame, text: str, label: str) -> DataFrame:
    """doc_id, y, text of every labelled document that is not held out (the largest text of an id), stored."""
    marked = labels.where(~is_held_out(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = documents.select(F.col("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    rows = chosen.join(marked.where("y IN (0, 1)"), "doc_id").groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text"))
    path = scratch_path(documents.sparkSession, "toxicity_rows")
    rows.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(rows.schema).parquet(path)


def train(documents: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic") -> Model | None:
    """A model from all labelled rows that are not held out; None without both labels."""
    spark = documents.sparkSession
    labelled = _labelled(documents, labels, text, label)
    chance = F.xxhash64("doc_id")
    sample = None
    for y in (0, 1):
        drawn = labelled.where(F.col("y") == y).select("doc_id").orderBy(chance, "doc_id").limit(SAMPLE)
        sample = drawn if sample is None else sample.union(drawn)
    # at most 2 * SAMPLE ids are broadcast, and one text of each comes back
    found = labelled.join(F.broadcast(sample), "doc_id").select("doc_id", "y", _sample_features("text").alias("found"))
    numbers: dict[bytes, int] = {}
    rows = []
    path = scratch_path(spark, "toxicity_sample")
    found.write.parquet(path)
    for r in spark.read.parquet(path).repartition(SAMPLE_PARTS, "doc_id").toLocalIterator():
        ids = _numbered(np.frombuffer(r.found.buckets, np.int32).reshape(-1, 1 + len(STEMS)), numbers)
        rows.append((r.doc_id, r.y, ids))
    rows.sort(key=lambda r: r[0])
    if len({y for _, y, _ in rows}) < 2:
        return None
    held = [i % 4 == 3 for i in range(len(rows))]
    model = _fit([(ids, y) for (_, y, ids), h in zip(rows, held, strict=True) if not h], _listed(numbers))
    start = spark.createDataFrame([(r[0], h) for r, h in zip(rows, held, strict=True)], f"doc_id {labelled.schema['doc_id'].dataType.simpleString()}, held boolean")
    # what the start was fitted on does not calibrate
    split = labelled.join(F.broadcast(start), "doc_id", "left").withColumn("held", F.coalesce("held", F.pmod(chance, F.lit(4)) == 3))
    _train_on_all(model, split.where(~F.col("held")).select("doc_id", "y", "text"))
    _calibrate(model, split.where("held").select("y", "text"))
    return model


def _numbered(buckets: np.ndarray, numbers: dict[bytes, int]) -> np.ndarray:
    """A number for each word by what it hashes to; new ones go to ``numbers``."""
    own, at = np.unique(buckets, axis=0, return_inverse=True)
    ids = np.array([numbers.setdefault(w.tobytes(), len(numbers)) for w in own], np.int32)
    return ids[at.ravel()] if len(ids) else ids


def _listed(numbers: dict[bytes, int]) -> np.ndarray:
    return np.frombuffer(b"".join(numbers), np.int32).reshape(-1, 1 + len(STEMS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each bucket occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for rows in slices(batches, "text", SLICE_BYTES):
        found = words(rows.column("text"), _APART)
        buckets = _features(found)
        text = np.repeat(found.doc, buckets.shape[1])
        both = np.unique(text * BUCKETS + buckets.ravel())
        total += np.bincount(both % BUCKETS, minlength=BUCKETS)
    parts = [p.tobytes() for p in total.reshape(PARTS, -1)]
    yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])


def _counts_summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}  # at most PARTS entries of fixed size
    for rows in batches:
        for part, counts in zip(*(rows.column(i).to_pylist() for i in range(2)), strict=True):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["part", "counts"])


def _dense(model: Model) -> np.ndarray:
    """All numbers of a model but its embeddings."""
    return np.concatenate([*[k.ravel() for k in model.filters], *model.biases, model.weights, [model.bias]]).astype(np.float64)


def _set_dense(model: Model, values: np.ndarray) -> None:
    at = 0
    for group in (model.filters, model.biases):
        for i, k in enumerate(group):
            group[i] = values[at : at + k.size].reshape(k.shape).astype(np.float32)
            at += k.size
    model.weights, model.bias = values[at:-1].copy(), float(values[-1])


_CHANGE = "part int, shard int, rows long, buckets binary, change binary"


def _shard(shared, known, weigh: tuple[float, float], passes: int):
    """Trains the model on the rows of a partition (``passes`` times): what it changed, the embeddings in ``PARTS`` parts and the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        texts: list[tuple[np.ndarray, int]] = []
        for rows in slices(batches, "text", SLICE_BYTES):
            found = words(rows.column("text"), _APART)
            ids = _numbered(_features(found).astype(np.int32), numbers)  # a text is one number a word
            texts += [(ids[a:b], y) for a, b, y in zip(found.first[:-1], found.first[1:], rows.column("y").to_pylist(), strict=True)]
        if not texts:
            return
        before = shared.value
        model = Model(before.embeddings.copy(), [k.copy() for k in before.filters], [b.copy() for b in before.biases], before.weights.copy(), before.bias)
        _descend(model, (texts[a : a + BATCH] for _ in range(passes) for a in range(0, len(texts), BATCH)), _listed(numbers), known.value, SHARD_RATE, weigh)
        shard = TaskContext.get().partitionId()
        changed = np.flatnonzero((model.embeddings != before.embeddings).any(1))
        part = changed // (BUCKETS // PARTS)
        out = [(p, shard, len(texts), changed[part == p].tobytes(), (model.embeddings - before.embeddings)[changed[part == p]].tobytes()) for p in range(PARTS)]
        out.append((PARTS, shard, len(texts), b"", (_dense(model) - _dense(before)).tobytes()))
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["part", "shard", "rows", "buckets", "change"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean change of a part by the shards' rows, in the order of the shards."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # at most PARTS + 1 entries of fixed size
    for rows in batches:
        for r in rows.to_pylist():
            if r["part"] == PARTS:
                own, change = slice(None), np.frombuffer(r["change"], np.float64)
                total, weight = sums.setdefault(PARTS, (np.zeros(len(change)), np.zeros(1)))
            else:
                own, change = np.frombuffer(r["buckets"], np.int64) % (BUCKETS // PARTS), np.frombuffer(r["change"], np.float32).reshape(-1, WIDTH)
                total, weight = sums.setdefault(r["part"], (np.zeros((BUCKETS // PARTS, WIDTH)), np.zeros((BUCKETS // PARTS, 1))))
            total[own] += change * float(r["rows"])
            weight[own] += r["rows"]
    means = [(total / np.maximum(weight, 1)).tobytes() for total, weight in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(means, pa.binary())], ["part", "change"])


def _train_on_all(model: Model, rows: DataFrame) -> None:
    """Trains the started model on every row (doc_id, y, text), in shards whose changes are averaged."""
    context = rows.sparkSession.sparkContext
    labels = {r.y > 0: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(labels) < 2:
        return
    n = sum(labels.values())
    seen = np.zeros(BUCKETS, np.int64)
    counts = rows.select("text").mapInArrow(_counted, "part int, counts binary").repartition(PARTS, "part").mapInArrow(_counts_summed, "part int, counts binary")
    for part, summed in counts.collect():
        seen.reshape(PARTS, -1)[part] = np.frombuffer(summed, np.int64)
    known = seen >= LEAST_ROWS
    # words that the start had no embedding for
    new = known & ~model.embeddings.any(1)
    model.embeddings[new] = np.random.default_rng(12).normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)[new]
    shards = -(-n // SHARD)
    weigh = (n / (2 * labels[False]), n / (2 * labels[True]))
    dealt = rows.repartition(shards, "doc_id").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("y", "text")
    passes = max(1, min(PASSES, STEPS * BATCH // n))
    changes = dealt.mapInArrow(_shard(context.broadcast(model), context.broadcast(known), weigh, passes), _CHANGE)
    means = changes.repartition(PARTS + 1, "part").sortWithinPartitions("part", "shard").mapInArrow(_averaged, "part int, change binary")
    after = model.embeddings.copy()
    for part, change in means.collect():
        if part == PARTS:
            dense = _dense(model) + np.frombuffer(change, np.float64)
        else:
            after.reshape(PARTS, -1, WIDTH)[part] += np.frombuffer(change, np.float64).reshape(-1, WIDTH).astype(np.float32)
    model.embeddings = after
    _set_dense(model, dense)


def _calibrate(model: Model, rows: DataFrame) -> None:
    """The thresholds, from every row (y, text) that has words."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            found = words(part.column("text"), _APART)
            p = shared.value.probabilities(_features(found), found.first)
            own = np.flatnonzero(np.diff(found.first))
            columns = [part.column("y").take(pa.array(own)), pa.array(_languages(found)[own].astype(np.int32)), pa.array(p[own].astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, ["y", "language", "p"])

    tested = rows.mapInArrow(run, "y int, language int, p double")
    bin_ = F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin")
    # at most BINS rows a language and label
    bins = tested.groupBy("language", F.col("y").cast("boolean").cast("int").alias("y"), bin_).agg(F.count("*").alias("n"), F.min("p").alias("low"), F.max("p").alias("high")).collect()
    overall = _cut(bins) if any(r.y for r in bins) else 0.5
    for i in range(len(LANGUAGES)):
        own = [r for r in bins if r.language == i]
        enough = min(sum(r.n for r in own if r.y == y) for y in (0, 1)) >= 20
        model.thresholds[i] = _cut(own) if enough else overall


@F.arrow_udf(StructType([StructField("buckets", BinaryType()), StructField("language", IntegerType())]))
def _sample_features(texts: pa.Array) -> pa.Array:
    found = words(texts, _APART)
    buckets, first = _features(found).astype(np.int32), found.first
    packed = [buckets[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
    return pa.StructArray.from_arrays([pa.array(packed, pa.binary()), pa.array(_languages(found).astype(np.int32))], ["buckets", "language"])


def score(documents: DataFrame, model: Model | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns and the score (column ``name``) of every row."""
    source = documents.select(*keep, F.col(text).alias("__text"))
    if model is None:
        return source.select(*keep, F.lit(0.0).alias(name))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "__text", SLICE_BYTES):
            found = shared.value.scores(rows.column("__text"))
            yield pa.RecordBatch.from_arrays([rows.column(k) for k in keep] + [pa.array(found)], [*keep, name])

    fields = ", ".join(f"`{k}` {documents.schema[k].dataType.simpleString()}" for k in keep)
    return source.mapInArrow(run, f"{fields}, `{name}` double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(documents, train(documents, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))


def clean_documents(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with their columns."""
    kept = score(documents, train(documents, labels, text), text, tuple(documents.columns), "__score")
    return kept.where(F.col("__score") < DECISION).select(*documents.columns)
