"""Quality by nearest-neighbour voting in a latent-semantic space (operator 13).

A text has two kinds of features, hashed into buckets: its words (lower case), and the shapes of
its tokens (classes of characters with runs as one, and whether a token repeats the one before).
Word counts are weighted by log frequency and rarity, shapes by the root of their share; each kind
has a fixed part of the vector's length. A truncated singular value decomposition of the labelled
sample (randomised, numpy on the driver) gives ``DIMS`` latent dimensions.

The sample's latent vectors and labels are broadcast (``2 * SAMPLE`` rows of ``DIMS`` floats, a fixed
size). Every document is projected, its cosines with all of them are computed exactly in blocks,
and its ``NEIGHBOURS`` nearest vote, weighted by a power of their similarity. Both labels have equal
numbers in the sample as far as there are so many, so a vote of one half is no evidence.

The sample is bounded by rows: at most ``SAMPLE`` of each label, whole texts of any length, sent as counts by bucket
(at most ``WORD_BUCKETS + SHAPE_BUCKETS`` a text).

Defined results: null text counts as empty; a text without features gets the share of label 1 among all
labelled rows that are learned from; without such rows every score is 0; labels that are null are not
learned from, and of several labels of a document the largest holds; rows of one doc_id with different texts
are different rows, equal rows count once in the sample and each get their score; equal cosines are cut by place in the sample; a text of any length is read whole; an empty table gives
an empty table; only doc_id and the text column are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from hitscope.llm.textio import Words, slices, words

DECISION = 0.7
#: Labelled rows of each label that are kept.
SAMPLE = 2000
WORD_BUCKETS = 1 << 13
SHAPE_BUCKETS = 1 << 11
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
#: Share of a vector's squared length that the shapes have.
SHAPE_SHARE = 0.75
DIMS = 32
NEIGHBOURS = 25
#: A neighbour's vote is its similarity to this power.
SHARPNESS = 4
BLOCK = 256
#: Products of a feature and a dimension that are held at once.
STEP = 1 << 17
SLICE_BYTES = 1 << 20

_APART = np.ones(256, bool)
_APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = ord("A"), ord("a"), ord("a"), ord("0")
#: The bucket of tokens that repeat the one before.
_AGAIN = BUCKETS - 1


@dataclass
class Counts:
    """Distinct buckets and their counts of each text, one text after the other."""

    first: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def _shapes(found: Words) -> np.ndarray:
    """One hash for the shape of every token."""
    kind = _CLASS[found.data]
    inside = np.zeros(len(kind) + 1, np.int8)
    inside[found.start] += 1
    np.add.at(inside, found.end, -1)
    keep = np.cumsum(inside, dtype=np.int8)[:-1] > 0
    same = np.append(False, kind[1:] == kind[:-1])[: len(kind)]
    same[found.start] = False
    keep &= ~same
    sums = np.append(0, np.cumsum(keep))
    return Words(kind[keep], sums[found.start], sums[found.end], found.first, found.breaks).hashes()


def counts(texts: pa.Array) -> Counts:
    tokens, found = words(texts), words(texts, _APART)
    hashes = found.hashes(lower=True)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (found.doc[1:] == found.doc[:-1])) + 1
    n = len(found.first) - 1
    doc = np.concatenate([found.doc, tokens.doc, found.doc[again]])
    shapes = WORD_BUCKETS + (_shapes(tokens) % np.uint64(SHAPE_BUCKETS - 1)).astype(np.int64)
    bucket = np.concatenate([(hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), shapes, np.full(len(again), _AGAIN)])
    key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    return Counts(np.searchsorted(key, np.arange(n + 1) * BUCKETS), key % BUCKETS, count)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each text's values; texts without any have 0."""
    total = np.append(0, np.cumsum(values, dtype=np.float64))
    return total[first[1:]] - total[first[:-1]]


def _weights(found: Counts, rarity: np.ndarray) -> np.ndarray:
    """Weight of each feature: the vector of a text with both kinds has length 1."""
    word = found.bucket < WORD_BUCKETS
    value = np.where(word, (1 + np.log(found.count)) * rarity[found.bucket], np.sqrt(found.count)).astype(np.float64)
    size = np.diff(found.first)
    for kind, share in ((word, 1 - SHAPE_SHARE), (~word, SHAPE_SHARE)):
        norm = np.sqrt(_sums(np.where(kind, value**2, 0), found.first) / share)
        value = np.where(kind, value / np.repeat(np.where(norm > 0, norm, 1), size), value)
    return value


def _product(first: np.ndarray, at: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Rows (sparse: ``at``, ``value`` between ``first``) times ``dense``, a bounded number of products at a time."""
    out = np.zeros((len(first) - 1, dense.shape[1]))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for a in range(0, len(at), STEP):
        own = row[a : a + STEP]
        edge = np.flatnonzero(np.diff(own, prepend=-1))
        np.add.at(out, own[edge], np.add.reduceat(dense[at[a : a + STEP]] * value[a : a + STEP, None], edge))
    return out


def _latent(found: Counts, value: np.ndarray, dims: int = DIMS, seed: int = 13) -> np.ndarray:
    """The ``dims`` right singular vectors with the largest values, a row a bucket (randomised, two power steps)."""
    n = len(found.first) - 1
    order = np.argsort(found.bucket, kind="stable")
    doc = np.repeat(np.arange(n), np.diff(found.first))[order]
    turned = np.searchsorted(found.bucket[order], np.arange(BUCKETS + 1))
    q = np.random.default_rng(seed).normal(size=(BUCKETS, dims + 8))
    for _ in range(3):
        y, _ = np.linalg.qr(_product(found.first, found.bucket, value, q))
        q = _product(turned, doc, value[order], y)
    u, _, _ = np.linalg.svd(q, full_matrices=False)
    return u[:, :dims]


@dataclass
class Model:
    rarity: np.ndarray
    latent: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, found: Counts) -> np.ndarray:
        out = _product(found.first, found.bucket, _weights(found, self.rarity), self.latent)
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32)

    def scores(self, found: Counts) -> np.ndarray:
        vectors = self.project(found)
        out = np.full(len(vectors), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(vectors) if k else 0, BLOCK):
            near = vectors[a : a + BLOCK] @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(near, top, 1), 0).astype(float) ** SHARPNESS
            total = vote.sum(1)
            out[a : a + BLOCK] = np.where(total > 0, (vote * self.labels[top]).sum(1) / np.where(total > 0, total, 1), self.prior)
        return np.clip(out, 0, 1)


@F.arrow_udf(StructType([StructField("bucket", BinaryType()), StructField("count", BinaryType())]))
def _packed(texts: pa.Array) -> pa.Array:
    found = counts(texts)
    bucket, count = found.bucket.astype("<u2"), found.count.astype("<u4")
    edges = list(zip(found.first[:-1], found.first[1:], strict=True))
    return pa.StructArray.from_arrays([pa.array([x[a:b].tobytes() for a, b in edges], pa.binary()) for x in (bucket, count)], ["bucket", "count"])


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality") -> Model | None:
    """A model from at most ``2 * SAMPLE`` labelled rows that are not held out; None without labelled rows."""
    known = labels.where(~is_held_out(F.col("doc_id")) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = source.select("doc_id", F.xxhash64("text").alias("tag")).join(known, "doc_id").persist()
    try:
        sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}  # one row a label
        sample = None
        for y in sorted(sizes):
            drawn = rows.where(F.col("y") == y).distinct().orderBy(F.xxhash64("doc_id", "tag"), "doc_id", "tag").limit(SAMPLE)
            sample = drawn if sample is None else sample.union(drawn)
        if sample is None:
            return None
        # at most 2 * SAMPLE rows of three integers are broadcast; equal rows are one before they come back
        chosen = source.withColumn("tag", F.xxhash64("text")).join(F.broadcast(sample), ["doc_id", "tag"])
        found = chosen.select("doc_id", "tag", "y", _packed("text").alias("found")).groupBy("doc_id", "tag").agg(F.first("y").alias("y"), F.first("found").alias("found")).collect()
    finally:
        rows.unpersist()
    found.sort(key=lambda r: (r["doc_id"], r["tag"]))
    buckets = [np.frombuffer(r["found"]["bucket"], "<u2").astype(np.int64) for r in found]
    table = Counts(np.append(0, np.cumsum([len(b) for b in buckets])), np.concatenate(buckets), np.concatenate([np.frombuffer(r["found"]["count"], "<u4") for r in found]))
    rarity = np.log(1 + len(found) / (1 + np.bincount(table.bucket, minlength=BUCKETS)))
    value = _weights(table, rarity)
    prior = sum(n for y, n in sizes.items() if y) / sum(sizes.values())
    model = Model(rarity, _latent(table, value).astype(np.float32), np.empty((0, DIMS), np.float32), np.empty(0), prior)
    vectors, y = model.project(table), np.array([float(r["y"] > 0) for r in found])
    some = np.abs(vectors).sum(1) > 0  # a text without features is near none
    model.vectors, model.labels = vectors[some], y[some]
    return model


def score(documents: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    if model is None:
        return source.select("doc_id", F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(shared.value.scores(counts(rows.column("text"))))], ["doc_id", "score"])

    return source.mapInArrow(run, "doc_id long, score double")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(documents, train(documents, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= DECISION).cast("int").alias("predicted"))
