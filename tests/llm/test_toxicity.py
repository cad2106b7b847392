import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hitscope.llm import toxicity

BAD = ["zorgling", "zorglet", "zorgion", "mudhat", "mudhats"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aeioudnrst") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(base) for _ in range(rng.randrange(5, 60))]
        y = int(rng.random() < 0.3)
        for _ in range(y * rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus(1200)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, marks, toxicity.train(docs, marks), dict(labels), rows


def test_held_out_accuracy(fitted):
    docs, marks, _, label, _ = fitted
    got = toxicity.classify(docs, marks).collect()
    assert len(got) == 1200
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in label if zlib.crc32(str(i).encode()) % 3 == 1}
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def test_scores_do_not_depend_on_batches(fitted):
    _, _, model, _, rows = fitted
    texts = [t for _, t in rows[:40]] + [""]
    together = model.scores(pa.array(texts))
    alone = [model.scores(pa.array([t]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_held_out_labels_are_not_used(spark, fitted):
    docs, marks, model, _, _ = fitted
    wrong = marks.withColumn("toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.train(docs, wrong)
    assert np.array_equal(model.embeddings, other.embeddings)


def test_odd_rows(spark, fitted):
    _, marks, model, _, _ = fitted
    rows = [(1, None, 1), (2, "", 1), (3, "\n ", 1), (None, "x " * 100_000, 1), (4, "é", 1), (4, "é", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = toxicity.score(frame, model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.classify(frame, none).collect()] == [0.0] * 6
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.classify(empty, marks).collect() == []


def test_clean_documents_keep_their_columns(fitted):
    docs, marks, _, label, _ = fitted
    frame = docs.withColumn("score", F.lit(3))
    out = toxicity.clean_documents(frame, marks)
    assert out.columns == frame.columns
    left = {r.doc_id for r in out.collect()}
    assert np.mean([(i in left) == (y == 0) for i, y in label.items()]) > 0.95


def test_long_texts_leave_no_gap_in_the_sample(spark, monkeypatch):
    """The sample has as many rows a label as it may, whatever their length, and copies of a labelled row count once."""
    monkeypatch.setattr(toxicity, "SAMPLE", 4)
    sizes = []
    monkeypatch.setattr(toxicity, "_fit", lambda texts, known_words: sizes.append((len(texts), max(len(t) for t, _ in texts), len(known_words))) or toxicity.Model(np.zeros((toxicity.BUCKETS, toxicity.WIDTH), np.float32), [np.zeros((s, toxicity.WIDTH, toxicity.FILTERS), np.float32) for s in toxicity.SIZES], [np.zeros(toxicity.FILTERS, np.float32) for _ in toxicity.SIZES], np.zeros(toxicity.FILTERS * len(toxicity.SIZES)), 0.0))
    rows = [(i, "a b c " * (10_000 if i % 10 else 1)) for i in range(300)]
    docs = spark.createDataFrame(rows + [rows[5]] * 50, "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(i, i // 10 % 2) for i, _ in rows], "doc_id long, toxic int"))
    assert sizes == [(6, 30_000, 3)]


def test_rows_outside_the_start_are_learned(spark, monkeypatch):
    """Words that mark toxic texts only in rows that the start was not drawn from are learned all the same."""
    monkeypatch.setattr(toxicity, "SAMPLE", 60)
    rows, labels = corpus(2400, seed=3)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    order = marks.where(~toxicity.is_held_out(F.col("doc_id")) & (F.col("toxic") == 1)).orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = {r.doc_id for r in order.limit(toxicity.SAMPLE).collect()}
    label, bad = dict(labels), dict.fromkeys(BAD, "vexquibble")
    rows = [(i, t if i in drawn else " ".join(bad.get(w, w) for w in t.split())) for i, t in rows]
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), marks)
    held = [(t, label[i]) for i, t in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    predicted = model.scores(pa.array([t for t, _ in held])) >= toxicity.DECISION
    assert np.mean(predicted == [bool(y) for _, y in held]) > 0.9
