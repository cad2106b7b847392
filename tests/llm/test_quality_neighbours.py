import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hitscope.llm import quality_neighbours as q

RNG = random.Random(5)
PLAIN = ["the", "river", "of", "stone", "and", "light", "was", "über", "green", "house", "in", "morning", "to", "old"]


def good(n):
    out = [RNG.choice(PLAIN) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 9 == 0 else w for i, w in enumerate(out))


def bad(n, kind):
    ws = [RNG.choice(PLAIN) for _ in range(n)]
    return [" ".join(w + RNG.choice(["###", "$$$"]) for w in ws), " | ".join(ws), " ".join(w.upper() + "!!" for w in ws), " ".join(w for w in ws for _ in range(4))][kind % 4]


ROWS = [(i, bad(20 + i % 40, i // 5) if i % 5 == 0 else good(15 + i % 60)) for i in range(600)]
LABELS = [(i, int(i % 5 != 0)) for i, _ in ROWS]


@pytest.fixture(scope="module")
def model(spark):
    return q.train(spark.createDataFrame(ROWS, "doc_id long, text string"), spark.createDataFrame(LABELS, "doc_id long, quality int"))


def test_held_out_accuracy_and_columns(spark):
    out = q.classify(spark.createDataFrame([(i, t, "src") for i, t in ROWS], "doc_id long, text string, source string"), spark.createDataFrame(LABELS, "doc_id long, quality int"))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(ROWS)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.predicted == int(r.doc_id % 5 != 0) for r in held) >= 0.98 * len(held)


def test_held_out_labels_change_no_score(spark, model):
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in LABELS]
    other = q.train(spark.createDataFrame(ROWS, "doc_id long, text string"), spark.createDataFrame(flipped, "doc_id long, quality int"))
    texts = pa.array([t for _, t in ROWS])
    assert np.array_equal(model.scores(q.counts(texts)), other.scores(q.counts(texts)))


def brute_counts(text):
    ws = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shapes = []
    for token in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        kinds = "".join("A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if c.isdigit() else c for c in token)
        shapes.append(re.sub(r"(.)\1+", r"\1", kinds, flags=re.S))
    return Counter(ws), Counter(shapes), sum(a == b for a, b in zip(ws, ws[1:]))


def test_features_against_brute_force():
    texts = [None, "", "Word word WORD wörd", "a1 b2## a1 ##", "x" * 100_000 + " y y y", *(t for _, t in ROWS[:40]), "ends a", "a starts"]
    found = q.counts(pa.array(texts))
    for i, text in enumerate(texts):
        own = dict(zip(found.bucket[found.first[i] : found.first[i + 1]].tolist(), found.count[found.first[i] : found.first[i + 1]].tolist()))
        ws, shapes, again = brute_counts(text)
        assert own.get(q._AGAIN, 0) == again
        assert sorted(n for b, n in own.items() if b < q.WORD_BUCKETS) == sorted(ws.values())
        assert sorted(n for b, n in own.items() if q.WORD_BUCKETS <= b < q._AGAIN) == sorted(shapes.values())


def test_votes_against_brute_force(model):
    found = q.counts(pa.array([t for _, t in ROWS[:60]]))
    vectors = model.project(found)
    for v, got in zip(vectors, model.scores(found)):
        near = sorted(((float(np.dot(v, w)), y) for w, y in zip(model.vectors, model.labels)), key=lambda x: -x[0])[: q.NEIGHBOURS]
        votes = [max(s, 0) ** q.SHARPNESS for s, _ in near]
        assert math.isclose(got, sum(a * y for a, (_, y) in zip(votes, near)) / sum(votes), abs_tol=2e-3)


def test_projection_keeps_what_the_full_decomposition_keeps():
    found = q.counts(pa.array([t for _, t in ROWS[:150]]))
    value = q._weights(found, np.ones(q.BUCKETS))
    dense = np.zeros((150, q.BUCKETS))
    dense[np.repeat(np.arange(150), np.diff(found.first)), found.bucket] = value
    assert np.allclose(np.linalg.norm(dense, axis=1), 1)
    latent = q._latent(found, value, 10)
    assert np.allclose(latent.T @ latent, np.eye(10), atol=1e-8)
    best = np.linalg.svd(dense, compute_uv=False)[:10]
    assert np.linalg.norm(dense @ latent) ** 2 >= 0.98 * (best**2).sum()


def test_nulls_empty_texts_repeated_rows_and_long_texts(spark):
    rows = ROWS + [(1000, None), (1001, ""), (None, good(30)), (3, good(40)), (5, bad(50, 0)), (5, bad(50, 0)), (2000, good(300_000)), (2001, bad(200_000, 1)), (2002, "z" * 2_000_000)]
    labels = LABELS + [(3, 0), (7, None), (None, 1), (2000, 1), (2001, 0), (1000, 1)]
    out = q.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    assert by_id[1000].score == by_id[1001].score and 0.5 < by_id[1000].score < 1
    assert by_id[None].held_out is False and by_id[2000].predicted == 1 and by_id[2001].predicted == 0


def test_copies_of_one_labelled_row_count_once(spark, model):
    rows = ROWS + [ROWS[5]] * 3000
    other = q.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(LABELS, "doc_id long, quality int"))
    assert len(other.labels) == len(model.labels)


def test_empty_tables_and_one_label(spark):
    none, some = spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    docs = spark.createDataFrame(ROWS[:30], "doc_id long, text string")
    assert {r.score for r in q.classify(docs, none).collect()} == {0.0}
    assert {r.score for r in q.classify(docs, some).collect()} == {1.0}
    assert q.classify(docs.limit(0), some).collect() == []


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in ROWS[:50]], ["doc_id", "text", "score", "y", "tag", "found"])
    labels = spark.createDataFrame([(i, y, "x", 9) for i, y in LABELS], ["doc_id", "quality", "text", "y"])
    assert q.classify(frame, labels).count() == 50
