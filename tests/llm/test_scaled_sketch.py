import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hitscope.llm import scaled_sketch


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def hashes(fingerprint):
    return {fingerprint[i : i + 8] for i in range(0, len(fingerprint), 8)}


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}é" for i in range(300)]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 5, 30, 900])))) for i in range(n)]
    return rows + [(1000, rows[5][1] + "  "), (1001, rows[5][1])]


def check(rows, got):
    rows = sorted({(d, t or "") for d, t in rows}, key=lambda r: -(r[0] if r[0] is not None else -1))
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, (doc, text) in enumerate(rows):
        follow = rows[(i + 1) % len(rows)]
        k = len(text) // 3
        edited = text[: len(text) - k] + follow[1][:k]
        r = by[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, beside = hashes(r.fingerprint), hashes(r.edited_fingerprint), hashes(by[follow[0]].fingerprint)
        assert r.near_edited == pytest.approx(jaccard(own, other)) and r.near_next == pytest.approx(jaccard(own, beside))
        assert bool(own) == bool(text.split())
        if len(shingles(text)) > 500:
            assert r.near_edited == pytest.approx(jaccard(shingles(text), shingles(edited)), abs=0.2)


def test_against_brute_force(spark, documents):
    rows = corpus()
    frame = documents([(a, b, 1) for a, b in rows], ", size int").repartition(7)
    got = scaled_sketch.fingerprints(frame).collect()
    check(rows, got)
    by = {r.doc_id: r for r in got}
    assert by[1001].fingerprint == by[15].fingerprint


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "x"), (4, "x"), (None, "a b c d e f"), (7, "é" * 40_000 + " b")]
    check(rows, scaled_sketch.fingerprints(documents(rows)).collect())
    check([(5, "one two three")], scaled_sketch.fingerprints(documents([(5, "one two three")])).collect())
    assert scaled_sketch.fingerprints(documents([])).collect() == []


def test_containment_and_merging(spark, documents):
    rng = random.Random(1)
    long = [f"v{rng.randrange(5000)}" for _ in range(8000)]
    frame = documents([(1, " ".join(long))]).withColumn("part", F.lit(" ".join(long[1000:1800])))
    frame = scaled_sketch.with_sketch(scaled_sketch.with_sketch(frame, "text", "whole"), "part", "piece")
    whole, piece = F.col("whole"), F.col("piece")
    r = frame.select(
        scaled_sketch.containment(piece, whole).alias("c"), scaled_sketch.likeness(piece, whole).alias("l"),
        (scaled_sketch.merged(whole, piece) == whole).alias("m"), F.size("whole").alias("n"),
    ).first()
    assert r.c > 0.98 and r.l < 0.15 and 800 < r.n < 1200 and r.m in (True, False)


def test_no_python_in_the_plan(spark, documents):
    plan = scaled_sketch.fingerprints(documents(corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_hashes_are_wide_enough_for_merged_sketches(spark, documents):
    """Of 63-bit hashes none agree by chance; the extra smallest hash of a short text is no evidence against a long one."""
    frame = documents([(1, "")]).select(F.expr("transform(sequence(1, 400000), i -> concat('w', i))").alias("w"))
    frame = frame.select(F.array_join("w", " ").alias("text"))
    size = scaled_sketch.with_sketch(frame, "text", "s").select(F.size("s").alias("n"), F.array_max("s").alias("top")).first()
    assert size.top >> 48 and 49_000 < size.n < 51_000
    words = [f"v{i}" for i in range(200)]
    parts = documents([(i, " ".join(words[i : i + 5])) for i in range(150)]).withColumn("long", F.lit(" ".join(words)))
    both = scaled_sketch.with_sketch(scaled_sketch.with_sketch(parts, "text", "part"), "long", "whole")
    got = {r.c for r in both.select(scaled_sketch.containment(F.col("part"), F.col("whole")).alias("c")).collect()}
    assert got == {1.0, None}
    alone = both.select(scaled_sketch.containment(F.col("part"), F.col("part")).alias("c")).distinct().collect()
    assert [r.c for r in alone] == [1.0]


def test_a_very_long_text(spark, documents):
    long = " ".join(f"w{i}" for i in range(60_000))
    got = {r.doc_id: r for r in scaled_sketch.fingerprints(documents([(1, long), (2, "x" * 300_000), (3, long)])).collect()}
    assert got[1].fingerprint == got[3].fingerprint != got[2].fingerprint and got[1].n_chars == len(long)
    assert 0.4 < got[3].near_edited < 0.9
