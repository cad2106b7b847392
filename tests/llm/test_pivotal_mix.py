import re
from collections import defaultdict

import pytest

from hitscope.llm import pivotal_mix

ROWS = [(i, " ".join(["w"] * (1 + (i * 37) % 90)), ["a", "b", "é", None][i % 7 if i % 7 < 4 else 0]) for i in range(600)]


def water_level(size, share=1.5, weights=(3, 1, 2), cap=2.0):
    names = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + ([None] if None in size else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(size.values()), set(names), {}
    while open_:
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if each[s] > cap * size[s]]
        if not over:
            return out | each
        for s in over:
            out[s] = cap * size[s]
            left -= out[s]
            open_.remove(s)
    return out


def check(got, rows):
    size, taken, target = defaultdict(int), defaultdict(int), {}
    source = {(d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): s for d, t, s in rows}
    longest = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id, r.size]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        longest[s] = max(longest[s], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    want = water_level(size)
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= longest[s]


def test_targets_and_taken_words(spark, documents):
    got = pivotal_mix.summary(documents(ROWS, ", source string")).collect()
    check(got, ROWS)


def test_many_blocks_and_levels(spark, documents, monkeypatch):
    monkeypatch.setattr(pivotal_mix, "BLOCK_ROWS", 8)
    monkeypatch.setattr(pivotal_mix, "FAN_IN", 4)
    frame = documents(ROWS, ", source string")
    got = pivotal_mix.summary(frame).collect()
    check(got, ROWS)
    again = pivotal_mix.summary(frame.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_expected_copies(spark, documents):
    """Over many seeds each document is taken as often as its ratio says."""
    rows = [(i, "w " * (1 + i % 5), "a" if i % 3 else "b") for i in range(30)]
    frame = documents(rows, ", source string").coalesce(1)
    total = defaultdict(int)
    for seed in range(5):
        for r in pivotal_mix.mix(frame, seed=seed).collect():
            total[r.source] += r.copies * r.size / r.target
    for s in ("a", "b"):
        assert total[s] / 5 == pytest.approx(1, abs=0.1)


def test_odd_rows(spark, documents):
    rows = [(1, None, "a"), (2, "", None), (3, "x y", None), (3, "x y", None), (None, "z", "b"), (5, "\t\n", "b")]
    got = pivotal_mix.summary(documents(rows, ", source string")).collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2), (5, 0)]
    assert pivotal_mix.summary(documents([], ", source string")).collect() == []


def test_repeated_keeps_columns(spark, documents):
    frame = documents([(a, b, c, 5) for a, b, c in ROWS[:50]], ", source string, copies int")
    picks = {r.doc_id: r.copies for r in pivotal_mix.mix(frame).collect()}
    out = pivotal_mix.repeated(frame)
    assert out.columns == frame.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id] += 1
    assert {d: c for d, c in picks.items() if c} == dict(seen)


def test_large_ids_beside_a_null_one(documents):
    ids = [(1 << 60) + 1, (1 << 60) + 3, None, -(1 << 62) - 1]
    got = pivotal_mix.summary(documents([(i, "a b c", "s") for i in ids], ", source string")).collect()
    assert sorted((r.doc_id for r in got if r.doc_id is not None)) == sorted(i for i in ids if i is not None) and len(got) == 4


def test_repeated_rows_are_documents_of_their_own(documents, monkeypatch):
    """Sizes, targets and what is taken count every row; equal rows share the copies of their group."""
    monkeypatch.setattr(pivotal_mix, "CHUNK", 3)
    rows = [(1, "a b c d", "s")] * 4 + [(2, "a b c d", "s")] + [(3, "x " * 7, "t")] * 20 + [(None, "z", None)] * 9
    frame = documents(rows, ", source string")
    got = pivotal_mix.summary(frame).collect()
    check(got, rows)
    assert {r.source_size for r in got if r.size == 4} == {20}
    copies = {(r.doc_id, r.number): r.copies for r in pivotal_mix.mix(frame).collect()}
    assert sorted(n for d, n in copies if d == 3) == list(range(20))
    out = pivotal_mix.repeated(frame.repartition(5)).collect()
    for doc_id in (1, 2, 3, None):
        assert sum(r.doc_id == doc_id for r in out) == sum(c for (d, _), c in copies.items() if d == doc_id)
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in got)


def test_numbers_of_equal_rows(spark):
    frame = spark.range(200).selectExpr("if(id % 3 = 0, null, 'k') AS k", "id AS v").repartition(6)
    out = pivotal_mix._numbered(frame, ["k"], "number").collect()
    assert sorted(r.number for r in out if r.k is None) == list(range(67)) and sorted(r.number for r in out if r.k) == list(range(133))


def test_a_very_long_text(documents):
    got = pivotal_mix.summary(documents([(1, "w " * 500_000, "a"), (2, "x" * 1_000_000, "a"), (3, "y z", "b")], ", source string")).collect()
    assert {r.doc_id: r.size for r in got} == {1: 500_000, 2: 1, 3: 2}
