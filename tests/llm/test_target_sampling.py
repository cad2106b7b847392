import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from hitscope.llm import crc, target_sampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, target, percent=10, least=20, run=1, buckets=10_000, key="2024"):
    def features(text):
        ws = WORD.findall(lowered(text))
        return ws, [zlib.crc32(" ".join(ws[i : i + n]).encode()) % buckets for n in range(1, run + 1) for i in range(len(ws) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for b in features(text)[1]:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    s_all, t_all = float(sum(s)), float(sum(t))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        ws, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"{key}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(ws)])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(fit[: len(fit) * percent // 100])}
    return sorted((tuple(r[:4]) + (rank.get(id(r)),) for r in out), key=str)


def text_of(i):
    return " ".join(f"W{(i * 31 + k * k) % 97}x" for k in range((i * 7) % 45))


ROWS = [(i, text_of(i)) for i in range(400)] + [(None, text_of(6)), (None, text_of(6)), (5, text_of(6)), (5, text_of(6)), (5, None), (1 << 60, "é" * 30 + " ÀB" * 25), (77777, ""), (88888, "\x00-/ 12a.34B")]
TARGET = [text_of(i) for i in range(0, 30, 4)] + [None, ""]


def got(documents, rows, target, **options):
    frame = documents([(d, t, "s") for d, t in rows], ", source string")
    goal = documents([(i, t) for i, t in enumerate(target)])
    return sorted((tuple(r) for r in target_sampling.draw(frame, goal, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"percent": 100, "least_words": 0}, {"percent": 37, "buckets": 50, "run": 3, "least_words": 3}])
def test_against_brute_force(documents, options):
    want = brute(ROWS, TARGET, **({"least": options["least_words"]} if "least_words" in options else {}), **{k: v for k, v in options.items() if k != "least_words"})
    assert got(documents, ROWS, TARGET, **options) == want


def test_many_equal_scores_are_cut_by_doc_id_and_then_by_row(documents):
    """Without features all weights are 0; rows with one id share their noise."""
    rows = [(i // 50, "") for i in range(1000)] + [(None, "")] * 30
    want = brute(rows, [], percent=23, least=0)
    assert got(documents, rows, [], percent=23, least_words=0) == want


def test_a_cutoff_of_equal_rows(documents):
    rows = [(9, "a b")] * 40
    out = got(documents, rows, ["a"], percent=50, least_words=0)
    assert sorted(r[4] for r in out if r[4] is not None) == list(range(1, 21)) and len(out) == 40


@pytest.mark.parametrize("ways", [7, 1024])
def test_bisection_finds_every_place(spark, monkeypatch, ways):
    monkeypatch.setattr(target_sampling, "WAYS", ways)
    values = [-(1 << 63), -5, -5, -4, 0, 0, 0, 7, (1 << 63) - 1]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    for n in (1, 3, 6, 9):
        value, below, at = target_sampling._nth(frame, "v", n)
        assert (value, below, at) == (sorted(values)[n - 1], sum(v < value for v in values), values.count(value))


def test_empty_tables(documents):
    assert got(documents, [], []) == [] and got(documents, [], ["a b"]) == []
    assert got(documents, [(1, None)], []) == brute([(1, None)], [])


def test_a_very_long_text_and_a_very_long_word(documents):
    rows = [(1, "ab cd " * 300_000), (2, "x" * 1_000_000 + " y" * 30), (3, "ab " * 25)]
    assert got(documents, rows, ["ab", "x y"], percent=67) == brute(rows, ["ab", "x y"], percent=67)


def test_clashing_columns(spark):
    names = ["doc_id", "text", "rank", "score", "bucket", "row", "place", "weight"]
    frame = spark.createDataFrame([(i, text_of(i), 1, 2, 3, 4, 5, 6) for i in range(60)], names)
    out = target_sampling.draw(frame, frame.limit(3), percent=50)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and out.count() == 60
    kept = target_sampling.selected(frame, frame.limit(3), percent=50)
    assert kept.columns == names and kept.count() == out.where("rank IS NOT NULL").count() > 0


def test_crc_of_ranges():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    start = rng.integers(0, 4000, 300)
    end = start + np.concatenate([np.arange(0, 150), rng.integers(0, 1000, 150)])
    seed = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    assert crc.crc32_ranges(data, start, end).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(start, end)]
    assert crc.crc32_ranges(data, start, end, seed).tolist() == [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, seed)]
