import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from hitscope.llm import line_join
from hitscope.llm.textio import Words, words


def shingles(line):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """Rows must have ids of their own."""
    every = sorted((1 << 62 if d is None else d, i, shingles(line)) for d, t in rows for i, line in enumerate((t or "").split("\n")))
    gone = set()
    for n, (d, i, s) in enumerate(every):
        if s and any(100 * len(s & o) >= 75 * len(s | o) for _, _, o in every[:n] if o):
            gone.add((d, i))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for i, x in enumerate(lines) if (1 << 62 if d is None else d, i) not in gone]
        n = len(lines) - len(left)
        out.append((d, len(lines), n, "\n".join(left) if n else t))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('abcd')}{rng.randrange(40)}"
    pool = [[word() for _ in range(rng.choice([1, 3, 5, 8, 30, 60]))] for _ in range(25)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(pool)) if rng.random() < 0.7 else [word() for _ in range(rng.randrange(40))]
            for _ in range(rng.choice([0, 0, 1, 2])):
                if line:
                    line[rng.randrange(len(line))] = word()
            lines.append(rng.choice([" ", "  "]).join(x.upper() if rng.random() < 0.05 else x for x in line))
        rows.append((i * 37 % 1009, "\n".join(lines)))
    return rows


def got(frame):
    return sorted(map(tuple, line_join.deduplicate(frame).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, documents, seed):
    rows = corpus(seed)
    assert got(documents(rows).repartition(4)) == brute(rows)


def test_one_line_in_most_documents(spark, documents):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(50)]
    rows = []
    for i in range(120):
        line = list(base)
        line[rng.randrange(50)] = f"x{i}"
        rows.append((i, "the same line in all of them\n" + " ".join(line) + f"\nown {i} a b c d"))
    assert got(documents(rows)) == brute(rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "a b\n"), (5, "A  b\nq"), (None, "q\nz"), (7, "é " * 9000), (8, "\n" + "é " * 9000 + "\n \n"), (9, "x\r\ny\r\nx")]
    frame = documents([(a, b, 2) for a, b in rows], ", __places int")
    assert got(frame) == brute(rows)
    assert got(documents([])) == []
    twice = got(documents([(1, "a\nb\na"), (1, "a\nb\na"), (2, "b\nc")]))
    assert twice == [(1, 3, 1, "a\nb"), (1, 3, 1, "a\nb"), (2, 2, 1, "c")]


def test_remove_keeps_columns_and_drops_emptied_documents(spark, documents):
    frame = documents([(1, "one two\nthree", 5), (2, "three\none  two", 5), (3, "", 5), (4, "three\nfour", 5)], ", n_lines int")
    out = line_join.remove(frame)
    assert out.columns == frame.columns
    assert sorted(map(tuple, out.collect())) == [(1, "one two\nthree", 5), (3, "", 5), (4, "four", 5)]


def test_very_long_lines_and_texts(spark, documents):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long + "\nshort line"), (2, long + " more\nother words here"), (3, "a\n" * 50_000), (4, "x" * 400_000)]
    out = {r.doc_id: (r.n_lines, r.n_removed) for r in line_join.deduplicate(documents(rows)).collect()}
    assert out[1] == (2, 0) and out[2] == (2, 1) and out[3] == (50_001, 49_999) and out[4] == (1, 0)


def thue_morse(a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(1024))


def test_words_that_collide_under_a_polynomial_hash_stay(spark, documents):
    x, y = thue_morse("a", "b"), thue_morse("b", "a")
    out = {r.doc_id: r.n_removed for r in line_join.deduplicate(documents([(1, f"{x} c d"), (2, f"{y} c d"), (3, f"{x} c d")])).collect()}
    assert out == {1: 0, 2: 0, 3: 1}


def test_sets_of_lines_with_repeated_shingles():
    rng = random.Random(6)
    texts = ["\n".join(" ".join(rng.choice("ab" if i % 2 else "abcdefgh") for _ in range(rng.randrange(30))) for _ in range(i % 9)) for i in range(80)] + ["", None, "\n" * 3]
    values, at, text, place = line_join._line_sets(pa.array(texts))
    lines = [(n, i, shingles(line)) for n, t in enumerate(texts) for i, line in enumerate((t or "").split("\n"))]
    assert [(n, i) for n, i, _ in lines] == list(zip(text.tolist(), place.tolist(), strict=True))
    by_set: dict = {}
    for (_, _, s), a, b in zip(lines, at[:-1], at[1:], strict=True):
        got = values[a:b].tolist()
        assert len(set(got)) == len(got) == len(s)
        by_set.setdefault(frozenset(s), set()).add(frozenset(got))
    assert all(len(x) == 1 for x in by_set.values()) and len(set.union(*by_set.values())) == len(by_set)


def test_distinct_past_the_lines_that_have_numbers_of_their_own():
    rng = np.random.default_rng(7)
    line = np.sort(rng.integers(0, 3 << 20, 300_000))
    values = rng.integers(0, 3, len(line)).astype(np.uint64) << np.uint64(62)
    got, at = line_join._distinct(values, np.searchsorted(line, np.arange((3 << 20) + 1)))
    pairs = list(zip(np.repeat(np.arange(len(at) - 1), np.diff(at)).tolist(), got.tolist(), strict=True))
    assert len(pairs) == len(set(pairs)) and set(pairs) == set(zip(line.tolist(), values.tolist(), strict=True))


def test_words_of_lines_are_not_looked_up_byte_by_byte(monkeypatch):
    """three passes over all texts make the sets, most of their time went into hashes()."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 12))) for _ in range(5000)]
    texts = pa.array(["\n".join(" ".join(rng.choices(vocabulary, k=50)) for _ in range(10)) for _ in range(150)])
    found = words(texts)

    def least(run):
        times = []
        for _ in range(9):
            began = time.process_time()
            run()
            times.append(time.process_time() - began)
        return min(times)

    assert least(lambda: found.keys(lower=True)) < least(lambda: found.hashes(lower=True))
    monkeypatch.delattr(Words, "hashes")
    assert len(line_join._line_sets(texts)[0]) == 150 * 10 * 46


def test_candidates_carry_the_earliest_line_of_their_class():
    same, other = "one two three four five six", "q r s t u v w"
    rows = pa.record_batch({"doc": [9, 3, 3, 5], "tag": [1, 8, -7, 2], "text": [same, f"{other}\n{same}\n{same}", f"\n\n{same}", other]})

    class Every:
        value = type("Table", (), {"may_repeat": staticmethod(lambda x: np.ones(len(x), bool))})

    (out,) = line_join._candidates(Every, Every, frozenset())(iter([rows]))
    assert sorted((r["doc"], r["tag"], r["place"], r["size"], len(r["tokens"])) for r in out.to_pylist()) == [(3, -7, 2, 2, 2), (3, 8, 0, 3, 3)]


def test_classes_that_only_their_own_copies_kept_go(spark, documents, monkeypatch):
    """copies of a line made all its shingles look common, and its class went through every join."""
    lines = [" ".join(f"w{i}x{k}" for k in range(20)) for i in range(30)]
    near = [" ".join(f"n{k}" for k in range(40)), " ".join(f"n{k}" for k in range(39)) + " other"]
    rows = [(i, line) for i, line in enumerate([*lines, *lines, *near])]
    kept, stored = {}, line_join._stored
    monkeypatch.setattr(line_join, "_stored", lambda frame, name: kept.setdefault(name, stored(frame, name)))
    assert got(documents(rows).repartition(4)) == brute(rows)
    assert kept["classes"].count() == 2 and kept["lists"].select("key").distinct().count() == 2
